"""Periodic runs, hard negatives and interleaved shards: brute force and small hand-made cases."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import interleave, negatives, periodic, url_rules

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard string, slot string, row string, runs long, rank string, s string"


def documents(spark, rows):
    """(doc_id, text, source) rows with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "k", "h", "r", 1, "x", "y") for i, t, s in rows], DOCS)


def brute_runs(w, min_length, min_exponent):
    found = {}
    for q in range(1, len(w) // min_exponent + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - start + q >= max(min_length, min_exponent * q):
                found.setdefault((start, i - start + q), q)
            i += 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_against_brute_force():
    pick = np.random.default_rng(3)
    for k in range(600):
        w = pick.integers(0, pick.integers(1, 4), pick.integers(0, 70))
        if k % 2 and len(w):
            a, p = int(pick.integers(0, len(w))), int(pick.integers(1, 9))
            w = np.concatenate([w[:a], np.resize(w[a : a + p], len(w) - a), w[:3]])
        for least, exponent in ((6, 4), (2, 2), (12, 3)):
            assert periodic.runs_of(w, least, exponent) == brute_runs(w.tolist(), least, exponent)
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(9, np.int64), 6, 1)


def test_runs_of_long_texts():
    pick = np.random.default_rng(4)
    once = pick.integers(0, 10_000, 5_000)
    w = np.concatenate([np.full(40_000, 20_000), once, np.tile(once[:700], 30)])
    # The tiled words begin right after a copy of their own first words.
    assert periodic.runs_of(w) == [(0, 40_000, 1), (45_000, 21_000, 700)]


def test_runs_cases(spark):
    loop = "a b c " * 5
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", "a"), (None, loop, None), (4, "x " + loop + "y", "b"), (4, "x " + loop + "y", "b"), (5, "one", "b")]
    rows += [(6, "é é é é é é ü", "c"), (7, "no run at all here", "c"), (8, " z z z " * 4, "c")]
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic.periodic_runs(documents(spark, rows)).collect()]
    assert got[:4] == [(1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (None, 15, [(0, 15, 3)], "a b c")]
    assert got[4] == got[5] == (4, 17, [(1, 15, 3)], "x a b c y") and got[6] == (5, 1, [], "one")
    assert got[7] == (6, 7, [(0, 6, 1)], "é ü") and got[8][2] == []
    assert got[9][1:3] == (8, [(0, 8, 2)])  # other blanks are parts of words
    plain = periodic.digests(periodic.periodic_runs(documents(spark, rows)))
    by = {r["doc_id"]: r for r in plain.collect()}
    assert by[1]["n_runs"] == 0 and by[1]["start"] is None and by[1]["exponent_milli"] is None
    assert by[1]["runs_sha256"] == by[1]["collapsed_sha256"] == hashlib.sha256(b"").hexdigest()
    assert (by[4]["start"], by[4]["length"], by[4]["period"], by[4]["exponent_milli"]) == (1, 15, 3, 5000)
    assert by[4]["runs_sha256"] == hashlib.sha256(b"1,15,3\n").hexdigest()
    assert periodic.periodic_runs(documents(spark, rows).limit(0)).count() == 0


def test_longest_run_ties(spark):
    text = "p p p p p p m " + "q q q q q q n " + "k l k l k l k l"
    r = periodic.digests(periodic.periodic_runs(documents(spark, [(1, text, "a"), (2, text[: text.index("k")], "a")]))).collect()
    assert (r[0]["n_runs"], r[0]["start"], r[0]["length"]) == (3, 14, 8)
    assert (r[1]["n_runs"], r[1]["start"], r[1]["length"], r[1]["period"]) == (2, 0, 6, 1)


def test_planted_tails():
    words = [b"%d" % k for k in range(100)]
    seen = 0
    for doc in range(200):
        out, h = periodic.periodic_tail(doc, words), zlib.crc32(str(doc).encode())
        if h % 10:
            assert out == words
            continue
        seen += 1
        a = h // 10 % 100
        p = 1 + (100 - a) // (3 + h // 10 % 8)
        assert len(out) == 100 and out[: a + p] == words[: a + p] and all(out[i] == out[i - p] for i in range(a + p, 100))
    assert seen and periodic.periodic_tail(None, words) == words and periodic.periodic_tail(4, []) == []


VECTORS = "vec_id long, embedding array<double>, label int, row string, n string, piece long, v string, key string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, lab, "a", "b", 3, "c", "d") for i, v, lab in rows], VECTORS).repartition(3)


def brute_negatives(rows, positives=5, negatives_=10, low=30, high=90):
    clean = [
        (k, i, lab, [int(np.floor(256 * x)) for x in v])
        for k, (i, v, lab) in enumerate(rows)
        if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for k, i, lab, v in clean:
        if i % 100:
            continue
        score = [(sum(a * b for a, b in zip(v, u)), j, other) for m, j, other, u in clean if m != k and len(u) == len(v)]
        near = sorted((-s, j) for s, j, other in score if other == lab)[:positives]
        for s, j in near:
            hard = sorted((-t, m) for t, m, other in score if other != lab and low * -s <= 100 * t <= high * -s)[:negatives_]
            out += [(i, j, r + 1, m, -s, -t) for r, (t, m) in enumerate(hard)]
    return sorted(out)


def mined_rows(df, **options):
    got = negatives.mined(df, F.col("vec_id") % 100 == 0, **options)
    return sorted(tuple(r) for r in got.collect())


def test_negatives_against_brute_force(spark):
    pick = np.random.default_rng(9)
    rows = [(int(i), [float(x) for x in pick.normal(size=24) * np.linspace(3, 0.05, 24)], int(pick.integers(0, 3))) for i in range(700)]
    rows += [(i, v, lab) for i, v, lab in rows[:120]]  # repeated rows and ids
    rows += [(200, [0.25] * 5, 1), (201, [0.5] * 5, 1), (202, [0.3] * 5, 2), (300, [0.0] * 24, 1)]
    rows += [(400, None, 1), (500, [], 1), (600, [float("nan")] + [1.0] * 23, 1), (700, [None] + [1.0] * 23, 0), (None, [1.0] * 24, 0), (800, [1.0] * 24, None)]
    for options in ({}, {"shard_rows": 64}):
        assert mined_rows(vectors(spark, rows), **options) == brute_negatives(rows)
    assert mined_rows(vectors(spark, rows[:0])) == []


def test_negatives_few_and_tied(spark):
    same = [(100 * i, [1.0, 0.0, 0.0], 0) for i in range(4)] + [(k, [0.5, 0.1, 0.0], 1) for k in (9, 7, 8)] + [(50, [-1.0, 0.0, 0.0], 2)]
    got = mined_rows(vectors(spark, same))
    assert got == brute_negatives(same)
    assert [r[3] for r in got if r[:2] == (0, 100)] == [7, 8, 9]
    assert mined_rows(vectors(spark, [(100, [1.0], 0), (1, [1.0], 1)])) == []  # no positive
    assert mined_rows(vectors(spark, [(100, [1.0], 0), (2, [-1.0], 0), (1, [1.0], 1)])) == []  # window below zero
    huge = [(100, [1e30, 1.0], 0), (1, [1e30, 1.0], 0), (2, [5e5, 1.0], 1)]
    assert all(abs(r[4]) < 1 << 62 for r in mined_rows(vectors(spark, huge)))


def test_threshold_join_is_complete():
    pick = np.random.default_rng(2)
    x = np.floor(pick.normal(size=(3000, 40)) * np.linspace(200, 1, 40)).astype(np.int64)
    for floor in (-np.inf, 150_000.0):
        index = negatives.Index(x, floor, np.sqrt((x * x).sum(axis=1)).max())
        for y in x[:40]:
            for t in (150_000, 200_000, 400_000):
                want = x @ y
                found, score = index.at_least(y, t)
                assert sorted(found) == np.flatnonzero(want >= t).tolist() and (score == want[found]).all()
    built = sum(len(v) for _, _, v in index.lists)
    assert built < 3000 * len(index.lists)  # postings below the floor are not there


def test_shards_follow_the_mixture(spark):
    pick = np.random.default_rng(6)
    rows = [(int(i), f"t{i}", str(pick.choice(["big", "mid", "small"], p=[0.7, 0.25, 0.05]))) for i in range(2003)] + [(5000 + i, None, None) for i in range(160)]
    got = interleave.interleaved(documents(spark, rows), shards=16).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _, _ in rows)
    shards, total = defaultdict(list), Counter(s for _, _, s in rows)
    for r in got:
        shards[r["shard"]].append(r)
    assert set(shards) == set(range(16)) and {len(x) for x in shards.values()} <= {2163 // 16, 2163 // 16 + 1}
    for x in shards.values():
        assert sorted(r["slot"] for r in x) == list(range(len(x)))
        mix = Counter(r["source"] for r in x)
        assert all(abs(mix[s] - n / 16) <= 2 for s, n in total.items())
    again = interleave.interleaved(documents(spark, rows[::-1]), shards=16).collect()
    assert {(r["doc_id"], r["shard"], r["slot"]) for r in again} == {(r["doc_id"], r["shard"], r["slot"]) for r in got}
    other = interleave.interleaved(documents(spark, rows), shards=16, seed=1).collect()
    assert {(r["doc_id"], r["shard"]) for r in other} != {(r["doc_id"], r["shard"]) for r in got}


def test_shards_cases(spark, tmp_path):
    rows = [(None, None, None), (None, "x", "a"), (1, "same", "a"), (1, "same", "a"), (2, "", "b"), (3, "y " * 50_000, "b")]
    got = interleave.interleaved(documents(spark, rows))
    assert got.columns == [c for c in documents(spark, rows).columns if c not in ("shard", "slot")] + ["shard", "slot", "law"]
    assert {r["slot"] for r in got.collect()} == {0} and got.select("shard").distinct().count() == 6
    assert interleave.interleaved(documents(spark, rows[:0])).count() == 0
    docs = documents(spark, [(i, "t", "ab"[i % 2]) for i in range(100)])
    interleave.write_shards(docs, f"{tmp_path}/out", shards=4, file_rows=10)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 100 and {r["count"] for r in back.groupBy("shard").count().collect()} == {25}
    assert back.groupBy("shard", "part").count().agg(F.max("count")).first()[0] == 10


def test_host_rules_stop_at_the_path(spark):
    """Blanks in the path (or the host) never let a rule match inside the path."""
    urls = ["http://foo.org/x.net /fr/1", "http://foo.org/docs.example.com /en/z", "http://foo.org/a.com /b", "http://a b.net/fr/1", "http://x.net y/fr/1", "http://NET/fr/", "http://barnet/fr/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r["page_id"]: r["rule"] for r in url_rules.judge(pages, url_rules.rule_table(spark)).collect()}
    assert got == {0: None, 1: None, 2: None, 3: "net/fr/", 4: None, 5: "net/fr/", 6: None}
