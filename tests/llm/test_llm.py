"""Operators for training data: against SQL, brute force and small hand-made cases."""

import hashlib
import re
import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barloom.llm import graph, hashing, jaccard, mixing, passages, pii, preferences, secret_scan, templates, toxicity, url_rules, vantage
from barloom.llm.registry import ORACLES
from compare import differences, spark_rows, sql_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, hash string, size long"


def documents(spark, rows):
    """(doc_id, text, source) rows with extra columns whose names clash with inner ones."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "k", "h", 1) for i, t, s in rows], DOCS)


COUNTS = jaccard.counts
WORDS = [f"w{i}" for i in range(500)]


def prose(seed, n):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, con, name):
    got, cols = spark_rows(entry.queries()[name](spark, data))
    want, sql_cols = sql_rows(con, ORACLES[name])
    assert cols == sql_cols
    assert differences(got, want, cols) == ""


@pytest.fixture(scope="module")
def odd(spark):
    long = prose(1, 30_000)
    rows = [(1, None, "a"), (2, "", None), (3, " \t ", "a"), (None, prose(2, 40), "b"), (4, prose(3, 60), None), (4, prose(3, 60), None)]
    rows += [(5, prose(3, 60), "a"), (6, "two words", "a"), (7, "TWO words", "b"), (8, long, "a"), (9, long + " tail", "b")]
    return documents(spark, rows)


def test_secrets_cases(spark, odd):
    assert secret_scan.secret_spans(odd).count() == odd.count()
    live = 'x token = "Zk81hQp0s7TtL2vB9xYw" y'
    rows = [(i, f'secret: "copied0copied1ab{0}zXq"', f"s{i}") for i in range(4)] + [(10, live, "s1"), (11, None, "s1")]
    out = {r["doc_id"]: r["text"] for r in secret_scan.redacted(documents(spark, rows)).collect()}
    assert "Zk81" not in out[10] and "[secret]" in out[10] and out[11] is None
    assert all("copied0" in out[i] for i in range(4))
    assert secret_scan.secret_spans(odd.limit(0)).count() == 0


def test_mix_cases(spark, odd):
    rows = mixing.plan(mixing.sized(odd), ["doc_id"]).collect()
    assert len(rows) == odd.count()
    taken, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    mixed = mixing.mixed(odd).groupBy().sum("taken").first()[0]
    assert mixed == sum(taken.values())
    assert mixing.plan(mixing.sized(odd.limit(0)), ["doc_id"]).count() == 0


def test_passages_cases(spark, odd):
    p = passages.deduplicated(odd)
    got = {(r["doc_id"], r["n_words"]): r["n_removed"] for r in p.collect()}
    assert got[5, 60] == 60 and got[4, 60] == 0 and got[9, 30_001] == 30_000 and got[8, 30_000] == 0 and got[1, 0] == 0
    assert passages.deduplicated(odd.limit(0)).count() == 0


def test_fm_index_against_search():
    pick = np.random.default_rng(5)
    words = [b" ".join(b"v%d" % x for x in pick.integers(0, 4, pick.integers(13, 40))) for _ in range(60)]
    docs = pick.integers(0, 30, 60)
    least = passages.removable(words, docs)
    holders = defaultdict(list)
    for w, d in zip(words, docs):
        s = w.split()
        for i in range(len(s) - 12):
            holders[tuple(s[i : i + 13])].append(int(d))
    for w in words:
        s = w.split()
        assert least[w].tolist() == [min(holders[tuple(s[i : i + 13])]) for i in range(len(s) - 12)]


def test_jaccard_cases(spark, odd):
    got = {(r["doc_id"], r["n"]): r["component_id"] for r in jaccard.linked(odd).collect()}
    assert got[5, 56] == 4 and got[9, max(n for d, n in got if d == 9)] == 8 and got[7, 1] == 6 and got[1, 0] == 1 and got[2, 0] == 2
    assert sorted(r["doc_id"] for r in jaccard.one_of_each(odd.filter("doc_id is not null")).collect()) == [1, 2, 3, 4, 6, 8]
    assert jaccard.linked(odd.limit(0)).count() == 0


def test_jaccard_group_of_near_copies(spark):
    """More copies than a block holds, each with a word of its own, and texts that share one line only."""
    base, line = prose(7, 80).split(), prose(8, 20)
    rows = [(i, " ".join([*base[:40], f"own{i}", *base[41:]]), "a") for i in range(400)]
    rows += [(1000 + i, line + " " + prose(100 + i, 90), "b") for i in range(300)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.linked(documents(spark, rows)).collect()}
    assert {got[i] for i in range(400)} == {0} and all(got[1000 + i] == 1000 + i for i in range(300))


def brute_components(rows):
    """The least id of each document's component, from all pairs of shingle sets."""
    sets = {i: {tuple(t.lower().split()[k : k + 5]) for k in range(max(1, len(t.split()) - 4))} for i, t, _ in rows}
    roots = {i: i for i in sets}
    for i in sorted(sets):
        for j in sets:
            common = len(sets[i] & sets[j])
            if roots[i] != roots[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                low, high = sorted((roots[i], roots[j]))
                roots = {k: low if r == high else r for k, r in roots.items()}
    return roots


def test_jaccard_partner_alone_in_its_size_class(spark):
    """More texts than a block holds, with one near copy whose size class is another part: exact copies, and texts of their own."""
    base, tree = prose(7, 104), prose(9, 104).split()
    rows = [(i, base, "a") for i in range(1000)] + [(1000, base + " " + prose(11, 10), "a")]
    rows += [(2000 + i, " ".join([*tree[:40], f"own{i}", *tree[41:]]), "b") for i in range(700)]
    rows += [(2900, " ".join(tree + prose(12, 10).split()), "b")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.linked(documents(spark, rows)).collect()}
    few = [r for r in rows if r[0] in (0, 1000, 2000, 2001, 2900)]
    want = brute_components(few)
    assert {i: got[i] for i in want} == want and set(want.values()) == {0, 2000}
    assert {got[i] for i in range(1001)} == {0} and {got[i] for i, _, s in rows if s == "b"} == {2000}


def test_jaccard_texts_that_nearly_link(spark):
    """600 texts with four words of their own: next to none link, and hardly any pair is verified."""
    base = prose(17, 100).split()
    rows = [(i, " ".join(w if k % 25 != i % 25 else f"own{i}x{k}" for k, w in enumerate(base)), "a") for i in range(600)]
    docs = documents(spark, rows)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.linked(docs).collect()}
    assert got == brute_components(rows)
    sets = jaccard.sets_of(docs.select("doc_id", "text")).dropDuplicates(["key"])
    members = jaccard.trees(docs.select("doc_id", "text")).join(sets, "nid").withColumns({"part": F.lit(0), "comp": F.col("key"), "side": F.lit(0)})
    assert jaccard.search_trees(members, join=False).select("a", "b").distinct().count() < 600


def test_jaccard_searches_give_joins_not_pairs(spark, monkeypatch):
    """Two groups of near copies whose points reach the threshold and whose sets do not: no search gives a pair of theirs each."""
    monkeypatch.setattr(jaccard, "counts", lambda s: COUNTS(np.zeros(len(s), dtype=np.uint64)))
    base, given = prose(23, 100).split(), []
    search = jaccard.search_trees
    monkeypatch.setattr(jaccard, "search_trees", lambda m, join: given.append(jaccard.settle(search(m, join))) or given[-1])
    rows = [(100 * g + i, " ".join([*base[:50], f"own{i}", *(w + "x" * g for w in base[51:])]), "a") for g in range(2) for i in range(40)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.linked(documents(spark, rows)).collect()}
    assert got == brute_components(rows) and set(got.values()) == {0, 100}
    assert len(given) == 3
    for found in given:
        most = found.groupBy("tree").count().agg(F.max("count")).first()[0]
        assert most is None or most < 80


def test_jaccard_last_search_is_not_verified_again(spark, monkeypatch):
    """What the search with texts gives links; only the two searches before it are verified, and the last one's links count."""
    monkeypatch.setattr(jaccard, "counts", lambda s: COUNTS(np.zeros(len(s), dtype=np.uint64)))
    verified, calls = jaccard.verified, []
    monkeypatch.setattr(jaccard, "verified", lambda *a: calls.append(1) or verified(*a))
    base = prose(29, 100).split()
    rows = [(100 * g + i, " ".join([*base[:50], f"own{i}", *(w + "x" * g for w in base[51:])]), "a") for g in range(3) for i in range(20)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.linked(documents(spark, rows)).collect()}
    assert got == brute_components(rows) and set(got.values()) == {0, 100, 200}
    assert len(calls) == 2


def test_jaccard_linking_sets():
    sets = [np.arange(k, k + n, dtype=np.uint64) for k, n in [(0, 80), (5, 80), (12, 80), (0, 60), (200, 3)]]
    want = [100 * len(np.intersect1d(sets[0], x)) >= 75 * len(np.union1d(sets[0], x)) for x in sets]
    assert jaccard.linking(sets[0], sets).tolist() == want


def test_jaccard_blocks_of_large_trees(spark, monkeypatch):
    """Trees cut into small blocks, with a large component, others, and pairs near the threshold, against brute force."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "SEARCH_BLOCK", 3)
    base = prose(19, 60).split()
    rows = []
    for i in range(90):
        own = {(7 * i + 11 * k) % 55 + 3 for k in range(i % 4)}
        rows.append((i, " ".join(f"own{i}x{k}" if k in own else w for k, w in enumerate(base)) + " tail" * (i % 3), "a"))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.linked(documents(spark, rows)).collect()}
    want = brute_components(rows)
    assert got == want and 1 < len(set(want.values())) < 90


def test_jaccard_bound_never_below_overlap():
    rng = np.random.default_rng(3)
    for size in (24, 90, 3000):
        shared = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        sets = [np.unique(np.concatenate([shared[: size - k], rng.integers(0, 1 << 63, k + 1, dtype=np.uint64)])) for k in range(0, size // 2, max(1, size // 60))]
        sets.sort(key=len)
        n = np.array([len(x) for x in sets])
        found = set(jaccard.candidates(n, [jaccard.counts(x) for x in sets], np.arange(len(n)), None, False))
        common = lambda i, j: len(np.intersect1d(sets[i], sets[j]))
        links = {(i, j) for i in range(len(n)) for j in range(i + 1, len(n)) if 100 * common(i, j) >= 75 * (n[i] + n[j] - common(i, j))}
        assert links and links <= found and len(found) <= len(links) + len(n)


def test_jaccard_trees_hold_distinct_sets(spark):
    """Copies over several tasks count once in the trees and their sizes; a null id is no set of its own."""
    base = prose(13, 60)
    rows = [(i, base, "a") for i in range(300)] + [(None, base, "a"), (300, base + " tail", "a")]
    docs = documents(spark, rows).repartition(5)
    members = jaccard.trees(docs.select("doc_id", "text")).collect()
    assert members and all(r["most"] == 2 for r in members)
    assert len(members) == len({(r["tree"], r["nid"]) for r in members})
    assert {r["component_id"] for r in jaccard.linked(docs).collect()} == {0}


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    assert all(got[i] == 0 for i in range(41)) and got[101] == 100


def test_components_shuffle_three_times_a_round(spark, monkeypatch):
    """Random edges, some of them twice: roots as by hand, without many shuffles; later edges merge into what was found."""
    settle, plans = graph.settle, []
    monkeypatch.setattr(graph, "settle", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or settle(df))
    pick = np.random.default_rng(31)
    edges = [tuple(map(int, e)) for e in pick.integers(0, 300, (220, 2))]
    edges += [(300, i) for i in range(301, 360)] + edges[:20]
    want = {x: x for e in edges for x in e}
    for a, b in edges:
        low, high = sorted((want[a], want[b]))
        want = {k: low if r == high else r for k, r in want.items()}
    met = {x for a, b in edges if a != b for x in (a, b)}
    made = lambda e: spark.createDataFrame(e, "a long, b long")
    got = {r["node"]: r["root"] for r in graph.components(made(edges)).collect()}
    assert got == {x: want[x] for x in met}
    assert all(p.count("Exchange hashpartitioning") <= 3 for p in plans)
    found = graph.merged(graph.components(made(edges[:150]), roots=False), made(edges[150:])).collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["root"] for r in found} == {x: want[x] for x in met if want[x] != x}


def test_word_hashes_follow_words():
    text = "Ab  cd\tab\x0bcd é Ab".encode()
    h = hashing.word_hashes(text)
    assert len(h) == len(text.split()) and h[0] == h[-1] and h[0] != h[2] and h[1] == h[3]
    assert hashing.word_hashes(text, lower=True)[0] == hashing.word_hashes(text, lower=True)[2]
    long = (b"word " * 300_000) + b"end"
    assert len(hashing.word_hashes(long)) == 300_001


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def kept(kind, v):
    n = sum(c in "0123456789" for c in v)
    return {"email": True, "ip": all(int(x) <= 255 for x in v.split(".")) if kind == "ip" else True, "card": 13 <= n <= 19 and luhn(v), "phone": 9 <= n <= 15}[kind]


def test_personal_data_against_brute_force(spark, data):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    rows = entry.queries()["op5_personal_data"](spark, data).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = [f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, texts[r["doc_id"]]) if kept(k, m[0])]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r["spans"].split(",")) | {""}


def test_personal_data_cases(spark, odd):
    rows = [(1, "a_b@x.co_c@y.de and 1.2.3.4.5.6.7.8, card 4111 1111 1111 1111", "a"), (2, "call (212) 555-0199 phone", "a"), (3, "1" * 5000, "a"), (4, None, "a")]
    got = {r["doc_id"]: r for r in pii.personal_spans(documents(spark, rows)).collect()}
    assert [s["value"] for s in got[1]["email"]] == ["a_b@x.co", "_c@y.de"] and len(got[1]["ip"]) == 2 and len(got[1]["card"]) == 1
    assert not got[3]["card"]
    assert pii.personal_spans(odd).count() == odd.count() and pii.personal_spans(odd.limit(0)).count() == 0


def test_template_leaks(spark, odd):
    item = "A train leaves at 9 and travels 120 km in 2 hours what is its mean speed over the whole way"
    items = spark.createDataFrame([(1, item), (2, "short one"), (3, None)], "item_id long, text string")
    rows = [(1, "so: " + item, "a"), (2, item.replace("120", "300").replace("9", "11"), "a"), (3, prose(4, 50), "a"), (4, None, "a")]
    rows += [(5, "x = 2 and 2 ; " + item.replace("120", "9"), "a")]
    got = {(r["doc_id"], r["item_id"]): r["consistent"] for r in templates.leaks(documents(spark, rows), items).collect()}
    assert got[1, 1] and got[2, 1] and not got[5, 1] and {d for d, _ in got} == {1, 2, 5}
    left = templates.decontaminated(documents(spark, rows), items)
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5] and left.columns == documents(spark, rows).columns
    assert templates.leaks(odd.limit(0), items).count() == 0 and templates.leaks(odd, items.limit(0)).count() == 0


def test_template_leaks_are_judged_by_passage(spark):
    """An item word for word stays a leak beside other passages of its template."""
    item = "A train leaves at 9 and travels 120 km in 2 hours what is its mean speed over the whole way"
    other = item.replace("120", "300").replace("9", "11")
    clash = item.replace("120", "9")
    items = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    rows = [(1, f"{item} ; {other}", "a"), (2, f"{item} . {clash}", "a"), (3, clash, "a"), (4, f"{clash} . then {clash}", "a")]
    docs = documents(spark, rows)
    got = {(r["doc_id"], r["item_id"]): r["consistent"] for r in templates.leaks(docs.unionByName(docs), items).collect()}
    assert got == {(d, i): d < 3 for d in range(1, 5) for i in (1, 2)}
    assert sorted(r["doc_id"] for r in templates.decontaminated(docs, items).collect()) == [3, 4]


def test_template_leaks_of_short_and_dense_items(spark):
    """Items without a usable window, and a first word whose capital stands inside a sentence."""
    texts = ["What is 7 times 8", "add 1 2 3 4 5 6 7 8 9 10 11 12 13 14", "How many legs do seven old spiders have in all", "Anna went to the market with her red bag of 3 big apples"]
    items = spark.createDataFrame([*enumerate(texts), (8, ""), (9, " . ")], "item_id long, text string")
    rows = [(i, f"They ask us {t}, of course", "a") for i, t in enumerate(texts)]
    rows += [(10, "What is 7 times 9", "a"), (11, texts[1].replace("13", "99"), "a"), (12, "", "a"), (13, None, "a"), (14, "how many legs do seven old spiders have in all", "a")]
    rows += [(15, "say Two many legs do seven old spiders have in all", "a"), (16, texts[3].replace("3", "5"), "a"), (17, "then " + texts[3], "a")]
    got = {(r["doc_id"], r["item_id"]) for r in templates.leaks(documents(spark, rows), items).collect() if r["consistent"]}
    assert got == {(0, 0), (1, 1), (2, 2), (3, 3), (11, 1), (14, 2), (16, 3), (17, 3)}


def test_template_leaks_find_every_literal_passage(spark, data):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()}
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in entry.queries()["op7_template_leaks"](spark, data).collect() if r["consistent"]}
    assert want <= got


def test_vantage_tree_is_exact_at_factor_one(spark):
    pick = np.random.default_rng(3)
    x = pick.normal(size=(3000, 16))
    x[:400] = x[0]
    unit, ids = vantage.unit_rows(x), np.arange(3000)
    q = np.arange(0, 3000, 50)
    at, row = vantage.Tree(unit, leaf=32).search(unit[q], ids[q], ids, 5, 1.0)
    dist = vantage.distances(unit[q], unit)
    dist[np.arange(len(q)), q] = np.inf
    for i in range(len(q)):
        assert set(np.flatnonzero(dist[i] <= np.sort(dist[i])[4] - 1e-9)) <= set(row[at == i])


def test_vantage_cases(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, [2.0, 0.0]), (6, [3.0, 0.0]), (7, [1.0, 1.0, 1.0]), (0, [1.0, 0.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, score string")
    from pyspark.sql import functions as F

    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in vantage.nearest(df, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(got) == [(0, 1, 5), (0, 2, 6)]
    assert vantage.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_preferences(spark):
    a = [("user", "hi"), ("assistant", "yes"), ("user", "go")]
    rows = [(1, "chosen", i, r, t) for i, (r, t) in enumerate([*a, ("assistant", "good")])] + [(1, "rejected", i, r, t) for i, (r, t) in enumerate([*a, ("assistant", None)])]
    rows += [(2, "chosen", 0, "user", "alone"), (3, "chosen", 0, None, "same"), (3, "rejected", 0, "user", "same"), (None, "chosen", 0, "user", "x")]
    df = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string")
    got = {r["pair_id"]: r for r in preferences.format_pairs(df).collect()}
    assert set(got) == {1, 3} and got[1]["n_prefix"] == 3 and got[1]["chosen"] == "<|assistant|>\ngood<|end|>\n"
    s, e = map(int, got[1]["chosen_mask"].split(":"))
    assert got[1]["chosen"][s:e] == "good<|end|>" and got[3]["n_prefix"] == 0 and got[3]["chosen_mask"] == ""


def test_url_rules(spark):
    urls = ["https://a.example.com/en/x", "http://www.example.com/en/", "http://x.net/fr/1?q", "http://m.casino-win.org/a", None, "nothing", "HTTP://NET/es/", "http://x.com"]
    df = spark.createDataFrame([(i, u, "r", "t") for i, u in enumerate(urls)], "page_id long, url string, rule2 string, tokens string")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_rules.judge(df, url_rules.rule_table(spark)).collect()}
    assert got[0] == ("example.com/en/", "block") and got[1] == ("www.example.com/en/", "allow") and got[2] == ("net/fr/", "block")
    assert got[3] == (None, "block") and got[4] == (None, "allow") and got[5] == (None, "allow") and got[6] == ("net/es/", "block") and got[7] == (None, "allow")


def test_toxicity_held_out(spark, data):
    small = data.replace("sf0.001", "sf0.1")
    rows = entry.queries()["op10_toxicity"](spark, small).collect()
    truth = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    hit = sum(r["predicted"] == 1 and truth[r["doc_id"]] == 1 for r in held)
    assert hit >= 0.8 * sum(truth[r["doc_id"]] for r in held) and hit >= 0.8 * sum(r["predicted"] for r in held)


def test_toxicity_cases(spark, odd):
    labels = spark.createDataFrame([(4, 1), (4, None), (None, 1)], "doc_id long, toxic int")
    weights, bias = toxicity.train(odd, labels)
    assert toxicity.scored(odd, weights, bias).count() == odd.count()
    assert toxicity.scored(odd.limit(0), weights, bias).count() == 0


def test_pipeline(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    out = corpus_pipeline.run(spark, data)
    assert out.columns == [*docs.columns, "repetition", "taken"] and 0 < out.count()
    leaked = {r["doc_id"] for r in entry.queries()["op7_template_leaks"](spark, data).collect() if r["consistent"]}
    assert not leaked & {r["doc_id"] for r in out.collect()}


def test_word_lookup_equals_all_features():
    texts = ["", "a ab abc abcd", "(abcd) _abcde_ ab* étonnant", "abcdefghij ABCDEFGHIJ x", "  ... ab-cd", "abc"] * 2
    every = sorted(set().union(*map(toxicity.features, texts)))
    for wanted in ({}, dict.fromkeys(every, 1.0), dict.fromkeys(every[::2], 1.0), dict.fromkeys(every[1::3], 1.0)):
        find = toxicity.Finder(wanted)
        find.REMEMBERED = 4
        for t in texts:
            assert find(t) == toxicity.features(t) & wanted.keys(), t


def test_jaccard_trees_of_known_sets_read_no_text(spark):
    """Trees made from sets that are there do not cut the texts again, and are those of the texts."""
    docs = documents(spark, [(i, prose(i % 7, 60), "a") for i in range(30)]).select("doc_id", "text")
    sets = jaccard.settle(jaccard.sets_of(docs, jaccard.frequent_shingles(docs)))
    found = jaccard.trees(docs, sets)
    assert "MapInArrow" not in found._jdf.queryExecution().optimizedPlan().toString()
    # Columns that might be null would be filtered below the shuffle, which its readers then would not share.
    assert not [f.name for f in jaccard.occurrences(sets).schema if f.nullable]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, jaccard.trees(docs).collect()))


def test_settled_tables_leave_no_shuffle_files(spark):
    """Files of a shuffle go when the table behind it is kept, not when the driver collects its garbage."""
    import time

    manager = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def files() -> set[str]:
        return {x for x in manager.getAllFiles().mkString(" ").split(" ") if "/shuffle_" in x}

    before = files()
    kept = jaccard.settle(spark.range(2000).repartition(4, "id").groupBy((F.col("id") % 50).alias("k")).count())
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.5)
    assert not files() - before
    assert kept.count() == 50


def test_toxicity_common_features():
    texts = [f"{prose(i, 60)} own{i}word, Shared." for i in range(12)]
    every = [f for t in texts for f in toxicity.features(t)]
    want = {f: every.count(f) for f in set(every) if every.count(f) >= 3}
    assert toxicity.common_features(texts, 3) == toxicity.common_features(texts, 3, buckets=7) == want


def test_toxicity_fit_holds_no_rare_features():
    rng = np.random.default_rng(5)
    texts = [" ".join(["common", *("".join(w) for w in rng.choice(list("abcdefghijklmnop"), (1500, 9)))]) for _ in range(100)]
    tracemalloc.start()
    toxicity.fit(texts[:95], texts[95:], 0.1, rounds=2)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 77e6


def test_passages_alone_stay_out_of_the_index(monkeypatch):
    held = []
    built = passages.FMIndex.__init__
    monkeypatch.setattr(passages.FMIndex, "__init__", lambda self, p, d: held.append(len(p)) or built(self, p, d))
    words = [prose(200 + i, 20).encode() for i in range(30)]
    copied, part = words[4], words[5] + b" " + words[6]
    least = passages.removable([*words, copied, part], np.array([*range(10, 40), 3, 50]))
    assert held == [4] and set(least) == {*words, part}
    assert set(least[copied].tolist()) == {3} and set(least[words[0]].tolist()) == {10}
    assert least[part].tolist() == [15] * 8 + [50] * 12 + [16] * 8
    assert passages.removable(words[:2], np.array([1, 2]))[words[1]].tolist() == [2] * 8


def test_window_hashes_are_compiled(spark):
    docs = spark.createDataFrame([(1, prose(3, 30)), (2, "few words"), (3, None)], "doc_id long, text string")
    rows = templates.windows(docs, "doc_id", 13)
    assert "lambdafunction(xxhash64(slice" not in rows._jdf.queryExecution().executedPlan().toString()
    got = rows.filter(F.col("hash") == F.xxhash64(F.transform(F.slice("form", F.col("at"), 13), lambda w: F.xxhash64(w))))
    assert got.count() == rows.count() == 18


def test_jaccard_join_sends_texts_in_small_batches(spark, monkeypatch):
    setting, made = "spark.sql.execution.arrow.maxRecordsPerBatch", jaccard.sets_of
    before = spark.conf.get(setting)
    most = spark.sparkContext.accumulator(0)

    def counted(docs, *rest):
        def run(batches):
            for b in batches:
                if b.num_rows > jaccard.BATCH_ROWS:
                    most.add(b.num_rows)
                yield b

        return made(docs.mapInArrow(run, docs.schema), *rest)

    monkeypatch.setattr(jaccard, "sets_of", counted)
    docs = spark.createDataFrame([(i, f"one two three four five {i % 700}") for i in range(1600)], "doc_id long, text string").coalesce(1)
    rows = jaccard.linked(docs).select("doc_id", "component_id").collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: i % 700 for i in range(1600)}
    assert most.value == 0 and spark.conf.get(setting) == before


def test_passage_search_begins_with_known_words(monkeypatch):
    steps = []
    down = passages.WaveletMatrix._down
    monkeypatch.setattr(passages.WaveletMatrix, "_down", lambda self, s, at: steps.append(len(at)) or down(self, s, at))
    words = [prose(700 + i, 30).encode().split() for i in range(6)]
    held = [b" ".join(w) for w in (*words, words[2][5:20], words[2][3:] + words[4][:9], words[5] + words[5])]
    docs = np.array([9, 8, 7, 6, 5, 4, 3, 2, 1])
    least = passages.removable(held, docs)
    windows = defaultdict(lambda: 99)
    for p, d in zip(held, docs.tolist()):
        w = p.split()
        for i in range(len(w) - 12):
            windows[tuple(w[i : i + 13])] = min(windows[tuple(w[i : i + 13])], d)
    for p in held:
        w = p.split()
        assert least[p].tolist() == [windows[tuple(w[i : i + 13])] for i in range(len(w) - 12)]
    # One call as the index is made; then a step for both bounds of five words, not two for each of thirteen.
    assert len(steps) == 1 + passages.WINDOW - passages.FMIndex.KNOWN


def template_cases(spark):
    """Documents and 40 items of their own words; item 41 has the words of item 1, and two rows lack an id."""
    letters = str.maketrans("0123456789", "abcdefghij")
    texts = {i: f"{prose(900 + i, 24).translate(letters)} holds {i + 3} kg and {2 * i + 50} km of it" for i in range(1, 41)}
    items = [*texts.items(), (41, texts[1]), (None, texts[2]), (None, texts[3]), (5, texts[6]), (7, texts[7])]
    docs = [(i, f"{prose(i, 30)} , {t} , {texts[1 + i % 40]}", "a") for i, t in texts.items()] + [(99, texts[4].replace("54", "77"), "a"), (99, texts[4], "a"), (None, None, "a")]
    docs += [docs[3]] * 2
    return documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")


def broadcast_columns(frame) -> list[str]:
    """The columns of each broadcast side in the plan of ``frame``."""
    stack, sides = [frame._jdf.queryExecution().optimizedPlan()], []
    while stack:
        node = stack.pop()
        stack += [node.children().apply(k) for k in range(node.children().size())]
        if node.nodeName() == "Join" and "strategy=broadcast" in node.verboseStringWithSuffix(99):
            sides.append(node.children().apply(1).schema().fieldNames())
    return [",".join(s) for s in sides]


def test_template_leaks_broadcast_hashes_alone(spark, monkeypatch):
    """Large tables of item windows stay out of the memory of every executor; only their hashes go there, part by part."""
    docs, items = template_cases(spark)
    columns = ["doc_id", "text_key", "item_id", "n_windows", "n_slots", "consistent"]
    want = sorted(map(str, templates.leaks(docs, items).select(*columns).collect()))
    monkeypatch.setattr(templates, "MAX_BROADCAST_BYTES", 0, raising=False)
    monkeypatch.setattr(templates, "MAX_BROADCAST_HASHES", 200, raising=False)
    got = templates.leaks(docs, items)
    sides = broadcast_columns(got)
    assert len(sides) > 1 and set(sides) == {"hash"}
    assert sorted(map(str, got.select(*columns).collect())) == want
    assert [r["doc_id"] for r in templates.decontaminated(docs, items).collect()] == [None]


def test_template_leaks_search_equal_items_once(spark, monkeypatch):
    """Items of the same texts have the same pairs; their windows are held once."""
    docs, items = template_cases(spark)
    got = {(r["doc_id"], r["text_key"], r["item_id"]): tuple(r)[3:] for r in templates.leaks(docs, items).collect()}
    alone = {}
    for i in (5, None):
        own = items.filter(F.col("item_id").eqNullSafe(F.lit(i).cast("long")))
        alone |= {(r["doc_id"], r["text_key"], r["item_id"]): tuple(r)[3:] for r in templates.leaks(docs, own).collect()}
    assert {k: v for k, v in got.items() if k[2] in (5, None)} == alone
    assert {(d, t): v for (d, t, i), v in got.items() if i == 1} == {(d, t): v for (d, t, i), v in got.items() if i == 41}
    assert {d for d, _, i in got if i is None} >= {2, 3} and {d for d, _, i in got if i == 5} >= {5, 6}
    held = []
    cut = templates.windows
    monkeypatch.setattr(templates, "windows", lambda texts, key, *rest, **more: held.append((key, texts)) or cut(texts, key, *rest, **more))
    many = spark.createDataFrame([(100 + k, items.first()["text"]) for k in range(30)], "item_id long, text string")
    assert templates.leaks(docs, many).filter("consistent").select("item_id").distinct().count() == 30
    assert [texts.count() for key, texts in held if key != "key"] == [1]


def test_decontamination_stage_broadcasts_hashes_alone(spark, monkeypatch, tmp_path):
    """The stage of the pipeline: documents with an item go, with the words of no item window in a broadcast."""
    import corpus_pipeline

    docs, items = template_cases(spark)
    docs = docs.unionByName(documents(spark, [(200, prose(77, 40), "a"), (None, prose(78, 40), "a")]))
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    monkeypatch.setattr(templates, "MAX_BROADCAST_BYTES", 0, raising=False)
    seen, judged = [], templates.judged
    monkeypatch.setattr(templates, "judged", lambda hits: seen.append(broadcast_columns(hits)) or judged(hits))
    left = dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] is None) for r in left) == [(0, False), (0, True), (200, False)]
    assert seen == [["hash"]]
