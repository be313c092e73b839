"""Periodic runs of words by uniting suffix classes in order of falling common prefixes (operator 11).

The suffixes of a text that share their first words are sorted by prefix doubling, and neighbours get the
length of their longest common prefix (LCP). As in Kruskal's algorithm the pairs of neighbours are taken
by falling LCP and their classes united; a union-find holds an ordered list of positions for each class, and
the shorter list goes into the longer. Two positions that become neighbours in a united list at distance ``q``
agree in exactly LCP words, so from the first on LCP + ``q`` words have period ``q``. That is a run if the
word before does not keep the period. The first two periods of every run meet this way, once, and the
period is the smallest: a position between them would have been united with both before.

A run is a stretch with smallest period ``q`` that no neighbouring word extends, of at least ``min_length`` words
and ``min_exponent`` periods. Runs may overlap. ``collapsed`` keeps of each run the first period only.

Null and empty texts have no words and no runs; a null id stays null. Repeated rows are treated each on its own. A
very long text is handled whole in one task, with memory linear in its words. Ties do not arise: start and
period name a run. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barloom.llm.registry import query
from barloom.llm.tables import read, ship

MIN_LENGTH = 6
MIN_EXPONENT = 4
BATCH_BYTES = 4 << 20
RUN = "struct<start:long,length:long,period:long>"


def numbers(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known = {w: k for k, w in enumerate(dict.fromkeys(words))}
    return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


def suffix_classes(w: np.ndarray, width: int) -> np.ndarray:
    """Positions whose first ``width`` words (a power of two) occur elsewhere too, in order of their suffixes."""
    n, size = len(w), 0
    rank, live, low, shared = np.zeros(n, np.int64), np.arange(n), w, None
    while len(live):
        key = rank[live] * (n + 2) + low
        by = np.argsort(key, kind="stable")
        live, key = live[by], key[by]
        old, at = rank[live], np.arange(len(live))
        first = np.append(True, key[1:] != key[:-1])
        # A class begins at its rank; its parts follow each other.
        begin = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), at, 0))
        rank[live] = old + np.maximum.accumulate(np.where(first, at, 0)) - begin
        live = live[~(first & np.append(first[1:], True))]
        size = 2 * size or 1
        if size == width:
            shared = live
        ahead = live + size
        low = np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, 0)
    if shared is None:
        return np.empty(0, np.int64)
    return shared[np.argsort(rank[shared])]


def common_prefixes(w: list[int], order: list[int], width: int) -> list[int]:
    """LCP of each suffix in ``order`` with the one before, in one pass by position; below ``width`` it may be 0."""
    before, found, h, last = dict(zip(order[1:], order)), {}, 0, -2
    w = [*w, -1]
    for i in sorted(order):
        j = before.get(i)
        h = h - 1 if i == last + 1 and h > width else 0
        if j is not None:
            while w[i + h] == w[j + h]:
                h += 1
        else:
            h = 0
        found[i], last = h, i
    return [found[i] for i in order]


def runs_of(w: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[tuple[int, int, int]]:
    """``start, length, period`` of every run of a sequence of numbers from 0, by start, then period."""
    if min_exponent < 2:
        raise ValueError("a run holds two periods at least")
    least = min_exponent - 1
    while least + least // (min_exponent - 1) < min_length:
        least += 1  # no shorter common prefix makes a run
    width = 1 << (least.bit_length() - 1)
    order = suffix_classes(w, width).tolist()
    if not order:
        return []
    word = w.tolist()
    lcp = common_prefixes(word, order, width)
    root, places, found = list(range(len(order))), [[p] for p in order], []

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    def seed(i: int, j: int, common: int) -> None:
        q = j - i
        if q * (min_exponent - 1) <= common and q + common >= min_length and (i == 0 or word[i - 1] != word[j - 1]):
            found.append((i, q + common, q))

    for k in sorted((k for k in range(1, len(order)) if lcp[k] >= least), key=lambda k: -lcp[k]):
        common, a, b = lcp[k], top(k - 1), top(k)
        if len(places[a]) < len(places[b]):
            a, b = b, a
        large, small = places[a], places[b]
        root[b], places[b] = a, []
        for s, x in enumerate(small):
            at = bisect_left(large, x)
            if at and (s == 0 or small[s - 1] < large[at - 1]):
                seed(large[at - 1], x, common)
            if at < len(large) and (s + 1 == len(small) or small[s + 1] > large[at]):
                seed(x, large[at], common)
        if len(small) < 32:
            for x in small:
                insort(large, x)
        else:
            large += small
            large.sort()  # two ordered stretches: one merge
    return sorted(found, key=lambda r: (r[0], r[2]))


def without_repeats(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside the second and later periods of all runs."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def periodic_runs(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
    rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row; the scan's partitions are the tasks, nothing is shuffled.

    ``rewrite`` may change the words of a document (id, UTF-8 words) before they are searched.
    """
    ship(docs.sparkSession)
    kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(kind)), ("collapsed", pa.binary())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                words = (text.as_py() or b"").split()
                if rewrite is not None:
                    words = rewrite(doc_id, words)
                runs = runs_of(numbers(words), min_length, min_exponent)
                kept = b" ".join(without_repeats(words, runs))
                out.append((doc_id, len(words), [dict(zip(("start", "length", "period"), r)) for r in runs], kept))
                held += len(kept) + 100 * len(runs) + 100
                if held > BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                    out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    found = slim.mapInArrow(search, f"doc_id long, n_words long, runs array<{RUN}>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest run, and digests of all runs and of the collapsed text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    picked = found.withColumn("best", best)
    return picked.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's contract: in every tenth document, by the checksum of its id, a stretch repeats up to the end."""
    h, n = crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
  xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
    lambda crc, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)),
    CAST(4294967295 AS BIGINT))) AS h FROM documents),
e AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n, h % 10 = 0 AND len(w) > 0 AS loops, (h // 10) % greatest(len(w), 1) AS a, (h // 10) % 8 AS g8 FROM d),
t AS (SELECT r, doc_id, n, CASE WHEN loops THEN list_transform(range(n),
        lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g8)) END]) ELSE w END AS w FROM e),
x AS (SELECT r, n, unnest(w) AS word, CAST(generate_subscripts(w, 1) AS BIGINT) - 1 AS i FROM t WHERE n >= 6),
g AS (SELECT r, n, i, hash(word, lead(word, 1) OVER s, lead(word, 2) OVER s, lead(word, 3) OVER s, lead(word, 4) OVER s) AS five
      FROM x WINDOW s AS (PARTITION BY r ORDER BY i) QUALIFY lead(word, 4) OVER s IS NOT NULL),
m AS (SELECT a.r, a.i, b.i - a.i AS q FROM g a JOIN g b ON a.r = b.r AND a.five = b.five AND b.i > a.i AND 4 * (b.i - a.i) <= a.n),
o AS (SELECT r, q, min(i) AS start, max(i) - min(i) + 5 + q AS length
      FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM m) GROUP BY r, q, k),
u AS (SELECT r, start, length, min(q) AS q FROM o WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
l AS (SELECT r, count(*) AS n_runs, list({'s': start, 'l': length, 'q': q}) AS runs,
             max({'l': length, 's': -start, 'q': -q}) AS best,
             string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q) AS lines FROM u GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, -best.s AS start, best.l AS length, -best.q AS period,
       1000 * best.l // -best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256,
       sha256(coalesce(array_to_string(CASE WHEN runs IS NULL THEN w ELSE
         list_filter(w, lambda v, i: len(list_filter(runs, lambda c: i > c.s + c.q AND i <= c.s + c.l)) = 0) END, ' '), '')) AS collapsed_sha256
FROM t LEFT JOIN l USING (r)
"""


@query("op11_periodic_runs", SQL)
def op11_periodic_runs(spark, sf_dir):
    """Runs of every document, with the loops that the contract plants, and its text with each run cut to one period."""
    return digests(periodic_runs(read(spark, sf_dir, "documents"), rewrite=periodic_tail))
