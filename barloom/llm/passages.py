"""Removal of repeated passages with an FM-index per shard (operator 4).

A word is removed if a window of ``WINDOW`` words that covers it also starts in a document with a smaller id.
Equal windows meet in one shard: a window is filed under its smallest five-word hash (its anchor), and
only anchors that several documents hold are followed up. The runs of windows under one anchor are the
passages of a shard. A shard holds a compressed full-text index of its distinct passages: suffixes sorted to
the window length, the Burrows-Wheeler column in a wavelet matrix, and the smallest document per
suffix. Backward search answers, for every window of the passages streamed through, the interval of suffixes
that begin with it; the smallest document of the interval decides.

A null text has no words. Rows with a null id take part in no comparison and lose nothing. Repeated rows
compare by id alone, so equal rows do not remove each other; each keeps a result. Fewer words than a window: nothing
is removed. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from barloom.llm.hashing import PLACES, window_hashes, word_hashes
from barloom.llm.registry import query
from barloom.llm.tables import read, settle, ship

WINDOW = 13
ANCHOR = 5
SHARD_PASSAGES = 40_000
SAMPLE, FREQUENT, MAX_FREQUENT, SALTS = 64, 4, 50_000, 8


def anchors(h: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The anchor of every window of a text given as word hashes."""
    g = window_hashes(h, ANCHOR)
    n = len(h) - window + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    low = g[:n].copy()
    for j in range(1, window - ANCHOR + 1):
        np.minimum(low, g[j : j + n], out=low)
    return low.view(np.int64)


class WaveletMatrix:
    """Rank of a symbol in a prefix of a sequence, bit by bit from the top."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.step = bits, len(symbols) + 1
        # Per level: where a place goes with a bit of 0, then where with a bit of 1.
        self.goes = []
        s, places = symbols, np.arange(self.step, dtype=np.int32)
        for level in range(bits - 1, -1, -1):
            b = ((s >> level) & 1).astype(bool)
            ones = np.zeros(self.step, dtype=np.int32)
            np.cumsum(b, dtype=np.int32, out=ones[1:])
            self.goes.append(np.concatenate([places - ones, ones + (len(s) - ones[-1])]))
            s = np.concatenate([s[~b], s[b]])
        # Where each symbol's own block begins after the last level.
        every = np.arange(1 << bits, dtype=np.int32)
        self.begin = self._down(every, np.zeros(len(every), dtype=np.int32))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, goes in enumerate(self.goes):
            at = goes[at + ((symbol >> (self.bits - 1 - k)) & 1) * self.step]
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbol, at) - self.begin[symbol]


class FMIndex:
    """Index of passages (lists of word numbers from 1) for patterns of up to 16 words.

    A backward search begins with the interval of the pattern's last ``KNOWN`` words, kept by their places in the text.
    """

    KNOWN = 8

    def __init__(self, passages: list[np.ndarray], docs: np.ndarray):
        zero = np.zeros(1, dtype=np.int64)
        text = np.concatenate([x for p in passages for x in (p, zero)])
        owner = np.repeat(docs, [len(p) + 1 for p in passages])
        n = len(text)
        rank, width = text.copy(), 1
        while width < 16:
            ahead = np.concatenate([rank[width:], np.zeros(min(width, n), dtype=np.int64)])[:n]
            # A separator ends its suffix: what follows it does not count.
            rank = np.unique(rank * (int(rank.max()) + 2) + ahead, return_inverse=True)[1].astype(np.int64) + 1
            width *= 2
            if width == self.KNOWN:
                known = rank
        suffixes = np.argsort(rank)  # any order of equal ones: a pattern is no longer than what they share
        self.owner = owner[suffixes]
        last = text[suffixes - 1]
        top = int(text.max()) + 1
        self.less = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top))]).astype(np.int32)
        # Suffixes with the same first words stand together, in the order of their ranks.
        self.known, self.bounds = known, np.concatenate([[0], np.cumsum(np.bincount(known))]).astype(np.int32)
        self.tree = WaveletMatrix(last.astype(np.int32), max(1, int(top).bit_length()))

    def interval(self, patterns: np.ndarray, at: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all rows of ``patterns`` at once; ``at``: a place of each in the text, if it has one."""
        patterns, n = patterns.astype(np.int32, copy=False), len(patterns)
        ends = np.repeat(np.array([0, len(self.owner)], dtype=np.int32), n)
        if at is not None and patterns.shape[1] >= self.KNOWN:
            last = self.known[at + patterns.shape[1] - self.KNOWN]
            ends = np.concatenate([self.bounds[last], self.bounds[last + 1]])
            patterns = patterns[:, : -self.KNOWN]
        for c in patterns.T[::-1]:
            both = np.concatenate([c, c])
            ends = self.less[both] + self.tree.rank(both, ends)
        return ends[:n].astype(np.int64), ends[n:].astype(np.int64)

    def least_owner(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest document in each interval; intervals of one pattern length are equal or apart."""
        first, back = np.unique(lo, return_inverse=True)
        end = np.zeros(len(first), dtype=np.int64)
        end[back] = hi
        cuts = np.stack([first, end], axis=1).ravel()
        padded = np.append(self.owner, np.iinfo(np.int64).max)
        return np.minimum.reduceat(padded, cuts)[::2][back]


def removable(passages: list[bytes], docs: np.ndarray, window: int = WINDOW) -> dict[bytes, np.ndarray]:
    """For each distinct passage: per window, the smallest document of the shard that holds it.

    The index holds the passages that can decide anything: those of several documents, and those with a window whose
    hash stands in the shard twice. The windows of the others are their own document's alone.
    """
    least: dict[bytes, int] = {}
    several: set[bytes] = set()
    for p, d in zip(passages, docs.tolist()):
        if (known := least.setdefault(p, d)) != d:
            several.add(p)
            least[p] = min(known, d)
    every, owners = list(least), np.array(list(least.values()), dtype=np.int64)
    words = [p.split() for p in every]
    lengths = np.array([len(w) for w in words])
    flat = list(chain.from_iterable(words))
    number = dict(zip(dict.fromkeys(flat), count(1)))
    codes = np.fromiter(map(number.__getitem__, flat), dtype=np.int64, count=len(flat))
    ends = np.cumsum(lengths)
    hashes = window_hashes(codes.astype(np.uint64), window)
    inside = np.arange(len(hashes)) + window <= np.repeat(ends, lengths)[: len(hashes)]
    _, same, times = np.unique(hashes[inside], return_inverse=True, return_counts=True)
    hit = inside.copy()
    hit[inside] = times[same] > 1
    total = np.concatenate([[0], np.cumsum(hit), np.full(window - 1, hit.sum())])
    wanted = (total[ends] > total[ends - lengths]) | np.array([p in several for p in every])
    answers = {p: np.full(n - window + 1, d, dtype=np.int64) for p, n, d, w in zip(every, lengths.tolist(), owners.tolist(), wanted.tolist()) if not w}
    if not wanted.any():
        return answers
    kept = codes[np.repeat(wanted, lengths)]
    present = np.zeros(len(number) + 1, dtype=np.int64)
    present[kept] = 1
    small = np.cumsum(present)[kept]
    coded = np.split(small, np.cumsum(lengths[wanted])[:-1])
    index = FMIndex(coded, owners[wanted])
    sizes = lengths[wanted]
    inside = np.flatnonzero(np.arange(len(small)) + window <= np.repeat(np.cumsum(sizes), sizes))
    patterns = np.lib.stride_tricks.sliding_window_view(small.astype(np.int32), window)[inside]
    # Windows that passages share are searched once.
    different, back = np.unique(window_hashes(small.astype(np.uint64), window)[inside], return_inverse=True)
    first = np.empty(len(different), dtype=np.int64)
    first[back] = np.arange(len(back))
    if not (patterns[first][back] == patterns).all():
        first = back = np.arange(len(patterns))
    # In the index's text a separator follows every passage.
    at = inside + np.repeat(np.arange(len(sizes)), sizes)[inside]
    lo, hi = index.interval(patterns[first], at[first])
    owner = index.least_owner(lo, hi)[back]
    cuts = np.cumsum(sizes - window + 1)[:-1]
    return answers | dict(zip([p for p, w in zip(every, wanted.tolist()) if w], np.split(owner, cuts)))


def packed_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, packed``: whole texts, compressed before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for b in batches:
            packed = [squeeze.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, packed binary")


def filed(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``token, salt, doc_id``: the distinct anchors of every document; frequent ones salted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, found = b.column("doc_id").to_pylist(), []
            for t in b.column("text"):
                found.append(np.unique(anchors(word_hashes((t.as_py() or "").encode("utf-8", "surrogatepass")))))
            tokens = np.concatenate([np.empty(0, np.int64), *found])
            owner = np.repeat(np.array(ids, dtype=np.int64), [len(f) for f in found])
            salt = salts(tokens, owner, frequent)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(salt), pa.array(owner)], names=["token", "salt", "doc_id"])

    return docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text").mapInArrow(run, "token long not null, salt int not null, doc_id long not null")


def salts(tokens: np.ndarray, owner: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), dtype=np.int32)
    hot = frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens
    return np.where(hot, owner % SALTS + 1, 0).astype(np.int32)


def frequent_anchors(docs: DataFrame) -> np.ndarray:
    """Anchors that many sampled documents hold; the list only decides which ones are salted."""
    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    counted = filed(sample, np.empty(0, np.int64)).groupBy("token").count().filter(F.col("count") >= FREQUENT)
    top = counted.orderBy(F.desc("count"), "token").limit(MAX_FREQUENT).collect()
    return np.sort(np.array([r["token"] for r in top], dtype=np.int64))


def shared_anchors(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``doc_id, tokens``: the anchors of each document that another document holds too."""
    spread = filed(docs, frequent).repartition("token", "salt")
    each = spread.groupBy("token", "salt").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.max("salt").alias("hot"))
    hot = each.filter("hot > 0").groupBy("token").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    hot = hot.select("token", F.explode(F.sequence(F.lit(1), F.lit(SALTS))).alias("salt"), "lo", "hi")
    shared = each.filter("hot = 0").select("token", "salt", "lo", "hi").unionByName(hot).filter("lo < hi")
    members = spread.join(shared.select("token", "salt").hint("shuffle_hash"), ["token", "salt"])
    return members.groupBy("doc_id").agg(F.collect_list("token").alias("tokens"))


def passages_of(texts: DataFrame, frequent: np.ndarray, hot_only: bool, window: int = WINDOW) -> DataFrame:
    """``token, salt, doc_id, text_key, at, words``: runs of windows under one shared anchor."""
    names = ["token", "salt", "doc_id", "text_key", "at", "words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            rows: list[tuple] = []
            tokens = b.column("tokens")
            for i, (doc, packed) in enumerate(zip(b.column("doc_id").to_pylist(), b.column("packed").to_pylist())):
                shared = tokens[i].values.to_numpy()
                if hot_only and not salts(shared, np.full(len(shared), doc), frequent).any():
                    continue
                text = unpack.decompress(packed)
                a = anchors(word_hashes(text), window)
                if not len(a):
                    continue
                edge = np.flatnonzero(np.diff(a, prepend=a[0] + 1, append=a[-1] + 1))
                begin, end = edge[:-1], edge[1:]
                follow = np.isin(a[begin], shared)
                begin, end = begin[follow], end[follow]
                salt = salts(a[begin], np.full(len(begin), doc), frequent)
                if hot_only:
                    begin, end, salt = begin[salt > 0], end[salt > 0], salt[salt > 0]
                if not len(begin):
                    continue
                words, key = text.split(), text_key(text)
                for t, salted, s, e in zip(a[begin].tolist(), salt.tolist(), begin.tolist(), end.tolist()):
                    rows.append((t, salted, doc, key, s, b" ".join(words[s : e + window - 1])))
                if len(rows) > 20_000:
                    yield batch(rows)
                    rows = []
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)

    return texts.mapInArrow(run, "token long, salt int, doc_id long, text_key long, at int, words binary")


def text_key(text: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)


def repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_key, spans``: the word intervals (start, end) to remove from each document."""
    ship(docs.sparkSession)
    frequent = frequent_anchors(docs)
    texts = packed_texts(docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")).join(settle(shared_anchors(docs, frequent)), "doc_id")
    found = passages_of(texts, frequent, hot_only=False, window=window)
    if len(frequent):
        # Salted anchors: each salt gets the distinct passages of all, with their smallest document.
        hot = passages_of(texts, frequent, hot_only=True, window=window).groupBy("token", "words").agg(F.min("doc_id").alias("doc_id"))
        every = F.explode(F.sequence(F.lit(1), F.lit(SALTS))).alias("salt")
        found = found.unionByName(hot.select("token", every, "doc_id", F.lit(0).cast("long").alias("text_key"), F.lit(-1).alias("at"), "words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            while size + len(b) > SHARD_PASSAGES:
                # Close the shard where an anchor ends; an anchor of its own size stays whole.
                t = b.column("token").to_numpy()
                before = held[-1].column("token")[-1].as_py() if held else None
                cut = int(np.argmax(t != before)) if before is not None and (t != before).any() else (len(t) if before is not None else 0)
                if before is None:
                    ends = np.flatnonzero(np.diff(t)) + 1
                    if not len(ends):
                        break
                    cut = int(ends[min(np.searchsorted(ends, SHARD_PASSAGES), len(ends) - 1)])
                elif cut == len(t):
                    break
                yield answer([*held, b.slice(0, cut)])
                held, size, b = [], 0, b.slice(cut)
            if len(b):
                held.append(b)
                size += len(b)
        if held:
            yield answer(held)

    def answer(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        words, doc = table["words"].to_pylist(), table["doc_id"].to_numpy()
        at, key = table["at"].to_numpy(), table["text_key"].to_numpy()
        least = removable(words, doc, window)
        live = np.flatnonzero(at >= 0)
        doc, at, key = doc[live], at[live], key[live]
        owners = [least[words[i]] for i in live.tolist()]
        sizes = np.array([len(x) for x in owners], dtype=np.int64)
        row = np.repeat(np.arange(len(owners)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        over = np.flatnonzero(np.concatenate([np.empty(0, np.int64), *owners]) < doc[row])
        # Consecutive windows of a passage make one interval.
        new = np.ones(len(over), dtype=bool)
        new[1:] = (np.diff(over) > 1) | (np.diff(row[over]) != 0)
        first, last = over[new], over[np.append(new[1:], True)[: len(over)]]
        of = row[first]
        columns = {"doc_id": doc[of], "text_key": key[of], "start": (at[of] + place[first]).astype(np.int32), "end": (at[of] + place[last] + window).astype(np.int32)}
        return pa.RecordBatch.from_pydict({c: pa.array(x) for c, x in columns.items()})

    shards = found.repartition("token", "salt").sortWithinPartitions("token", "salt")
    spans = shards.mapInArrow(run, "doc_id long, text_key long, start int, end int")
    return spans.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (of the kept words, joined by one blank) per document."""
    spans = settle(repeated(docs, window)).withColumnRenamed("text_key", "key")
    by_doc = spans.groupBy("doc_id").agg(F.collect_list(F.struct("key", "spans")).alias("all")).withColumnRenamed("doc_id", "_id")
    texts = packed_texts(docs)
    both = texts.join(by_doc, F.col("doc_id") == F.col("_id"), "left").select("doc_id", "packed", "all")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out = []
            for packed, every in zip(b.column("packed").to_pylist(), b.column("all")):
                text = unpack.decompress(packed)
                words = text.split()
                keep = np.ones(len(words), dtype=bool)
                if every.is_valid:
                    own = text_key(text)
                    for x in every.as_py():
                        if x["key"] == own:
                            for s in x["spans"]:
                                keep[s["start"] : s["end"]] = False
                kept = b" ".join(w for w, k in zip(words, keep) if k) if not keep.all() else b" ".join(words)
                out.append((len(words), int(len(words) - keep.sum()), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *columns], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT r, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d) WHERE i + 12 <= len(w)),
m AS (SELECT g, min(doc_id) AS lo FROM x GROUP BY g),
c AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM x JOIN m USING (g) WHERE lo < doc_id),
k AS (SELECT d.r, u.p, w[u.p] AS word FROM d, unnest(range(1, len(w) + 1)) AS u(p) WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.r = d.r AND c.p = u.p)),
t AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept FROM k GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (r)
"""


@query("op4_repeated_passages", SQL)
def op4_repeated_passages(spark, sf_dir):
    """Words that are left of each document when passages of earlier documents go."""
    return deduplicated(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")
