"""N-gram Jaccard join with a count-vector R-tree (operator 9).

A document is its set of five-word shingles. Two documents link when 100 * common >= 75 * union. Equal
sets are one node from the start. Shingles are hashed into groups, up to three to a shingle (half as many as shingles in large sets); the group counts of a set are a
point, and the sum of the smaller coordinates of two points bounds their overlap. With that many groups few shingles meet by
chance: near the threshold only those that two sets do not share can. Points travel packed, and are indexed in an R-tree
of packed nodes with upper corners; pairs whose bound can reach the threshold are verified on the texts.

Which points meet: a pair over the threshold shares one of the first |s| - ceil(0.75 |s|) + 1 shingles of
each set in any common order, so the tree of a shingle holds the sets that have it there. The order is by hash with
shingles that are frequent in a sample last; the sample moves work, never a result. Shingles with the same
list of sets keep one tree, and sets too large or too small for all others of a tree leave it before any vector is sent.

The first search takes every set to ``SEEDS`` of its trees only, which joins most near copies. Then only those rows of a
tree are searched that have a set of another component, and a size that can link, beside them: a tree of one component sends no vector.
A block of a tree joins the classes of its sets as pairs pass the bound, and searches no pair inside a class: a group of
thousands of near copies costs links, not pairs. Large trees are dealt into blocks by hash: the sets outside a tree's largest
component meet all blocks. Where a pair that joined two classes turns out not to link, the components of that class meet in that tree once
more, with their texts: there only pairs that link join.

A null or empty text has no shingle and no link. Fewer than five words are one shingle. A null id is kept as
its own row; a component takes the smallest id in it. Repeated rows keep a result each. An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from barloom.llm.graph import components, merged
from barloom.llm.hashing import PLACES, mix, window_hashes, word_hashes
from barloom.llm.registry import query
from barloom.llm.tables import fill, read, settle, ship

WIDTH = 5
PERCENT = 75
BLOCK = 1024
SEARCH_BLOCK = 2048
MAX_CORNER = 4096  # longest point in an R-tree
SAMPLE = 64  # one document in so many decides the order of the shingles
FREQUENT = 4  # shingles in so many sampled documents go last
MAX_FREQUENT = 50_000
SALTS = 32
SEEDS = 2  # trees of each set in the first search
CHECKED = 64  # sets compared at once with one, before the classes are looked at again
REMEMBERED = 2048  # sets a task keeps for the next trees
SMALL_SIDE = 200_000  # rows of ids and keys that may be broadcast
BATCH_ROWS = 500  # whole texts or vectors that a worker is sent at once


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text; only A-Z are lower-cased."""
    h = word_hashes((text or "").encode("utf-8", "surrogatepass"), lower=True)
    if not len(h):
        return h
    if len(h) < width:
        return mix((h * PLACES[: len(h)]).sum(keepdims=True, dtype=np.uint64), salt=len(h))
    s = np.sort(window_hashes(h, width))
    return s[np.concatenate([[True], s[1:] != s[:-1]])]


def set_key(s: np.ndarray) -> bytes:
    """128 bits that stand for a set of hashes."""
    both = np.array([mix(s, 1).sum(dtype=np.uint64), mix(s, 2).sum(dtype=np.uint64)], dtype=">u8")
    return both.tobytes()


def groups_for(n: int) -> int:
    """The groups of a set of ``n`` shingles: one and a half to three times as many, of a large set half as many or more.

    Chance weighs less in large sets, and they stand in many trees. Larger sets never have fewer groups.
    """
    return 1 << max(4, (int(n) * 3 // 2).bit_length()) if n <= 512 else max(1024, 1 << (int(n).bit_length() - 1))


def counts(s: np.ndarray) -> bytes:
    """The packed group counts of a set; a full byte stands for any count."""
    g = groups_for(len(s))
    c = np.bincount((s % np.uint64(g)).astype(np.int64), minlength=g)
    return zstandard.ZstdCompressor(level=1).compress(np.minimum(c, 255).astype(np.uint8).tobytes())


def folded(x: np.ndarray, g: int) -> np.ndarray:
    """Counts folded to ``g`` groups."""
    if len(x) == g and x.max() < 255:
        return x
    wide = x.astype(np.int32)
    wide[wide == 255] = 1 << 20
    return np.minimum(wide.reshape(-1, g).sum(axis=0), 1 << 20).astype(np.int32)


def first_shingles(s: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The shingles a set is filed under, and which of them are frequent."""
    n = len(s)
    keep = n - -(-n * percent // 100) + 1
    last = np.zeros(n, dtype=bool)
    if len(frequent) and n:
        last = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
        order = np.argsort(last, kind="stable")
        s, last = s[order], last[order]
    return s[:keep], last[:keep]


def over_texts(docs: DataFrame, schema: str, row):
    """Apply ``row(doc_id, text, seen, *rest)``, which gives a result tuple or None, to all documents.

    ``seen`` is a set that lasts for the task, ``rest`` the values of further columns.
    """
    ship(docs.sparkSession)
    names = [c.split()[0] for c in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            rest = list(zip(*[c.to_pylist() for c in b.columns[2:]])) or [()] * b.num_rows
            columns = [row(i, t.as_py(), seen, *r) for i, t, r in zip(b.column(0).to_pylist(), b.column(1), rest)]
            yield from pack([c for c in columns if c is not None], names)

    return docs.mapInArrow(run, schema)


TYPES = {"doc_id": pa.int64(), "nid": pa.int64(), "n": pa.int64(), "key": pa.binary(), "vec": pa.binary(), "m1": pa.int64(), "m2": pa.int64(), "token": pa.int64(), "first": pa.list_(pa.int64()), "rare": pa.int32()}


def pack(columns: list, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Tuples of arrays (one tuple per document) to record batches."""
    if columns:
        arrays = []
        for k, name in enumerate(names):
            part = [c[k] for c in columns]
            flat = np.concatenate(part) if isinstance(part[0], np.ndarray) else [x for p in part for x in p]
            arrays.append(pa.array(flat, TYPES[name]))
        yield pa.RecordBatch.from_arrays(arrays, names=names)


def node_id(s: np.ndarray) -> int:
    """64 bits of a set. Sets that share them only meet more often; pairs are decided by key."""
    return int(mix(s, 3).sum(dtype=np.uint64).astype(np.int64))


def settled(df: DataFrame) -> DataFrame:
    """``settle``, with texts sent to the workers in small batches."""
    return settle(df, BATCH_ROWS)


def marked(docs: DataFrame) -> DataFrame:
    """``docs`` with two hashes that together tell texts apart."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("m1"), F.xxhash64(F.lit(1), "text").alias("m2"))


def sets_of(docs: DataFrame, frequent: np.ndarray = np.empty(0, np.uint64)) -> DataFrame:
    """``doc_id, nid, n, key, vec, first, rare, m1, m2`` of every row: each text is cut into shingles once.

    ``first`` has the shingles a set is filed under, of which the first ``rare`` are not frequent. A task gives it
    and the vector of equal sets once.
    """

    def row(doc_id, text, seen, m1, m2):
        s = shingles(text)
        key = set_key(s) if len(s) else None
        vec = first = rare = None
        if len(s) and key not in seen:
            first, hot = first_shingles(s, frequent)
            vec, first, rare = counts(s), first.view(np.int64), int(len(hot) - hot.sum())
        seen.add(key)
        return [doc_id], [node_id(s)], [len(s)], [key], [vec], [first], [rare], [m1], [m2]

    return over_texts(marked(docs), "doc_id long,nid long,n long,key binary,vec binary,first array<long>,rare int,m1 long,m2 long", row)


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles that many sampled documents hold, sorted; at most ``MAX_FREQUENT``."""

    def row(doc_id, text, seen):
        return (shingles(text).view(np.int64),)

    sample = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)
    counted = over_texts(sample, "token long", row).groupBy("token").count().filter(F.col("count") >= FREQUENT)
    top = counted.orderBy(F.desc("count"), "token").limit(MAX_FREQUENT).collect()
    return np.sort(np.array([r["token"] for r in top], dtype=np.int64).view(np.uint64))


def occurrences(sets: DataFrame) -> DataFrame:
    """``token, salt, nid``: the first shingles of each set; frequent ones are salted by set.

    Documents with equal sets give the rows of one, at most once per task.
    """
    rows = sets.filter("first IS NOT NULL").select("nid", "rare", F.posexplode("first").alias("at", "token"))
    salt = F.when(F.col("at") < F.col("rare"), F.lit(0)).otherwise((F.pmod("nid", F.lit(SALTS)) + 1).cast("int"))
    # None is ever null: columns that might be would be filtered below the shuffle, which its readers then would not share.
    known = {"token": F.col("token"), "salt": salt, "nid": F.col("nid")}
    return rows.select(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in known.items()])


def trees(docs: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """``tree, most, nid``: the distinct sets that meet in each tree, and their number. ``sets`` are those of ``docs``, if they are there already.

    One shuffle deals the shingles out, and rows of equal sets from several tasks are dropped behind it; lists of
    sets are told apart by a count and two combined hashes.
    """
    spread = occurrences(sets_of(docs, frequent_shingles(docs)) if sets is None else sets).repartition("token", "salt").dropDuplicates(["token", "salt", "nid"])
    lists = spread.groupBy("token", "salt").agg(
        F.count("*").alias("c"),
        F.bit_xor(F.xxhash64(F.lit(2), "nid")).alias("s"),
        F.bit_xor(F.xxhash64(F.lit(1), "nid")).alias("x"),
        F.max("salt").alias("hot"),  # filters on it stay above the shuffle, which all readers so share
    )
    hot = lists.filter("hot > 0").groupBy("token").agg(F.sum("c").alias("c"), F.bit_xor("s").alias("s"), F.bit_xor("x").alias("x"))
    shared = lists.filter("hot = 0").select("token", "c", "s", "x").unionByName(hot).filter("c > 1")
    one = shared.groupBy("c", "s", "x").agg(F.min("token").alias("token")).select("token", F.col("c").alias("most"))
    salted = one.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS))))
    members = spread.join(salted.hint("shuffle_hash"), ["token", "salt"])
    return members.select(F.col("token").alias("tree"), "most", "nid")


def in_reach(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``tree, most, nid``: the ``members`` with a set of another component that is near enough in size to link, and one tree a list.

    ``nodes`` has ``nid, n, comp``. Sizes are counted in bands a little wider than the ratio that can link, so partners are in
    the same band or the next.
    """
    band = F.floor(F.log("n") / F.log(F.lit(1.005 * 100 / PERCENT)))
    placed = nodes.select("nid", "comp", band.alias("band")).repartition("nid").distinct()  # dealt out as the join needs it
    rows = members.select("tree", "nid").join(placed, "nid")
    held = rows.groupBy("tree", "band").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    near = held.withColumn("band", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    near = near.groupBy("tree", "band").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("tree", "band")
    rows = rows.join(near, ["tree", "band"], "left_semi").select("tree", "nid").repartition("tree")  # once for both that follow
    lists = rows.groupBy("tree").agg(
        F.count("*").alias("most"),
        F.bit_xor(F.xxhash64(F.lit(2), "nid")).alias("s"),
        F.bit_xor(F.xxhash64(F.lit(1), "nid")).alias("x"),
    )
    one = lists.groupBy("most", "s", "x").agg(F.min("tree").alias("tree")).select("tree", "most")
    return rows.join(one, "tree").select("tree", "most", "nid")


def seeds(members: DataFrame) -> DataFrame:
    """``tree, most, nid``: the ``SEEDS`` trees of each set that are first by hash, and the sets that so meet in each."""
    first = [F.min(F.struct(F.xxhash64("tree", F.lit(k)).alias("h"), "tree")).getField("tree") for k in range(SEEDS)]
    rows = members.groupBy("nid").agg(F.array_distinct(F.array(*first)).alias("tree")).select("nid", F.explode("tree").alias("tree"))
    return rows.join(rows.groupBy("tree").agg(F.count("*").alias("most")).filter("most > 1"), "tree").select("tree", "most", "nid")


class RTree:
    """Packed R-tree of count vectors: leaves of points in order, nodes with upper corners."""

    FAN = 16

    def __init__(self, points: np.ndarray):
        self.levels = [points]
        while len(self.levels[-1]) > self.FAN:
            below = self.levels[-1]
            cuts = np.arange(0, len(below), self.FAN)
            self.levels.append(np.maximum.reduceat(below, cuts, axis=0))

    def search(self, q: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Rows whose bound reaches ``need`` (an array over the rows, lowest of a node counts)."""
        lows = [need]
        for level in self.levels[1:]:
            lows.append(np.minimum.reduceat(lows[-1], np.arange(0, len(lows[-1]), self.FAN)))
        at = np.arange(len(self.levels[-1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            bound = np.minimum(self.levels[depth][at], q).sum(axis=1)
            at = at[bound >= lows[depth][at]]
            if depth:
                at = (at[:, None] * self.FAN + np.arange(self.FAN)).ravel()
                at = at[at < len(self.levels[depth - 1])]
        return at


class Window:
    """Some sets in order of size, searched by the R-tree of their points, all folded to the groups of the smallest."""

    def __init__(self, n: np.ndarray, vecs: list[np.ndarray], percent: int):
        self.n, self.vecs, self.percent = n, vecs, percent
        self.g = min(groups_for(int(n[0])), MAX_CORNER)
        points = np.stack([folded(v, self.g) for v in vecs])
        self.points = points.astype(np.uint8) if points.max() < 256 else points
        self.tree = RTree(self.points) if len(n) > RTree.FAN else None

    def partners(self, i: int, allowed: np.ndarray) -> np.ndarray:
        """Allowed rows whose bound with row ``i`` reaches the threshold, in the groups of the smaller set."""
        need = -(-self.percent * (self.n + self.n[i]) // (100 + self.percent))
        if self.tree is None:
            at = np.flatnonzero(allowed)
            at = at[np.minimum(self.points[at], self.points[i]).sum(axis=1, dtype=np.int64) >= need[at]]
        else:
            at = self.tree.search(self.points[i], np.where(allowed, need, 1 << 40))
        g = len(self.vecs[i])
        if g > self.g:
            fine = [int(np.minimum(self.vecs[i], folded(self.vecs[j], g)).sum(dtype=np.int64)) for j in at.tolist()]
            at = at[np.array(fine, dtype=np.int64) >= need[at]] if (self.vecs[i] < 255).all() else at
        return at


def linking(s: np.ndarray, others: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """Which of the sets ``others`` link with ``s``; all are sorted and not empty."""
    sizes = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    hit = s[np.minimum(np.searchsorted(s, flat), len(s) - 1)] == flat
    common = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))
    return 100 * common >= percent * (len(s) + sizes - common)


def candidates(n: np.ndarray, vecs: list[bytes], comp: np.ndarray, side: np.ndarray | None, join: bool, percent: int = PERCENT, set_of: Callable[[int], np.ndarray] | None = None) -> Iterator[tuple[int, int]]:
    """Pairs of rows of different classes (and sides) whose bound reaches the threshold.

    Rows come sorted by size. With ``join`` a pair unites its classes, so that later pairs inside them are left out. With
    ``set_of``, the shingles of a row, only pairs that link count.
    """
    unpack = zstandard.ZstdDecompressor()
    points = [np.frombuffer(unpack.decompress(v), dtype=np.uint8) for v in vecs]
    comp = comp.copy()
    window, low, high = None, 0, 0
    # Sizes that can link are within 100 / percent; each run of sizes folds its points to one length.
    for i in range(len(n) - 1):
        top = int(np.searchsorted(n, n[i] * 100 // percent, side="right"))
        if top <= i + 1:
            continue
        if window is None or top > high or (window.tree is not None and groups_for(int(n[i])) != groups_for(int(n[low]))):
            low = i
            high = len(n) if len(n) <= RTree.FAN else int(np.searchsorted(n, n[top - 1] * 100 // percent, side="right"))
            window = Window(n[low:high], points[low:high], percent)
        allowed = comp[low:high] != comp[i]
        allowed[: i + 1 - low] = False
        allowed[top - low :] = False
        if side is not None:
            allowed &= side[low:high] != side[i]
        if not allowed.any():
            continue
        at = window.partners(i - low, allowed) + low
        for part in [at] if set_of is None else np.split(at, range(CHECKED, len(at), CHECKED)):
            if set_of is not None:
                part = part[comp[part] != comp[i]] if join else part
                part = part[linking(set_of(i), [set_of(j) for j in part.tolist()], percent)] if len(part) else part
            for j in part.tolist():
                if not join:
                    yield i, j
                elif comp[j] != comp[i]:
                    yield i, j
                    comp[comp == comp[j]] = comp[i]


def search_trees(members: DataFrame, join: bool) -> DataFrame:
    """Pairs ``tree, a, b, class`` of keys from rows ``tree, part, key, n, vec, comp, side`` and, if there, ``packed``.

    ``join``: the pairs that unite classes; else every pair between classes whose bound reaches the
    threshold. ``class`` is the least key of the pairs that hang together in a block. With ``packed``, the text, only pairs that
    link are given. A task reads its blocks in order and holds one at a time.
    """
    columns = ["key", "n", "vec", "comp", "side", *(["packed"] if "packed" in members.columns else [])]

    known: dict[bytes, np.ndarray] = {}

    def pairs(tree: int, rows: list[tuple]) -> list[tuple[int, bytes, bytes, bytes]]:
        if len(rows) < 2 or len(rows) == 2 and 100 * rows[0][1] < PERCENT * rows[1][1]:
            return []
        keys, n = [r[0] for r in rows], np.array([r[1] for r in rows])
        names = {c: i for i, c in enumerate(dict.fromkeys(r[3] for r in rows))}
        comp, side = np.array([names[r[3]] for r in rows]), np.array([r[4] for r in rows])
        side = side if (side != side[0]).any() else None

        def set_of(i: int) -> np.ndarray:
            if keys[i] not in known:
                if len(known) >= REMEMBERED:
                    known.pop(next(iter(known)))
                known[keys[i]] = shingles(zstandard.decompress(rows[i][5]).decode("utf-8", "surrogatepass"))
            return known[keys[i]]

        found = list(candidates(n, [r[2] for r in rows], comp, side, join, set_of=set_of if len(columns) > 5 else None))
        over = classes([(int(comp[i]), int(comp[j])) for i, j in found])
        least: dict[int, bytes] = {}
        for i, j in found:
            c = over[int(comp[i])]
            least[c] = min(least.get(c, keys[i]), keys[i], keys[j])
        return [(tree, min(keys[i], keys[j]), max(keys[i], keys[j]), least[over[int(comp[i])]]) for i, j in found]

    def as_batch(found: list) -> pa.RecordBatch:
        kinds = {"tree": pa.int64(), "a": pa.binary(), "b": pa.binary(), "class": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate(kinds.values())], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], (None, None)
        for batch in batches:
            found: list = []
            places = zip(batch.column("tree").to_pylist(), batch.column("part").to_pylist())
            for place, row in zip(places, zip(*[batch.column(c).to_pylist() for c in columns])):
                if place != at:
                    found += pairs(at[0], held)
                    held, at = [], place
                held.append(row)
            yield as_batch(found)
        yield as_batch(pairs(at[0], held))

    dealt = members.repartition("tree", "part").sortWithinPartitions("tree", "part", "n", "key")
    return dealt.select("tree", "part", *columns).mapInArrow(run, "tree long, a binary, b binary, class binary")


def classes(pairs: list[tuple[int, int]]) -> dict[int, int]:
    """The class of every number in ``pairs``: numbers that pairs connect share one."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    for x, y in pairs:
        up[top(x)] = top(y)
    return {x: top(x) for x in list(up)}


def across_blocks(named: DataFrame) -> DataFrame:
    """``tree, part, key, comp, side``: the cells in which sets of several components meet.

    ``named`` has ``tree, key, comp``. A tree no larger than a block is one cell. In a larger one rows of the largest component
    meet the others only, so they are copied once per block of others; the others meet each block of either kind once.
    """
    sizes = named.groupBy("tree", "comp").agg(F.count("*").alias("c")).groupBy("tree")
    sizes = sizes.agg(F.sum("c").alias("all"), F.max(F.struct("c", "comp")).alias("top")).filter("`all` > top.c")
    blocks = lambda c: F.ceil(c / SEARCH_BLOCK).cast("int")
    sizes = sizes.select("tree", (F.col("all") <= SEARCH_BLOCK).alias("small"), F.col("top.comp").alias("main"), blocks(F.col("top.c")).alias("mains"), blocks(F.col("all") - F.col("top.c")).alias("rest"))
    rows = named.join(sizes, "tree").withColumn("other", F.col("comp") != F.col("main"))
    rows = rows.withColumn("i", F.pmod(F.xxhash64("key"), F.when(F.col("other"), F.col("rest")).otherwise(F.col("mains"))).cast("long"))
    mixed = lambda main, rest: main * F.col("rest") + rest
    to_others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("rest") - F.lit(1).cast("long")), lambda o: F.struct(mixed(F.col("i"), o).alias("part"), F.lit(0).alias("side")))
    to_main = F.transform(F.sequence(F.lit(0).cast("long"), F.col("mains") - F.lit(1).cast("long")), lambda m: F.struct(mixed(m, F.col("i")).alias("part"), F.lit(1).alias("side")))
    # Cells of two blocks of others are numbered behind those; a cell of one block compares all its rows.
    base = F.col("mains").cast("long") * F.col("rest")
    pair = lambda o: base + F.least(F.col("i"), o) * F.col("rest") + F.greatest(F.col("i"), o)
    among = F.transform(F.sequence(F.lit(0).cast("long"), F.col("rest") - F.lit(1).cast("long")), lambda o: F.struct(pair(o).alias("part"), F.col("i").cast("int").alias("side")))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("part"), F.lit(0).alias("side")))
    cells = F.explode(F.when(F.col("small"), whole).when(F.col("other"), F.concat(to_main, among)).otherwise(to_others))
    return rows.withColumn("cell", cells).select("tree", "key", "comp", "cell.part", "cell.side")


def verified(pairs: DataFrame, content: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs that link, decided on the shingles of both whole texts."""
    left = content.select(F.col("key").alias("a"), F.col("packed").alias("pa"))
    right = content.select(F.col("key").alias("b"), F.col("packed").alias("pb"))
    both = pairs.filter("a != b").join(left, "a").join(right, "b").select("a", "b", "pa", "pb")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, last = zstandard.ZstdDecompressor(), (None, None)
        text = lambda p: unpack.decompress(p).decode("utf-8", "surrogatepass")
        for batch in batches:
            keep = []
            for i, (p, q, b) in enumerate(zip(batch.column("pa"), batch.column("pb"), batch.column("b").to_pylist())):
                if last[0] != b:
                    last = (b, shingles(text(q.as_py())))
                x, y = shingles(text(p.as_py())), last[1]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_pydict({c: batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "b")})

    return both.mapInArrow(check, "a binary, b binary")


def contents(docs: DataFrame, wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """``key, packed``: one compressed text for each wanted set.

    The document with the least id, and hashes of its text, stand for a set. While there are few of them they are
    broadcast, and no other text is moved; else texts are compressed before the shuffle.
    """
    names = ["doc_id", "m1", "m2"]
    schema = "doc_id long, m1 long, m2 long, packed binary"

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for b in batches:
            packed = pa.array([squeeze.compress(t.as_py().encode("utf-8", "surrogatepass")) for t in b.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), packed], names=[*names, "packed"])

    held = sets.join(wanted, "key", "left_semi").groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull(), *names)).alias("h"))
    held = settled(held.select("key", *[F.col(f"h.{c}").alias(f"h_{c}") for c in names]))
    texts = marked(docs).filter("text IS NOT NULL")
    same = F.col("doc_id").eqNullSafe(F.col("h_doc_id")) & (F.col("m1") == F.col("h_m1")) & (F.col("m2") == F.col("h_m2"))
    if held.count() <= SMALL_SIDE:
        found = texts.join(F.broadcast(held.drop("key")), same, "left_semi").mapInArrow(compress, schema)
        found = found.join(F.broadcast(held), same)
    else:
        found = texts.mapInArrow(compress, schema).join(held, same)
    return found.select("key", "packed").dropDuplicates(["key"])


def linked(docs: DataFrame) -> DataFrame:
    """``doc_id, n, key, component_id`` for every row of ``doc_id, text``."""
    docs = docs.select("doc_id", "text")
    sets = settled(sets_of(docs, frequent_shingles(docs)))
    nodes = settled(sets.filter("vec IS NOT NULL").select("nid", "key", "n", "vec").dropDuplicates(["key"]))
    members = settled(in_reach(trees(docs, sets), nodes.select("nid", "n", F.col("nid").alias("comp"))))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The pairs that link."""
        pairs = settled(pairs)
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        return settled(verified(pairs, contents(docs, wanted, sets)))

    # First search: the blocks of some trees of each set. The blocks of a large tree are dealt anew for every tree.
    part = F.pmod(F.xxhash64("key", "tree"), F.ceil(F.col("most") / BLOCK))
    near = seeds(members).join(nodes, "nid").withColumns({"part": part, "comp": F.xxhash64("key"), "side": F.lit(0)})
    links = confirmed(search_trees(near, join=True).select("a", "b").distinct())
    roots = components(links, roots=False)

    # Between components: all trees, then what met in a class that a pair joined without a link. That search has the texts.
    open_ = members
    for exact in (False, True):
        to = roots.select(F.col("node").alias("key"), "root")
        comps = settled(nodes.select("nid", "n", "key").join(to, "key", "left").withColumn("comp", F.xxhash64(F.coalesce("root", "key"))).drop("root"))
        left = settled(in_reach(open_, comps))
        if left.isEmpty():
            break
        named = settled(left.join(comps, "nid").select("tree", "nid", "key", "comp"))
        cells = across_blocks(named.drop("nid")).join(nodes, "key")
        if exact:  # what it finds links
            cells = cells.join(settled(contents(docs, named.select("key").distinct(), sets)), "key")
            more = settled(search_trees(cells, join=True).select("a", "b"))
        else:
            found = settled(search_trees(cells, join=True))
            more = confirmed(found.select("a", "b").distinct().join(links, ["a", "b"], "left_anti"))
            failed = failed_classes(found, links.unionByName(more)).join(comps, "key").select("tree", "comp").distinct()
            open_ = settled(named.join(failed, ["tree", "comp"], "left_semi").select("tree", "nid"))
        roots = settled(merged(roots, more))
    rows = sets.select("doc_id", "n", "key").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "root", "left").select("doc_id", "n", "key", F.coalesce("component_id", "doc_id").alias("component_id"))


def failed_classes(found: DataFrame, links: DataFrame) -> DataFrame:
    """``tree, key``: sets in the pairs of a class that hold a pair without a link."""
    wrong = found.select("a", "b").distinct().join(links, ["a", "b"], "left_anti")
    failed = found.join(wrong, ["a", "b"], "left_semi").select("tree", "class").distinct()
    return found.join(failed, ["tree", "class"], "left_semi").select("tree", F.explode(F.array("a", "b")).alias("key"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of every component: that with the smallest id. Empty ones stay."""
    found = linked(docs).select(F.col("doc_id").alias("_id"), "component_id", "key")
    drop = found.filter(F.col("key").isNotNull() & (F.col("_id") != F.col("component_id"))).select("_id").distinct()
    # Equal rows share an id; one of them stays.
    return docs.join(drop, F.col("doc_id") == F.col("_id"), "left_anti").select(*docs.columns).dropDuplicates(["doc_id", "text"])


SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM d)),
z AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
e AS MATERIALIZED (SELECT c.a, c.b FROM c JOIN z x ON x.r = c.a JOIN z y ON y.r = c.b WHERE 100 * k >= 75 * (x.n + y.n - k)),
t(r, m) AS (SELECT r, r FROM d UNION SELECT e.b, t.m FROM t JOIN e ON e.a = t.r),
q AS (SELECT t.r, min(o.doc_id) AS component_id FROM t JOIN d o ON o.r = t.m GROUP BY t.r)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM d LEFT JOIN z USING (r) LEFT JOIN q USING (r)
"""


@query("op9_jaccard_join", SQL)
def op9_jaccard_join(spark, sf_dir):
    """Component of every document under links of 75 % shared shingles."""
    return linked(read(spark, sf_dir, "documents")).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
