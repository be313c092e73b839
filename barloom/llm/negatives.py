"""Hard-negative mining by threshold joins over an inverted index (operator 12).

Scores are inner products of integer vectors. Rows are dealt to shards of bounded size; a task indexes one shard
and streams the anchors through it. Dimensions come in groups, those with the largest squares first, and the index
holds for every group the rows filed under it with their components, ordered by suffix norm (the norm of this and all
later groups). As ``x . y <= |x| |y|`` on any suffix, a row is left out of a group's list as soon as its suffix norm
times the anchor's is below the threshold: lists are read up to that row only, and postings that no
threshold of the shard can reach are not built. A search adds up partial scores group by group and prunes rows whose
score so far plus the bound on the rest is below the threshold; survivors get their whole product in 64-bit
integers. A threshold join finds every row at or above its threshold, so thresholds start high and are lowered
until the wanted rows are there: the first ``positives`` rows of the anchor's label, then for each of them the first
``negatives`` rows of other labels inside its window. The lowest threshold is the window's lower end (for positives:
none), where a join is complete in any case.

Rows with a null label or id, a null or empty vector, or a null or non-finite component take no part. Components are
held to +-2**28 after scaling, so that products of up to 128 dimensions stay exact. Vectors of different length are
not compared. Repeated rows count each by itself; only the anchor's own row is no candidate, and of
equal scores the smaller id comes first. An anchor with fewer rows than wanted gets all; one without a positive or with
an empty window has no rows in the result. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from barloom.llm.registry import query
from barloom.llm.tables import numbered, read, settle, ship, sized_broadcast

SHARD_ROWS = 32_768
GROUP = 8
LIMIT = 1 << 28
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
MAX_BROADCAST_KEYS = 100_000  # of three numbers each
FOUND = 1024  # lists of results in one Arrow batch


class Index:
    """Inverted lists over groups of dimensions for rows of integer vectors."""

    def __init__(self, rows: np.ndarray, floor: float = -np.inf, reach: float = np.inf):
        """``floor``: no search goes below it; ``reach``: the largest norm of a searched vector."""
        self.rows = np.ascontiguousarray(rows, dtype=np.int64)
        x = self.rows.astype(np.float64)
        self.dims = np.argsort(-(x * x).sum(axis=0), kind="stable")
        self.cuts = list(range(0, x.shape[1], GROUP))
        x = x[:, self.dims]
        self.suffix = self._suffix_norms(x)
        self.median = float(np.median(self.suffix[0]))
        self.lists = []
        for norm, at in zip(self.suffix, self.cuts):
            by = np.argsort(-norm, kind="stable")
            built = len(by) if floor <= 0 else int((norm * reach >= floor * (1 - 1e-6)).sum())
            self.lists.append((by, -norm[by], np.ascontiguousarray(x[by[:built], at : at + GROUP])))

    def _suffix_norms(self, x: np.ndarray) -> np.ndarray:
        squares = np.stack([(x[:, at : at + GROUP] ** 2).sum(axis=1) for at in self.cuts])
        return np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])

    def at_least(self, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose product with ``y`` is ``threshold`` or more, and the products."""
        q = y.astype(np.float64)[self.dims]
        rest = self._suffix_norms(q[None, :])[:, 0]
        need = threshold - 1e-6 * (1 + abs(threshold)) if np.isfinite(threshold) else threshold
        partial, alive = np.zeros(len(self.rows)), np.ones(len(self.rows), dtype=bool)
        unread = np.full(len(self.rows), -1.0)  # the bound on what a row's lists no longer say
        for g, (by, norm, values) in enumerate(self.lists):
            end = len(values)
            if need > 0 and rest[g] > 0:
                # From here on the suffix alone cannot reach the threshold.
                end = min(end, int(np.searchsorted(norm, -need / rest[g] * (1 - 1e-9), side="right")))
            left = by[end:]
            unread[left] = np.where(unread[left] < 0, -norm[end:] * rest[g], unread[left])
            partial[by[:end]] += values[:end] @ q[self.cuts[g] : self.cuts[g] + GROUP]
            if need > -np.inf:
                ahead = self.suffix[g + 1] * rest[g + 1] if g + 1 < len(self.lists) else 0.0
                alive &= partial + np.where(unread < 0, ahead, unread) >= need
        found = np.flatnonzero(alive)
        score = self.rows[found] @ y.astype(np.int64)
        keep = score >= threshold
        return found[keep], score[keep]


def norm_of(y: np.ndarray) -> float:
    return float(np.sqrt((y.astype(np.float64) ** 2).sum()))


def lowered(index: Index, y: np.ndarray, start: float, floor: float, full: Callable[[np.ndarray, np.ndarray], bool]):
    """Threshold joins from ``start`` down until ``full(rows, scores)`` holds or the floor is reached."""
    step = 0.125 * index.median * norm_of(y)
    threshold, tries = max(start, floor), 0
    while True:
        rows, scores = index.at_least(y, threshold)
        if threshold <= floor or full(rows, scores):
            return rows, scores
        tries += 1
        threshold = floor if step == 0 or tries > 8 else max(floor, threshold - step * tries)


def usable(vector: str) -> Column:
    v = F.col(vector)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(v) > 0) & F.forall(v, fine), F.lit(False))


def integers(vector: str, scale: int) -> Column:
    whole = lambda x: F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(x.cast("double") * scale))).cast("long")
    return F.transform(vector, whole)


def streamed(rows: DataFrame, anchors: DataFrame, keys: list[str], search, names: tuple[str, ...], floor: float = -np.inf, reach: float = np.inf) -> DataFrame:
    """Both sides meet by ``keys`` in sorted partitions: the rows of a shard come first and are indexed, then its
    anchors stream through in blocks. ``search(shard, anchor)`` gives lists of the columns ``names``."""
    columns = list(dict.fromkeys([*keys, "side", "row", "vec_id", "label", "v", "goals"]))
    both = rows.withColumn("side", F.lit(0)).withColumn("goals", F.lit(None).cast("array<long>")).select(*columns)
    both = both.unionByName(anchors.withColumn("side", F.lit(1)).select(*columns))
    met = both.repartition(*keys).sortWithinPartitions(*keys, "side", "row")
    out = pa.schema([(c, pa.int64()) for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, shard, found = None, [], None, []

        def block():
            cols = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*found)]
            return pa.RecordBatch.from_arrays(cols, schema=out)

        for batch in batches:
            values, offsets = batch["v"].values.to_numpy(zero_copy_only=False), batch["v"].offsets.to_numpy()
            for k, r in enumerate(batch.drop_columns(["v"]).to_pylist()):
                r["v"] = values[offsets[k] : offsets[k + 1]]
                if tuple(r[c] for c in keys) != key:
                    key, held, shard = tuple(r[c] for c in keys), [], None
                if r["side"] == 0:
                    held.append((r["row"], r["vec_id"], r["label"], r["v"].copy()))
                    continue
                if held:
                    row, ids, labels, v = zip(*held)
                    shard, held = (Index(np.stack(v), floor, reach), np.array(row), np.array(ids), np.array(labels)), []
                if shard is not None:
                    found += search(shard, r)
                if len(found) >= FOUND:
                    yield block()
                    found = []
        if found:
            yield block()

    return met.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def dealt(rows: DataFrame, keys: list[str], shard_rows: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with their ``piece`` among the shards of ``keys``, and the number of pieces by key."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    most = F.greatest(F.ceil(F.col("_n") / shard_rows), F.least(F.lit(cores), F.ceil(F.col("_n") / (shard_rows // 8 + 1))))
    # A row per key: sent to all tasks while it is small, so that a frequent key stays where its rows are.
    counts = sized_broadcast(settle(counts.select(*keys, most.cast("int").alias("pieces"))), MAX_BROADCAST_KEYS)
    spread = rows.join(counts, keys).withColumn("piece", F.pmod(F.xxhash64("row"), F.col("pieces")).cast("int"))
    return spread.drop("pieces"), counts


def mined(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    scale: int = 256,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``vec_id, embedding, label``.

    A negative of rank r is the r-th of the rows with another label whose score lies between ``low`` and ``high`` percent of the
    positive's. Anchors go to every shard: they are the stated query set, and only they are copied.
    """
    ship(vectors.sparkSession)
    clean = vectors.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("embedding"))
    clean = clean.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if label is None else label).cast("long").alias("label"),
        integers("embedding", scale).alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    )
    clean = settle(numbered(clean.withColumn("n", F.size("v"))).withColumnRenamed("_row", "row"))
    asked = clean.filter("is_anchor").withColumn("goals", F.lit(None).cast("array<long>"))

    def first_of_label(shard, anchor):
        index, row, ids, _ = shard
        y = anchor["v"]
        others = lambda at, s: int((row[at] != anchor["row"]).sum()) >= positives
        at, score = lowered(index, y, 0.5 * norm_of(y) * index.median, -np.inf, others)
        at, score = at[row[at] != anchor["row"]], score[row[at] != anchor["row"]]
        by = np.lexsort((ids[at], -score))[:positives]
        return [([anchor["row"]] * len(by), [anchor["vec_id"]] * len(by), ids[at[by]], score[by])] if len(by) else []

    spread, counts = dealt(clean, ["n", "label"], shard_rows)
    to_pieces = lambda c: F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    sent = asked.join(counts, ["n", "label"]).withColumn("piece", to_pieces(counts)).drop("pieces")
    near = streamed(spread, sent, ["n", "label", "piece"], first_of_label, ("row", "anchor_id", "positive_id", "positive_score"))
    order = W.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    near = settle(near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives).drop("place"))

    def windows(shard, anchor):
        index, row, ids, labels = shard
        goals = np.array(sorted(set(anchor["goals"]), reverse=True), np.int64)
        # The integers s with low * goal <= 100 * s <= high * goal.
        least, most = -((-low * goals) // 100), (high * goals) // 100
        goals, least, most = goals[least <= most], least[least <= most], most[least <= most]
        if not len(goals):
            return []

        def inside(at, score):
            other = labels[at] != anchor["label"]
            return [np.flatnonzero(other & (score >= a) & (score <= b)) for a, b in zip(least, most)]

        full = lambda at, s: all(len(k) >= negatives for k in inside(at, s))
        at, score = lowered(index, anchor["v"], float(0.75 * most.min()), float(least.min()), full)
        found = []
        for goal, k in zip(goals.tolist(), inside(at, score)):
            by = k[np.lexsort((ids[at[k]], -score[k]))[:negatives]]
            if len(by):
                found.append(([anchor["row"]] * len(by), [goal] * len(by), ids[at[by]], score[by]))
        return found

    goals = near.groupBy("row").agg(F.collect_set("positive_score").alias("goals"))
    spread, counts = dealt(clean, ["n"], shard_rows)
    sent = asked.drop("goals").join(goals, "row").join(counts, "n").withColumn("piece", to_pieces(counts)).drop("pieces")
    # No search goes below the lower end of the lowest window; a window below zero is empty.
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    reach = asked.agg(F.max(norm)).first()[0] or 0.0
    floor = low / 100 * (near.filter("positive_score >= 0").agg(F.min("positive_score")).first()[0] or 0)
    hard = streamed(spread, sent, ["n", "piece"], windows, ("row", "positive_score", "negative_id", "negative_score"), floor, reach)
    order = W.partitionBy("row", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return near.join(hard, ["row", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, a.label = c.label AS same, c.vec_id, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
      FROM v a JOIN v c ON a.r <> c.r AND len(a.e) = len(c.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT ar, anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.ar, p.positive_id, p.positive_score ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10
"""


@query("op12_hard_negatives", SQL)
def op12_hard_negatives(spark, sf_dir):
    """Ten negatives for each of the five positives of every row whose id is divisible by 100."""
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, turned)
