"""Approximate nearest neighbours with vantage-point trees per shard (operator 2).

Vectors are dealt to shards of bounded size; a task builds one vantage-point tree per shard over unit
vectors, where the Euclidean distance orders like the cosine, and answers all queries of a block in it.
A branch is left out if the triangle inequality puts it ``factor`` times the current reach away: factor
1 is exact search, smaller factors prune more. The shards' best candidates are scored exactly
on the original vectors in double precision and merged per query.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an
id; equal rows count once. Vectors are compared with those of their own length. A query with fewer
candidates than ``k`` gets all of them. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from barloom.llm.registry import query
from barloom.llm.tables import read, settle, ship

SHARD_ROWS = 8192
BLOCK_ROWS = 2048
LEAF = 256
FACTOR = 0.4


class Tree:
    """Vantage-point tree over the rows of ``unit``, searched for many queries at a time."""

    def __init__(self, unit: np.ndarray, leaf: int = LEAF, seed: int = 7):
        self.unit, self.leaf = unit, leaf
        self.pick = np.random.default_rng(seed)
        self.root = self._build(np.arange(len(unit)))

    def _build(self, rows: np.ndarray):
        stack_leaf = rows
        if len(rows) <= self.leaf:
            return stack_leaf
        # Of a few drawn vantage points the one whose distances spread most.
        drawn = self.pick.choice(rows, size=min(5, len(rows)), replace=False)
        dist = distances(self.unit[drawn], self.unit[rows])
        best = int(np.argmax(dist.var(axis=1)))
        d = dist[best]
        radius = float(np.median(d))
        near = d <= radius
        if near.all() or not near.any():
            near = d < radius
            if near.all() or not near.any():
                return stack_leaf  # all at one distance: no split helps
        return drawn[best], radius, self._build(rows[near]), self._build(rows[~near])

    def search(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, factor: float):
        """For each query the rows of this tree that may be among its ``k`` nearest, as (query, row)."""
        self.reach = np.full(len(queries), np.inf)
        self.best = np.full((len(queries), k), np.inf)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.q, self.own, self.ids, self.k, self.factor = queries, own, ids, k, factor
        self._visit(self.root, np.arange(len(queries)))
        if not self.found:
            return np.empty(0, int), np.empty(0, int)
        q, r, d = (np.concatenate(x) for x in zip(*self.found))
        keep = d <= self.reach[q] + 1e-7  # ties of the last place stay in
        return q[keep], r[keep]

    def _visit(self, node, qs: np.ndarray) -> None:
        if not len(qs):
            return
        if isinstance(node, np.ndarray):
            d = distances(self.q[qs], self.unit[node])
            d[self.own[qs][:, None] == self.ids[node][None, :]] = np.inf
            near = np.sort(np.concatenate([self.best[qs], np.partition(d, min(self.k, len(node)) - 1, axis=1)[:, : self.k]], axis=1), axis=1)
            self.best[qs] = near[:, : self.k]
            self.reach[qs] = self.best[qs, -1]
            a, b = np.nonzero(d <= self.reach[qs][:, None] + 1e-7)
            fine = np.isfinite(d[a, b])
            self.found.append((qs[a[fine]], node[b[fine]], d[a[fine], b[fine]]))
            return
        point, radius, inner, outer = node
        gap = distances(self.q[qs], self.unit[point : point + 1])[:, 0] - radius
        inside = gap <= 0
        self._visit(inner, qs[inside])
        self._visit(outer, qs[~inside])
        open_ = np.abs(gap) <= self.reach[qs] * self.factor
        self._visit(outer, qs[inside & open_])
        self._visit(inner, qs[~inside & open_])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def unit_rows(x: np.ndarray) -> np.ndarray:
    top = np.abs(x).max(axis=1, keepdims=True)
    scaled = x / top
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of the rows of ``a`` and ``b`` in double precision; equal rows give equal scores."""
    far = (np.abs(a).max(axis=1) > 1e100) | (np.abs(b).max(axis=1) > 1e100) | (np.abs(a).max(axis=1) < 1e-100) | (np.abs(b).max(axis=1) < 1e-100)
    if far.any():
        a, b = a.copy(), b.copy()
        a[far] /= np.abs(a[far]).max(axis=1, keepdims=True)
        b[far] /= np.abs(b[far]).max(axis=1, keepdims=True)
    dot = lambda x, y: np.cumsum(x * y, axis=1)[:, -1]  # noqa: E731  added up in order, whatever the batch
    return dot(a, b) / np.sqrt(dot(a, a) * dot(b, b))


def usable(vector: str) -> Column:
    """Whether all components are there and finite and one is not zero."""
    v = F.col(vector)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce((F.size(v) > 0) & F.forall(v, fine) & F.exists(v, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows of ``vec_id, embedding`` that ``is_query`` names.

    Query blocks meet every shard: the query set is stated, and a task holds one shard and one block.
    """
    ship(vectors.sparkSession)
    clean = vectors.filter(F.col("vec_id").isNotNull() & usable("embedding"))
    clean = clean.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"), is_query.alias("is_query"))
    clean = settle(clean.dropDuplicates(["vec_id", "v"]).withColumn("n", F.size("v")))
    counts = clean.agg(F.count("*").alias("rows"), F.sum(F.col("is_query").cast("int")).alias("queries")).first()
    shards = max(1, -(-counts["rows"] // shard_rows))
    blocks = max(1, -(-(counts["queries"] or 0) // block_rows))
    spread = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    points = clean.select("n", spread(shards, 1).alias("shard"), every(blocks).alias("block"), "vec_id", "v")
    asked = clean.filter("is_query").select("n", spread(blocks, 2).alias("block"), every(shards).alias("shard"), "vec_id", "v")

    def search(points: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": np.empty(0, "int64"), "vec_id": np.empty(0, "int64"), "score": np.empty(0)})
        if not len(points) or not len(asked):
            return none
        # In a fixed order, so that every run builds the same tree.
        points = points.sort_values("vec_id", kind="stable")
        x, q = (np.array(f["v"].tolist(), dtype=np.float64) for f in (points, asked))
        ids, own = points["vec_id"].to_numpy(), asked["vec_id"].to_numpy()
        at, row = Tree(unit_rows(x)).search(unit_rows(q), own, ids, k, factor)
        score = np.empty(len(at))
        for i in range(0, len(at), 65536):
            score[i : i + 65536] = cosine(q[at[i : i + 65536]], x[row[i : i + 65536]])
        out = pd.DataFrame({"at": at, "query_id": own[at], "vec_id": ids[row], "score": score})
        out = out.sort_values(["at", "score", "vec_id"], ascending=[True, False, True]).groupby("at").head(k)
        return out[["query_id", "vec_id", "score"]]

    keys = ["n", "shard", "block"]
    found = asked.groupBy(*keys).cogroup(points.groupBy(*keys))
    best = found.applyInPandas(lambda a, p: search(p, a), "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e) / sqrt(list_dot_product(q.e, q.e) * list_dot_product(c.e, c.e)) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""


@query("op2_vantage_neighbours", SQL)
def op2_vantage_neighbours(spark, sf_dir):
    """The five nearest of every row whose id is divisible by 50."""
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
