"""Sums of products of columns (Gram matrices) in one pass.

Every task multiplies its rows as numpy matrices and hands on one row of sums per column; the engine adds them up. The plan
does not grow with the number of pairs, and what is shuffled is tasks x columns**2 numbers, however many rows there are. A
task holds 48 bytes for a pair of columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barloom.session import settle, ship_package, short_methods

SUMS = ("n", "s", "t", "q", "r", "c")
# Rows behind the shift that keeps sums of squares small; any shift gives the same statistics.
SHIFT_ROWS = 1_000
# A variance below this share of the mean square is rounding: the column is constant.
ROUNDING = 1e-13


def matrix(batch: pa.RecordBatch, columns: Sequence[int]) -> np.ndarray:
    """Columns of a batch as doubles; missing and infinite values become NaN."""
    x = np.stack([batch.column(k).cast(pa.float64()).to_numpy(zero_copy_only=False) for k in columns], axis=1)
    return np.where(np.isfinite(x), x, np.nan)


def add_batch(sums: np.ndarray, batch: pa.RecordBatch, shift: np.ndarray) -> None:
    """Add the pair sums of a batch of double columns. Columns are lines here, so that each is read and written in one go."""
    x = np.empty((batch.num_columns, batch.num_rows))
    for line, c in zip(x, batch.columns):
        line[:] = c.to_numpy(zero_copy_only=False)
    there = np.isfinite(x)
    x -= shift[:, None]
    x[~there] = 0.0
    there = there.astype(np.float64)
    n, s, q = there @ there.T, x @ there.T, (x * x) @ there.T
    for total, part in zip(sums, (n, s, s.T, q, q.T, x @ x.T)):
        total += part


def pair_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``i, j`` (``i <= j``) and, over the rows where both columns are there: the count ``n``, the sums ``s, t`` and
    squares ``q, r`` of the two, and the sum of products ``c``, all around a shift. The rows are read once, here: the
    result is kept, so that it may be used twice."""
    ship_package(df.sparkSession)
    slim = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(columns)])
    with short_methods(df.sparkSession):
        first = slim.limit(SHIFT_ROWS).agg(*[F.avg(F.when(F.abs(x) < float("inf"), F.col(x))) for x in slim.columns]).first()
    shift, m = np.array([v or 0.0 for v in first], float), len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(SUMS), m, m))
        for batch in batches:
            if batch.num_rows:
                add_batch(sums, batch, shift)
        if sums[0].any():
            cols = [pa.array([a[i, i:] for i in range(m)], pa.list_(pa.float64())) for a in sums]
            yield pa.RecordBatch.from_arrays([pa.array(range(m), pa.int32()), *cols], ["i", *SUMS])

    parts = slim.mapInArrow(run, "i int, " + ", ".join(f"{c} array<double>" for c in SUMS))
    cells = parts.select("i", F.posexplode(F.arrays_zip(*SUMS)).alias("p", "z"))
    added = cells.groupBy("i", "p").agg(*[F.sum(f"z.{c}").alias(c) for c in SUMS])
    return settle(added.select("i", (F.col("i") + F.col("p")).alias("j"), *SUMS))


def flat(n: float, s: float, q: float) -> bool:
    """Whether values with this count, sum and sum of squares are all the same."""
    return n * q - s * s <= ROUNDING * n * q


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``i, j, corr`` for all pairs both ways, over complete pairs; NULL where a side is constant."""
    sums = pair_sums(df, columns)
    vx, vy = F.col("n") * F.col("q") - F.col("s") * F.col("s"), F.col("n") * F.col("r") - F.col("t") * F.col("t")
    flat = (vx <= ROUNDING * F.col("n") * F.col("q")) | (vy <= ROUNDING * F.col("n") * F.col("r"))
    corr = F.when(~flat, (F.col("n") * F.col("c") - F.col("s") * F.col("t")) / (F.sqrt(vx) * F.sqrt(vy)))
    corr = F.when(F.col("i") == F.col("j"), F.when(~flat, 1.0)).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), corr)))
    found = sums.select("i", "j", F.when(~flat, corr).alias("corr"))
    return found.unionByName(found.filter("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "corr"))


def grams(df: DataFrame, sizes: dict[int, int], build: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
    """``X'X`` by key in one pass. ``build`` gives ``key, X`` for a batch; ``sizes`` names the columns of every key's X.

    The matrices come to the driver: their number and size are parameters, not data.
    """
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {k: np.zeros((m, m)) for k, m in sizes.items()}
        for batch in batches:
            for key, x in build(batch):
                sums[key] += x.T @ x
        for key, a in sums.items():
            if a.any():
                cols = [pa.array([key] * len(a), pa.int32()), pa.array(range(len(a)), pa.int32()), pa.array(list(a), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(cols, ["key", "i", "v"])

    parts = df.mapInArrow(run, "key int, i int, v array<double>")
    cells = parts.select("key", "i", F.posexplode("v").alias("j", "v")).groupBy("key", "i", "j").agg(F.sum("v").alias("v"))
    out = {k: np.zeros((m, m)) for k, m in sizes.items()}
    for r in cells.toLocalIterator():
        out[r.key][r.i, r.j] = r.v
    return out
