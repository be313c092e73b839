"""Order statistics of sliding windows, which neither window sums nor merged pieces can give.

They come last in a pack: the rows of a lane already lie together in time order, so they stream through numpy batch by
batch with the tail of the batch before, and neither a shuffle nor an array per row is needed. A comparison of a whole
window is a few vector instructions, and an order statistic is a partial selection instead of a sort.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructField, StructType

from barloom.operators.gram import matrix
from barloom.session import ship_package

CHUNK = 4_096


@dataclass(frozen=True)
class Share:
    """Share of the last ``n`` values at or below the current one."""

    name: str
    x: str
    n: int

    def __call__(self, windows: np.ndarray) -> np.ndarray:
        return (windows <= windows[:, -1:]).sum(axis=1) / float(self.n)


@dataclass(frozen=True)
class Quantile:
    """Order statistic of the last ``n`` values, interpolated between neighbours."""

    name: str
    x: str
    n: int
    p: float

    def __call__(self, windows: np.ndarray) -> np.ndarray:
        at = self.p * (self.n - 1)
        low = int(math.floor(at))
        if at == low:
            return np.partition(windows, low, axis=1)[:, low]
        found = np.partition(windows, (low, low + 1), axis=1)
        return found[:, low] + (found[:, low + 1] - found[:, low]) * (at - low)


def slide(df: DataFrame, asks: Sequence[Share | Quantile], row_no: str = "_n") -> DataFrame:
    """``df`` with a column per statistic, NULL where a window is not full or holds a missing value.

    ``df`` has the rows of a lane together and in order; ``row_no`` counts them from 1.
    """
    ship_package(df.sparkSession)
    columns = list(dict.fromkeys(a.x for a in asks))
    at = [df.columns.index(c) for c in columns]
    longest = max(a.n for a in asks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.full((longest - 1, len(columns)), np.nan)
        for batch in batches:
            if not batch.num_rows:
                continue
            row = batch.column(row_no).to_numpy(zero_copy_only=False)
            x = np.concatenate([tail, matrix(batch, at)])
            tail = x[len(x) - longest + 1 :]
            holes = np.concatenate([np.zeros((1, len(columns)), int), np.cumsum(np.isnan(x), axis=0)])
            made = []
            for a in asks:
                k, n = columns.index(a.x), a.n
                windows = np.lib.stride_tricks.sliding_window_view(x[longest - n :, k], n)
                value = np.concatenate([a(windows[i : i + CHUNK]) for i in range(0, len(windows), CHUNK)])
                gone = holes[longest:, k] - holes[longest - n : len(holes) - n, k]
                made.append(pa.array(value, pa.float64(), mask=(row < n) | (gone > 0)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *[a.name for a in asks]])

    schema = StructType([*df.schema.fields, *[StructField(a.name, DoubleType()) for a in asks]])
    return df.mapInArrow(run, schema)
