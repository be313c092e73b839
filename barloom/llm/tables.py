"""Small helpers shared by the operators: reading, column names, workers."""

from __future__ import annotations

import ctypes
import gc
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.session import settle, ship_package

__all__ = ["fill", "give_back", "numbered", "read", "settle", "shared_folder", "ship", "sized_broadcast", "words_of"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with a row number ``_row``. Settle the result before using it twice: the number
    is only fixed once the rows are written."""
    return df.withColumn("_row", F.monotonically_increasing_id())


def fill(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def sized_broadcast(df: DataFrame, limit_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``limit_rows`` rows; unchanged otherwise."""
    few = df.limit(limit_rows + 1).count() <= limit_rows
    return F.broadcast(df) if few else df


def ship(spark: SparkSession) -> None:
    """Make the package importable in Python workers, also in a local session started elsewhere."""
    ship_package(spark)


def give_back() -> None:
    """Return memory that this worker has freed to the machine: workers are kept for later tasks, with what they hold."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local session without one gets its own."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="barloom-shared-")
    return folder
