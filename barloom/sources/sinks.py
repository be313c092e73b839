"""Writing feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# Column names of the daily text tables.
DAILY_NAMES = {"ts": "Date", "open": "Open", "high": "High", "low": "Low", "close": "Close", "volume": "Volume"}


def daily_table(df: DataFrame) -> DataFrame:
    """Output naming of the daily files: Date first (``YYYY-MM-DD``), prices capitalised."""
    named = df.withColumnsRenamed({k: v for k, v in DAILY_NAMES.items() if k in df.columns})
    named = named.withColumn("Date", F.date_format("Date", "yyyy-MM-dd"))
    return named.select("Date", *[c for c in named.columns if c != "Date"])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV part files, written by all tasks."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet. With partition columns each value goes to few files; the rebalance splits a
    value that is too large for one task instead of sending it to a single writer."""
    if not partition_by:
        df.write.mode(mode).parquet(path)
        return
    df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_if_missing(df: DataFrame, path: str) -> None:
    """Does nothing when the target exists."""
    df.write.mode("ignore").option("header", True).csv(path)


def write_feature_list(spark: SparkSession, names: Sequence[str], path: str) -> None:
    """One feature name per line, no header. The list is as long as the schema is wide."""
    spark.createDataFrame([(n,) for n in names], "name string").coalesce(1).write.mode("overwrite").text(path)
