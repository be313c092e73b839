"""Reading and normalising raw market files."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from barloom.functions.cells import nan_to_null, to_number

OHLCV_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("ts", T.DateType()),
        *[T.StructField(c, T.DoubleType()) for c in ("open", "high", "low", "close", "volume")],
    ]
)

OPTION_SCHEMA = T.StructType(
    [
        T.StructField("contractSymbol", T.StringType()),
        T.StructField("lastTradeDate", T.TimestampType()),
        *[
            T.StructField(c, T.DoubleType())
            for c in ("strike", "lastPrice", "bid", "ask", "change", "percentChange", "volume")
        ],
        T.StructField("openInterest", T.LongType()),
        T.StructField("impliedVolatility", T.DoubleType()),
        T.StructField("inTheMoney", T.BooleanType()),
        T.StructField("contractSize", T.StringType()),
        T.StructField("currency", T.StringType()),
    ]
)

# Date column names by preference, and date formats in the order tried.
DATE_NAMES = ("time", "date", "timestamp", "quotedate")
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy", "dd/MM/yyyy", "yyyy/MM/dd")


def scan_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """Headered CSV; pass a schema for known tables, types are inferred only without one."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def scan_csv_tolerant(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV of text columns: rows with too many fields are dropped, short ones padded."""
    names = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_extra"]])
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").csv(path)
    return rows.filter(F.col("_extra").isNull()).drop("_extra")


def normalize_ohlcv(df: DataFrame, symbol: str | Column | None = None) -> DataFrame:
    """Case-insensitive mapping to symbol, ts, open, high, low, close, volume.

    ``date`` wins over ``time``. Raises when a date or price column is missing; a missing
    volume becomes NULL.
    """
    by_lower = {c.lower(): c for c in df.columns}
    date = by_lower.get("date") or by_lower.get("time")
    missing = [c for c in ("open", "high", "low", "close") if c not in by_lower]
    if date is None or missing:
        raise ValueError(f"bars need date/time and open, high, low, close columns; missing {missing or ['date']}")

    def price(name: str) -> Column:
        return nan_to_null(F.col(f"`{by_lower[name]}`").cast("double")).alias(name)

    volume = to_number(F.col(f"`{by_lower['volume']}`")) if "volume" in by_lower else F.lit(None).cast("double")
    sym = F.lit(symbol) if isinstance(symbol, str) else symbol
    if sym is None:
        sym = F.col(f"`{by_lower['symbol']}`") if "symbol" in by_lower else F.lit("")
    return df.select(
        sym.alias("symbol"),
        F.to_date(F.col(f"`{date}`")).alias("ts"),
        *[price(c) for c in ("open", "high", "low", "close")],
        volume.alias("volume"),
    )


def detect_date_column(columns: Sequence[str]) -> str | None:
    """The preferred date-like column, ignoring case."""
    by_lower = {c.lower(): c for c in columns}
    return next((by_lower[n] for n in DATE_NAMES if n in by_lower), None)


def parse_dates(df: DataFrame, column: str, out: str = "Date", formats: Sequence[str] = DATE_FORMATS) -> DataFrame:
    """Parse a text column with the first format that fits any row.

    That format then holds for the whole column and other rows become NULL; if none fits, a
    general cast is used. One aggregate looks at all formats at once. Dates and timestamps need no look.
    """
    if dict(df.dtypes)[column] in ("date", "timestamp", "timestamp_ntz"):
        return df.withColumn(out, F.col(f"`{column}`").cast("timestamp_ntz"))
    text = F.trim(F.col(f"`{column}`").cast("string"))
    fits = df.agg(*[F.bool_or(F.try_to_timestamp(text, F.lit(f)).isNotNull()) for f in formats]).first()
    chosen = next((f for f, ok in zip(formats, fits) if ok), None)
    value = F.try_to_timestamp(text, F.lit(chosen)) if chosen else text.try_cast("timestamp")
    return df.withColumn(out, value)


def normalize_date(df: DataFrame, column: str = "Date") -> DataFrame:
    """Drop rows without a date; keep the calendar day."""
    return df.filter(F.col(column).isNotNull()).withColumn(column, F.to_date(column))


def eastern_wall_time(c: str | Column) -> Column:
    """Zone dropped without conversion: the clock reading stays, read as New York time."""
    text = F.regexp_replace((F.col(c) if isinstance(c, str) else c).cast("string"), r"(Z|[+-]\d{2}:?\d{2})$", "")
    return text.try_cast("timestamp_ntz")


def eastern_instant(wall: str | Column) -> Column:
    """UTC clock reading of a New York wall time."""
    return F.convert_timezone(F.lit("America/New_York"), F.lit("UTC"), wall)


def ny_date(ts: str | Column) -> Column:
    """New York calendar date of a UTC clock reading; midnight UTC falls on the day before."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), ts))


def utc_date(ts: str | Column) -> Column:
    return F.to_date(ts)


def flatten_prefer_adjusted(df: DataFrame, index: Sequence[str] = ("Date",)) -> DataFrame:
    """``{level}_{ticker}`` columns to one column per ticker: adjusted closes if any, else closes."""
    level = "Adj Close" if any("Adj Close" in c for c in df.columns) else "Close"
    picked = [c for c in df.columns if level in c and c not in index]
    return df.select(*index, *[F.col(f"`{c}`").alias(c.replace(f"{level}_", "")) for c in picked])


def adjusted_close(df: DataFrame) -> Column:
    """Per-ticker frames: the adjusted close where the column exists, else the close."""
    names = {c.lower().replace(" ", "").replace("_", ""): c for c in df.columns}
    for n in ("adjclose", "close"):
        if n in names:
            return F.col(f"`{names[n]}`")
    raise ValueError("no close column")


def pick_history(history: DataFrame, symbol: str, keep: Sequence[str] = ("time", "open", "high", "low", "close", "volume")) -> DataFrame:
    """One symbol's rows and standard columns out of a (symbol, time) history."""
    return history.filter(F.col("symbol") == symbol).select(*[c for c in keep if c in history.columns])


def load_option_chain(spark: SparkSession, calls: str, puts: str) -> DataFrame:
    """Calls and puts of one snapshot, tagged ``cp`` = C / P."""
    sides = [scan_csv(spark, p, OPTION_SCHEMA).withColumn("cp", F.lit(t)) for p, t in ((calls, "C"), (puts, "P"))]
    return sides[0].unionByName(sides[1])


def load_series_set(loaders: dict[str, Callable[[], DataFrame]], on_error: str = "warn") -> DataFrame:
    """Named (ts, value) series as one long (name, ts, value) table.

    A loader that fails or has no rows is skipped with a warning; ``on_error="raise"`` lets failures through.
    """
    good = []
    for name, load in loaders.items():
        try:
            df = load()
            empty = df.isEmpty()
        except Exception as e:  # a broken source must not stop the others
            if on_error == "raise":
                raise
            warnings.warn(f"series {name} failed: {e}")
            continue
        if empty:
            warnings.warn(f"series {name} is empty")
            continue
        good.append(df.select(F.lit(name).alias("name"), "ts", F.col("value").cast("double").alias("value")))
    if not good:
        raise ValueError("no series could be loaded")
    return reduce(lambda a, b: a.unionByName(b), good)
