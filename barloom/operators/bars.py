"""Building bars: ticks or finer bars to OHLCV, and session bars from intraday parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions.cells import as_col, row_max, row_min


def _ord(order: str | Column | Sequence[str]) -> Column:
    """One orderable value; a single fixed-width column keeps the aggregation hash based."""
    if isinstance(order, (str, Column)):
        return as_col(order)
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def ohlcv_bars(
    rows: DataFrame,
    by: Sequence[str],
    order: str | Column | Sequence[str],
    open_: str = "open",
    high: str = "high",
    low: str = "low",
    close: str = "close",
    volume: str = "volume",
) -> DataFrame:
    """First open, max high, min low, last close, total volume per group.

    For ticks pass the price column four times. ``order`` must be unique inside a group.
    Partial aggregates shrink the data before the shuffle, so a hot symbol costs one small
    row per task and bar.
    """
    o = _ord(order)
    return rows.groupBy(*by).agg(
        F.min_by(open_, o).alias("open"),
        F.max(high).alias("high"),
        F.min(low).alias("low"),
        F.max_by(close, o).alias("close"),
        F.sum(volume).alias("volume"),
    )


def tick_bars(ticks: DataFrame, by: Sequence[str], order, price: str = "price", size: str = "size") -> DataFrame:
    return ohlcv_bars(ticks, by, order, price, price, price, price, size)


def last_per_day(rows: DataFrame, by: Sequence[str], order: str | Column, values: Sequence[str]) -> DataFrame:
    """Last non-missing value of each column per group."""
    o = as_col(order)
    return rows.groupBy(*by).agg(
        *[F.max_by(v, F.when(F.col(v).isNotNull(), o)).alias(v) for v in values]
    )


# Session layout (fixed values): minutes from 09:30, then end-of-hour labels 11..16.
OPEN_HOUR, OPEN_MINUTE = 9, 30
HOUR_LABELS = (11, 12, 13, 14, 15, 16)


def opening_minutes(ts: str = "ts") -> Column:
    return (F.hour(ts) == OPEN_HOUR) & (F.minute(ts) >= OPEN_MINUTE)


def pre_open_minutes(ts: str = "ts") -> Column:
    return (F.hour(ts) == OPEN_HOUR) & (F.minute(ts) < OPEN_MINUTE)


def session_hours(ts: str = "ts") -> Column:
    return F.hour(ts).isin(*HOUR_LABELS)


def session_bars(
    minutes: DataFrame,
    hours: DataFrame,
    include_extended: bool = True,
    keys: Sequence[str] = ("symbol",),
    order: str | Sequence[str] = "ts",
) -> DataFrame:
    """Daily session bars from opening minutes plus hourly bars.

    Open comes from the minutes, close from the hours, and a day needs both. With
    ``include_extended`` the pre-open minutes widen high and low and add their volume.
    Output: keys, ``date``, open, high, low, close, volume.
    """
    by = [*keys, "date"]
    m = minutes.withColumn("date", F.to_date("ts"))
    h = hours.withColumn("date", F.to_date("ts"))
    m_day = ohlcv_bars(m.filter(opening_minutes()), by, order)
    h_day = ohlcv_bars(h.filter(session_hours()), by, order)
    m_day = m_day.select(*by, F.col("open"), *[F.col(c).alias(f"{c}_m") for c in ("high", "low", "volume")])
    h_day = h_day.select(*by, *[F.col(c).alias(f"{c}_h") for c in ("high", "low", "close", "volume")])
    day = m_day.join(h_day, by, "inner").select(
        *by,
        "open",
        row_max("high_m", "high_h").alias("high"),
        row_min("low_m", "low_h").alias("low"),
        F.col("close_h").alias("close"),
        (F.col("volume_m") + F.col("volume_h")).alias("volume"),
    )
    if not include_extended:
        return day
    pre = (
        m.filter(pre_open_minutes())
        .groupBy(*by)
        .agg(F.max("high").alias("high_p"), F.min("low").alias("low_p"), F.sum("volume").alias("volume_p"))
    )
    return day.join(pre, by, "left").select(
        *by,
        "open",
        row_max("high", "high_p").alias("high"),
        row_min("low", "low_p").alias("low"),
        "close",
        (F.col("volume") + F.coalesce("volume_p", F.lit(0.0))).alias("volume"),
    )
