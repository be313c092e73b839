"""Market-shaped views of the test tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.functions.cells import ratio
from barloom.operators.bars import tick_bars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Enough columns to order the rows of one day without ties.
TICK_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def ticks(spark: SparkSession, sf_dir: str, symbol: str = "l_returnflag") -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col(symbol).alias("symbol"),
        F.to_date("l_shipdate").alias("ts"),
        ratio("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("size"),
        *TICK_ORDER,
    )


def bars_daily(spark: SparkSession, sf_dir: str, symbol: str = "l_returnflag") -> DataFrame:
    return tick_bars(ticks(spark, sf_dir, symbol), ["symbol", "ts"], TICK_ORDER)


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), "event_id"
    )


def event_bars(spark: SparkSession, sf_dir: str, unit: str) -> DataFrame:
    """Bars of the event values per type and time unit; volume counts events."""
    ev = event_ticks(spark, sf_dir).withColumns({"at": F.col("ts"), "size": F.lit(1.0)})
    ev = ev.withColumn("ts", F.date_trunc(unit, "ts").cast("timestamp_ntz"))
    return tick_bars(ev, ["symbol", "ts"], "at")


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices per part type plus a benchmark ``ALL``: (market, asset, ts, close, volume)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.to_date("l_shipdate").alias("ts"), ratio("l_extendedprice", "l_quantity").alias("price"), "l_quantity"
    )
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("asset"))
    rows = li.join(part, "l_partkey")
    # Type totals first; the benchmark is built from those few rows, not from the ticks again.
    cells = rows.groupBy("asset", "ts").agg(
        F.sum("price").alias("p"), F.count("price").alias("n"), F.sum("l_quantity").alias("volume")
    )
    both = cells.withColumn("asset", F.explode(F.array("asset", F.lit("ALL"))))
    return (
        both.groupBy("asset", "ts")
        .agg((F.sum("p") / F.sum("n")).alias("close"), F.sum("volume").alias("volume"))
        .select(F.lit("M").alias("market"), "asset", "ts", "close", "volume")
    )


ASSETS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def weekdays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monday to Friday dates seen in lineitem: a trading calendar."""
    day = F.to_date("l_shipdate")
    li = table(spark, sf_dir, "lineitem").select(day.alias("ts"))
    return li.filter(F.dayofweek("ts").between(2, 6)).distinct()


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two monthly series, long: (name, ts, value)."""
    o = table(spark, sf_dir, "orders").select(
        F.to_date(F.date_trunc("month", "o_orderdate")).alias("ts"), "o_totalprice"
    )
    monthly = o.groupBy("ts").agg(
        F.sum("o_totalprice").alias("orders_total"), F.count("*").cast("double").alias("orders_count")
    )
    return monthly.unpivot("ts", ["orders_total", "orders_count"], "name", "value").select("name", "ts", "value")


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option-chain shaped rows: (cp, strike, volume, openInterest, impliedVolatility)."""
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag").isin("A", "R"))
    return li.groupBy(
        F.when(F.col("l_returnflag") == "A", "C").otherwise("P").alias("cp"), F.col("l_quantity").alias("strike")
    ).agg(
        F.count("*").cast("double").alias("volume"),
        F.sum("l_linenumber").alias("openInterest"),
        F.avg("l_discount").alias("impliedVolatility"),
    )


def labelled_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a sentiment class: 0 negative, 1 neutral, 2 positive."""
    lab = table(spark, sf_dir, "labels")
    cls = F.when(F.col("toxic") == 1, 0.0).when(F.col("quality") == 1, 2.0).otherwise(1.0)
    return table(spark, sf_dir, "documents").join(lab, "doc_id").select("doc_id", "text", cls.alias("label"))
