"""Option-chain snapshot measures over (cp, strike, volume, openInterest, impliedVolatility)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from barloom.functions.cells import ratio
from barloom.functions.market import moneyness
from barloom.operators.panel import latest


def put_call_ratio(chain: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total put over total call, by volume and by open interest; NULL when calls add up to 0."""

    def side(c: str, tag: str):
        return F.sum(F.when(F.col("cp") == tag, F.col(c)))

    cells = [ratio(side(c, "P"), side(c, "C")).alias(n) for c, n in (("volume", "pcr_volume"), ("openInterest", "pcr_oi"))]
    return chain.groupBy(*by).agg(*cells) if by else chain.agg(*cells)


def join_strikes(chain: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Calls and puts with the same strike, and their implied-volatility difference."""
    sides = [
        chain.filter(F.col("cp") == tag).select(*by, "strike", F.col("impliedVolatility").alias(name))
        for tag, name in (("C", "IV_call"), ("P", "IV_put"))
    ]
    return sides[0].join(sides[1], [*by, "strike"]).withColumn("skew", F.col("IV_put") - F.col("IV_call"))


def with_moneyness(chain: DataFrame, bars: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Strike over the underlying's last close."""
    spot = latest(bars, "close", by).withColumnRenamed("close", "spot")
    return chain.join(spot, list(by), "left").withColumn("moneyness", moneyness("strike", "spot"))


def snapshot(chain: DataFrame, bars: DataFrame, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """One row per underlying: ratios, spot, mean skew and the number of common strikes."""
    skew = join_strikes(chain, by).groupBy(*by).agg(F.avg("skew").alias("iv_skew"), F.count("*").alias("common_strikes"))
    spot = latest(bars, "close", by).withColumnRenamed("close", "spot")
    return put_call_ratio(chain, by).join(skew, list(by), "left").join(spot, list(by), "left")
