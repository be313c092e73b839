"""Sector and cross-asset features on long prices (market, asset, ts, close)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from barloom.functions.cells import ratio
from barloom.functions.market import quote_to_percent, relative_strength, term_spread
from barloom.operators import align, panel
from barloom.operators.lanes import Lane
from barloom.operators.rolling import pct_change, rolling_zscore
from barloom.operators.stages import Stages

ASSET = ("market", "asset")


def _stages(df: DataFrame, by: Sequence[str]) -> Stages:
    return Stages(Lane(tuple(by), "ts", False, tuple(by)), df.columns)


def returns(grid: DataFrame, n: int = 1, by: Sequence[str] = ASSET) -> DataFrame:
    """Padded relative change per asset, added as ``ret``."""
    b = _stages(grid, by)
    b.out(pct_change(b, "close", n, "ret"))
    return b.build(grid)


def complete_dates(rets: DataFrame, by: Sequence[str] = ("market",)) -> DataFrame:
    """Keep dates on which every asset has a return (one flag per date, joined back)."""
    good = rets.groupBy(*by, "ts").agg(F.bool_and(F.col("ret").isNotNull()).alias("_all")).filter("_all").drop("_all")
    return rets.join(good, [*by, "ts"], "left_semi")


def rolling_mean(df: DataFrame, x: str, n: int, name: str, by: Sequence[str] = ("market",)) -> DataFrame:
    b = _stages(df, by)
    mean = b.mean(x, n)
    b.out(b.col(name, mean, mean))
    return b.build(df)


def asset_std(rets: DataFrame, n: int = 20, by: Sequence[str] = ASSET) -> DataFrame:
    """Sample deviation of returns per asset, added as ``std``."""
    b = _stages(rets, by)
    std = b.std_samp("ret", n)
    b.out(b.col("std", std, std))
    return b.build(rets)


@dataclass(frozen=True)
class SectorPlan:
    """Which assets play which part. The defaults are the US sector funds."""

    assets: tuple[str, ...] = ("SPY", "XLK", "XLF", "XLE", "XLV", "XLU", "XLY", "XLP", "XLB", "XLRE", "XLC")
    benchmark: str = "SPY"
    ratios: tuple[str, ...] = ("XLK", "XLU", "XLF")
    growth: tuple[str, ...] = ("XLK", "XLF", "XLE", "XLY")
    defensive_returns: tuple[str, ...] = ("XLU", "XLP", "XLV")
    vol_pair: tuple[str, str] = ("XLK", "XLU")
    defensive: tuple[str, ...] = ("XLP", "XLU", "XLV")
    cyclical: tuple[str, ...] = ("XLK", "XLF", "XLY")


def sector_features(
    prices: DataFrame,
    yields: DataFrame,
    commodities: DataFrame,
    plan: SectorPlan = SectorPlan(),
    exact: bool = True,
    max_age: int | None = None,
) -> DataFrame:
    """Prices, returns, ratios, features and their 252-row z-scores, one row per market and date.

    ``yields``: (market, ts, DGS10_quote, DGS5_quote). ``commodities``: (market, ts,
    Crude, Copper) prices on their own dates. ``exact`` starts all returns with the youngest
    asset; otherwise each asset starts on its own. ``max_age`` (days) ends the carry of series
    that stopped.
    """
    by, bench = ["market"], plan.benchmark
    grid = panel.on_calendar(prices.select(*by, "asset", "ts", "close"), plan.assets)
    every = returns(grid)
    rets = complete_dates(every) if exact else every.filter(F.col("ret").isNotNull())
    a, z = plan.vol_pair
    by_date = asset_std(rets).groupBy(*by, "ts").agg(
        *[panel.pick("ret", x).alias(f"Returns_{x}") for x in plan.assets],
        panel.pick("ret", bench).alias("SPY_Return"),
        (panel.basket_mean("ret", plan.growth) - panel.basket_mean("ret", plan.defensive_returns)).alias("GrowthMinusDef"),
        ratio(panel.pick("std", a), panel.pick("std", z)).alias(f"Vol_Ratio_{a}_{z}"),
    )
    price_rows = grid.groupBy(*by, "ts").agg(
        *[panel.pick("close", x).alias(f"Prices_{x}") for x in plan.assets],
        *[relative_strength(panel.pick("close", x), panel.pick("close", bench)).alias(f"{x}_{bench}") for x in plan.ratios],
        ratio(panel.basket_sum("close", plan.defensive), panel.basket_sum("close", plan.cyclical)).alias("_dc"),
    )
    base = price_rows.join(by_date, [*by, "ts"], "left").join(panel.breadth(grid, bench), [*by, "ts"], "left")
    base = base.withColumnRenamed("breadth", "Breadth").withColumn("Breadth", F.col("Breadth").cast("double"))
    base = base.join(
        panel.average_correlation(rets).withColumnRenamed("avg_corr", "_corr"), [*by, "ts"], "left"
    )
    dates = base.select(*by, "ts")
    percent = yields.select(
        *by, "ts", quote_to_percent("DGS10_quote").alias("DGS10"), quote_to_percent("DGS5_quote").alias("DGS5")
    ).withColumn("Spread", term_spread("DGS10", "DGS5"))
    carried = align.reindex_ffill(percent, dates, ["DGS10", "DGS5", "Spread"], by, max_age=max_age)
    c = _stages(commodities, by)
    for name in ("Crude", "Copper"):
        c.out(pct_change(c, name, 60, f"{name}_60dRet"))
    fut = align.reindex_ffill(c.build(commodities), dates, ["Crude_60dRet", "Copper_60dRet"], by, max_age=max_age)
    base = base.join(carried, [*by, "ts"]).join(fut, [*by, "ts"])

    names = [
        "SPY_Return",
        "GrowthMinusDef",
        *[f"{x}_{bench}" for x in plan.ratios],
        "Breadth",
        f"Vol_Ratio_{a}_{z}",
        "DGS10",
        "DGS5",
        "Spread",
        "DefCyc_Ratio",
        "Avg_Sector_Corr",
        "Crude_60dRet",
        "Copper_60dRet",
    ]
    b = _stages(base, by)
    mean = b.mean("_dc", 20)
    b.col("DefCyc_Ratio", mean, mean)
    b.col("Avg_Sector_Corr", b.pad("_corr"), "_pad__corr")
    for n in names:
        b.out(b.col(f"Features_{n}", n, n), rolling_zscore(b, n, 252, f"ZScores_{n}"))
    keep = [*by, "ts", *[f"Prices_{x}" for x in plan.assets], *[f"Returns_{x}" for x in plan.assets]]
    for x in plan.ratios:
        b.out(b.col(f"Ratios_{x}_{bench}", f"{x}_{bench}", f"{x}_{bench}"))
    return b.build(base, keep)
