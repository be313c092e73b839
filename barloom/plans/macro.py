"""Macro and volatility panels: low-frequency series on a trading calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from barloom.functions.market import credit_spread, hy_minus_ig, risk_appetite, term_spread, vix_term_slope
from barloom.operators import align

# Series names of the macro panel and the ones released monthly.
MACRO_SERIES = (
    "CPI",
    "CorePCE",
    "Payrolls",
    "Unemployment",
    "RetailSales",
    "Yield10",
    "Yield2",
    "VIX",
    "DurGoodsOrders",
    "CoreCapexOrders",
    "IndProd_Manufacturing",
)
MONTHLY_SERIES = (
    "CPI",
    "CorePCE",
    "Payrolls",
    "Unemployment",
    "RetailSales",
    "DurGoodsOrders",
    "CoreCapexOrders",
    "IndProd_Manufacturing",
)
VOL_INDEXES = ("VIX", "VVIX", "SKEW", "VIX3M")
RATES = ("UST_2Y", "UST_10Y", "SPREAD_10_2", "HY_OAS", "IG_OAS")


def macro_panel(bars: DataFrame, series: DataFrame, names: Sequence[str] = MACRO_SERIES, how: str = "exact") -> DataFrame:
    """Daily bars of one reference asset with macro series carried to its calendar.

    ``bars``: (ts, open, ..., volume) with one row per date. ``series``: long (name, ts,
    value). All columns are filled forward at the end.
    """
    wide = align.outer_align(series, names)
    if {"Yield10", "Yield2"} <= set(names):
        wide = wide.withColumn("TermSpread", term_spread("Yield10", "Yield2"))
    values = [c for c in wide.columns if c != "ts"]
    daily = align.reindex_ffill(wide, bars.select("ts"), values, how=how)
    joined = bars.join(daily, "ts", "left")
    return joined.withColumns({c: align.ffill(c, ()) for c in joined.columns if c != "ts"})


def vol_index_panel(series: DataFrame, names: Sequence[str] = VOL_INDEXES) -> DataFrame:
    """Volatility indexes side by side plus the term slope when both its sides exist."""
    wide = align.outer_align(series.filter(F.col("name").isin(*names)), names)
    slope = vix_term_slope(wide.columns)
    return wide if slope is None else wide.withColumn("VIX_TERM_SLOPE", slope)


def vol_index_panel_extended(series: DataFrame, indexes: Sequence[str] = VOL_INDEXES, rates: Sequence[str] = RATES) -> DataFrame:
    """Volatility indexes, yields and credit spreads, full outer on the date."""
    wide = align.outer_align(series, [*indexes, *rates])
    return wide.withColumns({"HY_minus_IG": hy_minus_ig("HY_OAS", "IG_OAS"), "Risk_Appetite": risk_appetite("HY_OAS", "IG_OAS")})


def macro_risk_panel(series: DataFrame, names: Sequence[str] = ("UST_2Y", "UST_10Y", "Fed_Funds", "HYG", "LQD", "VIX")) -> DataFrame:
    """Yields, term spread, policy rate, credit spread and VIX, all filled forward."""
    two, ten, funds, hyg, lqd, vix = names
    w = align.outer_align(series, names)
    cols = {
        "UST_2Y": F.col(two),
        "UST_10Y": F.col(ten),
        "Term_Spread": term_spread(ten, two),
        "Fed_Funds": F.col(funds),
        "HY-IG_Spread": credit_spread(hyg, lqd),
        "VIX": F.col(vix),
    }
    panel = w.select("ts", *[c.alias(n) for n, c in cols.items()])
    return panel.select("ts", *[align.ffill(F.col(f"`{n}`"), ()).alias(n) for n in cols])
