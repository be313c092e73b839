"""Flow and currency features of one reference asset per market, on its own calendar."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from barloom.functions.cells import inf_to_null
from barloom.functions.market import breadth_proxy, usd_strength
from barloom.operators import align, panel
from barloom.operators.lanes import Lane
from barloom.operators.rolling import pct_change, rolling_zscore
from barloom.operators.stages import Stages


@dataclass(frozen=True)
class FlowPlan:
    reference: str = "SPY"
    oil: str = "USO"
    gold: str = "GLD"
    eurusd: str = "EURUSD"
    usdjpy: str = "USDJPY"
    equal_weight: str | None = "RSP"

    @property
    def others(self) -> list[str]:
        return [a for a in (self.oil, self.gold, self.eurusd, self.usdjpy, self.equal_weight) if a]


FEATURES = (
    "flow_vol_z20",
    "flow_money_proxy5",
    "uso_ret5",
    "gld_ret5",
    "eurusd_ret5",
    "usdjpy_ret5",
    "usd_strength",
    "breadth_proxy",
)


def fx_flow_features(prices: DataFrame, plan: FlowPlan = FlowPlan(), by: Sequence[str] = ("market",), lookback: int = 20) -> DataFrame:
    """(market, ts) plus eight features; the first ``lookback`` rows and incomplete rows go.

    Prices are long (market, asset, ts, close, volume) with one row per day. The calendar is
    the reference asset's; gaps of the others are filled forward, then backward.
    """
    by = list(by)
    names = [plan.reference, *plan.others]
    wide = prices.groupBy(*by, "ts").agg(
        *[panel.pick("close", a).alias(a) for a in names], panel.pick("volume", plan.reference).alias("_vol")
    )
    spine = wide.filter(F.col(plan.reference).isNotNull())
    filled = spine.withColumns({c: align.ffill_bfill(c, by) for c in [*plan.others, "_vol"]})

    b = Stages(Lane(tuple(by), "ts", False, tuple(by)), filled.columns)
    b.out(rolling_zscore(b, "_vol", 20, "flow_vol_z20"))
    money = b.col("_money", f"`{plan.reference}` * _vol", plan.reference, "_vol")
    b.out(pct_change(b, money, 5, "flow_money_proxy5"))
    for asset, name in ((plan.oil, "uso"), (plan.gold, "gld"), (plan.eurusd, "eurusd"), (plan.usdjpy, "usdjpy")):
        b.out(pct_change(b, asset, 5, f"{name}_ret5"))
    b.out(pct_change(b, plan.reference, 5, "_ref5"))
    if plan.equal_weight:
        b.out(pct_change(b, plan.equal_weight, 5, "_eq5"))
    feats = b.build(filled, [*by, "ts"])
    feats = feats.withColumn("usd_strength", usd_strength("eurusd_ret5", "usdjpy_ret5"))
    if plan.equal_weight:
        feats = feats.withColumn("breadth_proxy", breadth_proxy("_eq5", "_ref5"))
    kept = [c for c in FEATURES if c in feats.columns]
    feats = align.skip_first(feats, lookback, by).select(*by, "ts", *[inf_to_null(c).alias(c) for c in kept])
    return align.drop_missing(feats, kept)


def with_bars(bars: DataFrame, features: DataFrame, on: Sequence[str] = ("market", "ts")) -> DataFrame:
    """The reference asset's bars joined to the features on the date."""
    return bars.join(features, list(on), "inner")
