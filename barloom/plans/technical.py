"""Feature packs over bars(symbol, ts, open, high, low, close[, volume])."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Window, functions as F

from barloom.functions.cells import is_true, nan_to_null
from barloom.operators import rolling as r
from barloom.operators.lanes import HALO_ROWS, OWN, PRICES, TILE, TILE_ROWS, Lane, lay
from barloom.operators.stages import Stages

Indicator = Callable[[Stages], None]


def basic_indicators(b: Stages) -> None:
    r.simple_returns(b)
    r.rolling_return(b)
    r.sma(b)
    r.emas(b)
    r.macd(b)
    r.rsi(b)
    r.stochastic(b)
    r.bollinger(b)
    r.atr(b)


def gaps_overnight(b: Stages, prob_windows: Iterable[int] = (20, 60, 120, 252)) -> None:
    r.gap_measures(b)
    r.return_decomposition(b)
    r.gap_flags(b)
    r.gap_fill_probability(b, tuple(prob_windows))


def liquidity_pressure(b: Stages) -> None:
    r.volume_percentile(b)
    r.obv(b)
    r.volume_surge(b)
    r.roll_spread(b)
    r.hl_range(b)
    r.amihud(b)


def trend_meanrev(b: Stages) -> None:
    r.simple_returns(b)
    r.momentum(b)
    r.days_since_extreme(b)
    r.distance_from_ma(b)
    r.zscore_returns(b)
    r.autocorr(b)


def volatility(b: Stages) -> None:
    r.skew_kurt(b)
    r.realized_vol(b)
    r.parkinson_vol(b)
    r.garman_klass_vol(b)
    r.rogers_satchell_vol(b)
    r.intraday_range(b)


PACKS: dict[str, Indicator] = {
    "basic_indicators": basic_indicators,
    "gaps_overnight": gaps_overnight,
    "liquidity_pressure": liquidity_pressure,
    "trend_meanrev": trend_meanrev,
    "volatility": volatility,
}


def clean_bars(bars: DataFrame) -> DataFrame:
    """Prices and volume as doubles without NaN; a missing volume column becomes NULL."""
    cells = {c: nan_to_null(F.col(c).cast("double")) for c in (*PRICES, "volume") if c in bars.columns}
    if "volume" not in bars.columns:
        cells["volume"] = F.lit(None).cast("double")
    return bars.withColumns(cells)


def _with_obv_carry(df: DataFrame, lane: Lane) -> DataFrame:
    """Signed volume of all earlier tiles of the symbol, on every row of a tile."""
    b = Stages(lane, df.columns)
    b.out(r.signed_volume(b), OWN, TILE)
    totals = b.build(df, keep=list(lane.symbol_keys), drop_halo=False)
    totals = totals.groupBy(*lane.keys).agg(F.sum(F.when(is_true(F.col(OWN)), F.col("_signed"))).alias("_t"))
    earlier = Window.partitionBy(*lane.symbol_keys).orderBy(TILE).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*lane.keys, F.sum("_t").over(earlier).alias(r.OBV_CARRY))
    return df.join(carry, list(lane.keys), "left")


def outputs(bars: DataFrame, *indicators: Indicator) -> list[str]:
    """Names of the columns that these indicators add, without building them."""
    b = Stages(Lane(("symbol",), "ts", False, ("symbol",)), [*bars.columns, "volume"])
    for indicator in indicators:
        indicator(b)
    return b.outputs


def history(bars: DataFrame, *indicators: Indicator, keys: tuple[str, ...] = ("symbol",), order: str = "ts") -> int:
    """Rows of history that a tile needs for these indicators."""
    b = Stages(Lane((*keys, TILE), order, True, keys), [*bars.columns, TILE, OWN, r.OBV_CARRY])
    for indicator in indicators:
        indicator(b)
    return b.reach + 1


def compute(
    bars: DataFrame,
    *indicators: Indicator,
    keys: tuple[str, ...] = ("symbol",),
    order: str = "ts",
    layout: str = "auto",
    **tiling: int,
) -> DataFrame:
    """Bars plus the columns of the given indicators or packs, from one shuffle by symbol.

    ``layout`` picks how symbols are spread over tasks (see ``operators.lanes``); both give the same values. A
    halo that is shorter than the longest window is an error; left out, it is as long as needed.
    """
    bars = clean_bars(bars)
    if layout != "key":
        need = history(bars, *indicators, keys=keys, order=order)
        if tiling.get("halo_rows", need) < need:
            raise ValueError(f"these indicators look back on {need} rows: halo_rows must not be less")
        halo = tiling.setdefault("halo_rows", max(need, HALO_ROWS))
        tiling["tile_rows"] = max(tiling.get("tile_rows", TILE_ROWS), halo)
    df, lane = lay(bars, keys, order, layout, **tiling)
    b = Stages(lane, [*df.columns, r.OBV_CARRY] if lane.tiled else df.columns)
    for indicator in indicators:
        indicator(b)
    keep = [c for c in df.columns if not c.startswith("_")]
    if lane.tiled and b.has("OBV"):
        df = _with_obv_carry(df, lane)
    return b.build(df, keep)


def all_features(bars: DataFrame, **how) -> DataFrame:
    """All five packs side by side; shared intermediates are computed once."""
    return compute(bars, *PACKS.values(), **how)


def feature_tables(bars: DataFrame, **how) -> dict[str, DataFrame]:
    """One lazy frame per pack, as the batch pipeline writes them."""
    return {name: compute(bars, pack, **how) for name, pack in PACKS.items()}
