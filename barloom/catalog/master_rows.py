"""The master dataset of all symbols from thirteen sources (P14, C3), checked in slices."""

from __future__ import annotations

from pyspark.sql import functions as F

from barloom import views
from barloom.catalog.basics import ALL_ASSETS, ASSETS_CTE, MACRO_CTE, MACRO_NAMES, r6, rnd
from barloom.catalog.kit import bars_cte, query
from barloom.catalog.products import RISK, SCALE, TRAIN, _series, _series_sql
from barloom.operators import align
from barloom.plans import macro, master, technical
from barloom.session import settle

BARS = bars_cte()
PACK_TABLES = {
    "spy_rth_basic_feats": technical.basic_indicators,
    "spy_rth_gaps_overnight": technical.gaps_overnight,
    "spy_rth_trend_liquidity_pressure": technical.liquidity_pressure,
    "spy_rth_trend_meanrev": technical.trend_meanrev,
    "spy_rth_volatility": technical.volatility,
}


def sources(spark, d):
    """Six tables by symbol and seven of the whole market, dated as another job would have written them."""
    bars = settle(views.bars_daily(spark, d))
    packs = settle(technical.all_features(bars))
    dated = lambda df: df.withColumnRenamed("ts", "Date")
    out = {"spy_ohlcv_1drth": dated(bars)}
    for name, pack in PACK_TABLES.items():
        out[name] = dated(packs.select("symbol", "ts", *technical.outputs(bars, pack)))
    orders = views.table(spark, d, "orders").withColumn("ts", F.to_date("o_orderdate"))
    events = views.table(spark, d, "events").withColumn("ts", F.to_date("ts"))
    # Four sources are made of the asset rows; a row per asset and date is kept, so that the ticks are joined to the parts once.
    assets = settle(views.assets(spark, d))
    wide = align.pivot_wide(assets, ALL_ASSETS, ["close", "volume"])
    return out | {
        "macro_positioning_data": dated(align.outer_align(views.macro(spark, d), MACRO_NAMES)),
        "market_indicators": dated(macro.vol_index_panel(_series(spark, d, macro.VOL_INDEXES, assets))),
        "macro_risk_data": dated(macro.macro_risk_panel(_series(spark, d, RISK, assets), RISK)),
        "order_flow": dated(orders.groupBy("ts").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))),
        "asset_prices": dated(wide.select("ts", *[c for c in wide.columns if c.endswith("_close")])),
        "asset_volumes": dated(wide.select("ts", *[c for c in wide.columns if c.endswith("_volume")])),
        "daily_sentiment": dated(events.groupBy("ts").agg(F.avg("value").alias("sentiment_score"))),
    }


_BUILT: dict[tuple[str, str], master.Master] = {}


def _build(spark, d):
    """Built once for the three queries of a session; the joined table is kept by reliable checkpoint."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = master.build_master(sources(spark, d), train=TRAIN, dedupe="error", by=("symbol",))
    return _BUILT[key]


JOINED = (
    f"WITH {BARS}, {ASSETS_CTE}, {_series_sql(macro.VOL_INDEXES)}, {MACRO_CTE}, f AS (SELECT CAST(o_orderdate AS DATE) AS ts, count(*) AS n FROM orders GROUP BY 1),"
    " s AS (SELECT b.symbol, b.ts, (open - lag(close) OVER o) / lag(close) OVER o AS gap_pct, CAST(CAST(coalesce(open <> lag(close) OVER o, false) AS INT) AS DOUBLE) AS is_gap,"
    " w.*, w.VIX3M - w.VIX AS VIX_TERM_SLOPE, volume, f.n, orders_total, orders_count, lead(close) OVER o / close - 1 AS target"
    " FROM bars b LEFT JOIN w ON w.ts = b.ts LEFT JOIN macro ON macro.ts = b.ts LEFT JOIN f ON f.ts = b.ts WINDOW o AS (PARTITION BY b.symbol ORDER BY b.ts)),"
    " t AS (SELECT * FROM s WHERE target IS NOT NULL)"
)


@query(
    "p14_master_all_symbols",
    f"{JOINED} SELECT symbol, ts AS \"Date\", {r6('gap_pct')} AS spy_rth_gaps_overnight_gap_pct, is_gap AS spy_rth_gaps_overnight_is_gap,"
    f" {r6(f'VIX * {SCALE}')} AS market_indicators_VIX, volume AS spy_ohlcv_1drth_volume, CAST(n AS DOUBLE) AS order_flow_n,"
    " last_value(orders_count IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS macro_positioning_data_orders_count,"
    f" {r6('target')} AS \"SPY_NextDay_Return\" FROM t",
)
def p14_all(spark, d):
    data = _build(spark, d).data
    return data.select(
        "symbol",
        "Date",
        rnd("spy_rth_gaps_overnight_gap_pct").alias("spy_rth_gaps_overnight_gap_pct"),
        "spy_rth_gaps_overnight_is_gap",
        rnd(F.col("market_indicators_VIX") * SCALE).alias("market_indicators_VIX"),
        "spy_ohlcv_1drth_volume",
        F.col("order_flow_n").cast("double").alias("order_flow_n"),
        "macro_positioning_data_orders_count",
        rnd("SPY_NextDay_Return").alias("SPY_NextDay_Return"),
    )


CORRELATED = {"spy_ohlcv_1drth_volume": "volume", "spy_rth_gaps_overnight_is_gap": "is_gap", "spy_rth_gaps_overnight_gap_pct": "gap_pct", "order_flow_n": "n"}


@query(
    "p14_master_correlations",
    f"{JOINED}, c AS ("
    + " UNION ALL ".join(
        f"SELECT '{n}' AS feature, CASE WHEN count({x}) = count(*) THEN corr({x}, target) END AS corr FROM t WHERE ts BETWEEN DATE '{TRAIN[0]}' AND DATE '{TRAIN[1]}'"
        for n, x in CORRELATED.items()
    )
    + f") SELECT feature, {r6('corr')} AS corr FROM c",
)
def p14_correlations(spark, d):
    """Correlation with the next return over the training rows, of one feature of each kind."""
    found = _build(spark, d).correlations
    return found.filter(F.col("feature").isin(list(CORRELATED))).select("feature", rnd("corr").alias("corr"))


REPORTED = {
    "market_indicators": (*macro.VOL_INDEXES, "VIX_TERM_SLOPE"),
    "macro_positioning_data": MACRO_NAMES,
    "order_flow": ("n",),
    "spy_rth_gaps_overnight": ("gap_pct", "is_gap"),
}


@query(
    "p14_master_null_report",
    f"{JOINED} "
    + " UNION ALL ".join(
        f"SELECT '{t}' AS source, '{t}_{c}' AS \"column\", round(100.0 * count(*) FILTER ({c} IS NULL) / count(*), 2) AS null_pct FROM s" for t, cols in REPORTED.items() for c in cols
    ),
)
def p14_nulls(spark, d):
    """Missing values after the join, per source."""
    shown = [f"{t}_{c}" for t, cols in REPORTED.items() for c in cols]
    report = master.null_report(_build(spark, d)).filter("stage = 'after'")
    return report.filter(F.col("source").isin(list(REPORTED)) & F.col("column").isin(shown)).select("source", "column", "null_pct")
