"""Queries for composite tables (P7 to P15), text scoring (J6) and models (K)."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
from pyspark.sql import functions as F

from barloom import views
from barloom.catalog.basics import (
    ALL_ASSETS,
    ASSETS_CTE,
    BASKET,
    CHAIN_CTE,
    CROSS_CTE,
    FILL,
    HEAD,
    MACRO_CTE,
    OTHER,
    RET_CTE,
    _daily_orders,
    _in,
    r6,
    rnd,
)
from barloom.catalog.kit import bars_cte, query
from barloom.operators import align, panel
from barloom.plans import comparison, flows, kernel, macro, master, models, options, regimes, sector, sentiment, technical
from barloom.session import settle

BARS = bars_cte()
# Price-like values are compared times this factor (1 / pi): averages of price quotients can
# end in an exact 5, where engines round differently, and scaled ones do not.
SCALE = 0.3183098861837907
TRAIN, TEST = ("1995-01-01", "1999-12-31"), ("2000-01-01", "2001-12-31")

# -- sector table ------------------------------------------------------------------------
SECTOR = sector.SectorPlan(
    assets=ALL_ASSETS,
    benchmark="ALL",
    ratios=("ECONOMY", "LARGE", "MEDIUM"),
    growth=BASKET,
    defensive_returns=OTHER,
    vol_pair=("ECONOMY", "LARGE"),
    defensive=OTHER,
    cyclical=BASKET,
)
FEATS = (
    "SPY_Return",
    "GrowthMinusDef",
    "ECONOMY_ALL",
    "LARGE_ALL",
    "MEDIUM_ALL",
    "Breadth",
    "Vol_Ratio_ECONOMY_LARGE",
    "DGS10",
    "DGS5",
    "Spread",
    "DefCyc_Ratio",
    "Avg_Sector_Corr",
    "Crude_60dRet",
    "Copper_60dRet",
)


def _sector_sql() -> str:
    def px(a: str) -> str:
        return f"max(close) FILTER (asset = '{a}')"

    full6 = f"count(close) FILTER (asset <> 'ALL') = {len(views.ASSETS)}"
    wide = (
        "wide AS MATERIALIZED (SELECT ts, "
        + ", ".join(f'{px(a)} AS "p_{a}"' for a in ALL_ASSETS)
        + f", CASE WHEN {full6} THEN sum(close) FILTER (asset IN {_in(OTHER)}) / sum(close) FILTER (asset IN {_in(BASKET)}) END AS dc FROM grid GROUP BY ts)"
    )
    kept = "kd AS (SELECT ts FROM rets GROUP BY ts HAVING count(ret) = 7), k AS MATERIALIZED (SELECT * FROM rets SEMI JOIN kd USING (ts))"
    stds = "s AS (SELECT ts, asset, ret, CASE WHEN count(ret) OVER w = 20 THEN stddev_samp(ret) OVER w END AS sd FROM k WINDOW w AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"
    by_date = (
        "rd AS MATERIALIZED (SELECT ts, "
        + ", ".join(f"max(ret) FILTER (asset = '{a}') AS \"r_{a}\"" for a in ALL_ASSETS)
        + f", avg(ret) FILTER (asset IN {_in(BASKET)}) - avg(ret) FILTER (asset IN {_in(OTHER)}) AS gmd,"
        " max(sd) FILTER (asset = 'ECONOMY') / max(sd) FILTER (asset = 'LARGE') AS vr FROM s GROUP BY ts)"
    )
    breadth = (
        "rel AS (SELECT g.ts, g.asset, g.close / x.close AS rel FROM grid AS g LEFT JOIN grid AS x ON x.ts = g.ts AND x.asset = 'ALL'),"
        " relp AS (SELECT *, last_value(rel IGNORE NULLS) OVER (PARTITION BY asset ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pad FROM rel),"
        " up AS (SELECT ts, coalesce(pad / lag(pad, 60) OVER (PARTITION BY asset ORDER BY ts) - 1 > 0, false) AS up FROM relp),"
        " br AS (SELECT ts, CAST(count(*) FILTER (up) AS DOUBLE) AS breadth FROM up GROUP BY ts)"
    )
    corr = CROSS_CTE.replace("k AS (SELECT ts, asset, ret FROM rets WHERE ret IS NOT NULL), ", "") + ", ac AS MATERIALIZED (SELECT ts, avg(c) AS corr FROM pairs GROUP BY ts)"
    fut = (
        "fut AS (SELECT ts, total / lag(total, 60) OVER (ORDER BY ts) - 1 AS crude, n / lag(n, 60) OVER (ORDER BY ts) - 1 AS copper FROM"
        " (SELECT CAST(o_orderdate AS DATE) AS ts, sum(o_totalprice) AS total, CAST(count(*) AS DOUBLE) AS n FROM orders GROUP BY 1) AS q)"
    )
    joined = (
        "jn AS MATERIALIZED (SELECT w.*, rd.* EXCLUDE (ts), br.breadth, ac.corr, m.orders_count / 10 AS y10, m.orders_total / 1e8 AS y5, f.crude, f.copper"
        " FROM wide AS w LEFT JOIN rd USING (ts) LEFT JOIN br USING (ts) LEFT JOIN ac USING (ts) LEFT JOIN macro AS m USING (ts) LEFT JOIN fut AS f USING (ts))"
    )
    f = {
        "SPY_Return": '"r_ALL"',
        "GrowthMinusDef": "gmd",
        **{f"{a}_ALL": f'"p_{a}" / "p_ALL"' for a in ("ECONOMY", "LARGE", "MEDIUM")},
        "Breadth": "breadth",
        "Vol_Ratio_ECONOMY_LARGE": "vr",
        "DGS10": FILL.format("y10"),
        "DGS5": FILL.format("y5"),
        "Spread": FILL.format("y10 - y5"),
        "DefCyc_Ratio": "CASE WHEN count(dc) OVER w20 = 20 THEN avg(dc) OVER w20 END",
        "Avg_Sector_Corr": FILL.format("corr"),
        "Crude_60dRet": FILL.format("crude"),
        "Copper_60dRet": FILL.format("copper"),
    }
    feats = (
        "ft AS MATERIALIZED (SELECT *, "
        + ", ".join(f'{e} AS "{n}"' for n, e in f.items())
        + " FROM jn WINDOW w20 AS (ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"
    )
    cols = [f"""{r6(f'"p_{a}" * {SCALE}')} AS "Prices_{a}" """ for a in ALL_ASSETS]
    cols += [f"""{r6(f'"r_{a}"')} AS "Returns_{a}" """ for a in ALL_ASSETS]
    cols += [f"{r6(f'{a}_ALL')} AS Ratios_{a}_ALL" for a in ("ECONOMY", "LARGE", "MEDIUM")]
    cols += [f"{r6(n)} AS Features_{n}" for n in FEATS]
    cols += [
        f"CASE WHEN count({n}) OVER w = 252 THEN {r6(f'({n} - avg({n}) OVER w) / nullif(stddev_samp({n}) OVER w, 0)')} END AS ZScores_{n}"
        for n in FEATS
    ]
    ctes = ", ".join([ASSETS_CTE, RET_CTE, MACRO_CTE, wide, kept, stds, by_date, breadth, corr, fut, joined, feats])
    return f"WITH {ctes} SELECT ts, {', '.join(cols)} FROM ft WINDOW w AS (ORDER BY ts ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)"


@query("p7_sector_features", _sector_sql())
def p7(spark, d):
    m = align.outer_align(views.macro(spark, d), ("orders_total", "orders_count"))
    yields = m.select(F.lit("M").alias("market"), "ts", F.col("orders_count").alias("DGS10_quote"), (F.col("orders_total") / 1e7).alias("DGS5_quote"))
    o = _daily_orders(spark, d)
    futures = o.select(F.lit("M").alias("market"), "ts", F.col("total").alias("Crude"), F.col("n").cast("double").alias("Copper"))
    out = sector.sector_features(views.assets(spark, d), yields, futures, SECTOR)
    # Prices are quotients that can end in an exact 5; scaled ones do not.
    cells = [rnd(F.col(c) * SCALE if c.startswith("Prices_") else F.col(c)).alias(c) for c in out.columns if c not in ("market", "ts")]
    return out.select("ts", *cells)


# -- flows -------------------------------------------------------------------------------
FLOW = flows.FlowPlan("ALL", "ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL")


def _flow_sql() -> str:
    names = (FLOW.oil, FLOW.gold, FLOW.eurusd, FLOW.usdjpy, FLOW.equal_weight)
    wide = "w AS (SELECT ts, " + ", ".join(f"max(close) FILTER (asset = '{a}') AS \"p_{a}\"" for a in ("ALL", *names))
    wide += ", max(volume) FILTER (asset = 'ALL') AS v FROM assets GROUP BY ts HAVING max(close) FILTER (asset = 'ALL') IS NOT NULL)"
    fill = "f AS MATERIALIZED (SELECT ts, \"p_ALL\", v, " + ", ".join(
        f"""coalesce({FILL.format(f'"p_{a}"')}, {HEAD.format(f'"p_{a}"')}) AS "p_{a}" """ for a in names
    ) + " FROM w)"
    r5 = {a: f'"p_{a}" / lag("p_{a}", 5) OVER o - 1' for a in ("ALL", *names)}
    feats = (
        "q AS (SELECT ts, row_number() OVER o AS rn, CASE WHEN count(v) OVER w20 = 20 THEN (v - avg(v) OVER w20) / nullif(stddev_samp(v) OVER w20, 0) END AS flow_vol_z20,"
        ' "p_ALL" * v / lag("p_ALL" * v, 5) OVER o - 1 AS flow_money_proxy5,'
        f" {r5['ECONOMY']} AS uso_ret5, {r5['LARGE']} AS gld_ret5, {r5['MEDIUM']} AS eurusd_ret5, {r5['PROMO']} AS usdjpy_ret5,"
        f" 0.5 * (-({r5['MEDIUM']})) + 0.5 * ({r5['PROMO']}) AS usd_strength, ({r5['SMALL']}) - ({r5['ALL']}) AS breadth_proxy"
        " FROM f WINDOW o AS (ORDER BY ts), w20 AS (ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"
    )
    whole = " AND ".join(f"{c} IS NOT NULL" for c in flows.FEATURES)
    return f"WITH {ASSETS_CTE}, {wide}, {fill}, {feats} SELECT ts, {', '.join(f'{r6(c)} AS {c}' for c in flows.FEATURES)} FROM q WHERE rn > 20 AND {whole}"


@query("p8_fx_flow_features", _flow_sql())
def p8(spark, d):
    out = flows.fx_flow_features(views.assets(spark, d), FLOW)
    return out.select("ts", *[rnd(c).alias(c) for c in flows.FEATURES])


# -- macro and volatility panels -----------------------------------------------------------
MACRO_NAMES = ("orders_total", "orders_count")


@query(
    "p9_macro_panel",
    f"WITH {BARS}, {MACRO_CTE}, b AS (SELECT * FROM bars WHERE symbol = 'A')"
    f" SELECT b.ts, volume, {r6('ln(close)')} AS log_close, round({FILL.format('orders_total').replace('ORDER BY ts', 'ORDER BY b.ts')}, 2) AS orders_total,"
    f" {FILL.format('orders_count').replace('ORDER BY ts', 'ORDER BY b.ts')} AS orders_count FROM b LEFT JOIN macro ON macro.ts = b.ts",
)
def p9(spark, d):
    bars = views.bars_daily(spark, d).filter("symbol = 'A'").drop("symbol")
    out = macro.macro_panel(bars, views.macro(spark, d), MACRO_NAMES)
    return out.select("ts", "volume", rnd(F.ln("close")).alias("log_close"), rnd("orders_total", 2).alias("orders_total"), "orders_count")


# Which asset column stands in for each index, yield or spread.
STAND_INS = {
    "VIX": ("SMALL", "close"),
    "VVIX": ("LARGE", "close"),
    "SKEW": ("MEDIUM", "close"),
    "VIX3M": ("PROMO", "close"),
    "UST_2Y": ("ECONOMY", "volume"),
    "UST_10Y": ("LARGE", "volume"),
    "SPREAD_10_2": ("SMALL", "volume"),
    "HY_OAS": ("ECONOMY", "close"),
    "IG_OAS": ("STANDARD", "close"),
    "Fed_Funds": ("PROMO", "volume"),
    "HYG": ("ECONOMY", "close"),
    "LQD": ("STANDARD", "close"),
}


def _series(spark, d, names, assets=None):
    """The stand-ins as a long table: one pass over the asset rows (``assets`` if they are there already), no self joins."""
    hits = [
        F.when(F.col("asset") == STAND_INS[n][0], F.struct(F.lit(n).alias("name"), F.col(STAND_INS[n][1]).alias("value"))) for n in names
    ]
    rows = (views.assets(spark, d) if assets is None else assets).select("ts", F.explode(F.array_compact(F.array(*hits))).alias("s"))
    return rows.select(F.col("s.name").alias("name"), "ts", F.col("s.value").alias("value"))


def _series_sql(names) -> str:
    cols = ", ".join(f"max({STAND_INS[n][1]}) FILTER (asset = '{STAND_INS[n][0]}') AS {n}" for n in names)
    used = _in(sorted({STAND_INS[n][0] for n in names}))
    return f"w AS (SELECT ts, {cols} FROM assets WHERE asset IN {used} GROUP BY ts)"


def _scaled(df, *skip):
    return df.select(*skip, *[rnd(F.col(f"`{c}`") * SCALE).alias(c) for c in df.columns if c not in skip])


@query(
    "p10_vol_index_panel",
    f"WITH {ASSETS_CTE}, {_series_sql(macro.VOL_INDEXES)} SELECT ts, "
    + ", ".join(f"{r6(f'{n} * {SCALE}')} AS {n}" for n in macro.VOL_INDEXES)
    + f", {r6(f'(VIX3M - VIX) * {SCALE}')} AS VIX_TERM_SLOPE FROM w",
)
def p10(spark, d):
    return _scaled(macro.vol_index_panel(_series(spark, d, macro.VOL_INDEXES)), "ts")


EXTENDED = (*macro.VOL_INDEXES, *macro.RATES)


@query(
    "p10_vol_index_panel_extended",
    f"WITH {ASSETS_CTE}, {_series_sql(EXTENDED)} SELECT ts, "
    + ", ".join(f"{r6(f'{n} * {SCALE}')} AS {n}" for n in EXTENDED)
    + f", {r6(f'(HY_OAS - IG_OAS) * {SCALE}')} AS HY_minus_IG, {r6(f'(IG_OAS - HY_OAS) * {SCALE}')} AS Risk_Appetite FROM w",
)
def p10x(spark, d):
    return _scaled(macro.vol_index_panel_extended(_series(spark, d, EXTENDED)), "ts")


RISK = ("UST_2Y", "UST_10Y", "Fed_Funds", "HYG", "LQD", "VIX")


@query(
    "p11_macro_risk_panel",
    f"WITH {ASSETS_CTE}, {_series_sql(RISK)} SELECT ts, {r6(FILL.format('UST_2Y') + f' * {SCALE}')} AS UST_2Y, {r6(FILL.format('UST_10Y') + f' * {SCALE}')} AS UST_10Y,"
    f" {r6(FILL.format('(UST_10Y - UST_2Y)') + f' * {SCALE}')} AS Term_Spread, {r6(FILL.format('Fed_Funds') + f' * {SCALE}')} AS Fed_Funds,"
    f" {r6(FILL.format('(HYG / LQD - 1)') + f' * {SCALE}')} AS \"HY-IG_Spread\", {r6(FILL.format('VIX') + f' * {SCALE}')} AS VIX FROM w",
)
def p11(spark, d):
    return _scaled(macro.macro_risk_panel(_series(spark, d, RISK), RISK), "ts")


@query(
    "p12_options_snapshot",
    f"WITH {CHAIN_CTE}, {BARS} SELECT 'A' AS symbol, {r6('''(SELECT sum(volume) FILTER (cp = 'P') / sum(volume) FILTER (cp = 'C') FROM chain)''')} AS pcr_volume,"
    f" {r6('''(SELECT sum(oi) FILTER (cp = 'P') / sum(oi) FILTER (cp = 'C') FROM chain)''')} AS pcr_oi,"
    " (SELECT round(avg(p.iv - c.iv), 9) FROM chain AS c JOIN chain AS p ON p.strike = c.strike AND c.cp = 'C' AND p.cp = 'P') + 0.0 AS iv_skew,"
    " (SELECT count(*) FROM chain AS c JOIN chain AS p ON p.strike = c.strike AND c.cp = 'C' AND p.cp = 'P') AS common_strikes,"
    f" {r6('''(SELECT ln(last(close ORDER BY ts)) FROM bars WHERE symbol = 'A')''')} AS log_spot",
)
def p12(spark, d):
    chain = views.chain(spark, d).withColumn("symbol", F.lit("A"))
    s = options.snapshot(chain, views.bars_daily(spark, d))
    return s.select(
        "symbol", rnd("pcr_volume").alias("pcr_volume"), rnd("pcr_oi").alias("pcr_oi"), rnd("iv_skew", 9).alias("iv_skew"), "common_strikes", rnd(F.ln("spot")).alias("log_spot")
    )


# -- sentiment ---------------------------------------------------------------------------
@query(
    "p13_daily_sentiment",
    "SELECT CAST(ts AS DATE) AS date, round(avg(value), 6) AS sentiment_score FROM (SELECT * FROM events QUALIFY"
    " row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) <= 10) AS q GROUP BY 1",
)
def p13(spark, d):
    ev = views.table(spark, d, "events")
    news = ev.select(F.col("ts").alias("time"), F.col("event_id").alias("id"), F.col("event_type").alias("title"), F.col("props").alias("description"), "value")
    scored = sentiment.daily_sentiment(news, lambda a: a.withColumn("sentiment_score", F.col("value")))
    return scored.withColumn("sentiment_score", rnd("sentiment_score"))


@query("j6_score_text")
def j6(spark, d):
    model = sentiment.fit_scorer(views.labelled_text(spark, d))
    docs = views.table(spark, d, "documents").select("doc_id", "text")
    return sentiment.score_text(docs, model).select("doc_id", rnd("sentiment_score").alias("sentiment_score"))


# -- master dataset ------------------------------------------------------------------------
def _master_sources(spark, d):
    """Six text-dated tables of one symbol, named as the master dataset expects them."""
    bars = views.bars_daily(spark, d).filter("symbol = 'A'")

    def dated(df, *cols):
        return df.select(F.date_format("ts", "yyyy-MM-dd").alias("Date"), *cols)

    m = align.outer_align(views.macro(spark, d), MACRO_NAMES)
    # The packs are tables another job has written; here they are computed once and kept.
    vol, gaps, liq = (
        settle(technical.compute(bars, pack))
        for pack in (technical.volatility, technical.gaps_overnight, technical.liquidity_pressure)
    )
    return {
        "macro_positioning_data": dated(m, *MACRO_NAMES),
        "market_indicators": dated(macro.vol_index_panel(_series(spark, d, macro.VOL_INDEXES)), *macro.VOL_INDEXES, "VIX_TERM_SLOPE"),
        "spy_ohlcv_1drth": dated(bars, "open", "high", "low", "close", "volume"),
        "spy_rth_gaps_overnight": dated(gaps, *[c for c in gaps.columns if c not in bars.columns]),
        "spy_rth_trend_liquidity_pressure": dated(liq, *[c for c in liq.columns if c not in bars.columns]),
        "spy_rth_volatility": dated(vol, *[c for c in vol.columns if c not in bars.columns]),
    }


def _build_master(spark, d):
    return master.build_master(_master_sources(spark, d), train=TRAIN)


@query("p14_master_dataset")
def p14(spark, d):
    return _build_master(spark, d).data


@query("p14_master_feature_corr")
def p14_corr(spark, d):
    return _build_master(spark, d).correlations


MASTER_SLICE = ("spy_rth_gaps_overnight_gap_pct", "spy_rth_gaps_overnight_is_gap", "market_indicators_VIX", "spy_ohlcv_1drth_volume", "macro_positioning_data_orders_count")


@query(
    "p14_master_slice",
    f"WITH {BARS}, {ASSETS_CTE}, {_series_sql(['VIX'])}, {MACRO_CTE}, b AS (SELECT * FROM bars WHERE symbol = 'A'),"
    " s AS (SELECT b.ts AS d, (open - lag(close) OVER o) / lag(close) OVER o AS gap_pct, CAST(CAST(coalesce(open <> lag(close) OVER o, false) AS INT) AS DOUBLE) AS is_gap, w.VIX, volume,"
    " orders_count, lead(close) OVER o / close - 1 AS target FROM b LEFT JOIN w ON w.ts = b.ts LEFT JOIN macro ON macro.ts = b.ts WINDOW o AS (ORDER BY b.ts)),"
    f" t AS (SELECT * FROM s WHERE target IS NOT NULL) SELECT d AS \"Date\", {r6('gap_pct')} AS spy_rth_gaps_overnight_gap_pct, is_gap AS spy_rth_gaps_overnight_is_gap,"
    f" {r6(f'VIX * {SCALE}')} AS market_indicators_VIX, volume AS spy_ohlcv_1drth_volume,"
    f" {FILL.format('orders_count').replace('ORDER BY ts', 'ORDER BY d')} AS macro_positioning_data_orders_count, {r6('target')} AS \"SPY_NextDay_Return\" FROM t",
)
def p14_slice(spark, d):
    data = _build_master(spark, d).data
    gap, is_gap, vix, vol, macro_count = MASTER_SLICE
    return data.select(
        "Date", rnd(gap).alias(gap), is_gap, rnd(F.col(vix) * SCALE).alias(vix), vol, macro_count, rnd("SPY_NextDay_Return").alias("SPY_NextDay_Return")
    )


# -- models ------------------------------------------------------------------------------
def _panel(spark, d):
    """Daily bars of all symbols with the macro series carried to their dates."""
    bars = views.bars_daily(spark, d)
    m = align.outer_align(views.macro(spark, d), MACRO_NAMES)
    daily = align.reindex_ffill(m, bars.select("ts").distinct(), MACRO_NAMES)
    return bars.join(daily, "ts").select("symbol", "ts", "close", *MACRO_NAMES)


def _frame(spark, d):
    return models.model_frame(_panel(spark, d), MACRO_NAMES, released=MACRO_NAMES)


@query(
    "k1_time_split",
    f"WITH {BARS} SELECT symbol, CASE WHEN ts <= DATE '{TRAIN[1]}' THEN 'train' ELSE 'test' END AS part, count(*) AS n, min(ts) AS a, max(ts) AS z"
    f" FROM bars WHERE ts BETWEEN DATE '{TRAIN[0]}' AND DATE '{TEST[1]}' GROUP BY 1, 2",
)
def k1(spark, d):
    parts = models.time_split(views.bars_daily(spark, d), TRAIN, TEST)
    both = parts[0].withColumn("part", F.lit("train")).unionByName(parts[1].withColumn("part", F.lit("test")))
    return both.groupBy("symbol", "part").agg(F.count("*").alias("n"), F.min("ts").alias("a"), F.max("ts").alias("z"))


@query(
    "k2_standardize",
    f"WITH {BARS}, m AS (SELECT avg(volume) AS a, stddev_pop(volume) AS s FROM bars WHERE ts BETWEEN DATE '{TRAIN[0]}' AND DATE '{TRAIN[1]}')"
    f" SELECT symbol, ts, {r6('(volume - a) / s')} AS volume FROM bars, m WHERE ts BETWEEN DATE '{TEST[0]}' AND DATE '{TEST[1]}'",
)
def k2(spark, d):
    past, future = models.time_split(views.bars_daily(spark, d), TRAIN, TEST)
    out = models.Standardizer.fit(past, ["volume"]).transform(future)
    return out.select("symbol", "ts", rnd("volume").alias("volume"))


@query(
    "k3_median_impute",
    "WITH q AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_discount, 0) AS disc, CASE WHEN l_tax > 0.01 THEN l_extendedprice END AS px FROM lineitem),"
    " m AS (SELECT quantile_cont(disc, 0.5) AS d, quantile_cont(px, 0.5) AS p FROM q)"
    " SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(disc, d), 6) AS disc, round(coalesce(px, p), 3) AS px FROM q, m",
)
def k3(spark, d):
    q = views.table(spark, d, "lineitem").select(
        *views.TICK_ORDER, F.nullif("l_discount", F.lit(0.0)).alias("disc"), F.when(F.col("l_tax") > 0.01, F.col("l_extendedprice")).alias("px")
    )
    out = models.median_impute(q, columns=["disc", "px"])[0]
    return out.withColumns({"disc": rnd("disc"), "px": rnd("px", 3)})


@query(
    "k4_expanding_folds",
    "WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS ts FROM lineitem), r AS (SELECT ts, row_number() OVER (ORDER BY ts) AS rn, count(*) OVER () AS n FROM d)"
    " SELECT ts, CAST(greatest(0, 6 - ceil((n - rn + 1) / floor(n / 6))) AS INT) AS fold FROM r",
)
def k4(spark, d):
    return models.add_folds(align.calendar(views.ticks(spark, d)))


BASE = (*MACRO_NAMES, "Ret1", "Ret5", "Vol10")
PENALTIES = (1e-4, 1e-3, 1.0)


@query(
    "k4_expanding_cv_grid",
    f"WITH {BARS}, d AS (SELECT DISTINCT ts FROM bars), r AS (SELECT ts, row_number() OVER (ORDER BY ts) AS rn, count(*) OVER () AS n FROM d),"
    " f AS (SELECT ts, greatest(0, 6 - ceil((n - rn + 1) / floor(n / 6))) AS fold FROM r),"
    " q AS (SELECT fold, volume AS x, ln(close) AS y FROM bars JOIN f USING (ts)),"
    " t AS (SELECT k, avg(x) AS mx, stddev_pop(x) AS sx, avg(y) AS my, count(*) AS n, covar_pop(x, y) * count(*) / stddev_pop(x) AS szy"
    " FROM q, range(1, 6) AS g(k) WHERE fold < k GROUP BY k),"
    f" c AS (SELECT unnest({list(PENALTIES)}) AS C)"
    " SELECT CAST(k AS INT) AS fold, CAST(C AS DOUBLE) AS C, count(*) AS n, round(avg(pow(y - my - szy / (t.n + 1 / C) * (x - mx) / sx, 2)), 6) AS mse"
    " FROM t JOIN q ON q.fold = t.k, c GROUP BY k, C",
)
def k4_grid(spark, d):
    """Error of every penalty and fold of a regression on one input."""
    b = views.bars_daily(spark, d).select("ts", "volume", F.ln("close").alias("y"))
    found = models.kernel_search(b, ["volume"], {"gamma": (None,), "C": PENALTIES}, label="y")
    rows = [(k, c, n, round(e, 6)) for _, c, k, n, e in found.errors]
    return spark.createDataFrame(rows, "fold int, C double, n long, mse double")


GIVEN = kernel.fourier([0.05, 8.0, 150.0], [0.02, 2.0, 40.0], 0.1, 8, 5)
GIVEN_WEIGHTS = tuple(round(float(x), 6) for x in np.linspace(-1.0, 1.5, 8))


def _given_sql() -> str:
    """The regression with given frequencies, phases and weights as one expression."""
    z = [f"(({c}) - {m!r}) / {s!r}" for c, m, s in zip(("high / low / 100", "ln(close)", "volume"), GIVEN.mean.tolist(), GIVEN.scale.tolist())]
    waves = []
    for w, f, b in zip(GIVEN_WEIGHTS, GIVEN.frequencies.T.tolist(), GIVEN.phases.tolist()):
        angle = " + ".join(f"{x!r} * {v}" for x, v in zip(f, z))
        waves.append(f"{w!r} * sqrt(2.0 / 8) * cos({angle} + {b!r})")
    return f"WITH {BARS} SELECT symbol, ts, round(0.25 + {' + '.join(waves)}, 6) AS prediction FROM bars"


@query("k5_kernel_scores", _given_sql())
def k5_scores(spark, d):
    """Predictions of a kernel regression with given frequencies and weights."""
    b = views.bars_daily(spark, d).select("symbol", "ts", (F.col("high") / F.col("low") / 100).alias("spread"), F.ln("close").alias("level"), "volume")
    model = kernel.KernelModel(("spread", "level", "volume"), GIVEN, np.array(GIVEN_WEIGHTS), 0.25)
    return model.transform(b).select("symbol", "ts", rnd("prediction").alias("prediction"))


@query("k5_regression_next_price")
def k5(spark, d):
    past, future = models.time_split(_frame(spark, d), TRAIN, TEST)
    tuned = models.kernel_search(past, BASE)
    return models.price_predictions(tuned.model, future).select("symbol", "ts", "true_price", "pred_price")


def _regimes(spark, d, states=2):
    past, future = models.time_split(_frame(spark, d), TRAIN, TEST)
    return regimes.fit(past, ("Ret1", "Vol10"), states), past, future


@query("k6_regime_hmm_fit")
def k6(spark, d):
    m, _, _ = _regimes(spark, d, 3)
    rows = [(k, float(m.start[k]), *map(float, m.mean[k]), *map(float, m.var[k])) for k in range(m.states)]
    return spark.createDataFrame(rows, "state int, start double, mean_ret double, mean_vol double, var_ret double, var_vol double")


@query("k7_regime_probs")
def k7(spark, d):
    m, _, future = _regimes(spark, d)
    return regimes.probabilities(future, m)


@query("k8_regime_forecast_hard")
def k8(spark, d):
    m, _, future = _regimes(spark, d)
    return regimes.forecast_hard(future, m).select("symbol", "ts", "state", "pred_price")


@query("k9_regime_forecast_soft")
def k9(spark, d):
    m, past, future = _regimes(spark, d)
    std = past.agg(F.stddev_samp("Ret1")).first()[0]
    return regimes.forecast_soft(future, m, std).select("symbol", "ts", "pred_price")


@query("k10_augment_with_regimes")
def k10(spark, d):
    m, past, future = _regimes(spark, d)
    probs = regimes.probabilities(past, m).unionByName(regimes.probabilities(future, m))
    return regimes.augment(_frame(spark, d), probs, lag=1, backfill=True)


@query(
    "k11_naive_baseline",
    f"WITH {BARS}, q AS (SELECT symbol, close, lead(close) OVER (PARTITION BY symbol ORDER BY ts) AS nxt FROM bars WHERE ts BETWEEN DATE '{TEST[0]}' AND DATE '{TEST[1]}')"
    " SELECT symbol, round(avg(pow(nxt - close, 2)) / 1e6, 6) AS mse FROM q WHERE nxt IS NOT NULL GROUP BY symbol",
)
def k11(spark, d):
    out = panel.mse(models.naive_baseline(views.bars_daily(spark, d), TEST), "true_price", "pred_price", ["symbol"])
    return out.select("symbol", rnd(F.col("mse") / 1e6).alias("mse"))


@query("p15_model_comparison")
def p15(spark, d):
    variant = comparison.Variant(macro=MACRO_NAMES, forecast="soft", impute=True, lagged=True, released=MACRO_NAMES)
    return comparison.compare(_panel(spark, d), variant, TRAIN, TEST)


@query("p15_model_comparison_compact")
def p15_compact(spark, d):
    """Two states, the most likely path forecasts."""
    return comparison.compare(_panel(spark, d), comparison.Variant(macro=MACRO_NAMES, released=MACRO_NAMES), TRAIN, TEST)


@query("p15_model_comparison_wide")
def p15_wide(spark, d):
    """Three states, five-day returns, no forecast from regimes alone."""
    variant = replace(comparison.wide_variant(MACRO_NAMES, ("Ret1", "Vol10")), released=MACRO_NAMES)
    return comparison.compare(_panel(spark, d), variant, TRAIN, TEST)
