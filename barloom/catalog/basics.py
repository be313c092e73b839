"""Queries for sources, columns, joins, aggregates, sorting, sets and scalars (A to H)."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from barloom import views
from barloom.catalog.kit import bars_cte, query
from barloom.functions import cells, market
from barloom.operators import align, bars, panel, profile
from barloom.sources import ingest



def r6(e: str) -> str:
    return f"round({e}, 6) + 0.0"


def rnd(c, digits: int = 6):
    return F.round(c, digits)


BARS = bars_cte()

# -- sources and ingest ------------------------------------------------------------------


@query(
    "a4_to_numeric_coerce",
    "SELECT p_partkey, TRY_CAST(replace(p_brand, 'Brand#', '') AS DOUBLE) AS brand_no,"
    " TRY_CAST(p_brand AS DOUBLE) AS bad FROM part",
)
def a4(spark, d):
    p = views.table(spark, d, "part")
    return p.select(
        "p_partkey",
        cells.to_number(F.replace("p_brand", F.lit("Brand#"), F.lit(""))).alias("brand_no"),
        cells.to_number("p_brand").alias("bad"),
    )


@query(
    "a9_to_ny_date",
    "SELECT symbol, ny_date, last(value ORDER BY ts) AS value FROM (SELECT event_type AS symbol, value, ts,"
    " CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS ny_date FROM events) AS e GROUP BY 1, 2",
)
def a9(spark, d):
    ev = views.event_ticks(spark, d).withColumn("ny_date", ingest.ny_date("ts"))
    return bars.last_per_day(ev.withColumnRenamed("price", "value"), ["symbol", "ny_date"], "ts", ["value"])


@query("a10_utc_date", "SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def a10(spark, d):
    return views.event_ticks(spark, d).groupBy(ingest.utc_date("ts").alias("day")).agg(F.count("*").alias("n"))


ASSETS_CTE = (
    "cells AS MATERIALIZED (SELECT p_type AS asset, CAST(l_shipdate AS DATE) AS ts, sum(l_extendedprice / l_quantity) AS p,"
    " count(*) AS n, sum(l_quantity) AS volume FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2),"
    " assets AS MATERIALIZED (SELECT asset, ts, p / n AS close, volume FROM cells UNION ALL"
    " SELECT 'ALL', ts, sum(p) / sum(n), sum(volume) FROM cells GROUP BY ts)"
)
ALL_ASSETS = ("ALL", *views.ASSETS)


@query(
    "a12_pivot_long_wide",
    f"WITH {ASSETS_CTE} SELECT ts, "
    + ", ".join(
        f"{r6(f'ln(max(CASE WHEN asset = {a!r} THEN {v} END))')} AS {a}_{v}" for a in ALL_ASSETS for v in ("close", "volume")
    )
    + " FROM assets GROUP BY ts",
)
def a12(spark, d):
    wide = align.pivot_wide(views.assets(spark, d), ALL_ASSETS, ["close", "volume"])
    # Averages of price quotients often end in an exact 5, where engines round differently;
    # logarithms do not.
    return wide.select("ts", *[rnd(F.ln(c)).alias(c) for c in wide.columns if c != "ts"])


CHAIN_CTE = (
    "chain AS MATERIALIZED (SELECT CASE l_returnflag WHEN 'A' THEN 'C' ELSE 'P' END AS cp, l_quantity AS strike,"
    " CAST(count(*) AS DOUBLE) AS volume, CAST(sum(l_linenumber) AS BIGINT) AS oi, avg(l_discount) AS iv"
    " FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1, 2)"
)


@query("a14_option_chain", f"WITH {CHAIN_CTE} SELECT cp, strike, volume, oi, {r6('iv')} AS iv FROM chain")
def a14(spark, d):
    c = views.chain(spark, d)
    return c.select("cp", "strike", "volume", F.col("openInterest").alias("oi"), rnd("impliedVolatility").alias("iv"))


# -- filters and columns -----------------------------------------------------------------
@query(
    "b3_filter_session",
    "SELECT event_id, CASE WHEN hour(ts) = 9 AND minute(ts) >= 30 THEN 'open' WHEN hour(ts) = 9 THEN 'pre' ELSE 'hour' END AS part"
    " FROM events WHERE hour(ts) = 9 OR hour(ts) IN (11, 12, 13, 14, 15, 16)",
)
def b3(spark, d):
    ev = views.event_ticks(spark, d)
    opening, pre = bars.opening_minutes(), bars.pre_open_minutes()
    kept = ev.filter(opening | pre | bars.session_hours())
    return kept.select("event_id", F.when(opening, "open").when(pre, "pre").otherwise("hour").alias("part"))


@query(
    "b4_filter_date_range",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-06-30'",
)
def b4(spark, d):
    o = views.table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return align.between_dates(o, "1996-01-01", "1998-06-30", "day").select("o_orderkey", "o_totalprice")


LAGGED = f"WITH {BARS} SELECT * FROM (SELECT symbol, ts, {r6('close / lag(close, 30) OVER o')} AS chg FROM bars WINDOW o AS (PARTITION BY symbol ORDER BY ts)) AS q"


def _lagged(spark, d):
    w = Window.partitionBy("symbol").orderBy("ts")
    b = views.bars_daily(spark, d)
    return b.select("symbol", "ts", rnd(cells.ratio("close", F.lag("close", 30).over(w))).alias("chg"))


@query("b5_dropna", LAGGED + " WHERE chg IS NOT NULL")
def b5(spark, d):
    return align.drop_missing(_lagged(spark, d), ["chg"])


@query(
    "b6_inf_to_null",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount > 0 THEN round(l_quantity / l_discount, 6) END AS q FROM lineitem",
)
def b6(spark, d):
    li = views.table(spark, d, "lineitem")
    # Division of doubles outside ANSI rules gives infinities, as a file of floats may hold.
    inf = F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(cells.ratio("l_quantity", "l_discount"))
    return li.select(*views.TICK_ORDER, rnd(cells.inf_to_null(inf)).alias("q"))


@query(
    "b7_zero_to_null",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(ln(nullif(l_discount, 0)), 6) AS log_discount FROM lineitem",
)
def b7(spark, d):
    li = views.table(spark, d, "lineitem")
    return li.select(*views.TICK_ORDER, rnd(cells.ln_pos(cells.zero_to_null("l_discount"))).alias("log_discount"))


@query(
    "b8_skip_first_n",
    f"WITH {BARS} SELECT symbol, ts, volume FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS rn FROM bars) AS q WHERE rn > 20",
)
def b8(spark, d):
    return align.skip_first(views.bars_daily(spark, d), 20, ["symbol"]).select("symbol", "ts", "volume")


@query("b10_build_calendar", "SELECT DISTINCT CAST(l_shipdate AS DATE) AS ts FROM lineitem")
def b10(spark, d):
    return align.calendar(views.ticks(spark, d))


@query(
    "b13_clip",
    "SELECT c_custkey, CASE WHEN c_acctbal IS NOT NULL THEN greatest(c_acctbal, 0) END AS low0,"
    " CASE WHEN c_acctbal IS NOT NULL THEN least(greatest(c_acctbal, -500), 5000) END AS band FROM customer",
)
def b13(spark, d):
    c = views.table(spark, d, "customer")
    return c.select(
        "c_custkey", cells.clip("c_acctbal", low=0.0).alias("low0"), cells.clip("c_acctbal", -500.0, 5000.0).alias("band")
    )


# -- joins -------------------------------------------------------------------------------
DAILY_ORDERS = (
    "o AS MATERIALIZED (SELECT CAST(o_orderdate AS DATE) AS ts, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY 1)"
)


def _daily_orders(spark, d):
    o = views.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("ts"), "o_totalprice")
    return o.groupBy("ts").agg(F.sum("o_totalprice").alias("total"), F.count("*").alias("n"))


def _join_sql(kind: str) -> str:
    return f"WITH {BARS}, {DAILY_ORDERS} SELECT symbol, ts, volume, round(total, 2) AS total FROM bars {kind} JOIN o USING (ts)"


@query("c1_join_inner_date", _join_sql("INNER"))
def c1(spark, d):
    j = views.bars_daily(spark, d).join(_daily_orders(spark, d), "ts", "inner")
    return j.select("symbol", "ts", "volume", rnd("total", 2).alias("total"))


@query("c2_join_left_date", _join_sql("LEFT"))
def c2(spark, d):
    j = views.bars_daily(spark, d).join(_daily_orders(spark, d), "ts", "left")
    return j.select("symbol", "ts", "volume", rnd("total", 2).alias("total"))


WEEKDAYS = "cal AS MATERIALIZED (SELECT DISTINCT CAST(l_shipdate AS DATE) AS ts FROM lineitem WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5)"


@query(
    "c3_spine_join",
    f"WITH {BARS}, {DAILY_ORDERS}, {WEEKDAYS} SELECT cal.ts, a.volume AS a_volume, r.volume AS r_volume, o.n AS orders_n FROM cal"
    " LEFT JOIN (SELECT * FROM bars WHERE symbol = 'A') AS a ON a.ts = cal.ts"
    " LEFT JOIN (SELECT * FROM bars WHERE symbol = 'R') AS r ON r.ts = cal.ts LEFT JOIN o ON o.ts = cal.ts",
)
def c3(spark, d):
    b = views.bars_daily(spark, d)

    def side(s: str):
        return b.filter(F.col("symbol") == s).select("ts", F.col("volume").alias(f"{s.lower()}_volume"))

    tables = {"a": side("A"), "r": side("R"), "o": _daily_orders(spark, d).select("ts", F.col("n").alias("orders_n"))}
    return align.spine_join(views.weekdays(spark, d), tables, on=["ts"])


@query(
    "c4_join_strike",
    f"WITH {CHAIN_CTE} SELECT c.strike, {r6('c.iv')} AS iv_call, {r6('p.iv')} AS iv_put FROM (SELECT * FROM chain WHERE cp = 'C') AS c"
    " JOIN (SELECT * FROM chain WHERE cp = 'P') AS p ON p.strike = c.strike",
)
def c4(spark, d):
    from barloom.plans import options

    j = options.join_strikes(views.chain(spark, d))
    return j.select("strike", rnd("IV_call").alias("iv_call"), rnd("IV_put").alias("iv_put"))


MACRO_CTE = (
    "macro AS MATERIALIZED (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS ts, sum(o_totalprice) AS orders_total,"
    " CAST(count(*) AS DOUBLE) AS orders_count FROM orders GROUP BY 1)"
)
MACRO_NAMES = ("orders_total", "orders_count")


@query(
    "c5_outer_align",
    f"WITH {MACRO_CTE}, {BARS}, x AS (SELECT ts, volume AS a_volume FROM bars WHERE symbol = 'A')"
    " SELECT ts, a_volume, orders_count FROM x FULL JOIN macro USING (ts)",
)
def c5(spark, d):
    vol = views.bars_daily(spark, d).filter("symbol = 'A'").select(F.lit("a_volume").alias("name"), "ts", F.col("volume").alias("value"))
    count = views.macro(spark, d).filter("name = 'orders_count'")
    return align.outer_align(vol.unionByName(count), ["a_volume", "orders_count"])


def _macro_wide(spark, d):
    return align.outer_align(views.macro(spark, d), MACRO_NAMES)


FILL = "last_value({} IGNORE NULLS) OVER (ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
HEAD = "first_value({} IGNORE NULLS) OVER (ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


@query(
    "c6_reindex_ffill",
    f"WITH {MACRO_CTE}, {WEEKDAYS} SELECT ts, round({FILL.format('orders_total')}, 2) AS orders_total,"
    f" {FILL.format('orders_count')} AS orders_count FROM cal LEFT JOIN macro USING (ts)",
)
def c6(spark, d):
    out = align.reindex_ffill(_macro_wide(spark, d), views.weekdays(spark, d), MACRO_NAMES)
    return out.withColumn("orders_total", rnd("orders_total", 2))


@query(
    "c6_reindex_asof",
    f"WITH {MACRO_CTE}, {WEEKDAYS}, j AS (SELECT ts, orders_count, cal.ts IS NOT NULL AS on_cal FROM cal FULL JOIN macro USING (ts)),"
    f" f AS (SELECT ts, on_cal, {FILL.format('orders_count')} AS orders_count FROM j) SELECT ts, orders_count FROM f WHERE on_cal",
)
def c6_asof(spark, d):
    return align.reindex_ffill(_macro_wide(spark, d), views.weekdays(spark, d), ["orders_count"], how="asof")


@query(
    "c7_reindex_ffill_bfill",
    f"WITH {MACRO_CTE}, {WEEKDAYS} SELECT ts, coalesce({FILL.format('orders_count')}, {HEAD.format('orders_count')}) AS orders_count"
    " FROM cal LEFT JOIN macro USING (ts)",
)
def c7(spark, d):
    return align.reindex_ffill(_macro_wide(spark, d), views.weekdays(spark, d), ["orders_count"], backfill=True)


@query("c9_index_intersection", f"WITH {BARS}, {WEEKDAYS} SELECT symbol, ts, volume FROM bars WHERE ts IN (SELECT ts FROM cal)")
def c9(spark, d):
    return align.intersect_dates(views.bars_daily(spark, d), views.weekdays(spark, d)).select("symbol", "ts", "volume")


@query(
    "c10_assign_align",
    f"WITH {ASSETS_CTE} SELECT a.ts, {r6('ln(a.close)')} AS ECONOMY, {r6('ln(b.close)')} AS LARGE FROM"
    " (SELECT * FROM assets WHERE asset = 'ECONOMY') AS a LEFT JOIN (SELECT * FROM assets WHERE asset = 'LARGE') AS b ON b.ts = a.ts",
)
def c10(spark, d):
    out = align.assign_align(views.assets(spark, d), ["ECONOMY", "LARGE"], name="asset", value="close")
    return out.select("ts", *[rnd(F.ln(a)).alias(a) for a in ("ECONOMY", "LARGE")])


# -- aggregates --------------------------------------------------------------------------
@query(
    "d1_ohlcv_bars",
    f"WITH {BARS} SELECT symbol, ts, open, high, low, close, volume FROM bars",
)
def d1(spark, d):
    return views.bars_daily(spark, d)


@query(
    "d1_ohlcv_bars_hourly",
    "SELECT event_type AS symbol, date_trunc('hour', ts)::TIMESTAMP AS ts, first(value ORDER BY ts) AS open, max(value) AS high, min(value) AS low,"
    " last(value ORDER BY ts) AS close, CAST(count(*) AS DOUBLE) AS volume FROM events GROUP BY 1, 2",
)
def d1h(spark, d):
    return views.event_bars(spark, d, "hour")


@query(
    "d2_last_per_day",
    "SELECT event_type AS symbol, CAST(ts AS DATE) AS day, last(value ORDER BY ts) AS value FROM events WHERE value IS NOT NULL GROUP BY 1, 2",
)
def d2(spark, d):
    ev = views.event_ticks(spark, d).select("symbol", "ts", F.to_date("ts").alias("day"), F.col("price").alias("value"))
    return bars.last_per_day(ev, ["symbol", "day"], "ts", ["value"])


def _session_sql(extended: bool) -> str:
    def part(cond: str, tag: str) -> str:
        return (
            f"{tag} AS (SELECT event_type AS symbol, CAST(ts AS DATE) AS date, first(value ORDER BY ts) AS o, max(value) AS h, min(value) AS l,"
            f" last(value ORDER BY ts) AS c, CAST(count(*) AS DOUBLE) AS v FROM events WHERE {cond} GROUP BY 1, 2)"
        )

    ctes = [
        part("hour(ts) = 9 AND minute(ts) >= 30", "m"),
        part("hour(ts) BETWEEN 11 AND 16", "h"),
        part("hour(ts) = 9 AND minute(ts) < 30", "p"),
    ]
    high, low, vol, tail = "greatest(m.h, h.h)", "least(m.l, h.l)", "m.v + h.v", ""
    if extended:
        high, low = "greatest(m.h, h.h, coalesce(p.h, m.h))", "least(m.l, h.l, coalesce(p.l, m.l))"
        vol, tail = "m.v + h.v + coalesce(p.v, 0)", " LEFT JOIN p USING (symbol, date)"
    return (
        f"WITH {', '.join(ctes)} SELECT symbol, date, m.o AS open, {high} AS high, {low} AS low, h.c AS close, {vol} AS volume"
        f" FROM m JOIN h USING (symbol, date){tail}"
    )


def _session(spark, d, extended):
    minutes = views.event_bars(spark, d, "minute")
    # The minute bars serve both parts here: hour labels pick their own rows.
    return bars.session_bars(minutes, minutes, include_extended=extended)


@query("d3_rth_from_intraday", _session_sql(True))
def d3(spark, d):
    return _session(spark, d, True)


@query("d3_rth_regular_only", _session_sql(False))
def d3_regular(spark, d):
    return _session(spark, d, False)


@query("d4_daily_mean", f"SELECT CAST(ts AS DATE) AS date, {r6('avg(value)')} AS value FROM events GROUP BY 1")
def d4(spark, d):
    ev = views.table(spark, d, "events").select(F.to_date("ts").alias("date"), "value")
    return panel.daily_mean(ev, "value", ["date"]).withColumn("value", rnd("value"))


MONTHLY_CTE = (
    "last_px AS (SELECT asset, date_trunc('month', ts)::DATE AS month, last(close ORDER BY ts) AS close FROM assets GROUP BY 1, 2),"
    " monthly AS MATERIALIZED (SELECT asset, last_day(month) AS ts, close, close / lag(close) OVER (PARTITION BY asset ORDER BY month) - 1 AS change FROM last_px)"
)


@query(
    "d5_resample_month_last",
    f"WITH {ASSETS_CTE}, {MONTHLY_CTE} SELECT asset, ts, {r6('close')} AS close, {r6('change')} AS change FROM monthly",
)
def d5(spark, d):
    m = panel.month_last(views.assets(spark, d), ["asset"])
    return m.withColumns({"close": rnd("close"), "change": rnd("change")})


@query(
    "d6_seasonality",
    f"WITH {ASSETS_CTE}, {MONTHLY_CTE} SELECT asset, CAST(month(ts) AS INT) AS month, {r6('avg(change)')} AS mean_change FROM monthly GROUP BY 1, 2",
)
def d6(spark, d):
    s = panel.seasonality(panel.month_last(views.assets(spark, d), ["asset"]), ["asset"])
    return s.withColumn("mean_change", rnd("mean_change"))


@query(
    "d7_put_call_ratio",
    f"WITH {CHAIN_CTE} SELECT {r6(chr(39).join(['sum(volume) FILTER (cp = ', 'P', ') / sum(volume) FILTER (cp = ', 'C', ')']))} AS pcr_volume,"
    f" {r6(chr(39).join(['sum(oi) FILTER (cp = ', 'P', ') / sum(oi) FILTER (cp = ', 'C', ')']))} AS pcr_oi FROM chain",
)
def d7(spark, d):
    from barloom.plans import options

    r = options.put_call_ratio(views.chain(spark, d))
    return r.select(rnd("pcr_volume").alias("pcr_volume"), rnd("pcr_oi").alias("pcr_oi"))


@query(
    "d8_iv_skew",
    f"WITH {CHAIN_CTE} SELECT round(avg(p.iv - c.iv), 9) + 0.0 AS iv_skew FROM (SELECT * FROM chain WHERE cp = 'C') AS c"
    " JOIN (SELECT * FROM chain WHERE cp = 'P') AS p ON p.strike = c.strike",
)
def d8(spark, d):
    from barloom.plans import options

    return options.join_strikes(views.chain(spark, d)).agg(rnd(F.avg("skew"), 9).alias("iv_skew"))


NULLY = f"q AS (SELECT close / lag(close, 100) OVER o AS far, close / lag(close, 7) OVER o AS near, volume FROM bars WINDOW o AS (PARTITION BY symbol ORDER BY ts))"


@query(
    "d9_null_profile",
    f"WITH {BARS}, {NULLY} SELECT 'far' AS \"column\", round(100.0 * count(*) FILTER (far IS NULL) / count(*), 2) AS null_pct FROM q UNION ALL"
    " SELECT 'near', round(100.0 * count(*) FILTER (near IS NULL) / count(*), 2) FROM q UNION ALL SELECT 'volume', 0.0",
)
def d9(spark, d):
    w = Window.partitionBy("symbol").orderBy("ts")
    b = views.bars_daily(spark, d)
    cols = {n: cells.ratio("close", F.lag("close", k).over(w)).alias(n) for n, k in (("far", 100), ("near", 7))}
    return profile.null_profile(b.select(*cols.values(), "volume"))


CORR_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "d10_corr_matrix",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS corr FROM lineitem" for a in CORR_COLS for b in CORR_COLS),
)
def d10(spark, d):
    return panel.correlation_matrix(views.table(spark, d, "lineitem"), CORR_COLS).withColumn("corr", rnd("corr"))


@query(
    "d11_feature_target_corr",
    f"WITH {BARS}, q AS (SELECT high / low AS spread, volume, 1.0 AS flat, lag(volume) OVER o AS holed, close / open - 1 AS y FROM bars WINDOW o AS (PARTITION BY symbol ORDER BY ts))"
    f" SELECT 'spread' AS feature, {r6('corr(spread, y)')} AS corr FROM q UNION ALL SELECT 'volume', {r6('corr(volume, y)')} FROM q"
    " UNION ALL SELECT 'flat', 0.0 UNION ALL SELECT 'holed', NULL",
)
def d11(spark, d):
    w = Window.partitionBy("symbol").orderBy("ts")
    q = views.bars_daily(spark, d).select(
        cells.ratio("high", "low").alias("spread"),
        "volume",
        F.lit(1.0).alias("flat"),
        F.lag("volume").over(w).alias("holed"),
        (cells.ratio("close", "open") - 1).alias("y"),
    )
    return profile.feature_target_corr(q, ["spread", "volume", "flat", "holed"], "y").withColumn("corr", rnd("corr"))


PRUNED = {
    "net": "l_extendedprice * (1 - l_discount)",
    "shifted_lag1": "l_extendedprice + 30000 * sin(l_quantity)",
    "noisy": "l_extendedprice + 30000 * sin(l_quantity)",
    "count_lag1": "l_quantity",
    "flat": "1.0",
}


@query(
    "d12_prune_high_corr",
    "WITH c AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS feature, corr({x}, l_extendedprice) AS corr FROM lineitem" for n, x in PRUNED.items() if n != "flat")
    + f") SELECT feature, {r6('corr')} AS corr, abs(corr) > 0.85 OR NOT feature LIKE '%!_lag1' ESCAPE '!' AS dropped FROM c WHERE abs(corr) > 0.7",
)
def d12(spark, d):
    """Which features their correlation with the target would drop."""
    x = views.table(spark, d, "lineitem").select("l_extendedprice", *[F.expr(e).cast("double").alias(n) for n, e in PRUNED.items()])
    return profile.pruning(profile.feature_target_corr(x, list(PRUNED), "l_extendedprice"), 0.85, 0.7).withColumn("corr", rnd("corr"))


MANY = {f"x{k}": f"sin(l_quantity * {k + 1}) + l_discount * {k % 7}" for k in range(60)}


@query(
    "d10_corr_matrix_wide",
    "WITH x AS (SELECT " + ", ".join(f"CASE WHEN (l_quantity + {k}) % 11 < 10 THEN {e} END AS {n}" for k, (n, e) in enumerate(MANY.items()))
    + " FROM lineitem), c AS (SELECT "
    + ", ".join(f"corr({a}, {b}) AS {a}_{b}" for a in MANY for b in MANY if int(a[1:]) <= int(b[1:]))
    + " FROM x), u AS (UNPIVOT c ON * INTO NAME pair VALUE corr),"
    " s AS (SELECT split_part(pair, '_', 1) AS a, split_part(pair, '_', 2) AS b, corr FROM u)"
    f" SELECT a, b, {r6('corr')} AS corr FROM s UNION ALL SELECT b, a, {r6('corr')} FROM s WHERE a <> b",
)
def d10_wide(spark, d):
    """Sixty columns with holes, 3,600 cells."""
    x = views.table(spark, d, "lineitem").selectExpr(
        *[f"CASE WHEN (l_quantity + {k}) % 11 < 10 THEN {e} END AS {n}" for k, (n, e) in enumerate(MANY.items())]
    )
    return panel.correlation_matrix(x, list(MANY)).withColumn("corr", rnd("corr"))


@query(
    "d13_mse",
    f"WITH {BARS} SELECT symbol, round(avg(pow(ln(close) - ln(open), 2)), 6) AS mse FROM bars GROUP BY symbol",
)
def d13(spark, d):
    logs = views.bars_daily(spark, d).select("symbol", F.ln("close").alias("truth"), F.ln("open").alias("guess"))
    return panel.mse(logs, "truth", "guess", ["symbol"]).withColumn("mse", rnd("mse"))


@query(
    "d14_dataset_stats",
    f"WITH {BARS} SELECT count(*) AS n_rows, 7 AS n_columns, min(ts) AS first_date, max(ts) AS last_date FROM bars",
)
def d14(spark, d):
    return profile.dataset_stats(views.bars_daily(spark, d), "ts")


@query(
    "d15_train_std",
    f"WITH {BARS}, q AS (SELECT *, ln(close) - lag(ln(close)) OVER (PARTITION BY symbol ORDER BY ts) AS lr FROM bars)"
    f" SELECT symbol, {r6('stddev_samp(lr)')} AS train_std FROM q WHERE ts BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY symbol",
)
def d15(spark, d):
    w = Window.partitionBy("symbol").orderBy("ts")
    lr = views.bars_daily(spark, d).select("symbol", "ts", (F.ln("close") - F.lag(F.ln("close")).over(w)).alias("lr"))
    train = align.between_dates(lr, "1996-01-01", "1999-12-31")
    return train.groupBy("symbol").agg(rnd(F.stddev_samp("lr")).alias("train_std"))


RET_CTE = (
    "grid AS MATERIALIZED (SELECT d.ts, n.asset, a.close, a.volume FROM (SELECT DISTINCT ts FROM assets) AS d CROSS JOIN (SELECT unnest(['ALL', "
    + ", ".join(f"'{a}'" for a in views.ASSETS)
    + "]) AS asset) AS n LEFT JOIN assets AS a ON a.ts = d.ts AND a.asset = n.asset),"
    " padded AS (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY asset ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pad FROM grid),"
    " rets AS MATERIALIZED (SELECT *, pad / lag(pad) OVER (PARTITION BY asset ORDER BY ts) - 1 AS ret FROM padded)"
)


def _returns(spark, d):
    from barloom.plans import sector

    return sector.returns(panel.on_calendar(views.assets(spark, d), ALL_ASSETS))


BASKET = ("ECONOMY", "LARGE", "MEDIUM")
OTHER = ("PROMO", "SMALL", "STANDARD")


def _in(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


@query(
    "d16_basket_mean_row",
    f"WITH {ASSETS_CTE}, {RET_CTE} SELECT ts, {r6(f'avg(ret) FILTER (asset IN {_in(BASKET)})')} AS mean_ret FROM rets GROUP BY ts",
)
def d16(spark, d):
    return _returns(spark, d).groupBy("ts").agg(rnd(panel.basket_mean("ret", BASKET)).alias("mean_ret"))


@query(
    "d17_basket_sum_ratio",
    f"WITH {ASSETS_CTE}, q AS (SELECT ts, CASE WHEN count(*) FILTER (asset <> 'ALL') = 6 THEN sum(close) FILTER (asset IN {_in(BASKET)})"
    f" / sum(close) FILTER (asset IN {_in(OTHER)}) END AS x FROM assets GROUP BY ts)"
    f" SELECT ts, CASE WHEN count(x) OVER w = 20 THEN {r6('avg(x) OVER w')} END AS ratio20 FROM q WINDOW w AS (ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)",
)
def d17(spark, d):
    from barloom.plans import sector

    wide = views.assets(spark, d).groupBy("market", "ts").agg(
        cells.ratio(panel.basket_sum("close", BASKET), panel.basket_sum("close", OTHER)).alias("x")
    )
    out = sector.rolling_mean(wide, "x", 20, "ratio20")
    return out.select("ts", rnd("ratio20").alias("ratio20"))


@query(
    "d18_breadth_count",
    f"WITH {ASSETS_CTE}, {RET_CTE}, b AS (SELECT g.ts, g.asset, g.close / x.close AS rel FROM grid AS g LEFT JOIN grid AS x ON x.ts = g.ts AND x.asset = 'ALL'),"
    " f AS (SELECT *, last_value(rel IGNORE NULLS) OVER (PARTITION BY asset ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pad FROM b),"
    " u AS (SELECT ts, coalesce(pad / lag(pad, 60) OVER (PARTITION BY asset ORDER BY ts) - 1 > 0, false) AS up FROM f)"
    " SELECT ts, count(*) FILTER (up) AS breadth FROM u GROUP BY ts",
)
def d18(spark, d):
    grid = panel.on_calendar(views.assets(spark, d), ALL_ASSETS)
    return panel.breadth(grid, "ALL").select("ts", "breadth")


@query("d19_rowwise_max_min", f"WITH {BARS} SELECT symbol, ts, greatest(open, close, high) = high AS top, least(open, close, low) = low AS bottom FROM bars")
def d19(spark, d):
    b = views.bars_daily(spark, d)
    return b.select(
        "symbol",
        "ts",
        (cells.row_max("open", "close", "high") == F.col("high")).alias("top"),
        (cells.row_min("open", "close", "low") == F.col("low")).alias("bottom"),
    )


CROSS_CTE = (
    "k AS (SELECT ts, asset, ret FROM rets WHERE ret IS NOT NULL),"
    " pairs AS (SELECT a.ts, a.asset AS a, b.asset AS b, CASE WHEN count(*) OVER w = 60 THEN corr(a.ret, b.ret) OVER w END AS c"
    " FROM k AS a JOIN k AS b ON a.ts = b.ts WINDOW w AS (PARTITION BY a.asset, b.asset ORDER BY a.ts ROWS BETWEEN 59 PRECEDING AND CURRENT ROW))"
)


@query(
    "d20_avg_cross_corr",
    f"WITH {ASSETS_CTE}, {RET_CTE}, {CROSS_CTE} SELECT ts, {r6('avg(c)')} AS avg_corr FROM pairs GROUP BY ts",
)
def d20(spark, d):
    rets = align.drop_missing(_returns(spark, d), ["ret"])
    return panel.average_correlation(rets).select("ts", rnd("avg_corr").alias("avg_corr"))


HOLES = "asset = 'PROMO' AND month(ts) = 6 AND day(ts) = 13"
# Windows of sixty dates of the market, not of sixty rows of a pair.
GAPS_CTE = (
    f"k AS (SELECT ts, asset, ret, dense_rank() OVER (ORDER BY ts) AS pos FROM rets WHERE ret IS NOT NULL AND NOT ({HOLES})),"
    " pairs AS (SELECT a.ts, a.asset AS a, b.asset AS b, CASE WHEN count(*) OVER w = 60 THEN corr(a.ret, b.ret) OVER w END AS c"
    " FROM k AS a JOIN k AS b ON a.ts = b.ts WINDOW w AS (PARTITION BY a.asset, b.asset ORDER BY a.pos RANGE BETWEEN 59 PRECEDING AND CURRENT ROW))"
)


@query(
    "d20_avg_cross_corr_gaps",
    f"WITH {ASSETS_CTE}, {RET_CTE}, {GAPS_CTE} SELECT ts, {r6('avg(c)')} AS avg_corr FROM pairs GROUP BY ts",
)
def d20_gaps(spark, d):
    """A return missing inside one series, its row dropped: the other series' dates still meet."""
    rets = align.drop_missing(_returns(spark, d), ["ret"]).filter(f"NOT ({HOLES})")
    return panel.average_correlation(rets).select("ts", rnd("avg_corr").alias("avg_corr"))


# -- windows over panels -----------------------------------------------------------------
@query(
    "e3_ffill",
    f"WITH {ASSETS_CTE}, {RET_CTE} SELECT asset, ts, {r6('ln(pad)')} AS log_close FROM rets",
)
def e3(spark, d):
    grid = panel.on_calendar(views.assets(spark, d), ALL_ASSETS)
    return grid.select("asset", "ts", rnd(F.ln(align.ffill("close", ["asset"]))).alias("log_close"))


@query(
    "e34_vol_ratio",
    f"WITH {ASSETS_CTE}, {RET_CTE}, v AS (SELECT ts, asset, CASE WHEN count(ret) OVER w = 20 THEN stddev_samp(ret) OVER w END AS s FROM rets"
    " WINDOW w AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"
    f" SELECT ts, {r6(chr(39).join(['max(s) FILTER (asset = ', 'ECONOMY', ') / max(s) FILTER (asset = ', 'LARGE', ')']))} AS vol_ratio FROM v GROUP BY ts",
)
def e34(spark, d):
    from barloom.plans import sector

    vols = sector.asset_std(_returns(spark, d), 20)
    return vols.groupBy("ts").agg(rnd(cells.ratio(panel.pick("std", "ECONOMY"), panel.pick("std", "LARGE"))).alias("vol_ratio"))


@query(
    "e35_sector_growth",
    f"WITH {ASSETS_CTE}, {RET_CTE} SELECT asset, ts, CASE WHEN count(ret) OVER w = 60 THEN {r6('avg(ret) OVER w')} END AS growth FROM rets"
    " WINDOW w AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)",
)
def e35(spark, d):
    from barloom.plans import sector

    g = sector.rolling_mean(_returns(spark, d), "ret", 60, "growth", ("market", "asset"))
    return g.select("asset", "ts", rnd("growth").alias("growth"))


@query(
    "e41_target_next_return",
    f"WITH {BARS} SELECT * FROM (SELECT symbol, ts, {r6('lead(close) OVER (PARTITION BY symbol ORDER BY ts) / close - 1')} AS target FROM bars) AS q WHERE target IS NOT NULL",
)
def e41(spark, d):
    from barloom.plans import master

    out = master.next_return(views.bars_daily(spark, d), "close", "target", ["symbol"], "ts")
    return out.select("symbol", "ts", rnd("target").alias("target"))


@query(
    "e42_target_next_log_close",
    f"WITH {BARS} SELECT symbol, ts, {r6('lead(ln(close)) OVER (PARTITION BY symbol ORDER BY ts)')} AS y FROM bars",
)
def e42(spark, d):
    w = Window.partitionBy("symbol").orderBy("ts")
    return views.bars_daily(spark, d).select("symbol", "ts", rnd(F.lead(cells.ln_pos("close")).over(w)).alias("y"))


@query(
    "e43_release_lag",
    f"WITH {MACRO_CTE}, {WEEKDAYS}, f AS (SELECT ts, {FILL.format('orders_count')} AS orders_count FROM cal LEFT JOIN macro USING (ts))"
    " SELECT ts, lag(orders_count) OVER (ORDER BY ts) AS orders_count FROM f",
)
def e43(spark, d):
    filled = align.reindex_ffill(_macro_wide(spark, d), views.weekdays(spark, d), ["orders_count"])
    return align.release_lag(filled, ["orders_count"])


# -- sorting and sets --------------------------------------------------------------------
@query(
    "f1_top_n_per_day",
    "SELECT event_id, CAST(ts AS DATE) AS date FROM events QUALIFY row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id) <= 10",
)
def f1(spark, d):
    ev = views.table(spark, d, "events").select("event_id", "ts", F.to_date("ts").alias("date"))
    return align.top_n(ev, 10, ["date"], ["ts", "event_id"]).select("event_id", "date")


@query("f2_sort_by_date", f"WITH {BARS} SELECT ts, symbol, volume FROM bars ORDER BY ts, symbol")
def f2(spark, d):
    return views.bars_daily(spark, d).select("ts", "symbol", "volume").orderBy("ts", "symbol")


@query(
    "f3_top_k_missing",
    f"WITH {BARS}, {NULLY}, p AS (SELECT 'far' AS \"column\", round(100.0 * count(*) FILTER (far IS NULL) / count(*), 2) AS null_pct FROM q UNION ALL"
    " SELECT 'near', round(100.0 * count(*) FILTER (near IS NULL) / count(*), 2) FROM q) SELECT * FROM p ORDER BY null_pct DESC LIMIT 1",
)
def f3(spark, d):
    return profile.top_missing(d9(spark, d), 1)


@query("f4_latest_value", f"WITH {BARS} SELECT symbol, {r6('last(close ORDER BY ts)')} AS close FROM bars GROUP BY symbol")
def f4(spark, d):
    return panel.latest(views.bars_daily(spark, d), "close", ["symbol"]).withColumn("close", rnd("close"))


@query("g1_distinct_dates", "SELECT DISTINCT CAST(o_orderdate AS DATE) AS ts FROM orders")
def g1(spark, d):
    return align.calendar(_daily_orders(spark, d))


@query(
    "g2_intersect_dates",
    "SELECT CAST(o_orderdate AS DATE) AS ts FROM orders INTERSECT SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5",
)
def g2(spark, d):
    return _daily_orders(spark, d).select("ts").intersect(views.weekdays(spark, d))


# -- scalars -----------------------------------------------------------------------------
@query(
    "h1_safe_log",
    f"SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN {r6('ln(c_acctbal)')} END AS log_bal FROM customer",
)
def h1(spark, d):
    return views.table(spark, d, "customer").select("c_custkey", rnd(cells.ln_pos("c_acctbal")).alias("log_bal"))


@query(
    "h2_math",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(exp(l_discount), 6) AS e, round(sqrt(l_quantity), 6) AS s,"
    " abs(l_tax - l_discount) > 0.01 AS a, CAST(sign(l_tax - l_discount) AS DOUBLE) AS g, round(pow(l_tax, 2), 6) AS p FROM lineitem",
)
def h2(spark, d):
    li = views.table(spark, d, "lineitem")
    gap = F.col("l_tax") - F.col("l_discount")
    return li.select(
        *views.TICK_ORDER,
        rnd(F.exp("l_discount")).alias("e"),
        rnd(cells.root("l_quantity")).alias("s"),
        (F.abs(gap) > 0.01).alias("a"),
        F.signum(gap).alias("g"),
        rnd(F.pow("l_tax", F.lit(2.0))).alias("p"),
    )


@query(
    "h3_date_parts",
    "SELECT event_id, CAST(hour(ts) AS INT) AS h, CAST(minute(ts) AS INT) AS m, CAST(ts AS DATE) AS day, CAST(month(ts) AS INT) AS mo,"
    " CAST(hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS INT) AS ny_hour FROM events",
)
def h3(spark, d):
    ev = views.table(spark, d, "events")
    ny = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), "ts")
    return ev.select(
        "event_id", F.hour("ts").alias("h"), F.minute("ts").alias("m"), F.to_date("ts").alias("day"), F.month("ts").alias("mo"), F.hour(ny).alias("ny_hour")
    )


@query(
    "h4_headline_text",
    "SELECT p_partkey, coalesce(CASE WHEN p_size > 10 THEN p_name END, '') || '. ' || coalesce(p_type, '') AS text FROM part",
)
def h4(spark, d):
    p = views.table(spark, d, "part")
    title = F.when(F.col("p_size") > 10, F.col("p_name"))
    return p.select("p_partkey", cells.headline_text(title, "p_type").alias("text"))


@query(
    "h5_text_predicates",
    "SELECT p_partkey, lower(trim(p_type)) AS t, starts_with(p_name, 'red') AS s, ends_with(p_name, 'gear') AS e, contains(p_name, 'o') AS c FROM part",
)
def h5(spark, d):
    p = views.table(spark, d, "part")
    return p.select(
        "p_partkey",
        F.lower(F.trim("p_type")).alias("t"),
        F.startswith("p_name", F.lit("red")).alias("s"),
        F.endswith("p_name", F.lit("gear")).alias("e"),
        F.contains("p_name", F.lit("o")).alias("c"),
    )


@query(
    "h6_moneyness",
    f"WITH {CHAIN_CTE}, {BARS}, s AS (SELECT last(close ORDER BY ts) AS spot FROM bars WHERE symbol = 'A')"
    f" SELECT cp, strike, {r6('strike / spot')} AS moneyness FROM chain, s",
)
def h6(spark, d):
    from barloom.plans import options

    chain = views.chain(spark, d).withColumn("symbol", F.lit("A"))
    out = options.with_moneyness(chain, views.bars_daily(spark, d))
    return out.select("cp", "strike", rnd("moneyness").alias("moneyness"))


def _wide_assets(spark, d):
    return align.pivot_wide(views.assets(spark, d), ALL_ASSETS)


WIDE = f"WITH {ASSETS_CTE}, w AS (SELECT ts, " + ", ".join(f"max(close) FILTER (asset = '{a}') AS {a}" for a in ALL_ASSETS).replace(" AS ALL", ' AS "ALL"') + " FROM assets GROUP BY ts) "


@query(
    "h7_h10_spreads",
    WIDE
    + f"SELECT ts, {r6('ECONOMY - LARGE')} AS term_spread, {r6('MEDIUM / PROMO - 1')} AS credit_spread, {r6('SMALL - STANDARD')} AS vix_term_slope,"
    f" {r6('ECONOMY - SMALL')} AS hy_minus_ig, {r6('SMALL - ECONOMY')} AS risk_appetite FROM w",
)
def h7(spark, d):
    w = _wide_assets(spark, d)
    slope = market.vix_term_slope(w.columns, near="STANDARD", far="SMALL")
    return w.select(
        "ts",
        rnd(market.term_spread("ECONOMY", "LARGE")).alias("term_spread"),
        rnd(market.credit_spread("MEDIUM", "PROMO")).alias("credit_spread"),
        rnd(slope).alias("vix_term_slope"),
        rnd(market.hy_minus_ig("ECONOMY", "SMALL")).alias("hy_minus_ig"),
        rnd(market.risk_appetite("ECONOMY", "SMALL")).alias("risk_appetite"),
    )


@query(
    "h11_h12_strength_breadth",
    f"WITH {ASSETS_CTE}, {RET_CTE}, five AS (SELECT ts, asset, pad / lag(pad, 5) OVER (PARTITION BY asset ORDER BY ts) - 1 AS r5 FROM padded),"
    " w AS (SELECT ts, max(r5) FILTER (asset = 'SMALL') AS s, max(r5) FILTER (asset = 'LARGE') AS l, max(r5) FILTER (asset = 'ALL') AS a FROM five GROUP BY ts)"
    f" SELECT ts, {r6('0.5 * (-s) + 0.5 * l')} AS usd_strength, {r6('l - a')} AS breadth_proxy FROM w",
)
def h11(spark, d):
    from barloom.plans import sector

    r5 = sector.returns(panel.on_calendar(views.assets(spark, d), ALL_ASSETS), n=5)
    w = r5.groupBy("ts").agg(*[panel.pick("ret", a).alias(a) for a in ("SMALL", "LARGE", "ALL")])
    return w.select(
        "ts", rnd(market.usd_strength("SMALL", "LARGE")).alias("usd_strength"), rnd(market.breadth_proxy("LARGE", "ALL")).alias("breadth_proxy")
    )


@query(
    "h13_relative_strength",
    f"WITH {ASSETS_CTE} SELECT a.asset, a.ts, {r6('a.close / b.close')} AS rel FROM assets AS a LEFT JOIN (SELECT * FROM assets WHERE asset = 'ALL') AS b ON b.ts = a.ts",
)
def h13(spark, d):
    rel = panel.with_benchmark(views.assets(spark, d), "ALL")
    return rel.select("asset", "ts", rnd(market.relative_strength("close", "benchmark")).alias("rel"))


@query(
    "h14_growth_minus_def",
    f"WITH {ASSETS_CTE}, {RET_CTE} SELECT ts, {r6(f'avg(ret) FILTER (asset IN {_in(BASKET)}) - avg(ret) FILTER (asset IN {_in(OTHER)})')} AS spread FROM rets GROUP BY ts",
)
def h14(spark, d):
    spread = panel.basket_mean("ret", BASKET) - panel.basket_mean("ret", OTHER)
    return _returns(spark, d).groupBy("ts").agg(rnd(spread).alias("spread"))


@query(
    "h16_price_forecast",
    f"WITH {BARS} SELECT symbol, ts, {r6('close * exp(ln(close) - ln(open)) / close')} AS rel FROM bars",
)
def h16(spark, d):
    b = views.bars_daily(spark, d)
    return b.select("symbol", "ts", rnd(cells.ratio(market.price_forecast("close", F.ln("close") - F.ln("open")), "close")).alias("rel"))


@query("h17_date_to_string", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def h17(spark, d):
    return views.table(spark, d, "orders").select("o_orderkey", market.day_text("o_orderdate").alias("day"))


@query("h18_round", "SELECT s_suppkey, round(s_acctbal / 7, 2) + 0.0 AS r FROM supplier")
def h18(spark, d):
    return views.table(spark, d, "supplier").select("s_suppkey", rnd(F.col("s_acctbal") / 7, 2).alias("r"))
