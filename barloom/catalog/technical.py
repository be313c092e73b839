"""Queries on daily bars: single indicators (E) and packs (P1 to P6)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from barloom import views
from barloom.catalog.kit import (
    STEP_CTE,
    Show,
    as_is,
    bars_cte,
    full,
    over_bars,
    per_close,
    register,
    shown,
    shown_sql,
    windows,
)
from barloom.operators import rolling as r
from barloom.operators.stages import Stages
from barloom.plans import technical as packs

KEYS = ["symbol", "ts"]
MA, VOL = r.MA_WINDOWS, r.VOL_WINDOWS


def indicator(name: str, define, show: Show, sql_body: str, digits: int = 6, **how) -> None:
    """Register an indicator or pack on the daily bars of the three return flags."""
    parts = define if isinstance(define, (list, tuple)) else [define]

    def run(spark, sf_dir):
        return shown(packs.compute(views.bars_daily(spark, sf_dir), *parts, **how), KEYS, show, digits)

    register(name, run, shown_sql(sql_body, KEYS, show, digits))


# -- SQL text per indicator ----------------------------------------------------------------
def sql_pct(n: int) -> str:
    return f"close / lag(close, {n}) OVER o - 1"


SQL: dict[str, str] = {}

SQL["returns"] = "ret AS ret_1d, lr AS logret_1d"
SQL["roll_ret"] = ", ".join(
    f"{full('ret', n, f'product(1 + ret) OVER w{n} - 1')} AS roll_ret_{n}d" for n in (5, 10, 20)
)
SQL["sma"] = ", ".join(f"{full('close', n, f'avg(close) OVER w{n}')} AS SMA_{n}" for n in MA)
SQL["stoch_k"] = full("low", 14, "100.0 * (close - min(low) OVER w14) / nullif(max(high) OVER w14 - min(low) OVER w14, 0)")
SQL["bollinger"] = (
    f"{full('close', 20, 'avg(close) OVER w20')} AS BB_Middle_20,"
    f" {full('close', 20, 'avg(close) OVER w20 + 2 * stddev_pop(close) OVER w20')} AS BB_Upper_20_2,"
    f" {full('close', 20, 'avg(close) OVER w20 - 2 * stddev_pop(close) OVER w20')} AS BB_Lower_20_2,"
    f" {full('close', 20, '4 * stddev_pop(close) OVER w20 / avg(close) OVER w20')} AS BB_Width_20"
)
SQL["gap"] = "pc AS prev_Close, open - pc AS gap_abs, (open - pc) / pc AS gap_pct, ln(open) - ln(pc) AS gap_log"
SQL["decomposition"] = (
    "open / pc - 1 AS overnight_ret, ln(open) - ln(pc) AS overnight_logret, close / open - 1 AS intraday_ret,"
    " ln(close) - ln(open) AS intraday_logret, close / pc - 1 AS daily_ret, ln(close) - ln(pc) AS daily_logret"
)
GAP_FLAGS = (
    "CAST(coalesce(open <> pc, false) AS INT)::DOUBLE AS is_gap, CAST(coalesce(open > pc, false) AS INT)::DOUBLE AS is_gap_up,"
    " CAST(coalesce(open < pc, false) AS INT)::DOUBLE AS is_gap_down,"
    " CAST(coalesce((open > pc AND low <= pc) OR (open < pc AND high >= pc), false) AS INT)::DOUBLE AS gap_filled"
)
SQL["gap_flags"] = GAP_FLAGS
FLAG_CTE = f"g AS MATERIALIZED (SELECT *, {GAP_FLAGS} FROM t)"
SQL["gap_fill"] = ", ".join(
    f"sum(gap_filled * {den}) OVER w{n} / nullif(sum({den}) OVER w{n}, 0) AS p_fill_{tag}_{n}d"
    for n in (20, 60, 120, 252)
    for tag, den in (("any", "is_gap"), ("up", "is_gap_up"), ("down", "is_gap_down"))
)
# Shares, order statistics and positions look at the window's values as a list.
SQL["vol_pct"] = ", ".join(
    full("volume", n, f"len(list_filter(list(volume) OVER w{n}, lambda x: x <= volume)) / {n}.0") + f" AS vol_pct_{n}"
    for n in (20, 60, 252)
)
SQL["surge"] = ", ".join(
    f"{full('volume', n, f'avg(volume) OVER w{n}')} AS vol_avg_{n},"
    f" {full('volume', n, f'volume / avg(volume) OVER w{n}')} AS vol_ratio_{n},"
    f" {full('volume', n, f'quantile_cont(volume, 0.95) OVER w{n}')} AS vol_p95_{n},"
    f" CASE WHEN count(volume) OVER w{n} = {n} AND volume >= quantile_cont(volume, 0.95) OVER w{n} THEN 1.0 ELSE 0.0 END AS vol_gt_p95_{n},"
    f" {full('volume', n, f'(volume - avg(volume) OVER w{n}) / nullif(stddev_pop(volume) OVER w{n}, 0)')} AS vol_z_{n}"
    for n in (20, 60)
)
OBV_CTE = (
    "b AS MATERIALIZED (SELECT *, sum(coalesce(sign(dp), 0) * volume) OVER "
    "(PARTITION BY symbol ORDER BY ts ROWS UNBOUNDED PRECEDING) AS OBV FROM t)"
)
SQL["obv_z"] = full("OBV", 20, "(OBV - avg(OBV) OVER w20) / nullif(stddev_pop(OBV) OVER w20, 0)") + " AS OBV_z20"
DP_CTE = "d AS MATERIALIZED (SELECT *, lag(dp) OVER (PARTITION BY symbol ORDER BY ts) AS dp1 FROM t)"
SQL["roll"] = (
    f"{full('dp1', 20, '2 * sqrt(greatest(-covar_samp(dp, dp1) OVER w20, 0))')} AS roll_spread_abs_20,"
    f" {full('dp1', 20, '2 * sqrt(greatest(-covar_samp(dp, dp1) OVER w20, 0)) / close')} AS roll_spread_pct_20"
)
SQL["hl"] = "(high - low) / close AS HL_rel_range, ln(high) - ln(low) AS HL_log_range"
ILLIQ_CTE = "i AS MATERIALIZED (SELECT *, abs(ret) / (close * volume) AS illiq FROM t)"
SQL["amihud"] = (
    f"{full('illiq', 20, 'avg(illiq) OVER w20')} AS amihud_illiq_mean_20,"
    f" {full('illiq', 20, 'quantile_cont(illiq, 0.5) OVER w20')} AS amihud_illiq_median_20"
)
SQL["momentum"] = ", ".join(f"{sql_pct(n)} AS mom_{n}d" for n in range(1, 21))
SQL["since"] = ", ".join(
    full(x, n, f"{n} - list_position(list({x}) OVER w{n}, {agg}({x}) OVER w{n})") + f"::DOUBLE AS days_since_{x}_{n}d"
    for n in (20, 60, 120, 252)
    for x, agg in (("high", "max"), ("low", "min"))
)
SQL["since"] = SQL["since"].replace(" END::DOUBLE", " END")
SQL["zret"] = ", ".join(
    f"{full('lr', n, f'(lr - avg(lr) OVER w{n}) / nullif(stddev_pop(lr) OVER w{n}, 0)')} AS zret_{n}d" for n in (5, 20, 60)
)
LR_CTE = "a AS MATERIALIZED (SELECT *, lag(lr) OVER (PARTITION BY symbol ORDER BY ts) AS lr1 FROM t)"
SQL["autocorr"] = ", ".join(
    full("lr", n, f"corr(lr, lr1) OVER w{n - 1}") + f" AS autocorr_ret_lag1_{n}d" for n in (20, 60, 120)
)
ANN = repr(math.sqrt(252.0))
SQL["realized"] = ", ".join(f"{full('lr', n, f'{ANN} * stddev_pop(lr) OVER w{n}')} AS RealizedVol_{n}d_ann" for n in VOL)


def _range_sql(label: str, daily: str) -> str:
    def one(n: int) -> str:
        mean = f"252.0 * avg({daily}) OVER w{n}"
        return full("close", n, f"CASE WHEN {mean} >= 0 THEN sqrt(greatest({mean}, 0)) END") + f" AS {label}_{n}d_ann"

    return ", ".join(one(n) for n in VOL)


SQL["parkinson"] = _range_sql("ParkinsonVol", "pow(ln(high / low), 2) / (4 * ln(2.0))")
SQL["garman"] = _range_sql("GarmanKlassVol", "0.5 * pow(ln(high / low), 2) - (2 * ln(2.0) - 1) * pow(ln(close / open), 2)")
SQL["rogers"] = _range_sql(
    "RogersSatchellVol", "ln(high / close) * ln(high / open) + ln(low / close) * ln(low / open)"
)
SQL["range"] = "high - low AS Range_abs, (high - low) / close AS Range_rel_close, ln(high) - ln(low) AS Range_log"
SQL["shape"] = ", ".join(
    f"{full('lr', n, f'skewness(lr) OVER w{n}')} AS RealizedSkew_{n}d,"
    f" {full('lr', n, f'kurtosis(lr) OVER w{n}')} AS RealizedKurtExcess_{n}d"
    for n in (20, 60, 120)
)


def _ema_sql(columns: Sequence[str]) -> str:
    """Recursive CTE ``e`` with the asked-for recursive averages, one row per bar."""
    alphas = {f"e{n}": 2.0 / (n + 1) for n in (*MA, 12, 26)}
    steps = {c: ("close", f"e.{c} + {a!r} * (n.close - e.{c})") for c, a in alphas.items()}
    line = f"((e.e12 + {alphas['e12']!r} * (n.close - e.e12)) - (e.e26 + {alphas['e26']!r} * (n.close - e.e26)))"
    steps["sig"] = ("0.0", f"CASE WHEN n.rn <= 26 THEN {line} ELSE e.sig + 0.2 * ({line} - e.sig) END")
    w = "(1.0 / 14)"
    up, down = "greatest(n.dp, 0.0)", "greatest(-n.dp, 0.0)"
    steps["au"] = ("0.0", f"CASE WHEN n.rn = 2 THEN {up} ELSE e.au + {w} * ({up} - e.au) END")
    steps["ad"] = ("0.0", f"CASE WHEN n.rn = 2 THEN {down} ELSE e.ad + {w} * ({down} - e.ad) END")
    tr = "greatest(n.high - n.low, abs(n.high - n.pc), abs(n.low - n.pc))"
    steps["atr"] = ("high - low", f"e.atr + {w} * ({tr} - e.atr)")
    names = list(columns)
    first = ", ".join(f"CAST({steps[c][0]} AS DOUBLE) AS {c}" for c in names)
    after = ", ".join(f"{steps[c][1]} AS {c}" for c in names)
    return (
        f"e AS (SELECT symbol, ts, rn, {first} FROM t WHERE rn = 1 UNION ALL"
        f" SELECT n.symbol, n.ts, n.rn, {after} FROM e JOIN t AS n ON n.symbol = e.symbol AND n.rn = e.rn + 1)"
    )


EMA_COLS = [f"e{n}" for n in MA]
SQL["ema"] = ", ".join(f"CASE WHEN rn >= {n} THEN e{n} END AS EMA_{n}" for n in MA)
SQL["macd"] = (
    "CASE WHEN rn >= 26 THEN e12 - e26 END AS MACD_line, CASE WHEN rn >= 59 THEN sig END AS MACD_signal,"
    " CASE WHEN rn >= 59 THEN e12 - e26 - sig END AS MACD_hist"
)
SQL["rsi"] = "CASE WHEN rn >= 15 AND ad > 0 THEN 100 - 100 / (1 + au / ad) END AS RSI_14"
SQL["atr"] = "CASE WHEN rn >= 14 THEN atr END AS ATR_14"
SQL["dist"] = ", ".join(
    f"{full('close', n, f'close / avg(close) OVER w{n} - 1')} AS dist_sma_{n}d,"
    f" CASE WHEN rn >= {n} THEN close / e{n} - 1 END AS dist_ema_{n}d"
    for n in MA
)


def recursive_body(columns: Sequence[str], select: str, *ctes: str, source: str = "j") -> str:
    joined = f"j AS MATERIALIZED (SELECT t.*, {', '.join(f'e.{c}' for c in columns)} FROM t JOIN e USING (symbol, rn))"
    more = "".join(f", {c}" for c in ctes)
    body = windows(f"SELECT *, {select} FROM {source}")
    return f"WITH RECURSIVE {bars_cte()}, {STEP_CTE}, {_ema_sql(columns)}, {joined}{more} {body}"


STOCH_CTE = windows(f"SELECT *, {SQL['stoch_k']} AS k FROM j")
STOCH = f'k AS "Stoch_%K_14", {full("k", 3, "avg(k) OVER w3")} AS "Stoch_%D_3"'

# -- output columns ----------------------------------------------------------------------
SHOW: dict[str, Show] = {
    "returns": as_is("ret_1d", "logret_1d"),
    "roll_ret": as_is(*[f"roll_ret_{n}d" for n in (5, 10, 20)]),
    "sma": per_close(*[f"SMA_{n}" for n in MA]),
    "ema": per_close(*[f"EMA_{n}" for n in MA]),
    "macd": per_close("MACD_line", "MACD_signal", "MACD_hist"),
    "rsi": as_is("RSI_14"),
    "stoch": as_is("Stoch_%K_14", "Stoch_%D_3"),
    "bollinger": {**per_close("BB_Middle_20", "BB_Upper_20_2", "BB_Lower_20_2"), **as_is("BB_Width_20")},
    "atr": per_close("ATR_14"),
    "gap": {**per_close("prev_Close", "gap_abs"), **as_is("gap_pct", "gap_log")},
    "decomposition": as_is(*[f"{d}_{k}" for d in ("overnight", "intraday", "daily") for k in ("ret", "logret")]),
    "gap_flags": as_is("is_gap", "is_gap_up", "is_gap_down", "gap_filled"),
    "gap_fill": as_is(*[f"p_fill_{t}_{n}d" for n in (20, 60, 120, 252) for t in ("any", "up", "down")]),
    "vol_pct": as_is(*[f"vol_pct_{n}" for n in (20, 60, 252)]),
    "obv": as_is("OBV", "OBV_z20"),
    "surge": as_is(*[f"vol_{k}_{n}" for n in (20, 60) for k in ("avg", "ratio", "p95", "gt_p95", "z")]),
    "roll": {**per_close("roll_spread_abs_20"), **as_is("roll_spread_pct_20")},
    "hl": as_is("HL_rel_range", "HL_log_range"),
    "amihud": {c: f"`{c}` * 1e6" for c in ("amihud_illiq_mean_20", "amihud_illiq_median_20")},
    "momentum": as_is(*[f"mom_{n}d" for n in range(1, 21)]),
    "since": as_is(*[f"days_since_{x}_{n}d" for n in (20, 60, 120, 252) for x in ("high", "low")]),
    "dist": as_is(*[f"dist_{k}_{n}d" for n in MA for k in ("sma", "ema")]),
    "zret": as_is(*[f"zret_{n}d" for n in (5, 20, 60)]),
    "autocorr": as_is(*[f"autocorr_ret_lag1_{n}d" for n in (20, 60, 120)]),
    "realized": as_is(*[f"RealizedVol_{n}d_ann" for n in VOL]),
    "parkinson": as_is(*[f"ParkinsonVol_{n}d_ann" for n in VOL]),
    "garman": as_is(*[f"GarmanKlassVol_{n}d_ann" for n in VOL]),
    "rogers": as_is(*[f"RogersSatchellVol_{n}d_ann" for n in VOL]),
    "range": {**per_close("Range_abs"), **as_is("Range_rel_close", "Range_log")},
    "shape": as_is(*[f"Realized{k}_{n}d" for n in (20, 60, 120) for k in ("Skew", "KurtExcess")]),
}


def _shows(*names: str) -> Show:
    return {k: v for n in names for k, v in SHOW[n].items()}


def _sqls(*names: str) -> str:
    return ", ".join(SQL[n] for n in names)


# -- single indicators -------------------------------------------------------------------
def _changes(b: Stages) -> None:
    for n in (1, 5):
        before = b.lag("close", n)
        b.out(b.col(f"diff_{n}", f"close - {before}", "close", before))
    b.out(b.col("prev", b.lag("close"), "_lag_close_1"))
    nxt = b.win("_next", "lead(close)", b.lane.rows, "close")
    b.out(b.col("next", nxt, nxt))


indicator(
    "e1_lag_lead_diff",
    _changes,
    per_close("diff_1", "diff_5", "prev", "next"),
    over_bars(
        "close - lag(close, 1) OVER o AS diff_1, close - lag(close, 5) OVER o AS diff_5,"
        " lag(close) OVER o AS prev, lead(close) OVER o AS next"
    ),
)


def _pct(b: Stages) -> None:
    for n in (1, 5, 20, 60):
        b.out(r.pct_change(b, "close", n, f"pct_{n}"))


indicator(
    "e2_pct_change",
    _pct,
    as_is("pct_1", "pct_5", "pct_20", "pct_60"),
    over_bars(", ".join(f"{sql_pct(n)} AS pct_{n}" for n in (1, 5, 20, 60))),
)
indicator("e4_rolling_return", r.rolling_return, SHOW["roll_ret"], over_bars(SQL["roll_ret"]))
indicator("e5_sma", r.sma, SHOW["sma"], over_bars(SQL["sma"]))
indicator("e6_ema", r.emas, SHOW["ema"], recursive_body(EMA_COLS, SQL["ema"]))
indicator("e7_macd", r.macd, SHOW["macd"], recursive_body(["e12", "e26", "sig"], SQL["macd"]))
indicator("e8_rsi", r.rsi, SHOW["rsi"], recursive_body(["au", "ad"], SQL["rsi"]))
indicator(
    "e9_stochastic",
    r.stochastic,
    SHOW["stoch"],
    over_bars(STOCH, f"s AS MATERIALIZED ({STOCH_CTE.replace('FROM j', 'FROM t')})", source="s"),
)
indicator("e10_bollinger", r.bollinger, SHOW["bollinger"], over_bars(SQL["bollinger"]))
indicator("e11_atr", r.atr, SHOW["atr"], recursive_body(["atr"], SQL["atr"]))
indicator("e12_gap_measures", r.gap_measures, SHOW["gap"], over_bars(SQL["gap"]))
indicator("e13_return_decomposition", r.return_decomposition, SHOW["decomposition"], over_bars(SQL["decomposition"]))
indicator("e14_gap_flags", r.gap_flags, SHOW["gap_flags"], over_bars(SQL["gap_flags"]))
indicator("e15_gap_fill_prob", r.gap_fill_probability, SHOW["gap_fill"], over_bars(SQL["gap_fill"], FLAG_CTE, source="g"))
indicator("e16_volume_percentile", r.volume_percentile, SHOW["vol_pct"], over_bars(SQL["vol_pct"]))
indicator("e17_obv", r.obv, SHOW["obv"], over_bars(SQL["obv_z"], OBV_CTE, source="b"))
indicator("e18_volume_surge", r.volume_surge, SHOW["surge"], over_bars(SQL["surge"]))
indicator("e19_roll_spread", r.roll_spread, SHOW["roll"], over_bars(SQL["roll"], DP_CTE, source="d"))
indicator("e20_hl_range", r.hl_range, SHOW["hl"], over_bars(SQL["hl"]))
indicator("e21_amihud", r.amihud, SHOW["amihud"], over_bars(SQL["amihud"], ILLIQ_CTE, source="i"))
indicator("e22_momentum", r.momentum, SHOW["momentum"], over_bars(SQL["momentum"]))
indicator("e23_days_since_extreme", r.days_since_extreme, SHOW["since"], over_bars(SQL["since"]))
indicator("e24_dist_from_ma", r.distance_from_ma, SHOW["dist"], recursive_body(EMA_COLS, SQL["dist"]))
indicator("e25_zscore_returns", r.zscore_returns, SHOW["zret"], over_bars(SQL["zret"]))
indicator("e26_autocorr", r.autocorr, SHOW["autocorr"], over_bars(SQL["autocorr"], LR_CTE, source="a"))
indicator("e27_realized_vol", r.realized_vol, SHOW["realized"], over_bars(SQL["realized"]))
indicator("e28_parkinson_vol", r.parkinson_vol, SHOW["parkinson"], over_bars(SQL["parkinson"]))
indicator("e29_garman_klass_vol", r.garman_klass_vol, SHOW["garman"], over_bars(SQL["garman"]))
indicator("e30_rogers_satchell_vol", r.rogers_satchell_vol, SHOW["rogers"], over_bars(SQL["rogers"]))
indicator("e31_intraday_range", r.intraday_range, SHOW["range"], over_bars(SQL["range"]))
indicator("e32_realized_skew_kurt", r.skew_kurt, SHOW["shape"], over_bars(SQL["shape"]))
indicator(
    "e33_realized_vol_simple",
    r.realized_vol_simple,
    as_is("realized_vol"),
    over_bars(f"{full('ret', 21, f'stddev_samp(ret) OVER w21 * {ANN}')} AS realized_vol"),
)


def _z252(b: Stages) -> None:
    ret = r.pct_change(b, "close", 1, "ret_1d")
    b.out(r.rolling_zscore(b, "close", 252, "z_close"), r.rolling_zscore(b, ret, 252, "z_ret"))


indicator(
    "e36_rolling_zscore",
    _z252,
    as_is("z_close", "z_ret"),
    over_bars(
        ", ".join(
            f"{full(x, 252, f'({x} - avg({x}) OVER w252) / nullif(stddev_samp({x}) OVER w252, 0)')} AS {n}"
            for x, n in (("close", "z_close"), ("ret", "z_ret"))
        )
    ),
)


def _flows(b: Stages) -> None:
    b.out(r.rolling_zscore(b, "volume", 20, "flow_vol_z20"))
    money = b.col("_money", "close * volume", "close", "volume")
    b.out(r.pct_change(b, money, 5, "flow_money_proxy5"))


FLOW_SQL = (
    f"{full('volume', 20, '(volume - avg(volume) OVER w20) / nullif(stddev_samp(volume) OVER w20, 0)')} AS flow_vol_z20,"
    " close * volume / lag(close * volume, 5) OVER o - 1 AS flow_money_proxy5"
)
indicator("e37_flow_zscore", _flows, as_is("flow_vol_z20"), over_bars(FLOW_SQL))
indicator("e38_flow_money", _flows, as_is("flow_money_proxy5"), over_bars(FLOW_SQL))


def _log_returns(b: Stages) -> None:
    for n in (1, 5):
        b.out(r.log_return(b, "close", n, f"Ret{n}"))


indicator(
    "e39_log_return",
    _log_returns,
    as_is("Ret1", "Ret5"),
    over_bars("lr AS Ret1, ln(close) - lag(ln(close), 5) OVER o AS Ret5"),
)


def _vol10(b: Stages) -> None:
    std = b.std_samp(r.log_return(b, "close", 1, "Ret1"), 10)
    b.out(b.col("Vol10", std, std))


indicator("e40_vol10", _vol10, as_is("Vol10"), over_bars(f"{full('lr', 10, 'stddev_samp(lr) OVER w10')} AS Vol10"))

# -- packs -------------------------------------------------------------------------------
P1 = ("returns", "roll_ret", "sma", "ema", "macd", "rsi", "stoch", "bollinger", "atr")
P1_COLS = [*EMA_COLS, "e12", "e26", "sig", "au", "ad", "atr"]
P1_SQL = _sqls(*[n for n in P1 if n not in ("stoch", "atr")]) + f", {STOCH}, CASE WHEN rn >= 14 THEN atr END AS ATR_14"
S_CTE = f"s AS MATERIALIZED ({STOCH_CTE})"
P1_BODY = recursive_body(P1_COLS, P1_SQL, S_CTE, source="s")
indicator("p1_basic_indicators", packs.basic_indicators, _shows(*P1), P1_BODY)

P2 = ("gap", "decomposition", "gap_flags", "gap_fill")
P2_SQL = _sqls("gap", "decomposition", "gap_fill")
indicator("p2_gaps_overnight", packs.gaps_overnight, _shows(*P2), over_bars(P2_SQL, FLAG_CTE, source="g"))

P3 = ("vol_pct", "obv", "surge", "roll", "hl", "amihud")
P3_CTES = (
    DP_CTE.replace("SELECT *,", "SELECT *, abs(ret) / (close * volume) AS illiq,"),
    OBV_CTE.replace("FROM t", "FROM d"),
)
P3_SQL = _sqls("vol_pct", "obv_z", "surge", "roll", "hl", "amihud")
indicator("p3_liquidity_pressure", packs.liquidity_pressure, _shows(*P3), over_bars(P3_SQL, *P3_CTES, source="b"))

P4 = ("returns", "momentum", "since", "dist", "zret", "autocorr")
P4_CTE = LR_CTE.replace("FROM t", "FROM j")
indicator("p4_trend_meanrev", packs.trend_meanrev, _shows(*P4), recursive_body(EMA_COLS, _sqls(*P4), P4_CTE, source="a"))

P5 = ("realized", "parkinson", "garman", "rogers", "range", "shape")
indicator("p5_volatility", packs.volatility, _shows(*P5), over_bars(_sqls(*P5)))

# One frame with everything: the packs' SQL side by side on the shared steps.
P6 = tuple(dict.fromkeys((*P1, *P2, *P3, *P4, *P5)))
P6_CTES = (
    S_CTE,
    f"g AS MATERIALIZED (SELECT *, {GAP_FLAGS} FROM s)",
    LR_CTE.replace("FROM t", "FROM g"),
    P3_CTES[0].replace("FROM t", "FROM a"),
    P3_CTES[1],
)
P6_SQL = ", ".join([P1_SQL, P2_SQL, P3_SQL, _sqls("momentum", "since", "dist", "zret", "autocorr"), _sqls(*P5)])
P6_BODY = recursive_body(P1_COLS, P6_SQL, *P6_CTES, source="b")
indicator("p6_all_features", list(packs.PACKS.values()), _shows(*P6), P6_BODY)

# The tiled layout must give the same rows, on tiles small enough that every symbol is cut. The averages reach
# back further than any halo here: their state is carried from tile to tile.
indicator(
    "e6_ema_tiled",
    r.emas,
    SHOW["ema"],
    recursive_body(EMA_COLS, SQL["ema"]),
    layout="tiled",
    tile_rows=150,
    halo_rows=20,
    bucket="month",
)
indicator(
    "p1_basic_indicators_tiled",
    packs.basic_indicators,
    _shows(*P1),
    P1_BODY,
    layout="tiled",
    tile_rows=450,
    bucket="month",
)
indicator(
    "p5_volatility_tiled",
    packs.volatility,
    _shows(*P5),
    over_bars(_sqls(*P5)),
    layout="tiled",
    tile_rows=600,
    halo_rows=300,
    bucket="month",
)
indicator(
    "e17_obv_tiled",
    r.obv,
    SHOW["obv"],
    over_bars(SQL["obv_z"], OBV_CTE, source="b"),
    layout="tiled",
    tile_rows=500,
    halo_rows=60,
    bucket="month",
)
