"""Regime queries with given parameters, checked by recursive SQL over every row (K6 to K10)."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from barloom import views
from barloom.catalog.basics import rnd
from barloom.catalog.kit import STEP_CTE, bars_cte, full, query, windows
from barloom.operators import rolling as r
from barloom.plans import regimes, technical
from barloom.session import settle

GIVEN = regimes.Regimes(
    ("Ret1", "Vol10"),
    np.array([0.6, 0.4]),
    np.array([[0.85, 0.15], [0.3, 0.7]]),
    np.array([[0.05, 1.2], [-0.1, 2.0]]),
    np.array([[1.5, 0.3], [5.0, 0.6]]),
)
# Blocks far shorter than the series, so that the scan over blocks decides the rows.
BLOCK_ROWS = 600
TRAIN_STD = 0.015


def _log_density(k: int) -> str:
    terms = [f"({x} - {m!r}) * ({x} - {m!r}) / {v!r}" for x, m, v in zip("xy", GIVEN.mean[k].tolist(), GIVEN.var[k].tolist())]
    const = float(np.log(2 * np.pi * GIVEN.var[k]).sum())
    return f"-0.5 * ({const!r} + {' + '.join(terms)})"


def _cell(i: int, j: int) -> str:
    return repr(float(GIVEN.move[i, j]))


VOL = full("lr", 10, "stddev_samp(lr) OVER w10")
OBSERVED = (
    f"WITH RECURSIVE {bars_cte()}, {STEP_CTE}, v AS MATERIALIZED ({windows(f'SELECT symbol, ts, close, lr AS x, {VOL} AS y FROM t')}),"
    f" l AS (SELECT *, {_log_density(0)} AS l0, {_log_density(1)} AS l1 FROM v WHERE x IS NOT NULL AND y IS NOT NULL),"
    " o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS k, exp(l0 - greatest(l0, l1)) AS d0, exp(l1 - greatest(l0, l1)) AS d1 FROM l)"
)
START = [repr(float(x)) for x in GIVEN.start]
FORWARD = (
    f"f AS (SELECT symbol, k, {START[0]} * d0 / ({START[0]} * d0 + {START[1]} * d1) AS a0, {START[1]} * d1 / ({START[0]} * d0 + {START[1]} * d1) AS a1,"
    f" {START[0]} * d0 + {START[1]} * d1 AS c FROM o WHERE k = 1 UNION ALL"
    " SELECT symbol, k, u0 / (u0 + u1), u1 / (u0 + u1), u0 + u1 FROM (SELECT o.symbol, o.k,"
    f" (f.a0 * {_cell(0, 0)} + f.a1 * {_cell(1, 0)}) * d0 AS u0, (f.a0 * {_cell(0, 1)} + f.a1 * {_cell(1, 1)}) * d1 AS u1"
    " FROM f JOIN o ON o.symbol = f.symbol AND o.k = f.k + 1) AS u)"
)
# w: what follows a row, weighted by the next row's densities; the last row has nothing after it.
BACKWARD = (
    "e AS MATERIALIZED (SELECT o.*, f.a0, f.a1, f.c, count(*) OVER (PARTITION BY o.symbol) AS n FROM o JOIN f USING (symbol, k)),"
    " b AS (SELECT symbol, k, 1.0::DOUBLE AS b0, 1.0::DOUBLE AS b1, d0 / c AS w0, d1 / c AS w1 FROM e WHERE k = n UNION ALL"
    " SELECT symbol, k, g0, g1, d0 * g0 / c, d1 * g1 / c FROM (SELECT e.symbol, e.k, e.d0, e.d1, e.c,"
    f" {_cell(0, 0)} * b.w0 + {_cell(0, 1)} * b.w1 AS g0, {_cell(1, 0)} * b.w0 + {_cell(1, 1)} * b.w1 AS g1"
    " FROM b JOIN e ON e.symbol = b.symbol AND e.k = b.k - 1) AS s)"
)


def _inputs(spark, d):
    def define(b):
        ret = r.log_return(b, "close", 1, "Ret1")
        std = b.std_samp(ret, 10)
        b.out(ret, b.col("Vol10", std, std))

    return technical.compute(views.bars_daily(spark, d), define).select("symbol", "ts", "close", "Ret1", "Vol10")


@query(
    "k7_regime_filter_given",
    f"{OBSERVED}, {FORWARD} SELECT symbol, ts, round(a0, 6) AS hmm_state_0, round(a1, 6) AS hmm_state_1 FROM o JOIN f USING (symbol, k)",
)
def k7_filter(spark, d):
    probs = regimes.probabilities(_inputs(spark, d), GIVEN, "filter", block_rows=BLOCK_ROWS)
    return probs.select("symbol", "ts", *[rnd(c).alias(c) for c in ("hmm_state_0", "hmm_state_1")])


@query(
    "k7_regime_smooth_given",
    f"{OBSERVED}, {FORWARD}, {BACKWARD} SELECT symbol, ts, round(a0 * b0 / (a0 * b0 + a1 * b1), 6) AS hmm_state_0,"
    " round(a1 * b1 / (a0 * b0 + a1 * b1), 6) AS hmm_state_1 FROM e JOIN b USING (symbol, k)",
)
def k7_smooth(spark, d):
    probs = regimes.probabilities(_inputs(spark, d), GIVEN, "smooth", block_rows=BLOCK_ROWS)
    return probs.select("symbol", "ts", *[rnd(c).alias(c) for c in ("hmm_state_0", "hmm_state_1")])


def _moments(k: int) -> str:
    g = f"a{k} * b{k}"
    out = f"SELECT {k} AS state, sum({g}) FILTER (k = 1) AS first, sum(m{k}0) AS m0, sum(m{k}1) AS m1, sum({g}) AS w,"
    return out + f" sum({g} * x) AS x1, sum({g} * y) AS y1, sum({g} * x * x) AS x2, sum({g} * y * y) AS y2, sum(ln(c) + greatest(l0, l1)) AS ll FROM g"


@query(
    "k6_em_step",
    f"{OBSERVED}, {FORWARD}, {BACKWARD}, j AS (SELECT e.*, b0, b1, lead(w0) OVER q AS v0, lead(w1) OVER q AS v1 FROM e JOIN b USING (symbol, k)"
    " WINDOW q AS (PARTITION BY symbol ORDER BY k)),"
    f" g AS (SELECT *, {', '.join(f'a{i} * {_cell(i, j)} * v{j} AS m{i}{j}' for i in (0, 1) for j in (0, 1))} FROM j),"
    f" s AS ({_moments(0)} UNION ALL {_moments(1)})"
    " SELECT state, round(first / sum(first) OVER (), 6) AS start, round(m0 / (m0 + m1), 6) AS to_0, round(m1 / (m0 + m1), 6) AS to_1,"
    " round(x1 / w, 6) AS mean_ret, round(y1 / w, 6) AS mean_vol, round(x2 / w - pow(x1 / w, 2), 6) AS var_ret,"
    " round(y2 / w - pow(y1 / w, 2), 6) AS var_vol, round(ll / 1000, 6) AS kilo_likelihood FROM s",
)
def k6_step(spark, d):
    """Parameters after one step of EM from given ones, and the likelihood of those."""
    packed = settle(regimes.pack(_inputs(spark, d), GIVEN.inputs, block_rows=BLOCK_ROWS))
    m, likelihood = regimes.em_step(packed, GIVEN)
    cells = [
        (k, float(m.start[k]), *m.move[k].tolist(), *[float(x) for x in (*m.mean[k], *m.var[k])], likelihood / 1000) for k in range(m.states)
    ]
    names = ("start", "to_0", "to_1", "mean_ret", "mean_vol", "var_ret", "var_vol", "kilo_likelihood")
    out = spark.createDataFrame(cells, "state int, " + ", ".join(f"{c} double" for c in names))
    return out.select("state", *[rnd(c).alias(c) for c in names])


LOGS = [[repr(math.log(float(GIVEN.move[i, j]))) for j in (0, 1)] for i in (0, 1)]
BEST = (
    f"p AS (SELECT symbol, k, {math.log(float(GIVEN.start[0]))!r} + l0 AS s0, {math.log(float(GIVEN.start[1]))!r} + l1 AS s1, -1 AS q0, -1 AS q1 FROM o WHERE k = 1 UNION ALL"
    f" SELECT o.symbol, o.k, greatest(s0 + {LOGS[0][0]}, s1 + {LOGS[1][0]}) + l0, greatest(s0 + {LOGS[0][1]}, s1 + {LOGS[1][1]}) + l1,"
    f" CASE WHEN s1 + {LOGS[1][0]} > s0 + {LOGS[0][0]} THEN 1 ELSE 0 END, CASE WHEN s1 + {LOGS[1][1]} > s0 + {LOGS[0][1]} THEN 1 ELSE 0 END"
    " FROM p JOIN o ON o.symbol = p.symbol AND o.k = p.k + 1),"
    " e AS MATERIALIZED (SELECT p.*, count(*) OVER (PARTITION BY symbol) AS n FROM p),"
    " b AS (SELECT symbol, k, CASE WHEN s1 > s0 THEN 1 ELSE 0 END AS state, q0, q1 FROM e WHERE k = n UNION ALL"
    " SELECT e.symbol, e.k, CASE WHEN b.state = 1 THEN b.q1 ELSE b.q0 END, e.q0, e.q1 FROM b JOIN e ON e.symbol = b.symbol AND e.k = b.k - 1)"
)
MEANS = [repr(float(x)) for x in GIVEN.mean[:, 0]]


@query(
    "k8_regime_path_given",
    f"{OBSERVED}, {BEST} SELECT symbol, ts, CAST(state AS BIGINT) AS state, round(exp(CASE WHEN state = 1 THEN {MEANS[1]} ELSE {MEANS[0]} END), 6) AS growth FROM o JOIN b USING (symbol, k)",
)
def k8_given(spark, d):
    """The most likely path and the growth that it forecasts."""
    inputs = _inputs(spark, d)
    out = regimes.forecast_hard(inputs, GIVEN, block_rows=BLOCK_ROWS)
    return out.select("symbol", "ts", "state", rnd(F.col("pred_price") / F.col("close")).alias("growth"))


@query(
    "k9_regime_forecast_soft_given",
    f"{OBSERVED}, {FORWARD} SELECT symbol, ts, round(exp(greatest({-3 * TRAIN_STD!r}, least({3 * TRAIN_STD!r}, a0 * {MEANS[0]} + a1 * {MEANS[1]}))), 6) AS growth FROM o JOIN f USING (symbol, k)",
)
def k9_given(spark, d):
    out = regimes.forecast_soft(_inputs(spark, d), GIVEN, TRAIN_STD, mode="filter", block_rows=BLOCK_ROWS)
    return out.select("symbol", "ts", rnd(F.col("pred_price") / F.col("close")).alias("growth"))


@query(
    "k10_augment_with_regimes_given",
    f"{OBSERVED}, {FORWARD}, a AS (SELECT v.symbol, v.ts, lag(a0) OVER w AS p0, lag(a1) OVER w AS p1 FROM v LEFT JOIN (SELECT symbol, ts, a0, a1 FROM o JOIN f USING (symbol, k)) AS s USING (symbol, ts)"
    " WINDOW w AS (PARTITION BY symbol ORDER BY ts))"
    + " SELECT symbol, ts, "
    + ", ".join(
        f"round(coalesce(last_value(p{i} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),"
        f" first_value(p{i} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), 6) AS hmm_state_{i}"
        for i in (0, 1)
    )
    + " FROM a",
)
def k10_given(spark, d):
    inputs = _inputs(spark, d)
    probs = regimes.probabilities(inputs, GIVEN, "filter", block_rows=BLOCK_ROWS)
    out = regimes.augment(inputs, probs, lag=1, backfill=True)
    return out.select("symbol", "ts", *[rnd(c).alias(c) for c in ("hmm_state_0", "hmm_state_1")])
