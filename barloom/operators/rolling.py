"""Indicators on bars, each as definitions added to a ``Stages``.

Every function names its output columns on the given ``Stages`` and reads the columns
``open, high, low, close, volume``. Windows count rows (trading days). Formulas are SQL text
over column names.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from barloom.functions.text import at_least_zero, flag, num, ratio, root
from barloom.operators.lanes import OWN
from barloom.operators.recursive import ema, span_alpha
from barloom.operators.sliding import Quantile, Share
from barloom.operators.stages import Stages

YEAR_DAYS = 252


# -- changes and returns -------------------------------------------------------------
def pct_change(b: Stages, x: str, n: int, name: str, pad: bool = True) -> str:
    """Relative change over n rows; with ``pad`` a missing value is carried forward first."""
    src = b.pad(x) if pad else x
    before = b.lag(src, n)
    return b.col(name, f"{ratio(src, before)} - 1", src, before)


def log_return(b: Stages, x: str = "close", n: int = 1, name: str | None = None) -> str:
    ln = b.col(f"_ln_{x}", f"ln({x})", x)
    before = b.lag(ln, n)
    return b.col(name or f"_lr{n}_{x}", f"{ln} - {before}", ln, before)


def simple_returns(b: Stages) -> None:
    b.out(pct_change(b, "close", 1, "ret_1d"), log_return(b, name="logret_1d"))


def rolling_return(b: Stages, windows: Sequence[int] = (5, 10, 20)) -> None:
    """Compounded return of n rows.

    The factors 1 + r telescope to a price ratio. A total loss (price zero) counts as a
    factor of one; the next factor is undefined, so it can only be a window's last row.
    """
    pad = b.pad("close")
    ret = pct_change(b, "close", 1, "ret_1d")
    prev = b.lag(pad, 1)
    end = b.col("_end_price", f"CASE WHEN {pad} = 0 THEN {prev} ELSE {pad} END", pad, prev)
    ok = b.col("_ret_ok", f"CASE WHEN {ret} IS NOT NULL THEN 0D END", ret)
    for n in windows:
        start, whole = b.lag(pad, n), b.rolled("total", n, ok)["sum"]
        sql = f"CASE WHEN {whole} IS NOT NULL THEN {ratio(end, start)} - 1 END"
        b.out(b.col(f"roll_ret_{n}d", sql, whole, start, end))


def momentum(b: Stages, longest: int = 20) -> None:
    for n in range(1, longest + 1):
        b.out(pct_change(b, "close", n, f"mom_{n}d"))


# -- averages ------------------------------------------------------------------------
MA_WINDOWS = (5, 10, 20, 50, 200)


def sma(b: Stages, windows: Sequence[int] = MA_WINDOWS) -> None:
    for n in windows:
        m = b.mean("close", n)
        b.out(b.col(f"SMA_{n}", m, m))


def emas(b: Stages, windows: Sequence[int] = MA_WINDOWS) -> None:
    seen = ema(b, "close", {f"_ema{n}": span_alpha(n) for n in windows})
    for n in windows:
        b.out(b.col(f"EMA_{n}", f"CASE WHEN {seen} >= {n} THEN _ema{n} END", f"_ema{n}", seen))


def macd(b: Stages, fast: int = 12, slow: int = 26, signal: int = 9) -> None:
    f, s = f"_ema{fast}", f"_ema{slow}"
    seen = ema(b, "close", {f: span_alpha(fast), s: span_alpha(slow)})
    line = b.col("MACD_line", f"CASE WHEN {seen} >= {slow} THEN {f} - {s} END", f, s, seen)
    lines = ema(b, line, {"_macd_signal": span_alpha(signal)})
    sql = f"CASE WHEN {lines} >= {slow + signal - 1} THEN _macd_signal END"
    sig = b.col("MACD_signal", sql, "_macd_signal", lines)
    b.out(line, sig, b.col("MACD_hist", f"{line} - {sig}", line, sig))


def distance_from_ma(b: Stages, windows: Sequence[int] = MA_WINDOWS) -> None:
    b.quietly(sma, windows)
    b.quietly(emas, windows)
    for n in windows:
        for kind, m in (("sma", f"SMA_{n}"), ("ema", f"EMA_{n}")):
            b.out(b.col(f"dist_{kind}_{n}d", ratio(f"close - {m}", m), "close", m))


# -- oscillators and bands -----------------------------------------------------------
def rsi(b: Stages, period: int = 14) -> None:
    before = b.lag("close")
    up = b.col("_up", at_least_zero(f"(close - {before})"), "close", before)
    down = b.col("_down", at_least_zero(f"({before} - close)"), "close", before)
    n_up, n_down = (ema(b, x, {f"_rsi{x}": 1.0 / period}) for x in (up, down))
    strength = ratio(
        f"CASE WHEN {n_up} >= {period} THEN _rsi{up} END", f"CASE WHEN {n_down} >= {period} THEN _rsi{down} END"
    )
    sql = f"100D - {ratio('100D', f'1D + {strength}')}"
    b.out(b.col(f"RSI_{period}", sql, f"_rsi{up}", f"_rsi{down}", n_up, n_down))


def stochastic(b: Stages, k: int = 14, d: int = 3) -> None:
    low, high = b.rolled("min", k, "low")["ext"], b.rolled("max", k, "high")["ext"]
    raw = b.col("_stoch", ratio(f"100D * (close - {low})", f"({high} - {low})"), "close", low, high)
    mean = b.mean(raw, d)
    b.out(b.col(f"Stoch_%K_{k}", raw, raw), b.col(f"Stoch_%D_{d}", mean, mean))


def bollinger(b: Stages, n: int = 20, width: float = 2.0) -> None:
    mid, std = b.center("close", n), b.std_pop("close", n)
    upper, lower, tag = f"({mid} + {num(width)} * {std})", f"({mid} - {num(width)} * {std})", int(width)
    b.out(
        b.col(f"BB_Middle_{n}", mid, mid),
        b.col(f"BB_Upper_{n}_{tag}", upper, mid, std),
        b.col(f"BB_Lower_{n}_{tag}", lower, mid, std),
        b.col(f"BB_Width_{n}", ratio(f"{upper} - {lower}", mid), mid, std),
    )


def atr(b: Stages, period: int = 14) -> None:
    before = b.lag("close")
    tr = b.col("_tr", f"greatest(high - low, abs(high - {before}), abs(low - {before}))", "high", "low", before)
    seen = ema(b, tr, {"_atr": 1.0 / period})
    b.out(b.col(f"ATR_{period}", f"CASE WHEN {seen} >= {period} THEN _atr END", "_atr", seen))


# -- gaps ----------------------------------------------------------------------------
def gap_measures(b: Stages) -> None:
    lag = b.lag("close")
    prev = b.col("prev_Close", lag, lag)
    b.out(
        prev,
        b.col("gap_abs", f"open - {lag}", "open", lag),
        b.col("gap_pct", ratio(f"open - {lag}", lag), "open", lag),
        b.col("gap_log", f"ln(open) - ln({lag})", "open", lag),
    )


def return_decomposition(b: Stages) -> None:
    prev = b.lag("close")
    for name, top, base in (("overnight", "open", prev), ("intraday", "close", "open"), ("daily", "close", prev)):
        b.out(
            b.col(f"{name}_ret", f"{ratio(top, base)} - 1", top, base),
            b.col(f"{name}_logret", f"ln({top}) - ln({base})", top, base),
        )


def gap_flags(b: Stages) -> None:
    prev = b.lag("close")
    up = b.col("is_gap_up", flag(f"open > {prev}"), "open", prev)
    down = b.col("is_gap_down", flag(f"open < {prev}"), "open", prev)
    f_up = b.col("_filled_up", flag(f"open > {prev} AND low <= {prev}"), "open", "low", prev)
    f_down = b.col("_filled_down", flag(f"open < {prev} AND high >= {prev}"), "open", "high", prev)
    b.out(
        b.col("is_gap", f"greatest({up}, {down})", up, down),
        up,
        down,
        b.col("gap_filled", f"greatest({f_up}, {f_down})", f_up, f_down),
    )


def gap_fill_probability(b: Stages, windows: Sequence[int] = (20, 60, 120, 252)) -> None:
    """Share of gaps filled the same day, over up to n rows; NULL while there is no gap."""
    b.quietly(gap_flags)
    shares = (("any", "gap_filled", "is_gap"), ("up", "_filled_up", "is_gap_up"), ("down", "_filled_down", "is_gap_down"))
    for n in windows:
        for tag, filled, gaps in shares:
            top, base = b.rolled("partial", n, filled)["sum"], b.rolled("partial", n, gaps)["sum"]
            b.out(b.col(f"p_fill_{tag}_{n}d", ratio(top, base), top, base))


# -- volume and liquidity ------------------------------------------------------------
def volume_percentile(b: Stages, windows: Sequence[int] = (20, 60, 252)) -> None:
    """Share of the window at or below the current volume."""
    for n in windows:
        b.out(b.slide(Share(f"vol_pct_{n}", "volume", n)))


def volume_surge(b: Stages, windows: Sequence[int] = (20, 60), share: float = 0.95) -> None:
    tag = int(round(share * 100))
    for n in windows:
        mean, std = b.center("volume", n), b.std_pop("volume", n)
        thr = b.slide(Quantile(f"vol_p{tag}_{n}", "volume", n, share))
        b.out(
            b.col(f"vol_avg_{n}", mean, mean),
            b.col(f"vol_ratio_{n}", ratio("volume", mean), "volume", mean),
            thr,
            b.col(f"vol_gt_p{tag}_{n}", flag(f"volume >= {thr}"), "volume", thr),
            b.col(f"vol_z_{n}", ratio(f"volume - {mean}", std), "volume", mean, std),
        )


def signed_volume(b: Stages) -> str:
    before = b.lag("close")
    sql = f"coalesce(signum(close - {before}), 0D) * coalesce(volume, 0D)"
    return b.col("_signed", sql, "close", "volume", before)


OBV_CARRY = "_obv_before"


def obv(b: Stages, n: int = 20) -> None:
    signed = signed_volume(b)
    run = b.win("_obv", f"sum({signed})", b.lane.so_far, signed)
    if b.lane.tiled:
        # Own rows only, on top of what the earlier tiles add up to.
        own = b.win("_obv_own", f"sum(CASE WHEN {OWN} THEN {signed} END)", b.lane.so_far, signed, OWN)
        total = b.col("OBV", f"coalesce({own}, 0D) + coalesce({OBV_CARRY}, 0D)", own, OBV_CARRY)
    else:
        total = b.col("OBV", run, run)
    # The z-score does not change with a constant offset, so the running sum of the lane serves.
    mean, std = b.center(run, n), b.std_pop(run, n)
    b.out(total, b.col(f"OBV_z{n}", ratio(f"{run} - {mean}", std), run, mean, std))


def roll_spread(b: Stages, n: int = 20) -> None:
    before = b.lag("close")
    dp = b.col("_dp", f"close - {before}", "close", before)
    cross = b.rolled("comoments", n, dp, b.lag(dp))["ab"]
    spread = f"2D * sqrt({at_least_zero(f'(-{cross} / {num(n - 1)})')})"
    name = b.col(f"roll_spread_abs_{n}", spread, cross)
    b.out(name, b.col(f"roll_spread_pct_{n}", ratio(name, "close"), name, "close"))


def hl_range(b: Stages) -> None:
    b.out(
        b.col("HL_rel_range", ratio("high - low", "close"), "high", "low", "close"),
        b.col("HL_log_range", "ln(high) - ln(low)", "high", "low"),
    )


def amihud(b: Stages, n: int = 20) -> None:
    ret = pct_change(b, "close", 1, "ret_1d")
    illiq = b.col("_illiq", ratio(f"abs({ret})", "close * volume"), ret, "close", "volume")
    mean = b.mean(illiq, n)
    b.out(b.col(f"amihud_illiq_mean_{n}", mean, mean), b.slide(Quantile(f"amihud_illiq_median_{n}", illiq, n, 0.5)))


# -- trend ---------------------------------------------------------------------------
def days_since_extreme(b: Stages, windows: Sequence[int] = (20, 60, 120, 252)) -> None:
    """Rows since the window's high / low; the earliest of equal extremes counts."""
    pos = b.row_no()
    for x, kind, sign in (("high", "max", "-"), ("low", "min", "")):
        mark = b.col(
            f"_mark_{x}", f"CASE WHEN {x} IS NOT NULL THEN named_struct('v', {x}, 'p', {sign}{pos}) END", x, pos
        )
        for n in windows:
            ext = b.rolled(kind, n, mark)["ext"]
            b.out(b.col(f"days_since_{x}_{n}d", f"CAST({pos} - ({sign}{ext}.p) AS DOUBLE)", pos, ext))


def zscore_returns(b: Stages, windows: Sequence[int] = (5, 20, 60)) -> None:
    lr = log_return(b, name="logret_1d")
    for n in windows:
        mean, std = b.center(lr, n), b.std_pop(lr, n)
        b.out(b.col(f"zret_{n}d", ratio(f"{lr} - {mean}", std), lr, mean, std))


def autocorr(b: Stages, windows: Sequence[int] = (20, 60, 120), lag: int = 1) -> None:
    """Correlation of each window's returns with the same returns ``lag`` rows earlier."""
    lr = log_return(b, name="logret_1d")
    before = b.lag(lr, lag)
    for n in windows:
        c = b.rolled("comoments", n - lag, lr, before)
        corr = ratio(c["ab"], f"sqrt({c['aa']} * {c['bb']})")
        b.out(b.col(f"autocorr_ret_lag{lag}_{n}d", corr, c["ab"], c["aa"], c["bb"]))


# -- volatility ----------------------------------------------------------------------
VOL_WINDOWS = (5, 10, 20, 60, 120, 252)


def realized_vol(b: Stages, windows: Sequence[int] = VOL_WINDOWS, year: int = YEAR_DAYS) -> None:
    lr = log_return(b, name="logret_1d")
    for n in windows:
        std = b.std_pop(lr, n)
        b.out(b.col(f"RealizedVol_{n}d_ann", f"{num(math.sqrt(year))} * {std}", std))


def _range_vol(b: Stages, label: str, daily: str, windows: Sequence[int], year: int) -> None:
    for n in windows:
        mean = b.mean(daily, n)
        b.out(b.col(f"{label}_{n}d_ann", root(f"({num(year)} * {mean})"), mean))


def _ln(b: Stages, x: str) -> str:
    return b.col(f"_ln_{x}", f"ln({x})", x)


def parkinson_vol(b: Stages, windows: Sequence[int] = VOL_WINDOWS, year: int = YEAR_DAYS) -> None:
    h, l = _ln(b, "high"), _ln(b, "low")
    daily = b.col("_park", f"({h} - {l}) * ({h} - {l}) / {num(4.0 * math.log(2.0))}", h, l)
    _range_vol(b, "ParkinsonVol", daily, windows, year)


def garman_klass_vol(b: Stages, windows: Sequence[int] = VOL_WINDOWS, year: int = YEAR_DAYS) -> None:
    o, h, l, c = (_ln(b, x) for x in ("open", "high", "low", "close"))
    k = num(2.0 * math.log(2.0) - 1.0)
    daily = b.col("_gk", f"0.5D * ({h} - {l}) * ({h} - {l}) - {k} * ({c} - {o}) * ({c} - {o})", o, h, l, c)
    _range_vol(b, "GarmanKlassVol", daily, windows, year)


def rogers_satchell_vol(b: Stages, windows: Sequence[int] = VOL_WINDOWS, year: int = YEAR_DAYS) -> None:
    o, h, l, c = (_ln(b, x) for x in ("open", "high", "low", "close"))
    daily = b.col("_rs", f"({h} - {c}) * ({h} - {o}) + ({l} - {c}) * ({l} - {o})", o, h, l, c)
    _range_vol(b, "RogersSatchellVol", daily, windows, year)


def intraday_range(b: Stages) -> None:
    b.out(
        b.col("Range_abs", "high - low", "high", "low"),
        b.col("Range_rel_close", ratio("high - low", "close"), "high", "low", "close"),
        b.col("Range_log", "ln(high) - ln(low)", "high", "low"),
    )


def skew_kurt(b: Stages, windows: Sequence[int] = (20, 60, 120)) -> None:
    """Bias-corrected sample skew and excess kurtosis; NULL on a constant window."""
    lr = log_return(b, name="logret_1d")
    for n in windows:
        m = b.rolled("shape", n, lr)
        m2, m3, m4 = m["m2"], m["m3"], m["m4"]
        skew = f"{ratio(m3, f'({m2} * sqrt({m2}))')} * {num(n * math.sqrt(n - 1) / (n - 2))}"
        corr = num((n - 1) / ((n - 2) * (n - 3)))
        kurt = f"({ratio(f'{num(n * (n + 1))} * {m4}', f'({m2} * {m2})')} - {num(3 * (n - 1))}) * {corr}"
        b.out(
            b.col(f"RealizedSkew_{n}d", skew, m2, m3),
            b.col(f"RealizedKurtExcess_{n}d", kurt, m2, m4),
        )


def realized_vol_simple(b: Stages, n: int = 21, year: int = YEAR_DAYS) -> None:
    """Sample deviation of simple returns, annualised."""
    std = b.std_samp(pct_change(b, "close", 1, "ret_1d"), n)
    b.out(b.col("realized_vol", f"{std} * {num(math.sqrt(year))}", std))


def rolling_zscore(b: Stages, x: str, n: int, name: str) -> str:
    """(x - mean) / sample deviation over n rows; NULL on a zero deviation."""
    mean, std = b.center(x, n), b.std_samp(x, n)
    return b.col(name, ratio(f"{x} - {mean}", std), x, mean, std)
