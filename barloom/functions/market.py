"""Derived market quantities: plain column arithmetic with the null rules of ``cells``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from barloom.functions.cells import Cell, as_col, ratio


def moneyness(strike: Cell, spot: Cell) -> Column:
    return ratio(strike, spot)


def term_spread(long_yield: Cell, short_yield: Cell) -> Column:
    return as_col(long_yield) - as_col(short_yield)


def credit_spread(high_yield_price: Cell, grade_price: Cell) -> Column:
    """Price ratio of a high-yield and an investment-grade fund, minus one."""
    return ratio(high_yield_price, grade_price) - 1


def hy_minus_ig(hy_oas: Cell, ig_oas: Cell) -> Column:
    return as_col(hy_oas) - as_col(ig_oas)


def risk_appetite(hy_oas: Cell, ig_oas: Cell) -> Column:
    """Narrower credit spread, higher appetite."""
    return -hy_minus_ig(hy_oas, ig_oas)


def vix_term_slope(columns: list[str], near: str = "VIX", far: str = "VIX3M") -> Column | None:
    """Three-month minus one-month volatility index, only when both columns exist."""
    return F.col(far) - F.col(near) if near in columns and far in columns else None


def usd_strength(eurusd_ret: Cell, usdjpy_ret: Cell) -> Column:
    return F.lit(0.5) * (-as_col(eurusd_ret)) + F.lit(0.5) * as_col(usdjpy_ret)


def breadth_proxy(equal_weight_ret: Cell, cap_weight_ret: Cell) -> Column:
    return as_col(equal_weight_ret) - as_col(cap_weight_ret)


def relative_strength(price: Cell, benchmark: Cell) -> Column:
    return ratio(price, benchmark)


def quote_to_percent(c: Cell) -> Column:
    """Yield quotes arrive multiplied by ten."""
    return as_col(c) / F.lit(10.0)


def price_forecast(close: Cell, expected_log_return: Cell) -> Column:
    return as_col(close) * F.exp(as_col(expected_log_return))


def day_text(c: Cell) -> Column:
    """``YYYY-MM-DD`` for text sinks."""
    return F.date_format(as_col(c), "yyyy-MM-dd")
