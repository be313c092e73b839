"""Null-safe scalar expressions.

One rule for missing values everywhere: SQL NULL, never NaN or infinity. Under ANSI mode a
bare ``/`` raises on zero and the built-in ``corr`` raises on constant input, so ratios and
correlations go through this module.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

Cell = Column | str


def as_col(c: Cell) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(a: Cell, b: Cell) -> Column:
    """a / b, NULL where b is zero."""
    return F.try_divide(as_col(a), as_col(b))


def ln_pos(c: Cell) -> Column:
    """Natural logarithm, NULL for zero and negative values."""
    return F.ln(as_col(c))


def root(c: Cell) -> Column:
    """Square root, NULL (not NaN) for negative values."""
    c = as_col(c)
    return F.when(c >= 0, F.sqrt(c))


def is_true(cond: Column) -> Column:
    """A comparison with a missing value counts as false."""
    return F.coalesce(cond, F.lit(False))


def flag(cond: Column) -> Column:
    """0.0 / 1.0 with missing counted as 0.0."""
    return is_true(cond).cast("double")


def nan_to_null(c: Cell) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def inf_to_null(c: Cell) -> Column:
    """Infinities and NaN become NULL."""
    c = as_col(c)
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def zero_to_null(c: Cell) -> Column:
    c = as_col(c)
    return F.when(c != 0, c)


def to_number(c: Cell) -> Column:
    """Text to double; anything unparseable, NaN or infinite becomes NULL."""
    return inf_to_null(F.trim(as_col(c).cast("string")).try_cast("double"))


def clip(c: Cell, low: Cell | float | None = None, high: Cell | float | None = None) -> Column:
    """Bound a value; a missing value stays missing (``greatest`` alone would skip it)."""
    c = as_col(c)
    bounded = c
    if low is not None:
        bounded = F.greatest(bounded, low if isinstance(low, Column) else F.lit(low))
    if high is not None:
        bounded = F.least(bounded, high if isinstance(high, Column) else F.lit(high))
    return F.when(c.isNotNull(), bounded)


def row_max(*cols: Cell) -> Column:
    """Row-wise maximum over the values present."""
    return F.greatest(*[as_col(c) for c in cols])


def row_min(*cols: Cell) -> Column:
    """Row-wise minimum over the values present."""
    return F.least(*[as_col(c) for c in cols])


def row_mean(*cols: Cell) -> Column:
    """Row-wise mean over the values present."""
    cs = [as_col(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cs])
    n = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cs])
    return ratio(total, n)


def text_or_empty(c: Cell) -> Column:
    return F.coalesce(as_col(c), F.lit(""))


def headline_text(title: Cell, description: Cell) -> Column:
    """``title. description`` with a missing part taken as empty."""
    return F.concat(text_or_empty(title), F.lit(". "), text_or_empty(description))
