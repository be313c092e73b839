"""The null rules of ``cells`` as SQL text, for the feature packs.

Packs hold hundreds of small definitions. Written as text each one is a single call into the
engine, and the formulas read like formulas.
"""

from __future__ import annotations


def ratio(a: str, b: str) -> str:
    return f"try_divide({a}, {b})"


def flag(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS DOUBLE)"


def root(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN sqrt({x}) END"


def at_least_zero(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN greatest({x}, 0D) END"


def num(x: float) -> str:
    """A double literal."""
    return f"{float(x)!r}D"


def quoted(column: str) -> str:
    return f"`{column}`"


def string(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pearson(a: str, b: str) -> str:
    """Correlation over complete pairs, as an aggregate; NULL when either side is constant."""
    a2, b2 = f"CASE WHEN {b} IS NOT NULL THEN {a} END", f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    return f"try_divide(covar_pop({a2}, {b2}), stddev_pop({a2}) * stddev_pop({b2}))"
