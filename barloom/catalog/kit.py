"""Registry of runnable queries, each with the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, query: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"duplicate query {name}")
    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def query(name: str, sql: str | None = None):
    """Decorator form of ``register``."""

    def add(fn: Query) -> Query:
        register(name, fn, sql)
        return fn

    return add


# -- presentation ------------------------------------------------------------------------
# Results are compared at a fixed number of decimals. ``show`` maps an output column to an
# expression that reads the same in both engines; price-scaled columns are divided by close.
Show = dict[str, str]


def as_is(*names: str) -> Show:
    return {n: f"`{n}`" for n in names}


def per_close(*names: str) -> Show:
    return {n: f"`{n}` / close" for n in names}


def shown(df: DataFrame, keys: list[str], show: Show, digits: int = 6) -> DataFrame:
    return df.selectExpr(*keys, *[f"round({e}, {digits}) AS `{n}`" for n, e in show.items()])


def shown_sql(body: str, keys: list[str], show: Show, digits: int = 6) -> str:
    """``body`` is ``[WITH ...] SELECT ...``; adding 0.0 turns a negative zero positive."""
    cols = [f'CAST(round({e}, {digits}) AS DOUBLE) + 0.0 AS "{n}"'.replace("`", '"') for n, e in show.items()]
    return f"SELECT {', '.join([*keys, *cols])} FROM ({body}) AS shown_rows"


# -- SQL building blocks -----------------------------------------------------------------
def bars_cte(symbol: str = "l_returnflag") -> str:
    order = "l_orderkey, l_linenumber, l_partkey, l_suppkey"
    return (
        f"bars AS MATERIALIZED (SELECT {symbol} AS symbol, CAST(l_shipdate AS DATE) AS ts,"
        f" first(p ORDER BY {order}) AS open, max(p) AS high, min(p) AS low,"
        f" last(p ORDER BY {order}) AS close, sum(l_quantity) AS volume"
        " FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem) AS li GROUP BY 1, 2)"
    )


STEP_CTE = (
    "t AS MATERIALIZED (SELECT *, row_number() OVER o AS rn, lag(close) OVER o AS pc,"
    " close / lag(close) OVER o - 1 AS ret, ln(close) - lag(ln(close)) OVER o AS lr,"
    " close - lag(close) OVER o AS dp"
    " FROM bars WINDOW o AS (PARTITION BY symbol ORDER BY ts))"
)


def full(x: str, n: int, expr: str) -> str:
    """``expr`` over window wN where all N values of x are there."""
    return f"CASE WHEN count({x}) OVER w{n} = {n} THEN {expr} END"


def windows(select: str, part: str = "symbol") -> str:
    """Adds the WINDOW clause for every ``OVER wN`` (N rows) and ``OVER o`` in ``select``."""
    by = f"PARTITION BY {part} " if part else ""
    sizes = sorted({int(n) for n in re.findall(r"OVER w(\d+)", select)})
    defs = [f"w{n} AS ({by}ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)" for n in sizes]
    if re.search(r"OVER o\b", select):
        defs.append(f"o AS ({by}ORDER BY ts)")
    if re.search(r"OVER u\b", select):
        defs.append(f"u AS ({by}ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    return select + (f" WINDOW {', '.join(defs)}" if defs else "")


def over_bars(columns: str, *ctes: str, source: str = "t", symbol: str = "l_returnflag") -> str:
    """WITH bars, t[, more] SELECT * plus ``columns`` FROM source."""
    more = "".join(f", {c}" for c in ctes)
    return f"WITH {bars_cte(symbol)}, {STEP_CTE}{more} " + windows(f"SELECT *, {columns} FROM {source}")
