"""Calendars, reindexing and date joins.

Calendars and aligned panels hold one row per date (and panel key), so their windows are
bounded by the calendar, never by the number of raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def calendar(df: DataFrame, by: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """Distinct dates (per panel key) of a reference table."""
    return df.select(*by, ts).distinct()


def intersect_dates(a: DataFrame, b: DataFrame, on: Sequence[str] = ("ts",)) -> DataFrame:
    """Rows of ``a`` whose date is in ``b`` too."""
    return a.join(b.select(*on).distinct(), list(on), "left_semi")


def between_dates(df: DataFrame, low: str, high: str, ts: str = "ts") -> DataFrame:
    """Inclusive at both ends."""
    return df.filter(F.col(ts).between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def _order(by: Sequence[str], ts: str):
    return Window.partitionBy(*by).orderBy(ts)


def ffill(c: str | Column, by: Sequence[str], ts: str = "ts") -> Column:
    """Last value so far that is not missing."""
    w = _order(by, ts).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(c, ignorenulls=True).over(w)


def ffill_bfill(c: str, by: Sequence[str], ts: str = "ts") -> Column:
    """Forward fill, then backfill the head.

    Wherever the forward fill is empty the first value of the whole partition is the next
    one, so one whole-partition frame replaces a look-ahead frame per row.
    """
    whole = _order(by, ts).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(ffill(c, by, ts), F.first(c, ignorenulls=True).over(whole))


def reindex(series: DataFrame, dates: DataFrame, by: Sequence[str] = (), ts: str = "ts") -> DataFrame:
    """The calendar's rows with the series' values on exactly matching dates."""
    return dates.join(series, [*by, ts], "left")


def reindex_ffill(
    series: DataFrame,
    dates: DataFrame,
    values: Sequence[str],
    by: Sequence[str] = (),
    ts: str = "ts",
    how: str = "exact",
    backfill: bool = False,
    max_age: int | None = None,
) -> DataFrame:
    """Align low-frequency values to a calendar and carry them forward.

    ``exact`` keeps only values dated on the calendar: a release on a closed day is lost.
    ``asof`` carries those too. ``max_age`` (days) stops the carry of stale values.
    """
    if how not in ("exact", "asof"):
        raise ValueError("how must be 'exact' or 'asof'")
    dates = dates.select(*by, ts)
    if how == "exact":
        base = reindex(series.select(*by, ts, *values), dates, by, ts).withColumn("_on", F.lit(True))
    else:
        rows = series.select(*by, ts, *values).unionByName(dates.withColumn("_on", F.lit(True)), allowMissingColumns=True)
        # One row per date: the values of the series and whether the calendar has it.
        base = rows.groupBy(*by, ts).agg(
            *[F.max(v).alias(v) for v in values], F.coalesce(F.bool_or("_on"), F.lit(False)).alias("_on")
        )
    part = f"PARTITION BY {', '.join(by)} " if by else ""
    past = f"OVER ({part}ORDER BY {ts} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    whole = f"OVER ({part}ORDER BY {ts} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"

    def cell(v: str) -> str:
        sql = f"last(`{v}`, true) {past}"
        if backfill:
            sql = f"coalesce({sql}, first(`{v}`, true) {whole})"
        if max_age is not None:
            seen = f"last(CASE WHEN `{v}` IS NOT NULL THEN {ts} END, true) {past}"
            sql = f"CASE WHEN datediff({ts}, {seen}) <= {max_age} THEN {sql} END"
        return f"{sql} AS `{v}`"

    rest = [f"`{c}`" for c in base.columns if c not in values]
    return base.selectExpr(*rest, *[cell(v) for v in values]).filter("_on").drop("_on")


def outer_align(
    series: DataFrame, names: Sequence[str], by: Sequence[str] = (), ts: str = "ts", name: str = "name", value: str = "value"
) -> DataFrame:
    """Full outer alignment of many long series: one pivot shuffle instead of k outer joins."""
    return series.groupBy(*by, ts).pivot(name, list(names)).agg(F.first(value, ignorenulls=True))


def assign_align(series: DataFrame, names: Sequence[str], ts: str = "ts", name: str = "name", value: str = "value") -> DataFrame:
    """Columns assigned to the first series' frame: only its dates stay."""
    return outer_align(series, names, (), ts, name, value).filter(F.col(f"`{names[0]}`").isNotNull())


def spine_join(
    spine: DataFrame, tables: dict[str, DataFrame], on: Sequence[str] = ("Date",), dedupe: str = "fan_out", order: str | dict[str, str] | None = None
) -> DataFrame:
    """Left join every table onto the spine's dates.

    Duplicate right dates fan rows out (``fan_out``), raise (``error``) or keep the row that
    is last by ``order``, a column of all tables or one for each (``last``).
    """
    on = list(on)

    def prepared(name: str, df: DataFrame) -> DataFrame:
        if dedupe == "fan_out":
            return df
        if dedupe == "error":
            seen = F.count("*").over(Window.partitionBy(*on))
            checked = F.when(seen > 1, F.raise_error(F.lit("duplicate dates on the right side"))).otherwise(F.lit(1))
            return df.withColumn("_one", checked.cast("int")).filter("_one = 1").drop("_one")
        if dedupe == "last":
            by = order.get(name) if isinstance(order, dict) else order
            if by is None:
                raise ValueError(f"dedupe='last' needs an order column for {name}")
            rest = [c for c in df.columns if c not in on]
            row = F.max_by(F.struct(*rest), F.col(by)).alias("_row")
            return df.groupBy(*on).agg(row).select(*on, *[F.col("_row").getField(c).alias(c) for c in rest])
        raise ValueError("dedupe must be 'fan_out', 'error' or 'last'")

    return reduce(lambda left, t: left.join(prepared(*t), on, "left"), tables.items(), spine)


def stack_join(
    spine: DataFrame, tables: dict[str, DataFrame], on: Sequence[str] = ("Date",), dedupe: str = "error", order: dict[str, str] | None = None
) -> DataFrame:
    """Left join of any number of tables onto the spine's keys in one shuffle.

    All rows are stacked as key and one struct per table, and one aggregate folds them by key. A key that a table
    holds twice raises (``error``) or keeps the row that is last by that table's ``order`` column (``last``). Columns other than
    the keys must differ between tables.
    """
    on, order = list(on), order or {}
    if dedupe not in ("error", "last"):
        raise ValueError("dedupe must be 'error' or 'last'")
    lacking = [n for n in tables if dedupe == "last" and n not in order]
    if lacking:
        raise ValueError(f"dedupe='last' needs an order column for {lacking}")
    rest = {n: [c for c in t.columns if c not in on] for n, t in tables.items()}
    stacked = [spine.select(*on).distinct().withColumn("_spine", F.lit(True))]
    for k, (n, t) in enumerate(tables.items()):
        stacked.append(t.select(*on, F.struct(*[F.col(f"`{c}`") for c in rest[n]]).alias(f"_t{k}")))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
    aggs = [F.max("_spine").alias("_spine")]
    for k, n in enumerate(tables):
        row = F.col(f"_t{k}")
        if dedupe == "last":
            aggs.append(F.max_by(row, row[order[n]]).alias(f"_t{k}"))
        else:
            aggs += [F.first(row, ignorenulls=True).alias(f"_t{k}"), F.count(row).alias(f"_n{k}")]
    folded = both.groupBy(*on).agg(*aggs).filter(F.col("_spine"))
    if dedupe == "error":
        many = reduce(lambda a, b: a | b, [F.col(f"_n{k}") > 1 for k in range(len(tables))], F.lit(False))
        folded = folded.filter(F.when(many, F.raise_error(F.lit("duplicate dates on the right side")).cast("boolean")).otherwise(True))
    cells = [F.col(f"_t{k}").getField(c).alias(c) for k, n in enumerate(tables) for c in rest[n]]
    return folded.select(*on, *cells)


def pivot_wide(df: DataFrame, assets: Sequence[str], values: Sequence[str] = ("close",), by: Sequence[str] = (), ts: str = "ts", asset: str = "asset") -> DataFrame:
    """Long (ts, asset, ...) to one column per asset (``{asset}_{value}`` for several values)."""
    return df.groupBy(*by, ts).pivot(asset, list(assets)).agg(*[F.first(v, ignorenulls=True).alias(v) for v in values])


def drop_missing(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(how="any", subset=list(subset) if subset else None)


def skip_first(df: DataFrame, n: int, by: Sequence[str], ts: str = "ts") -> DataFrame:
    """Drop the first n rows of every series."""
    return df.withColumn("_rn", F.row_number().over(_order(by, ts))).filter(F.col("_rn") > n).drop("_rn")


def top_n(df: DataFrame, n: int, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First n rows per group in the stated order.

    Each task keeps at most n rows per group before the shuffle, so a group of any size is fine.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def release_lag(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), ts: str = "ts", n: int = 1) -> DataFrame:
    """Shift low-frequency columns by n rows so that a value is used only after its date."""
    w = _order(by, ts)
    return df.withColumns({c: F.lag(c, n).over(w) for c in columns if c in df.columns})
