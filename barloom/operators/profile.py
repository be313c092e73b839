"""Null profiles, column-set rules and leakage-safe feature selection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from barloom.functions.cells import to_number
from barloom.functions.text import quoted, string
from barloom.operators import gram

# Names and name parts a feature must not have.
FORBIDDEN_NAMES = (
    "SPY_Close",
    "SPY_Close_Next",
    "price_change",
    "vol_price",
    "target_price_z",
    "SPY_NextDay_Return",
)
FORBIDDEN_PARTS = ("AdjClose", "Open", "High", "Low", "Close")
SECTOR_PRICE_PREFIX = "sector_data_Prices"
MACRO_PART = "macro_positioning_data"
DATE, TARGET = "Date", "SPY_NextDay_Return"


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, null_pct) for all columns from one pass, percentages to 2 places."""
    columns = list(columns) if columns is not None else df.columns
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, null_pct double")
    # One counter per column in a single aggregate; the result row is turned into a table.
    counts = [f"count({quoted(c)}) AS _c{i}" for i, c in enumerate(columns)]
    pct = "round(try_divide((_n - _c{}) * 100D, _n), 2)"
    cells = [f"named_struct('column', {string(c)}, 'null_pct', {pct.format(i)})" for i, c in enumerate(columns)]
    return df.selectExpr("count(1) AS _n", *counts).selectExpr(f"inline(array({', '.join(cells)}))")


def top_missing(profile: DataFrame, k: int = 5) -> DataFrame:
    """The k columns with the highest share of missing values, ones without any left out."""
    return profile.filter(F.col("null_pct") > 0).orderBy(F.desc("null_pct"), "column").limit(k)


def source_profile(merged: DataFrame, names: Sequence[str]) -> dict[str, list[str]]:
    """Joined columns counted under each source. A source's name also matches longer names
    that begin with it."""
    return {n: [c for c in merged.columns if c.startswith(n)] for n in names}


def dataset_stats(df: DataFrame, ts: str = DATE) -> DataFrame:
    """Rows, columns and date range."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.min(ts).alias("first_date"),
        F.max(ts).alias("last_date"),
    )


def coerce_text_columns(df: DataFrame, skip: Sequence[str] = (DATE,)) -> DataFrame:
    """Text columns become numbers; what does not parse becomes NULL."""
    cells = {c: to_number(F.col(f"`{c}`")) for c, t in df.dtypes if t == "string" and c not in skip}
    return df.withColumns(cells) if cells else df


def drop_all_null(df: DataFrame, skip: Sequence[str] = (DATE,)) -> DataFrame:
    """Drop columns without a single value (one aggregate row decides)."""
    columns = [c for c in df.columns if c not in skip]
    seen = df.selectExpr(*[f"count({quoted(c)}) AS _c{i}" for i, c in enumerate(columns)]).first()
    return df.drop(*[c for i, c in enumerate(columns) if not seen[i]])


def prefix_columns(df: DataFrame, prefix: str, skip: Sequence[str] = (DATE,)) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c in df.columns if c not in skip})


def group_columns(groups: dict[str, DataFrame], on: Sequence[str] = ("ts",)) -> DataFrame:
    """Side by side under ``{group}_{column}`` names, full outer on the dates.

    The wide groups are stacked and folded per date, so any number of groups costs one shuffle.
    """
    named = [
        g.selectExpr(*on, *[f"{quoted(c)} AS {quoted(f'{k}_{c}')}" for c in g.columns if c not in on])
        for k, g in groups.items()
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
    values = [c for c in stacked.columns if c not in on]
    return stacked.groupBy(*on).agg(*[F.first(F.col(f"`{c}`"), ignorenulls=True).alias(c) for c in values])


def select_features(columns: Sequence[str], macro: Sequence[str] | None = None) -> list[str]:
    """Name rules only; case matters, so a lower-case ``..._close`` passes."""
    macro = [c for c in columns if MACRO_PART in c] if macro is None else macro
    barred = {DATE, TARGET, *FORBIDDEN_NAMES, *macro}
    return [
        c
        for c in columns
        if c not in barred and not c.startswith(SECTOR_PRICE_PREFIX) and not any(p in c for p in FORBIDDEN_PARTS)
    ]


def feature_target_corr(train: DataFrame, features: Sequence[str], target: str = TARGET) -> DataFrame:
    """(feature, corr) over the training rows, one pass for all features; the table is computed at once.

    A constant or empty feature has correlation 0. A feature with any missing value has none
    (NULL): it can never be flagged.
    """
    spark, m = train.sparkSession, len(features)
    if not features:
        return spark.createDataFrame([], "feature string, corr double")
    # Names of their own: a feature may be the target's namesake or hold odd characters.
    cells = [F.col(f"`{c}`").cast("double").alias(f"f{k}") for k, c in enumerate([*features, target])]
    sums = gram.pair_sums(train.select(*cells, F.lit(1.0).alias("one")), [*[f"f{k}" for k in range(m + 1)], "one"])
    # Of the pairs only those of a feature with itself and with the target: two rows per feature.
    found = {(r.i, r.j): r for r in sums.filter(f"i = j OR (i < {m} AND j = {m})").collect()}
    total = found[m + 1, m + 1].n if found else 0.0

    def corr(k: int) -> float | None:
        own, both = found.get((k, k)), found.get((k, m))
        if own is None or own.n == 0 or gram.flat(own.n, own.s, own.q):
            return 0.0
        if own.n < total or both.n < 2 or gram.flat(both.n, both.s, both.q) or gram.flat(both.n, both.t, both.r):
            return None
        product = (both.n * both.q - both.s**2) * (both.n * both.r - both.t**2)
        return max(-1.0, min(1.0, (both.n * both.c - both.s * both.t) / product**0.5))

    return spark.createDataFrame([(f, corr(k)) for k, f in enumerate(features)], "feature string, corr double")


def prune_high_corr(corrs: DataFrame, threshold: float = 0.9, audit: float = 0.8) -> tuple[list[str], list[str]]:
    """(dropped, kept) among features whose correlation with the target exceeds ``audit``.

    Above ``threshold`` a feature is dropped; between the two only lagged ones stay. The
    table has one row per feature, so reading it here is bounded by the schema.
    """
    flagged = corrs.filter(F.abs("corr") > audit).orderBy(F.desc(F.abs("corr")), "feature").collect()
    drop = [r.feature for r in flagged if abs(r["corr"]) > threshold or not r.feature.endswith("_lag1")]
    return drop, [r.feature for r in flagged if r.feature not in drop]


def pruning(corrs: DataFrame, threshold: float = 0.9, audit: float = 0.8) -> DataFrame:
    """(feature, corr, dropped) for the features that ``prune_high_corr`` looks at, as a table."""
    high = F.abs("corr")
    drop = (high > threshold) | ~F.col("feature").endswith("_lag1")
    return corrs.filter(high > audit).select("feature", "corr", drop.alias("dropped"))
