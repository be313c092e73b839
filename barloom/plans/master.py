"""The master dataset: many daily tables on one calendar, a target and a pruned feature list."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from barloom.functions.cells import ratio
from barloom.operators import align, profile
from barloom.operators.profile import DATE, MACRO_PART, TARGET
from barloom.session import settle
from barloom.sources import ingest, sinks

CALENDAR_TABLE = "spy_rth_volatility"
CLOSE_COLUMN = "spy_ohlcv_1drth_close"


def next_return(df: DataFrame, close: str, name: str, by: Sequence[str] = (), ts: str = DATE) -> DataFrame:
    """Return to the next row of the carried-forward close; rows without one are dropped."""
    w = Window.partitionBy(*by).orderBy(ts)
    carried = df.withColumn("_close", align.ffill(close, by, ts))
    target = ratio(F.lead("_close").over(w), "_close") - 1
    return carried.withColumn(name, target).filter(F.col(name).isNotNull()).drop("_close")


def prepare(raw: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame | None:
    """Parsed ``Date`` plus all source columns under ``{name}_``; None without a date column."""
    date_column = ingest.detect_date_column(raw.columns)
    if date_column is None:
        return None
    parsed = ingest.normalize_date(ingest.parse_dates(raw, date_column))
    return profile.prefix_columns(parsed, name, (DATE, *by))


@dataclass
class Master:
    data: DataFrame
    features: list[str]
    dropped: list[str]
    correlations: DataFrame
    null_before: dict[str, DataFrame]
    null_after: dict[str, DataFrame]


def build_master(
    sources: dict[str, DataFrame],
    calendar_table: str = CALENDAR_TABLE,
    close_column: str = CLOSE_COLUMN,
    train: tuple[str, str] = ("2015-01-01", "2021-12-31"),
    threshold: float = 0.9,
    dedupe: str = "fan_out",
    order: dict[str, str] | None = None,
    by: Sequence[str] = (),
) -> Master:
    """Join prepared tables on the calendar of one of them, then target and feature selection.

    The calendar table gives only its dates. Correlations look at the training range only.
    With ``dedupe="last"`` ``order`` names a source column for each table, the highest value of which stays per date.
    ``by`` names the columns of an instrument: tables that hold them are aligned by instrument and date, the others (one row
    per date for the whole market) by date. Unless dates may fan out, each kind is aligned in one shuffle. The
    joined table is computed once and kept; windows over it run by instrument.
    """
    by = tuple(by)
    prepared, before = {}, {}
    for name, raw in sources.items():
        table = prepare(raw, name, by)
        if table is None:
            continue
        prepared[name] = table
        date_column = ingest.detect_date_column(raw.columns)
        before[name] = profile.null_profile(raw, [c for c in raw.columns if c not in (date_column, *by)])
    keys = [*by, DATE]
    spine = prepared[calendar_table].select(*keys).filter(F.col(DATE).isNotNull()).distinct()
    tables = {n: t for n, t in prepared.items() if n != calendar_table}
    orders = {n: f"{n}_{c}" for n, c in (order or {}).items()}
    own = {n: t for n, t in tables.items() if set(by) <= set(t.columns)}
    market = {n: t for n, t in tables.items() if n not in own}
    if dedupe == "fan_out":
        merged = align.spine_join(align.spine_join(spine, own, keys, dedupe, orders), market, [DATE], dedupe, orders)
    else:
        merged = align.stack_join(spine, own, keys, dedupe, orders)
        if market:
            dates = spine.select(DATE).distinct()
            merged = merged.join(align.stack_join(dates, market, [DATE], dedupe, orders), DATE, "left")
    merged = settle(merged)
    after = {
        n: profile.null_profile(merged, cols) for n, cols in profile.source_profile(merged, list(prepared)).items() if cols
    }
    clean = profile.drop_all_null(profile.coerce_text_columns(merged, keys), keys)
    data = next_return(clean, close_column, TARGET, by)
    macro = [c for c in data.columns if MACRO_PART in c]
    data = data.withColumns({c: align.ffill(c, by, DATE) for c in macro}) if macro else data
    candidates = [c for c in profile.select_features(data.columns, macro) if c not in by]
    corrs = profile.feature_target_corr(align.between_dates(data, *train, DATE), candidates)
    dropped, _ = profile.prune_high_corr(corrs, threshold)
    return Master(data, [c for c in candidates if c not in dropped], dropped, corrs, before, after)


def null_report(master: Master, k: int | None = None) -> DataFrame:
    """(source, stage, column, null_pct) before and after the join, the ``k`` worst columns of each source or all."""
    parts = []
    for stage, profiles in (("before", master.null_before), ("after", master.null_after)):
        for name, table in profiles.items():
            table = profile.top_missing(table, k) if k else table
            parts.append(table.select(F.lit(name).alias("source"), F.lit(stage).alias("stage"), "column", "null_pct"))
    return reduce(lambda a, b: a.unionByName(b), parts)


def write_master(master: Master, folder: str) -> None:
    """Feature list, Parquet and CSV."""
    sinks.write_feature_list(master.data.sparkSession, master.features, f"{folder}/final_feature_list")
    sinks.write_parquet(master.data, f"{folder}/master_parquet")
    sinks.write_csv(master.data, f"{folder}/master_csv")
