"""Lanes: how ordered rows are spread over tasks for window work.

A lane is the partitioning every window of a feature pack uses. Two layouts give the same
results:

* **by key**: one lane per symbol. One shuffle, no copies. Right whenever a symbol's row
  count is bounded, as with dated bars (at most 366 rows a year under the one-bar-per-date
  contract).
* **tiled**: a symbol is cut into tiles of ``tile_rows`` complete bars, and each tile also
  receives the last ``halo_rows`` complete bars before it. A symbol that holds a third of
  the data is spread over as many tasks as it has tiles. Halo rows give rolling functions their history and are
  dropped at the end; the state of recursive averages is carried from tile to tile (see ``scan``).

Tiles are counted in complete bars (no missing price), so a stretch of missing values never
shortens the history a tile sees.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.functions.cells import is_true

TILE = "_tile"
OWN = "_own"
PRICES = ("open", "high", "low", "close")

# Above this many rows per symbol an intraday series is tiled.
ROWS_PER_LANE = 200_000
TILE_ROWS = 65_536
# The least halo; ``technical.compute`` asks for as many rows as its longest window looks back on.
HALO_ROWS = 300
# Recursive averages work in runs of this many rows (see ``recursive``).
RUN_ROWS = 1_024


@dataclass(frozen=True)
class Lane:
    """Window clauses for one layout of a frame."""

    keys: tuple[str, ...]
    order: str
    tiled: bool = False
    symbol_keys: tuple[str, ...] = field(default=())

    def _spec(self, keys: tuple[str, ...], order: tuple[str, ...], frame: str = "") -> str:
        part = f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} " if keys else ""
        return f"({part}ORDER BY {', '.join(f'`{o}`' for o in order)}{frame})"

    # The run number leads the sort so that windows per lane and per run share one sort.
    @property
    def rows(self) -> str:
        return self._spec(self.keys, ("_run", self.order))

    @property
    def by_time(self) -> str:
        return self._spec(self.keys, (self.order,))

    @property
    def so_far(self) -> str:
        return self._spec(self.keys, ("_run", self.order), " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")

    @property
    def before(self) -> str:
        return self._spec(self.keys, ("_run", self.order), " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING")

    @property
    def in_run(self) -> str:
        return self._spec(
            (*self.keys, "_run"), (self.order,), " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
        )


def _complete(df: DataFrame) -> Column:
    cond = F.lit(True)
    for c in PRICES:
        if c in df.columns:
            cond = cond & F.col(c).isNotNull()
    return cond


def needs_tiles(df: DataFrame, keys: tuple[str, ...], order: str, limit: int = ROWS_PER_LANE) -> bool:
    """Whether some symbol is too long for one task.

    Dated bars are bounded by the calendar and need no look at the data. For timestamps one
    narrow aggregate (map-side combined, one row back) finds the longest symbol.
    """
    if dict(df.dtypes)[order] == "date":
        return False
    longest = df.groupBy(*keys).count().agg(F.max("count")).first()[0]
    return (longest or 0) > limit


def lay(
    df: DataFrame,
    keys: tuple[str, ...] = ("symbol",),
    order: str = "ts",
    layout: str = "auto",
    tile_rows: int = TILE_ROWS,
    halo_rows: int = HALO_ROWS,
    bucket: str = "day",
) -> tuple[DataFrame, Lane]:
    """Spread ``df`` over lanes. ``layout`` is ``auto``, ``key`` or ``tiled``."""
    keys = tuple(keys)
    if layout == "auto":
        layout = "tiled" if needs_tiles(df, keys, order) else "key"
    if layout == "key":
        return df, Lane(keys, order, False, keys)
    if halo_rows > tile_rows:
        raise ValueError("halo_rows must not exceed tile_rows")
    return _tile(df, keys, order, tile_rows, halo_rows, bucket), Lane((*keys, TILE), order, True, keys)


def _tile(df, keys, order, tile_rows, halo_rows, bucket):
    # Position of each row among the symbol's complete bars, without ever putting a whole
    # symbol in one task: count per time bucket, accumulate the small counts, then number
    # rows inside their bucket. The numbering and the join share one shuffle.
    df = df.withColumn("_bucket", F.date_trunc(bucket, order))
    part = [*keys, "_bucket"]
    tally = df.groupBy(*part).agg(F.count_if(_complete(df)).alias("_in_bucket"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    tally = tally.select(*part, F.coalesce(F.sum("_in_bucket").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    numbered = (
        df.withColumn("_seen", F.sum(_complete(df).cast("long")).over(inside))
        .join(tally, part, "left")
        .withColumn("_seq", F.greatest(F.coalesce("_offset", F.lit(0)) + F.col("_seen") - 1, F.lit(0)))
    )
    home = F.floor(F.col("_seq") / F.lit(tile_rows)).cast("long")
    near_end = F.col("_seq") % F.lit(tile_rows) >= tile_rows - halo_rows
    return (
        numbered.withColumn("_home", home)
        .withColumn(TILE, F.explode(F.when(near_end, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))))
        .withColumn(OWN, F.col(TILE) == F.col("_home"))
        .drop("_bucket", "_seen", "_offset", "_seq", "_home")
    )


def own_rows(df: DataFrame, lane: Lane) -> DataFrame:
    """Drop halo copies and layout columns."""
    if lane.tiled:
        df = df.filter(is_true(F.col(OWN)))
    return df.drop(TILE, OWN)
