"""An associative scan of affine maps: the state of recursive averages from tile to tile.

Inside a run of rows a recursion is one affine map ``y -> product * y + local`` of the state before it. Maps compose, so
the state after any number of rows is a fold of maps. Three levels keep every fold short and nothing whole in one
place: rows fold into runs (running sums, see ``recursive``), the runs of a tile into one map of the tile, and the maps of
a symbol's tiles into states by doubling (each pass composes a tile with the tile 2**k before it). A tile's map includes
its first value, whose weight depends on the rows since the last value in an earlier tile, and those are counted
exactly. One row per tile goes through the doubling; the rows of the table are read once and joined back by tile.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.functions.cells import is_true
from barloom.operators.lanes import OWN, TILE, Lane
from barloom.session import settle


@dataclass(frozen=True)
class Average:
    """A recursion with weight ``alpha``; ``product`` and ``local`` are the map of a row's run up to the row."""

    name: str
    alpha: float
    product: str
    local: str

    @property
    def carry(self) -> str:
        """State at the end of the run before, at the tile's first value for the first run."""
        return f"_c_{self.name}"

    @property
    def before(self) -> str:
        """State at the end of the tile before."""
        return f"_y0_{self.name}"


@dataclass(frozen=True)
class Scan:
    """Averages of one series under the tag ``x``; ``own`` is the series on the tile's own rows, ``seen`` counts its values."""

    x: str
    own: str
    seen: str
    averages: tuple[Average, ...]

    @property
    def seen_before(self) -> str:
        return f"_seen0_{self.x}"

    @property
    def inputs(self) -> tuple[str, ...]:
        return (OWN, "_n", "_run", "_run_end", self.own, self.seen, *[c for a in self.averages for c in (a.product, a.local)])

    @property
    def outputs(self) -> tuple[str, ...]:
        return (self.seen_before, *[c for a in self.averages for c in (a.carry, a.before)])


def carried(df: DataFrame, lane: Lane, scans: list[Scan]) -> DataFrame:
    """``df`` with the state columns of ``scans`` added."""
    df = settle(df)
    rows = df.filter(is_true(F.col(OWN)))
    averages = [a for s in scans for a in s.averages]
    maps = F.struct("_run", *[c for a in averages for c in (a.product, a.local)])
    facts = [F.count("*").alias("own_rows"), F.min("_n").alias("start")]
    for s in scans:
        at = F.when(F.col(s.own).isNotNull(), F.col("_n"))
        facts += [F.min(at).alias(f"first_{s.x}"), F.max(at).alias(f"last_{s.x}"), F.max(s.seen).alias(f"seen_{s.x}")]
        facts.append(F.min_by(s.own, at).alias(f"value_{s.x}"))
    # One map per run: full runs end at a marked row, the tile's last run at its last row.
    facts.append(F.collect_list(F.when(is_true(F.col("_run_end")), maps)).alias("runs"))
    facts.append(F.max_by(maps, "_n").alias("tail"))
    tiles = settle(rows.groupBy(*lane.keys).agg(*facts).withColumn("runs", F.sort_array("runs")))

    earlier = Window.partitionBy(*lane.symbol_keys).orderBy(TILE)
    so_far = earlier.rowsBetween(Window.unboundedPreceding, -1)
    tiles = tiles.withColumn("base", F.coalesce(F.sum("own_rows").over(so_far), F.lit(0)) - F.col("start"))
    for s in scans:
        tiles = tiles.withColumns(
            {
                s.seen_before: F.coalesce(F.sum(f"seen_{s.x}").over(so_far), F.lit(0)),
                f"gap_{s.x}": F.col("base") + F.col(f"first_{s.x}") - F.max(F.col("base") + F.col(f"last_{s.x}")).over(so_far),
            }
        )
    whole: dict[str, Column] = {}
    for s in scans:
        for a in s.averages:
            p, t = _tile_map(s, a)
            whole |= {f"p_{a.name}": p, f"t_{a.name}": t}
    tiles = tiles.withColumns(whole)
    most = tiles.groupBy(*lane.symbol_keys).count().agg(F.max("count")).first()[0] or 1
    # After pass k a tile's map covers the 2**k tiles up to it.
    back = 1
    while back < most:
        composed = {}
        for a in averages:
            p, t = f"p_{a.name}", f"t_{a.name}"
            composed[p] = F.col(p) * F.coalesce(F.lag(p, back).over(earlier), F.lit(1.0))
            composed[t] = F.col(t) + F.when(F.col(p) == 0, 0.0).otherwise(F.col(p) * F.coalesce(F.lag(t, back).over(earlier), F.lit(0.0)))
        tiles = tiles.withColumns(composed)
        back *= 2
    tiles = tiles.withColumns(
        {a.before: F.when(F.col(s.seen_before) > 0, F.lag(f"t_{a.name}").over(earlier)) for s in scans for a in s.averages}
    )
    tiles = tiles.withColumns({f"y_{a.name}": _after_first(s, a, F.col(a.before)) for s in scans for a in s.averages})
    states = {f"states_{a.name}": _run_states(a, F.col(f"y_{a.name}")) for a in averages}
    tiles = tiles.withColumns(states).select(
        *lane.keys, *[s.seen_before for s in scans], *[c for a in averages for c in (a.before, f"states_{a.name}")], (F.expr("get(runs, 0)._run")).alias("run0")
    )
    # A tile's first own row may stand inside a run that its halo began.
    joined = df.join(tiles, list(lane.keys), "left")
    at = F.coalesce(F.col("_run") - F.col("run0"), F.lit(0)).cast("int")
    joined = joined.withColumns({a.carry: F.get(F.col(f"states_{a.name}"), F.greatest(at, F.lit(0))) for a in averages})
    return joined.select(*df.columns, *[c for s in scans for c in s.outputs])


def _map_of(r: Column, a: Average, acc: Column) -> Column:
    return r[a.product] * acc + r[a.local]


def _run_states(a: Average, first: Column) -> Column:
    """State before each run of the tile, in order."""
    step = lambda acc, r: F.concat(acc, F.array(_map_of(r, a, F.element_at(acc, -1))))
    return F.aggregate("runs", F.array(first), step)


def _tile_map(s: Scan, a: Average) -> tuple[Column, Column]:
    """The map of the state before a tile to the state after it."""
    ends = F.when(F.get("runs", F.size("runs") - 1)["_run"] == F.col("tail._run"), F.col("runs"))
    ends = F.coalesce(ends, F.concat("runs", F.array("tail")))
    product = F.aggregate(ends, F.lit(1.0), lambda acc, r: acc * r[a.product])
    local = F.aggregate(ends, F.lit(0.0), lambda acc, r: _map_of(r, a, acc))
    decay = 1.0 - _first_weight(s, a)
    none, alone = F.col(f"seen_{s.x}") == 0, F.col(f"gap_{s.x}").isNull()
    value = F.col(f"value_{s.x}")
    p = F.when(none, 1.0).when(alone, 0.0).otherwise(product * decay)
    t = F.when(none, 0.0).when(alone, product * value + local).otherwise(product * _first_weight(s, a) * value + local)
    return p, t


def _first_weight(s: Scan, a: Average) -> Column:
    """Weight of the tile's first value against the state before it."""
    old = F.pow(F.lit(1.0 - a.alpha), F.col(f"gap_{s.x}"))
    return F.when(F.col(f"gap_{s.x}") == 1, F.lit(a.alpha)).otherwise(F.lit(a.alpha) / (old + F.lit(a.alpha)))


def _after_first(s: Scan, a: Average, before: Column) -> Column:
    w, value = _first_weight(s, a), F.col(f"value_{s.x}")
    return F.when(F.col(f"gap_{s.x}").isNull(), value).otherwise((1.0 - w) * before + w * value)
