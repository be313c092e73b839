"""Column staging: as few window passes as the definitions allow.

Spark does not nest window functions, so a feature that reads another windowed column needs
a later pass. ``Stages`` collects named definitions and places each window in the earliest
pass its inputs allow. All windows of one pass share a partitioning and a sort, whatever
their frames, so a whole pack costs one shuffle. Columns nobody reads any more are dropped
between passes, which keeps the rows that windows buffer narrow.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

from barloom.operators.lanes import OWN, RUN_ROWS, TILE, Lane, own_rows
from barloom.operators.pieces import KINDS, parts
from barloom.operators.scan import Scan, carried
from barloom.operators.sliding import Quantile, Share, slide

Spot = tuple[int, int]  # (pass, depth of scalar steps inside the pass)
LAST = 1 << 20  # the pass of sliding order statistics


class Stages:
    def __init__(self, lane: Lane, raw: list[str]):
        self.lane = lane
        self._ready: dict[str, Spot] = {c: (0, 0) for c in raw}
        self._made: dict[Spot, dict[str, tuple[str, tuple[str, ...]]]] = {}
        self._run_rows: int | None = None
        self._out: list[str] = []
        self._reach: dict[str, int] = {}
        self._own_only: set[str] = set()
        self._scans: dict[int, list[Scan]] = {}
        self._slides: list[Share | Quantile] = []

    # -- definitions -------------------------------------------------------------
    def has(self, name: str) -> bool:
        return name in self._ready

    def _put(self, spot: Spot, name: str, sql: str, inputs: tuple[str, ...], back: int = 0) -> str:
        self._made.setdefault(spot, {})[name] = (sql, inputs)
        self._reach[name] = back + max((self._reach.get(i, 0) for i in inputs), default=0)
        return name

    def win(self, name: str, call: str, window: str, *inputs: str, back: int = 0) -> str:
        """A window function call over the named inputs; ``back`` rows of history decide its value."""
        if name not in self._ready:
            if not self._own_only.isdisjoint(inputs) and back:
                raise ValueError(f"tiles hold no history of the recursive average behind {name}")
            at = max((self._ready[i][0] for i in inputs), default=0)
            if at == LAST:
                raise ValueError(f"{name} reads a sliding order statistic, which come after all windows")
            self._ready[name] = (at + 1, 0)
            self._put((at + 1, 0), name, f"{call} OVER {window}", inputs, back)
        return name

    def col(self, name: str, sql: str, *inputs: str) -> str:
        """A scalar expression over the named inputs."""
        if name not in self._ready:
            at = max(self._ready[i][0] for i in inputs)
            spot = at, 1 + max(d for p, d in (self._ready[i] for i in inputs) if p == at)
            self._ready[name] = spot
            self._put(spot, name, sql, inputs)
            if not self._own_only.isdisjoint(inputs):
                self._own_only.add(name)
        return name

    def scan(self, scan: Scan) -> None:
        """Carry a recursion from tile to tile; its columns can be read from the next pass on."""
        at = max(self._ready[i][0] for i in scan.inputs)
        self._scans.setdefault(at, []).append(scan)
        for c in scan.outputs:
            self._ready[c] = (at + 1, 0)
            self._reach[c] = max(self._reach.get(i, 0) for i in scan.inputs)
            self._own_only.add(c)

    def slide(self, ask: Share | Quantile) -> str:
        """An order statistic of the last rows; only scalar expressions can read it."""
        if ask.name not in self._ready:
            self.row_no()
            if ask.x in self._own_only or self._ready[ask.x][0] == LAST:
                raise ValueError(f"no window of {ask.x} to order")
            self._slides.append(ask)
            self._ready[ask.name] = (LAST, 0)
            self._reach[ask.name] = self._reach.get(ask.x, 0) + ask.n - 1
        return ask.name

    @property
    def reach(self) -> int:
        """Rows of history that the outputs look back on, recursions aside (their state is carried)."""
        return max((self._reach.get(c, 0) for c in [*self._out, *(i for x in self._scans.values() for s in x for i in s.inputs)]), default=0)

    def out(self, *names: str) -> None:
        self._out += [n for n in names if n not in self._out]

    def quietly(self, define, *args) -> None:
        """Run a definition without adding its columns to the output."""
        kept = list(self._out)
        define(self, *args)
        self._out = kept

    @property
    def outputs(self) -> list[str]:
        return list(self._out)

    # -- shared pieces -----------------------------------------------------------
    def row_no(self) -> str:
        return self.win("_n", "row_number()", self.lane.rows)

    def need_runs(self, log_decay: float) -> None:
        """Ask for runs short enough that ``exp(rows * log_decay)`` stays a finite double."""
        rows = max(1, min(RUN_ROWS, int(600 / log_decay)))
        self._run_rows = min(rows, self._run_rows or RUN_ROWS)
        for c in ("_n", "_run", "_run_end"):
            self._ready.setdefault(c, (0, 0))

    def lag(self, x: str, n: int = 1, default: float | None = None) -> str:
        tail = "" if default is None else f", {default}D"
        return self.win(f"_lag{'' if default is None else 0}_{x}_{n}", f"lag({x}, {n}{tail})", self.lane.rows, x, back=n)

    def pad(self, x: str) -> str:
        """Last value so far that is not missing."""
        return self.win(f"_pad_{x}", f"last({x}, true)", self.lane.so_far, x)

    def rolled(self, kind: str, n: int, *xs: str) -> dict[str, str]:
        """Full-window statistic of the last n rows, as column names per field."""
        how = KINDS[kind]
        tag = f"_{kind}_{'_'.join(xs)}_{n}"
        names = {f: f"{tag}_{f}" for f in how.fields}
        if all(self.has(c) for c in names.values()):
            return names
        default = getattr(how, "default", None)
        inputs: list[str] = []
        pieces = []
        for size, offset in parts(n) if n > 1 else [(1, 0)]:
            src = list(xs) if size == 1 else list(self.rolled(kind, size, *xs).values())
            got = [self.lag(c, offset, default) if offset else c for c in src]
            inputs += got
            pieces.append((size, how.single(*got) if size == 1 else dict(zip(how.fields, got))))

        def define(field: str, sql: str) -> str:
            inputs.append(self.col(names[field], sql, *inputs))
            return names[field]

        merged = how.merge(pieces, define) if n > 1 else pieces[0][1]
        for f in how.fields:
            self.col(names[f], merged[f], *inputs)
        return names

    def mean(self, x: str, n: int) -> str:
        total = self.rolled("total", n, x)["sum"]
        return self.col(f"_mean_{x}_{n}", f"{total} / {float(n)}D", total)

    def _moments(self, x: str, n: int) -> dict[str, str]:
        return self.rolled("shape" if self.has(f"_shape_{x}_{n}_m2") else "moments", n, x)

    def std_pop(self, x: str, n: int) -> str:
        m2 = self._moments(x, n)["m2"]
        return self.col(f"_stdp_{x}_{n}", f"sqrt({m2} / {float(n)}D)", m2)

    def std_samp(self, x: str, n: int) -> str:
        m2 = self._moments(x, n)["m2"]
        return self.col(f"_stds_{x}_{n}", f"sqrt({m2} / {float(n - 1)}D)", m2)

    def center(self, x: str, n: int) -> str:
        """The mean that goes with the deviations, exact on a constant window."""
        return self._moments(x, n)["mean"]

    # -- execution ---------------------------------------------------------------
    def build(self, df: DataFrame, keep: list[str] | None = None, drop_halo: bool = True) -> DataFrame:
        """``keep`` (default: the columns of ``df``) plus the outputs."""
        keep = [c for c in df.columns if not c.startswith("_")] if keep is None else list(keep)
        layout = [TILE, OWN] if self.lane.tiled else []
        final = [*keep, *[c for c in self._out if c not in keep]]
        final += [c for c in layout if drop_halo and c not in final]
        frame = {*self.lane.keys, self.lane.order, "_run", *final}

        made = {spot: dict(defs) for spot, defs in self._made.items()}
        if self._run_rows is None:
            df = df.selectExpr("*", "0 AS _run")
        else:
            df = df.selectExpr("*", f"row_number() OVER {self.lane.by_time} AS _n").selectExpr(
                "*", f"(_n - 1) DIV {self._run_rows} AS _run", f"_n % {self._run_rows} = 0 AS _run_end"
            )
            made.get((1, 0), {}).pop("_n", None)
        # The scans of a pass follow its last step.
        spots: dict[tuple, dict | list[Scan]] = {spot: defs for spot, defs in made.items() if defs}
        spots |= {(at, math.inf): scans for at, scans in self._scans.items()}
        if self._slides:
            spots[LAST, 0] = tuple(self._slides)
        steps = [spots[spot] for spot in sorted(spots)]
        last_read: dict[str, int] = {}
        for i, step in enumerate(steps):
            reads = [d[1] for d in step.values()] if isinstance(step, dict) else [s.inputs if isinstance(s, Scan) else (s.x, "_n") for s in step]
            for inputs in reads:
                last_read.update(dict.fromkeys(inputs, i))
        have = list(df.columns)
        for i, step in enumerate(steps):
            have = [c for c in have if c in frame or last_read.get(c, -1) >= i]
            if isinstance(step, dict):
                df = df.selectExpr(*[f"`{c}`" for c in have], *[f"{sql} AS `{c}`" for c, (sql, _) in step.items()])
                have += step
            elif isinstance(step, tuple):
                # Windows left the rows in this order; stated again, it costs no sort.
                df = df.select(*[f"`{c}`" for c in have]).sortWithinPartitions(*self.lane.keys, "_run", self.lane.order)
                df = slide(df, step)
                have += [a.name for a in step]
            else:
                df = carried(df.select(*[f"`{c}`" for c in have]), self.lane, step)
                have += [c for s in step for c in s.outputs]
        df = df.selectExpr(*[f"`{c}`" for c in final])
        return own_rows(df, self.lane) if drop_halo else df


def log_decay(alpha: float) -> float:
    return -math.log1p(-alpha)
