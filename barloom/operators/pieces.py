"""Rolling statistics put together from shorter windows.

A sliding frame re-reads its n rows for every row. Here a window of n rows is merged from a
few shorter windows instead: 252 = 4 x 60 + 12, 60 = 3 x 20, 20 = 4 x 5, each part taken
from an earlier row with ``lag``. The cost per row no longer grows with n, parts are shared
between windows, and because moments are merged around the common mean nothing cancels: a
constant window has a deviation of exactly zero.

A missing value makes every window that holds it NULL, and so does a window that reaches
back before the first row, which is the full-window rule. Formulas are SQL text.
"""

from __future__ import annotations

from collections.abc import Callable

from barloom.functions.text import num

LADDER = (1, 5, 20, 60)

Piece = tuple[int, dict[str, str]]  # size, column name or expression per field


def parts(n: int) -> list[tuple[int, int]]:
    """(size, offset) of the windows that make up n rows, newest first."""
    step = max(s for s in LADDER if s < n)
    k, rest = divmod(n, step)
    return [(step, i * step) for i in range(k)] + ([(rest, k * step)] if rest else [])


def _mean(pieces: list[Piece], field: str) -> str:
    """Weighted mean, written around the first part so that equal parts give it back exactly."""
    n = sum(size for size, _ in pieces)
    first = pieces[0][1][field]
    return " + ".join([first] + [f"({p[field]} - {first}) * {num(size / n)}" for size, p in pieces[1:]])


class Total:
    fields = ("sum",)

    def single(self, x: str) -> dict[str, str]:
        return {"sum": x}

    def merge(self, pieces: list[Piece], define: Callable) -> dict[str, str]:
        return {"sum": " + ".join(p["sum"] for _, p in pieces)}


class PartialTotal(Total):
    """Sum over the rows there are: a window cut off at the start still counts."""

    default = 0.0


class Moments:
    """Mean and central power sums M2..M4 (``order`` 2 or 4)."""

    def __init__(self, order: int):
        self.order = order
        self.fields = ("mean", "m2", "m3", "m4")[:order]

    def single(self, x: str) -> dict[str, str]:
        return {"mean": x, **{f: "0D" for f in self.fields[1:]}}

    def merge(self, pieces: list[Piece], define: Callable) -> dict[str, str]:
        mean = define("mean", _mean(pieces, "mean"))
        terms: dict[str, list[str]] = {f: [] for f in self.fields[1:]}
        for size, p in pieces:
            d = f"({p['mean']} - {mean})"
            # A single row has no spread of its own.
            own = {f: "" if size == 1 else f"{p[f]} + " for f in self.fields[1:]}
            w = num(size)
            terms["m2"].append(f"{own['m2']}{w} * {d} * {d}")
            if self.order > 2:
                m3 = "" if size == 1 else f"3D * {d} * {p['m2']} + "
                m4 = "" if size == 1 else f"4D * {d} * {p['m3']} + 6D * {d} * {d} * {p['m2']} + "
                terms["m3"].append(f"{own['m3']}{m3}{w} * {d} * {d} * {d}")
                terms["m4"].append(f"{own['m4']}{m4}{w} * {d} * {d} * {d} * {d}")
        return {"mean": mean, **{f: " + ".join(t) for f, t in terms.items()}}


class Comoments:
    """Means, square sums and the cross product of two series."""

    fields = ("ma", "mb", "aa", "bb", "ab")

    def single(self, a: str, b: str) -> dict[str, str]:
        return {"ma": a, "mb": b, "aa": "0D", "bb": "0D", "ab": "0D"}

    def merge(self, pieces: list[Piece], define: Callable) -> dict[str, str]:
        # Both means come before either is used, so that they share a step.
        sql = {m: _mean(pieces, m) for m in ("ma", "mb")}
        mean = {m: define(m, sql[m]) for m in sql}
        sums: dict[str, list[str]] = {"aa": [], "bb": [], "ab": []}
        for size, p in pieces:
            d = {"a": f"({p['ma']} - {mean['ma']})", "b": f"({p['mb']} - {mean['mb']})"}
            for f in sums:
                own = "" if size == 1 else f"{p[f]} + "
                sums[f].append(f"{own}{num(size)} * {d[f[0]]} * {d[f[1]]}")
        return {**mean, **{f: " + ".join(t) for f, t in sums.items()}}


class Extreme:
    """Largest or smallest value; works on structs (value, tie-break) too."""

    fields = ("ext",)

    def __init__(self, pick: str):
        self.pick = pick

    def single(self, x: str) -> dict[str, str]:
        return {"ext": x}

    def merge(self, pieces: list[Piece], define: Callable) -> dict[str, str]:
        cols = [p["ext"] for _, p in pieces]
        whole = " AND ".join(f"{c} IS NOT NULL" for c in cols)
        return {"ext": f"CASE WHEN {whole} THEN {self.pick}({', '.join(cols)}) END"}


KINDS = {
    "total": Total(),
    "partial": PartialTotal(),
    "moments": Moments(2),
    "shape": Moments(4),
    "comoments": Comoments(),
    "max": Extreme("greatest"),
    "min": Extreme("least"),
}
