"""Regular-expression matches with code-point offsets, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

SPAN = "array<struct<start:int,end:int,value:string>>"


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost non-overlapping matches of ``pattern``: array of (start, end, value).

    ``value`` is the given group. Offsets count code points, the end is exclusive. The gaps
    between matches come from splitting at the same pattern; their lengths give the offsets.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = hits if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(hits))
    parts = F.zip_with(
        F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("len"))),
        values,
        lambda p, v: F.struct(p["gap"].alias("gap"), p["len"].alias("len"), v.alias("value")),
    )
    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + p["gap"]
        span = F.struct(begin.alias("start"), (begin + p["len"]).alias("end"), p["value"].alias("value"))
        return F.struct((begin + p["len"]).alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    found = F.aggregate(parts, start, step, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), found).otherwise(none)


def kept(spans: Column, keep: Callable[[Column], Column]) -> Column:
    return F.filter(spans, lambda s: keep(s["value"]))


def joined(kinds: dict[str, Column], by_start: bool) -> Column:
    """``kind:start:end`` of all spans, comma-joined; by start then kind, or by kind then start."""

    def ranks(rank: int, spans: Column) -> Column:
        order = (lambda s: (s["start"], F.lit(rank))) if by_start else (lambda s: (F.lit(rank), s["start"]))
        return F.transform(spans, lambda s: F.struct(order(s)[0].alias("a"), order(s)[1].alias("b"), s["end"].alias("e")))

    ranked = [ranks(rank, spans) for rank, spans in enumerate(kinds.values())]
    names = F.array(*[F.lit(k) for k in kinds])
    kind, start = ("b", "a") if by_start else ("a", "b")
    text = F.transform(
        F.array_sort(F.concat(*ranked)),
        lambda s: F.concat_ws(":", F.get(names, s[kind]), s[start].cast("string"), s["e"].cast("string")),
    )
    return F.array_join(text, ",")
