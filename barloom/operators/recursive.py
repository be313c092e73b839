"""Exponential averages as window sums.

The recursion ``y = a*y' + b`` (weights as in an unadjusted average: a missing value holds
the output while its weight keeps decaying, leading missing values are skipped) unrolls to

    y = P * (carry + sum(b / P)),     P = product of a since the run began

so inside a run of bounded length it is one running sum, and the running product is a power
of the decay. Runs are short enough that P stays a normal double. The carry folds the
(P, sum) pairs of the runs before, one pair per run. In the tiled layout it comes from a scan of these affine maps
over runs and tiles (``scan``), so it is exact however far the history reaches.
"""

from __future__ import annotations

from barloom.functions.text import num
from barloom.operators.lanes import OWN
from barloom.operators.scan import Average, Scan
from barloom.operators.stages import Stages, log_decay


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1.0)


def ema(b: Stages, x: str, averages: dict[str, float]) -> str:
    """Define the averages ``name -> alpha`` of ``x``. They hold over gaps and are not gated.

    Returns the name of the running count of values, for minimum-periods rules.
    """
    if b.lane.tiled:
        return _tiled_ema(b, x, averages)
    lane = b.lane
    seen = b.win(f"_obs_{x}", f"count({x})", lane.so_far, x)
    todo = {}
    for name, alpha in averages.items():
        if alpha >= 1.0:
            b.win(name, f"last({x}, true)", lane.so_far, x)
        elif not b.has(name):
            todo[name] = alpha
    if not todo:
        return seen
    b.need_runs(log_decay(max(todo.values())))
    prev = b.win(f"_prev_{x}", f"last(CASE WHEN {x} IS NOT NULL THEN _n END, true)", lane.before, x, "_n")
    gap = b.col(f"_gap_{x}", f"_n - {prev}", "_n", prev)
    in_run = b.win(f"_inrun_{x}", f"count({x})", lane.in_run, x, "_run")
    pairs = []
    for name, alpha in todo.items():
        q, a = num(1.0 - alpha), num(alpha)
        weight = f"pow({q}, {gap})"
        # A gap of more than one row changes the decay of the next value; else this is zero.
        extra = b.win(
            f"_extra_{name}",
            f"sum(CASE WHEN {x} IS NOT NULL AND {gap} > 1"
            f" THEN ln({weight} / ({weight} + {a})) + {num(log_decay(alpha))} END)",
            lane.in_run,
            x,
            gap,
        )
        product = b.col(f"_p_{name}", f"pow({q}, {in_run}) * exp(coalesce({extra}, 0D))", in_run, extra)
        step = (
            f"CASE WHEN {gap} IS NULL THEN {x} WHEN {gap} = 1 THEN {a} * {x}"
            f" ELSE {a} * {x} / ({weight} + {a}) END"
        )
        total = b.win(
            f"_s_{name}",
            f"sum(CASE WHEN {x} IS NOT NULL THEN ({step}) / {product} END)",
            lane.in_run,
            x,
            gap,
            product,
        )
        pairs.append((name, product, b.col(f"_l_{name}", f"{product} * coalesce({total}, 0D)", product, total)))
    parts = [c for _, p, local in pairs for c in (p, local)]
    ends = b.win(
        f"_ends_{'_'.join(todo)}",
        f"collect_list(CASE WHEN _run_end THEN struct({', '.join(parts)}) END)",
        lane.before,
        "_run_end",
        *parts,
    )
    for name, product, local in pairs:
        carry = f"aggregate({ends}, 0D, (acc, r) -> r.{product} * acc + r.{local})"
        b.col(name, f"CASE WHEN {seen} > 0 THEN {product} * {carry} + {local} END", product, local, ends, seen)
    return seen


def _tiled_ema(b: Stages, x: str, averages: dict[str, float]) -> str:
    """The same over tiles. A tile's own rows start from the state that the tiles before leave: its first value
    meets that state over the true gap, and the steps after it are summed as above."""
    lane, total = b.lane, f"_seen_{x}"
    own = b.col(f"_own_{x}", f"CASE WHEN {OWN} THEN {x} END", x, OWN)
    todo = {n: a for n, a in averages.items() if not b.has(n)}
    if not todo:
        return total
    tag = f"{x}_{min(todo)}"
    slow = [a for a in todo.values() if a < 1.0]
    b.need_runs(log_decay(max(slow)) if slow else 1.0)
    seen = b.win(f"_obs_{x}", f"count({own})", lane.so_far, own)
    prev = b.win(f"_prev_{x}", f"last(CASE WHEN {own} IS NOT NULL THEN _n END, true)", lane.before, own, "_n")
    gap = b.col(f"_gap_{x}", f"_n - {prev}", "_n", prev)
    value = f"{own} IS NOT NULL AND {gap} IS NOT NULL"
    in_run = b.win(f"_inrun_{x}", f"count(CASE WHEN {value} THEN 1 END)", lane.in_run, own, gap, "_run")
    parts = []
    for name, alpha in todo.items():
        q, a = num(1.0 - alpha), num(alpha)
        if alpha >= 1.0:
            product = b.col(f"_p_{name}", f"CASE WHEN {in_run} = 0 THEN 1D ELSE 0D END", in_run)
            last = b.win(f"_s_{name}", f"last(CASE WHEN {value} THEN {own} END, true)", lane.in_run, own, gap)
            local = b.col(f"_l_{name}", f"coalesce({last}, 0D)", last)
        else:
            weight = f"pow({q}, {gap})"
            extra = b.win(
                f"_extra_{name}",
                f"sum(CASE WHEN {value} AND {gap} > 1 THEN ln({weight} / ({weight} + {a})) + {num(log_decay(alpha))} END)",
                lane.in_run,
                own,
                gap,
            )
            product = b.col(f"_p_{name}", f"pow({q}, {in_run}) * exp(coalesce({extra}, 0D))", in_run, extra)
            step = f"CASE WHEN {gap} = 1 THEN {a} * {own} ELSE {a} * {own} / ({weight} + {a}) END"
            summed = b.win(f"_s_{name}", f"sum(CASE WHEN {value} THEN ({step}) / {product} END)", lane.in_run, own, gap, product)
            local = b.col(f"_l_{name}", f"{product} * coalesce({summed}, 0D)", product, summed)
        parts.append(Average(name, alpha, product, local))
    scan = Scan(tag, own, seen, tuple(parts))
    b.scan(scan)
    b.col(total, f"{seen} + {scan.seen_before}", seen, scan.seen_before)
    for p in parts:
        # Before the tile's first value the state of the tiles before holds.
        held = f"CASE WHEN {seen} = 0 THEN {p.before} ELSE {p.product} * {p.carry} + {p.local} END"
        b.col(p.name, held, seen, p.before, p.product, p.carry, p.local)
    return total
