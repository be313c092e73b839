"""Market regimes: a Gaussian hidden Markov model shared by all symbols.

Each symbol is one sequence, cut into blocks of bounded length that are packed once, one row per block. Over a block the
recursions are products of small matrices, so a block is summed up in one matrix of its states; a scan over these matrices
gives every block the state of what lies before and after it, and the block's own rows follow by themselves. Sums
and products serve the probabilities, maxima and sums of logarithms the most likely path. An EM step is a map over the
packed blocks followed by one sum: only the summed statistics (states x inputs numbers) reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from barloom.functions.cells import clip
from barloom.functions.market import price_forecast
from barloom.operators import align
from barloom.operators.lanes import TILE, lay
from barloom.session import settle, ship_package


@dataclass(frozen=True)
class Regimes:
    """Start, transition, mean and variance tables; rows are states, columns inputs."""

    inputs: tuple[str, ...]
    start: np.ndarray
    move: np.ndarray
    mean: np.ndarray
    var: np.ndarray
    log_likelihood: tuple[float, ...] = ()

    @property
    def states(self) -> int:
        return len(self.start)


BLOCK_ROWS = 8_192
# More dates than this are no calendar of trading days.
CALENDAR_ROWS = 8_192
# States at block bounds are sent to all tasks up to this size; beyond it they are joined.
BROADCAST_BYTES = 32 << 20


def pack(df: DataFrame, inputs: Sequence[str], by: str = "symbol", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(symbol, block, ts array, values array in time order), complete rows only. Rows of one symbol and time are
    ordered by their values."""
    z = F.array(*[F.col(f"`{c}`").cast("double") for c in inputs])
    rows = df.na.drop(subset=list(inputs)).select(F.col(by), "ts", z.alias("z"))
    if dict(df.dtypes)["ts"] == "date" and block_rows >= CALENDAR_ROWS:
        blocks = rows.withColumn(TILE, F.lit(0).cast("long"))  # a date occurs once
    else:
        bucket = "month" if dict(df.dtypes)["ts"] == "date" else "day"
        blocks, _ = lay(settle(rows), (by,), "ts", "tiled", tile_rows=block_rows, halo_rows=0, bucket=bucket)
    packed = blocks.groupBy(by, F.col(TILE).alias("block")).agg(F.sort_array(F.collect_list(F.struct("ts", "z"))).alias("r"))
    return packed.select(by, "block", F.col("r.ts").alias("ts"), F.col("r.z").alias("z"))


# -- sequence recursions, over a batch of sequences at once ---------------------------------
def _stack(values: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Sequences padded to one block (sequence, time, input) and their lengths."""
    seqs = [np.stack(v) if len(v) else np.zeros((0, 1)) for v in values]
    n = np.array([len(s) for s in seqs])
    block = np.zeros((len(seqs), max(n.max(), 1), max(s.shape[1] for s in seqs)))
    for i, s in enumerate(seqs):
        block[i, : len(s), : s.shape[1]] = s
    return block, n


def _log_density(m: Regimes, z: np.ndarray) -> np.ndarray:
    d = z[:, :, None, :] - m.mean
    return -0.5 * (np.log(2 * np.pi * m.var).sum(-1) + (d * d / m.var).sum(-1))


def _densities(m: Regimes, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Densities scaled to one at the best state of each row, and the logarithm of that scale."""
    logb = _log_density(m, z)
    top = logb.max(-1, keepdims=True)
    return np.exp(logb - top), top[:, :, 0]


def _forward(m: Regimes, z: np.ndarray, n: np.ndarray, first: np.ndarray):
    """Filtered state probabilities, scaled densities, scales and the log-likelihood per block. ``first`` is the
    distribution of a block's first state given all before it."""
    dens, top = _densities(m, z)
    alpha, scale = np.zeros_like(dens), np.ones(dens.shape[:2])
    loglik = np.zeros(len(n))
    for t in range(dens.shape[1]):
        live = t < n
        a = (first if t == 0 else alpha[:, t - 1] @ m.move) * dens[:, t]
        c = np.where(live, a.sum(-1), 1.0)
        alpha[:, t] = np.where(live[:, None], a / c[:, None], alpha[:, t - 1] if t else first)
        scale[:, t] = c
        loglik += np.where(live, np.log(c) + top[:, t], 0.0)
    return alpha, dens, scale, loglik


def _backward(m: Regimes, alpha: np.ndarray, dens: np.ndarray, scale: np.ndarray, n: np.ndarray, after: np.ndarray) -> np.ndarray:
    """``after`` weighs the last state of a block by what follows; ``alpha . beta`` is one in every row."""
    beta = np.repeat((after / (alpha[:, -1] * after).sum(-1, keepdims=True))[:, None], dens.shape[1], axis=1)
    for t in range(dens.shape[1] - 2, -1, -1):
        b = (dens[:, t + 1] * beta[:, t + 1] / scale[:, t + 1, None]) @ m.move.T
        beta[:, t] = np.where((t + 1 < n)[:, None], b, beta[:, t + 1])
    return beta


def _smooth(m: Regimes, z: np.ndarray, n: np.ndarray, first: np.ndarray, after: np.ndarray):
    alpha, dens, scale, loglik = _forward(m, z, n, first)
    beta = _backward(m, alpha, dens, scale, n, after)
    gamma = alpha * beta
    gamma /= np.maximum(gamma.sum(-1, keepdims=True), 1e-300)
    return alpha, beta, gamma, dens, scale, loglik


def _block_maps(m: Regimes, z: np.ndarray, n: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Of each block the matrix from the state before it to the state at its end, up to a factor. The first block of a
    symbol starts from the state of its own first row."""
    dens, _ = _densities(m, z)
    step = np.where(opens[:, None, None], np.eye(m.states), m.move)
    out = step * dens[:, 0, None, :]
    for t in range(1, dens.shape[1]):
        nxt = (out @ m.move) * dens[:, t, None, :]
        nxt /= np.maximum(nxt.max((1, 2), keepdims=True), 1e-300)
        out = np.where((t < n)[:, None, None], nxt, out)
    return out


def _logs(m: Regimes) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(divide="ignore"):
        return np.log(m.start), np.log(m.move)


def _best_maps(m: Regimes, z: np.ndarray, n: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The same with the best logarithm in place of the sum: the score of the best way from each state to each."""
    _, log_move = _logs(m)
    logb = _log_density(m, z)
    with np.errstate(divide="ignore"):
        here = np.log(np.eye(m.states))
    out = np.where(opens[:, None, None], here, log_move) + logb[:, 0, None, :]
    for t in range(1, logb.shape[1]):
        nxt = (out[:, :, :, None] + log_move).max(2) + logb[:, t, None, :]
        out = np.where((t < n)[:, None, None], nxt, out)
    return out


def _best_path(m: Regimes, z: np.ndarray, n: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Most likely states of each block, given the scores of its first state and the state it ends in (-1: any)."""
    _, log_move = _logs(m)
    logb = _log_density(m, z)
    score, back = first + logb[:, 0], np.zeros(logb.shape, dtype=int)
    for t in range(1, logb.shape[1]):
        step = score[:, :, None] + log_move
        back[:, t] = step.argmax(1)
        score = np.where((t < n)[:, None], step.max(1) + logb[:, t], score)
    path = np.zeros(logb.shape[:2], dtype=int)
    state = np.where(last >= 0, last, score.argmax(-1))
    rows = np.arange(len(n))
    for t in range(logb.shape[1] - 1, -1, -1):
        path[:, t] = state
        inside = (t > 0) & (t < n)
        state = np.where(inside, back[rows, t, state], state)
    return path


BLOCKS = 128  # blocks worked on at a time


def _batches(frame: pd.DataFrame, size: int = BLOCKS) -> Iterator[pd.DataFrame]:
    for i in range(0, len(frame), size):
        yield frame.iloc[i : i + size]


# -- the scan over blocks -------------------------------------------------------------------
def _bounds(packed: DataFrame, m: Regimes, by: str, best: bool) -> DataFrame:
    """For every block ``before`` and ``after``: state weights at its bounds, or for the best path the state it starts
    from (-1: none) and ends in. One matrix per block goes through the scan, in the order of the symbol's blocks."""

    def maps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in _batches(frame):
                z, n = _stack(part["z"])
                made = (_best_maps if best else _block_maps)(m, z, n, part["block"].to_numpy() == 0)
                yield pd.DataFrame({by: part[by].values, "block": part["block"].values, "map": [x.ravel().tolist() for x in made]})

    def sums(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("block")
        each = np.stack(blocks["map"]).reshape(-1, m.states, m.states)
        before, after = np.empty(each.shape[:2]), np.empty(each.shape[:2])
        v, u = m.start, np.ones(m.states)
        for i, x in enumerate(each):
            before[i] = v
            v = v @ x
            v = v / v.sum()
        for i in range(len(each) - 1, -1, -1):
            after[i] = u
            u = each[i] @ u
            u = u / u.max()
        return pd.DataFrame({by: blocks[by], "block": blocks["block"], "before": before.tolist(), "after": after.tolist()})

    def tops(blocks: pd.DataFrame) -> pd.DataFrame:
        blocks = blocks.sort_values("block")
        each = np.stack(blocks["map"]).reshape(-1, m.states, m.states)
        v, back = _logs(m)[0], []
        for x in each:
            step = v[:, None] + x
            back.append(step.argmax(0))
            v = step.max(0)
        ends, state = np.empty(len(each), int), int(v.argmax())
        for i in range(len(each) - 1, -1, -1):
            ends[i], state = state, int(back[i][state])
        starts = np.concatenate([[-1], ends[:-1]])
        rows = [([float(a)], [float(b)]) for a, b in zip(starts, ends)]
        return pd.DataFrame({by: blocks[by], "block": blocks["block"], "before": [r[0] for r in rows], "after": [r[1] for r in rows]})

    kind = dict(packed.dtypes)[by]
    made = packed.select(by, "block", "z").mapInPandas(maps, f"`{by}` {kind}, block long, map array<double>")
    return made.groupBy(by).applyInPandas(tops if best else sums, f"`{by}` {kind}, block long, before array<double>, after array<double>")


def _blocks(packed: DataFrame) -> tuple[int, int]:
    """Number of blocks, and of the last block of a symbol."""
    row = packed.agg(F.count("*"), F.max("block")).first()
    return row[0], row[1] or 0


def _bounded(packed: DataFrame, m: Regimes, by: str, best: bool = False, size: tuple[int, int] | None = None) -> DataFrame:
    """``packed`` with ``before`` and ``after``."""
    blocks, last = size or _blocks(packed)
    if last == 0:
        if best:
            return packed.withColumns({"before": F.array(F.lit(-1.0)), "after": F.array(F.lit(-1.0))})
        return packed.withColumns({"before": F.array(*map(F.lit, m.start.tolist())), "after": F.array(*[F.lit(1.0)] * m.states)})
    bounds = _bounds(packed, m, by, best)
    if blocks * (2 * m.states + 8) * 8 <= BROADCAST_BYTES:
        bounds = F.broadcast(bounds)
    return packed.join(bounds, [by, "block"])


def _firsts(m: Regimes, part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether a block opens its symbol, the distribution of its first state, and the weights of its last."""
    opens = part["block"].to_numpy() == 0
    before, after = np.stack(part["before"]), np.stack(part["after"])
    return opens, np.where(opens[:, None], m.start, before @ m.move), after


def _statistics(m: Regimes):
    """Map function: packed blocks to one row of summed expected counts per batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for part in _batches(frame):
                z, n = _stack(part["z"])
                opens, first, after = _firsts(m, part)
                alpha, beta, gamma, dens, scale, loglik = _smooth(m, z, n, first, after)
                live = np.arange(z.shape[1])[None, :] < n[:, None]
                g = gamma * live[:, :, None]
                nxt = dens * beta / scale[:, :, None] * live[:, :, None]
                moves = np.einsum("sti,ij,stj->ij", alpha[:, :-1], m.move, nxt[:, 1:])
                # The step from the block before.
                moves += np.einsum("si,ij,sj->ij", np.stack(part["before"])[~opens], m.move, nxt[~opens, 0])
                stats = [g[opens, 0].sum(0), moves, g.sum((0, 1)), np.einsum("stk,std->kd", g, z), np.einsum("stk,std->kd", g, z * z)]
                yield pd.DataFrame({"v": [np.concatenate([s.ravel() for s in stats] + [[loglik.sum()]]).tolist()]})

    return run


def em_step(packed: DataFrame, m: Regimes, floor: float = 1e-6, by: str = "symbol", size: tuple[int, int] | None = None) -> tuple[Regimes, float]:
    """The next parameters, and the log-likelihood of the given ones."""
    k, d = m.states, len(m.inputs)
    width = k + k * k + k + 2 * k * d + 1
    counted = _bounded(packed, m, by, size=size).select("block", "z", "before", "after").mapInPandas(_statistics(m), "v array<double>")
    s = np.array(counted.agg(*[F.sum(F.get("v", F.lit(i))) for i in range(width)]).first(), float)
    first, moves, mass, zs, zz = np.split(s[:-1], np.cumsum([k, k * k, k, k * d]))
    moves, zs, zz = moves.reshape(k, k), zs.reshape(k, d), zz.reshape(k, d)
    weight = np.maximum(mass, 1e-12)[:, None]
    mean = zs / weight
    moved = moves.sum(1, keepdims=True)
    moves = np.where(moved > 0, moves / np.maximum(moved, 1e-12), m.move)
    return Regimes(m.inputs, first / first.sum(), moves, mean, np.maximum(zz / weight - mean * mean, floor)), float(s[-1])


def fit(
    df: DataFrame,
    inputs: Sequence[str],
    states: int = 3,
    iterations: int = 300,
    tolerance: float = 1e-4,
    floor: float = 1e-6,
    by: str = "symbol",
    block_rows: int = BLOCK_ROWS,
) -> Regimes:
    """EM until the log-likelihood per observation gains less than ``tolerance`` or ``iterations`` are done."""
    k = states
    ship_package(df.sparkSession)
    packed = settle(pack(df, inputs, by, block_rows))
    size = _blocks(packed)
    row = df.na.drop(subset=list(inputs)).agg(*[f(c) for c in inputs for f in (F.avg, F.var_pop)], F.count("*")).first()
    if not row[-1]:
        raise ValueError("no complete rows to fit")
    mu, var = np.array(row[0:-1:2], float), np.maximum(np.array(row[1:-1:2], float), floor)
    spread = np.linspace(-1, 1, k)[:, None] * np.sqrt(var)
    # Calm to wild: states differ in spread from the start, not only in level.
    move = np.full((k, k), 0.1 / max(k - 1, 1)) + np.eye(k) * (0.9 - 0.1 / max(k - 1, 1))
    m = Regimes(tuple(inputs), np.full(k, 1 / k), move, mu + 0.5 * spread, np.outer(np.linspace(0.5, 1.5, k), var))
    history: list[float] = []
    for _ in range(iterations):
        m, loglik = em_step(packed, m, floor, by, size)
        history.append(loglik)
        if len(history) > 1 and history[-1] - history[-2] < tolerance * row[-1]:
            break
    return Regimes(m.inputs, m.start, m.move, m.mean, m.var, tuple(history))


def log_likelihood(df: DataFrame, m: Regimes, by: str = "symbol", block_rows: int = BLOCK_ROWS) -> float:
    ship_package(df.sparkSession)
    return em_step(settle(pack(df, m.inputs, by, block_rows)), m, by=by)[1]


def _per_row(df: DataFrame, m: Regimes, compute, fields: str, by: str, block_rows: int, best: bool = False) -> DataFrame:
    """Run a recursion over the packed blocks and unpack one row per time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCKS):
                rows = batch.slice(i, BLOCKS)
                part = rows.drop_columns([by, "ts"]).to_pandas()
                z, n = _stack(part["z"])
                got = pa.array([g[:k].tolist() for g, k in zip(compute(part, z, n), n)])
                yield pa.RecordBatch.from_arrays([rows[by], rows["ts"], got], [by, "ts", "v"])

    ship_package(df.sparkSession)
    packed = pack(df, m.inputs, by, block_rows)
    kinds = dict(df.dtypes)
    if not (kinds["ts"] == "date" and block_rows >= CALENDAR_ROWS):
        packed = settle(packed)
    size = (0, 0) if kinds["ts"] == "date" and block_rows >= CALENDAR_ROWS else None
    out = _bounded(packed, m, by, best, size).select(by, "block", "ts", "z", "before", "after")
    out = out.mapInArrow(run, f"`{by}` {kinds[by]}, ts array<{kinds['ts']}>, v array<{fields}>")
    return out.select(by, F.explode(F.arrays_zip("ts", "v")).alias("r")).select(by, F.col("r.ts").alias("ts"), F.col("r.v").alias("v"))


def probabilities(df: DataFrame, m: Regimes, mode: str = "smooth", by: str = "symbol", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """State probabilities per row, ``hmm_state_k``.

    ``smooth`` looks at all of ``df``, later rows included; ``filter`` only at rows up to
    the current one. Call it on each part (train, test) by itself.
    """
    if mode not in ("smooth", "filter"):
        raise ValueError("mode must be 'smooth' or 'filter'")

    def pick(part, z, n):
        _, first, after = _firsts(m, part)
        return _smooth(m, z, n, first, after)[2] if mode == "smooth" else _forward(m, z, n, first)[0]

    rows = _per_row(df, m, pick, "array<double>", by, block_rows)
    return rows.select(by, "ts", *[F.get("v", F.lit(i)).alias(f"hmm_state_{i}") for i in range(m.states)])


def path(df: DataFrame, m: Regimes, by: str = "symbol", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(symbol, ts, state) along the most likely path."""

    def pick(part, z, n):
        log_start, log_move = _logs(m)
        start = np.concatenate(part["before"].to_list()).astype(int)
        first = np.where((start < 0)[:, None], log_start, log_move[start])
        return _best_path(m, z, n, first, np.concatenate(part["after"].to_list()).astype(int))

    return _per_row(df, m, pick, "bigint", by, block_rows, best=True).withColumnRenamed("v", "state")


def forecast_hard(df: DataFrame, m: Regimes, by: str = "symbol", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Next price from the mean return of the current most likely state (first input)."""
    means = F.array(*[F.lit(float(x)) for x in m.mean[:, 0]])
    joined = df.join(path(df, m, by, block_rows), [by, "ts"])
    return joined.withColumn("pred_price", price_forecast("close", F.get(means, F.col("state").cast("int"))))


def forecast_soft(df: DataFrame, m: Regimes, train_std: float, by: str = "symbol", mode: str = "smooth", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Next price from the probability-weighted state return, clipped to three deviations."""
    probs = probabilities(df, m, mode, by, block_rows)
    expected = sum((F.col(f"hmm_state_{i}") * F.lit(float(x)) for i, x in enumerate(m.mean[:, 0])), F.lit(0.0))
    bounded = clip(expected, -3.0 * train_std, 3.0 * train_std)
    return df.join(probs, [by, "ts"]).withColumn("pred_price", price_forecast("close", bounded))


def augment(df: DataFrame, probs: DataFrame, by: str = "symbol", lag: int = 0, backfill: bool = False) -> DataFrame:
    """Adds state probabilities to a feature frame; gaps are filled forward (then backward)."""
    states = [c for c in probs.columns if c.startswith("hmm_state_")]
    out = df.join(probs, [by, "ts"], "left")
    if lag:
        w = Window.partitionBy(by).orderBy("ts")
        out = out.withColumns({c: F.lag(c, lag).over(w) for c in states})
    fill = align.ffill_bfill if backfill else align.ffill
    out = out.withColumns({c: fill(c, [by]) for c in states})
    return align.drop_missing(out, states)
