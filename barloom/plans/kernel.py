"""Kernel regression at scale: random Fourier features, ridge weights, and a grid searched from sums.

A Gaussian kernel ``exp(-gamma |a - b|**2)`` is the mean of products of ``sqrt(2) cos(w.x + b)`` over random frequencies, so a
ridge on a few hundred such features is a kernel regression whose cost is linear in the rows. A ridge needs only
sums of products, and sums over expanding folds add up: one pass over the data gives the matrix of every fold and
kernel width, and all penalties and folds of the grid are solved from those small matrices. Features are
standardised by what each fold may see.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from barloom.operators.gram import grams, matrix
from barloom.session import settle, ship_package

# Widths and penalties of the search; "scale" is 1 / number of features (inputs have unit variance).
GRID = {"gamma": ("scale", 0.1, 0.01), "C": (1.0, 10.0, 100.0)}
WIDTH = 128
SEED = 20


@dataclass(frozen=True)
class FourierMap:
    """Standardised inputs to random Fourier features; without frequencies the inputs themselves."""

    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray | None = None
    phases: np.ndarray | None = None

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        if self.frequencies is None:
            return z
        return np.sqrt(2.0 / len(self.phases)) * np.cos(z @ self.frequencies + self.phases)

    @property
    def width(self) -> int:
        return len(self.mean) if self.frequencies is None else len(self.phases)


def fourier(mean, scale, gamma: float | str | None, width: int = WIDTH, seed: int = SEED) -> FourierMap:
    """Seeded features for a kernel width; ``gamma`` None leaves the inputs linear."""
    mean, scale = np.asarray(mean, float), np.asarray(scale, float)
    if gamma is None:
        return FourierMap(mean, scale)
    pick = np.random.default_rng(seed)
    g = 1.0 / len(mean) if gamma == "scale" else float(gamma)
    return FourierMap(mean, scale, np.sqrt(2.0 * g) * pick.normal(size=(len(mean), width)), pick.uniform(0, 2 * np.pi, width))


@dataclass(frozen=True)
class KernelModel:
    """A fitted regression; ``transform`` adds ``prediction`` (NULL where a feature is missing)."""

    features: tuple[str, ...]
    map: FourierMap
    weights: np.ndarray
    bias: float

    def transform(self, df: DataFrame) -> DataFrame:
        phi, weights, bias = self.map, self.weights, self.bias
        ship_package(df.sparkSession)

        @F.pandas_udf("double")
        def predict(x: pd.DataFrame) -> pd.Series:
            return pd.Series(phi(x.to_numpy(np.float64)) @ weights + bias)

        cells = F.struct(*[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(self.features)])
        whole = F.lit(True)
        for c in self.features:
            whole = whole & F.col(f"`{c}`").isNotNull()
        return df.withColumn("prediction", F.when(whole, F.nanvl(predict(cells), F.lit(None).cast("double"))))


def ridge(gram: np.ndarray, penalty: float) -> tuple[np.ndarray, float]:
    """Weights and bias from ``[X, 1, y]'[X, 1, y]``; the bias is not penalised."""
    m = len(gram) - 2
    n = gram[m, m]
    mean, centre = gram[:m, m] / n, gram[m, m + 1] / n
    a = gram[:m, :m] - n * np.outer(mean, mean) + penalty * np.eye(m)
    weights = np.linalg.lstsq(a, gram[:m, m + 1] - n * mean * centre, rcond=None)[0]
    return weights, float(centre - weights @ mean)


def elastic_net(gram: np.ndarray, reg: float, share: float, rounds: int = 10_000) -> tuple[np.ndarray, float]:
    """Weights and bias of an elastic net on standardised inputs and label, by coordinate descent on the sums.

    The objective is that of ``pyspark.ml.regression.LinearRegression`` with standardisation: the penalty applies to inputs
    and label of unit deviation.
    """
    m = len(gram) - 2
    n = gram[m, m]
    mean, centre = gram[:m, m] / n, gram[m, m + 1] / n
    cov = (gram[:m, :m] - n * np.outer(mean, mean)) / n
    cross = (gram[:m, m + 1] - n * mean * centre) / n
    sx, sy = np.sqrt(np.maximum(np.diag(cov), 0)), np.sqrt(max(gram[m + 1, m + 1] / n - centre**2, 0.0))
    live = sx > 0
    weights = np.zeros(m)
    if sy == 0 or not live.any():
        return weights, float(centre)
    a, r = cov[np.ix_(live, live)] / np.outer(sx[live], sx[live]), cross[live] / (sx[live] * sy)
    one, two, w = reg / sy * share, reg / sy * (1 - share), np.zeros(int(live.sum()))
    if one == 0:
        w = np.linalg.lstsq(a + two * np.eye(len(w)), r, rcond=None)[0]
    else:
        for _ in range(rounds):
            before = w.copy()
            for j in range(len(w)):
                pull = r[j] - a[j] @ w + a[j, j] * w[j]
                w[j] = np.sign(pull) * max(abs(pull) - one, 0.0) / (a[j, j] + two)
            if np.abs(w - before).max() < 1e-12:
                break
    weights[live] = w * sy / sx[live]
    return weights, float(centre - weights @ mean)


def fold_sums(folded: DataFrame, features: Sequence[str], label: str, splits: int) -> list[np.ndarray]:
    """``[X, 1, y]'[X, 1, y]`` of every fold, around no shift, in one pass."""
    slim = folded.select("fold", *[F.col(f"`{c}`").cast("double").alias(c) for c in (*features, label)])
    d = len(features)

    def build(batch: pa.RecordBatch):
        if batch.num_rows:
            fold, x = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch, range(1, d + 2))
            for k in np.unique(fold).tolist():
                rows = x[(fold == k) & ~np.isnan(x).any(axis=1)]
                yield k, np.concatenate([rows[:, :d], np.ones((len(rows), 1)), rows[:, d:]], axis=1)

    sums = grams(slim, {k: d + 2 for k in range(splits + 1)}, build)
    return [sums[k] for k in range(splits + 1)]


def squared_error(gram: np.ndarray, weights: np.ndarray, bias: float) -> float:
    v = np.concatenate([weights, [bias, -1.0]])
    return max(float(v @ gram @ v), 0.0)


@dataclass(frozen=True)
class Searched:
    """``errors``: gamma, C, fold, rows and mean squared error of every point; ``params`` won on average."""

    model: KernelModel
    params: dict
    errors: list[tuple]


def _standards(folded: DataFrame, features: Sequence[str], splits: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and population deviation over the folds before k, for k up to splits + 1, from one row per fold."""
    aggs = [f(F.col(c)).alias(f"{n}{i}") for i, c in enumerate(features) for n, f in (("m", F.avg), ("v", F.var_pop))]
    rows = {r["fold"]: r for r in folded.groupBy("fold").agg(F.count("*").alias("n"), *aggs).collect()}
    d, out = len(features), {}
    n, mean, m2 = 0, np.zeros(d), np.zeros(d)
    for k in range(splits + 1):
        if k in rows:
            r = rows[k]
            each, var = (np.array([r[f"{c}{i}"] for i in range(d)], float) for c in "mv")
            gap, total = each - mean, n + r["n"]
            m2 = m2 + var * r["n"] + gap * gap * (n * r["n"] / total)
            mean, n = mean + gap * (r["n"] / total), total
        if n:
            std = np.sqrt(m2 / n)
            out[k + 1] = (mean, np.where(std > 0, std, 1.0))
    return out


def search(folded: DataFrame, features: Sequence[str], label: str, grid: dict = GRID, splits: int = 5, width: int = WIDTH, seed: int = SEED) -> Searched:
    """The grid point with the least mean squared error over expanding folds, refitted on all rows.

    ``folded`` has a ``fold`` column (see ``models.add_folds``) and no missing values. It is read twice: for the standards
    of each fold, and for the sums of products.
    """
    folded = settle(folded.select("fold", *[F.col(f"`{c}`").cast("double").alias(c) for c in (*features, label)]))
    standards = _standards(folded, features, splits)
    gammas, d = tuple(grid["gamma"]), len(features)
    maps = {(g, k): fourier(*standards[k], gamma, width, seed) for g, gamma in enumerate(gammas) for k in standards}
    # Keys: gamma, fold that is scored (splits + 1: the refit), and whether the rows train (0) or are scored (1).
    number = {(g, k, part): (g * (splits + 2) + k) * 2 + part for g, k in maps for part in (0, 1)}
    sizes = {key: maps[g, k].width + 2 for (g, k, _), key in number.items()}

    def build(batch: pa.RecordBatch):
        if not batch.num_rows:
            return
        fold = batch.column(0).to_numpy(zero_copy_only=False)
        x = matrix(batch, range(1, d + 2))
        keep = ~np.isnan(x).any(axis=1)
        fold, x, y = fold[keep], x[keep, :d], x[keep, d:]
        for (g, k), phi in maps.items():
            for part, rows in ((0, fold < k), (1, fold == k)):
                if rows.any():
                    yield number[g, k, part], np.concatenate([phi(x[rows]), np.ones((int(rows.sum()), 1)), y[rows]], axis=1)

    sums = grams(folded, sizes, build)
    errors, scores = [], {}
    for g, gamma in enumerate(gammas):
        for c in grid["C"]:
            found = []
            for k in range(1, splits + 1):
                if (g, k) not in maps:
                    continue
                past, block = sums[number[g, k, 0]], sums[number[g, k, 1]]
                if past[-2, -2] and block[-2, -2]:
                    error = squared_error(block, *ridge(past, 1.0 / c)) / float(block[-2, -2])
                    errors.append((gamma, float(c), k, int(block[-2, -2]), error))
                    found.append(error)
            if found:
                scores[g, c] = sum(found) / len(found)
    if not scores:
        raise ValueError("too few dates to validate on")
    g, c = min(scores, key=lambda p: (scores[p], p))
    weights, bias = ridge(sums[number[g, splits + 1, 0]], 1.0 / c)
    params = {"gamma": gammas[g], "C": float(c)}
    return Searched(KernelModel(tuple(features), maps[g, splits + 1], weights, bias), params, errors)


def fit(df: DataFrame, features: Sequence[str], label: str, gamma=None, C: float = 1.0, width: int = WIDTH, seed: int = SEED) -> KernelModel:
    """One fit with given parameters."""
    one = df.select(F.lit(0).alias("fold"), *features, label)
    folded = settle(one.select("fold", *[F.col(f"`{c}`").cast("double").alias(c) for c in (*features, label)]))
    phi, d = fourier(*_standards(folded, features, 0)[1], gamma, width, seed), len(features)

    def build(batch: pa.RecordBatch):
        if batch.num_rows:
            x = matrix(batch, range(1, d + 2))
            x = x[~np.isnan(x).any(axis=1)]
            yield 0, np.concatenate([phi(x[:, :d]), np.ones((len(x), 1)), x[:, d:]], axis=1)

    weights, bias = ridge(grams(folded, {0: phi.width + 2}, build)[0], 1.0 / C)
    return KernelModel(tuple(features), phi, weights, bias)
