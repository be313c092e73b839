"""Test errors of the baseline, the regression, the regime forecast and both together."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from barloom.operators.align import drop_missing
from barloom.operators.panel import mse
from barloom.plans import kernel, models, regimes
from barloom.plans.macro import MONTHLY_SERIES

SHARED_MACRO = ("CPI", "CorePCE", "RetailSales", "DurGoodsOrders")


@dataclass(frozen=True)
class Variant:
    """One modelling variant: which inputs, how many states, which forecast."""

    macro: tuple[str, ...] = SHARED_MACRO
    states: int = 2
    hmm_inputs: tuple[str, ...] = ("Ret1", "Vol10")
    extras: tuple[str, ...] = ()
    forecast: str | None = "hard"  # hard, soft or None
    impute: bool = False
    lagged: bool = False
    iterations: int = 300
    released: tuple[str, ...] = MONTHLY_SERIES


def wide_variant(macro: Sequence[str], hmm_inputs: Sequence[str]) -> Variant:
    """All macro series, five-day return, three states, no forecast from regimes alone."""
    return Variant(tuple(macro), 3, tuple(hmm_inputs), ("Ret5",), None)


COMPACT = Variant()
SAFE = Variant(forecast="soft", impute=True, lagged=True)


def compare(
    panel: DataFrame,
    variant: Variant = COMPACT,
    train: tuple[str, str] = models.TRAIN,
    test: tuple[str, str] = models.TEST,
    grid: dict = kernel.GRID,
    by: str = "symbol",
    splits: int = 5,
) -> DataFrame:
    """(model, mse) on test prices. ``panel``: symbol, ts, close and the macro columns.

    A grid with ``gamma`` and ``C`` asks for the kernel regression, one with ``regParam`` for the linear one.
    """
    frame = models.model_frame(panel.select(by, "ts", "close", *variant.macro), variant.macro, (by,), variant.extras, variant.released)
    base = [*variant.macro, "Ret1", *variant.extras, "Vol10"]
    past, future = models.time_split(frame, train, test)
    if variant.impute:
        past, future = models.median_impute(past, future, columns=base)
    tuned = (models.kernel_search if "gamma" in grid else models.expanding_grid_search)(past, base, grid, splits)
    results = {
        "naive": models.naive_baseline(frame, test, (by,)),
        "regression": models.price_predictions(tuned.model, future),
    }

    inputs = frame.select(by, "ts", "close", models.TARGET, "Ret1", *variant.hmm_inputs[1:])
    if variant.lagged:
        w = Window.partitionBy(by).orderBy("ts")
        inputs = drop_missing(inputs.withColumns({c: F.lag(c).over(w) for c in variant.hmm_inputs}))
    z_past, z_future = models.time_split(inputs, train, test)
    hmm = regimes.fit(z_past, variant.hmm_inputs, variant.states, variant.iterations, by=by)
    probs = regimes.probabilities(z_past, hmm, by=by).unionByName(regimes.probabilities(z_future, hmm, by=by))
    if variant.forecast == "hard":
        results["regimes"] = regimes.forecast_hard(z_future, hmm, by).withColumn("true_price", F.exp(models.TARGET))
    elif variant.forecast == "soft":
        std = past.agg(F.stddev_samp("Ret1")).first()[0]
        results["regimes"] = regimes.forecast_soft(z_future, hmm, std, by).withColumn("true_price", F.exp(models.TARGET))
    both = regimes.augment(frame, probs, by, lag=1 if variant.lagged else 0, backfill=variant.lagged)
    aug_past, aug_future = models.time_split(both, train, test)
    columns = [*base, *[f"hmm_state_{i}" for i in range(variant.states)]]
    if "gamma" in grid:
        refit = kernel.fit(aug_past, columns, models.TARGET, **tuned.params)
    else:
        refit = models.regression_pipeline(columns, **tuned.params).fit(aug_past)
    results["regression_with_regimes"] = models.price_predictions(refit, aug_future)
    rows = [mse(df, "true_price", "pred_price").select(F.lit(n).alias("model"), "mse") for n, df in results.items()]
    return reduce(lambda a, b: a.unionByName(b), rows)
