"""Next-day models: frame, split, scaling, imputation, expanding validation, regression."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.operators import align
from barloom.functions.cells import inf_to_null
from barloom.operators.lanes import Lane
from barloom.operators.rolling import log_return
from barloom.operators.stages import Stages
from barloom.plans import kernel
from barloom.plans.macro import MONTHLY_SERIES
from barloom.session import settle

TARGET = "y_next_log_close"
# The assignment's date ranges, both ends included.
TRAIN = ("2015-01-01", "2021-12-31")
TEST = ("2022-01-01", "2025-06-01")


def model_frame(
    panel: DataFrame, macro: Sequence[str], by: Sequence[str] = ("symbol",), extras: Sequence[str] = ("Ret5",), released: Sequence[str] = MONTHLY_SERIES
) -> DataFrame:
    """Macro columns, LogClose, Ret1, Ret5, Vol10 and the next log close; complete rows.

    ``released`` names the series that are known a row later only (monthly figures); daily ones such as yields stay.
    """
    macro = [c for c in macro if c in released]
    b = Stages(Lane(tuple(by), "ts", False, tuple(by)), panel.columns)
    for c in macro:
        before = b.lag(c, 1)
        b.out(b.col(f"{c}_released", before, before))
    log = b.col("LogClose", "ln(close)", "close")
    ret = log_return(b, "close", 1, "Ret1")
    std = b.std_samp(ret, 10)
    b.out(log, ret, b.col("Vol10", std, std))
    if "Ret5" in extras:
        b.out(log_return(b, "close", 5, "Ret5"))
    nxt = b.win("_next_log", f"lead({log})", b.lane.rows, log)
    b.out(b.col(TARGET, nxt, nxt))
    keep = [c for c in panel.columns if c not in macro]
    return b.build(panel, keep).withColumnsRenamed({f"{c}_released": c for c in macro}).na.drop()


def time_split(df: DataFrame, train: tuple[str, str] = TRAIN, test: tuple[str, str] = TEST) -> tuple[DataFrame, DataFrame]:
    return align.between_dates(df, *train), align.between_dates(df, *test)


# -- scaling and imputation --------------------------------------------------------------
@dataclass(frozen=True)
class Standardizer:
    """Mean and population deviation per column, as learned from the training rows."""

    stats: dict[str, tuple[float, float]]

    @staticmethod
    def fit(train: DataFrame, columns: Sequence[str]) -> "Standardizer":
        row = train.agg(*[f(c).alias(f"{i}_{n}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
        return Standardizer({c: (row[f"{i}_m"], row[f"{i}_s"] or 1.0) for i, c in enumerate(columns)})

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in self.stats.items()})


BUCKETS = 1024


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians of columns of any size.

    Each pass counts rows in 1024 buckets between the current bounds, combined map-side, and
    narrows the bounds to the bucket that holds the wanted rank, until a bucket holds a single
    value. What comes back to the driver is at most 1024 rows per wanted rank and pass.
    NaN and infinities count as missing.
    """
    df = df.select(*[inf_to_null(F.col(c).cast("double")).alias(c) for c in columns])
    row = df.agg(
        *[f(c).alias(f"{i}_{n}") for i, c in enumerate(columns) for n, f in (("n", F.count), ("a", F.min), ("z", F.max))]
    ).first()
    # One or two middle ranks per column: [column, rank among the rows in bounds, low, high].
    wanted: list[list] = []
    for i, c in enumerate(columns):
        n = row[f"{i}_n"]
        for rank in sorted({(n - 1) // 2, n // 2}) if n else ():
            wanted.append([c, rank, float(row[f"{i}_a"]), float(row[f"{i}_z"])])
    while open_ := [t for t, w in enumerate(wanted) if w[2] < w[3]]:
        def cell(t: int) -> Column:
            c, _, low, high = wanted[t]
            x = F.col(c)
            # Halves keep the width finite for any pair of doubles.
            share = (x / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
            bucket = F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))
            return F.struct(F.lit(t).alias("t"), F.when(x.between(low, high), bucket).alias("bucket"), x.alias("x"))

        counts = (
            df.select(F.inline(F.array(*[cell(t) for t in open_])))
            .filter(F.col("bucket").isNotNull())
            .groupBy("t", "bucket")
            .agg(F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("z"))
            .orderBy("t", "bucket")
            .collect()
        )
        for t in open_:
            left = wanted[t][1]
            for r in (r for r in counts if r.t == t):
                if left < r.n:
                    wanted[t][1:] = [left, r.a, r.z]
                    break
                left -= r.n
    out: dict[str, float | None] = {}
    for c in columns:
        mid = [w[2] for w in wanted if w[0] == c]
        out[c] = sum(mid) / len(mid) if mid else None
    return out


def median_impute(train: DataFrame, *frames: DataFrame, columns: Sequence[str]) -> list[DataFrame]:
    """Fill missing values with the training medians, in the training frame and the others."""
    medians = {c: m for c, m in exact_medians(train, columns).items() if m is not None}
    return [f.na.fill(medians) for f in (train, *frames)]


# -- validation --------------------------------------------------------------------------
def add_folds(df: DataFrame, splits: int = 5, ts: str = "ts") -> DataFrame:
    """``fold`` 0 for the first training block, 1..splits for the expanding test blocks.

    Test blocks have ``dates // (splits + 1)`` dates each, counted from the end. Folds are cut
    on dates, so the numbering runs over the calendar, not over all rows. With fewer dates than blocks
    each block has one date and the first test blocks are empty.
    """
    dates = df.select(ts).distinct()
    w = Window.orderBy(ts)
    n = F.count("*").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    from_end = F.ceil((n - F.row_number().over(w) + 1) / F.greatest(F.lit(1), F.floor(n / F.lit(splits + 1))))
    return df.join(dates.withColumn("fold", F.greatest(F.lit(0), F.lit(splits + 1) - from_end).cast("int")), ts)


def regression_pipeline(features: Sequence[str], label: str = TARGET, **params) -> Pipeline:
    """Standardised linear regression (elastic net)."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="_x"),
            StandardScaler(inputCol="_x", outputCol="_scaled", withMean=True, withStd=True),
            LinearRegression(featuresCol="_scaled", labelCol=label, predictionCol="prediction", **params),
        ]
    )


GRID = {"regParam": (0.0, 0.01, 0.1), "elasticNetParam": (0.0, 0.5)}


@dataclass
class Tuned:
    model: PipelineModel
    params: dict[str, float]
    scores: list[tuple[dict[str, float], float]]


def expanding_grid_search(train: DataFrame, features: Sequence[str], grid: dict[str, Iterable[float]] = GRID, splits: int = 5, label: str = TARGET) -> Tuned:
    """Pick parameters by mean squared error over expanding folds, refit on all of train.

    Fold k is scored by a model that saw only the folds before it. The data is read once: the sums of products of the
    folds add up to those of every training block, and all grid points are solved and scored from them.
    """
    data = settle(add_folds(train.select("ts", *features, label), splits))
    # Around the overall means, so that squares do not cancel.
    middle = data.agg(*[F.avg(c) for c in (*features, label)]).first()
    centred = data.select("fold", *[(F.col(c) - F.lit(m or 0.0)).alias(c) for c, m in zip((*features, label), middle)])
    sums = kernel.fold_sums(centred, features, label, splits)
    scores = []
    for values in product(*grid.values()):
        params = dict(zip(grid, values))
        errors, past = [], sums[0]
        for block in sums[1:]:
            if past[-2, -2] and block[-2, -2]:
                fitted = kernel.elastic_net(past, params.get("regParam", 0.0), params.get("elasticNetParam", 0.0))
                errors.append(kernel.squared_error(block, *fitted) / block[-2, -2])
            past = past + block
        if not errors:
            raise ValueError("too few dates to validate on")
        scores.append((params, sum(errors) / len(errors)))
    best = min(scores, key=lambda s: s[1])[0]
    return Tuned(regression_pipeline(features, label, **best).fit(data), best, scores)


def kernel_search(train: DataFrame, features: Sequence[str], grid: dict = kernel.GRID, splits: int = 5, label: str = TARGET, **how) -> kernel.Searched:
    """The same selection for the kernel regression: widths and penalties over expanding folds."""
    return kernel.search(add_folds(train.select("ts", *features, label), splits), features, label, grid, splits, **how)


def price_predictions(model: PipelineModel | kernel.KernelModel, df: DataFrame, label: str = TARGET) -> DataFrame:
    """Actual and predicted next price: the model works on logs, errors are on prices."""
    out = model.transform(df)
    return out.select(*df.columns, F.exp(label).alias("true_price"), F.exp("prediction").alias("pred_price"))


def naive_baseline(df: DataFrame, test: tuple[str, str] = TEST, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Tomorrow equals today inside the test range; the last row has no tomorrow."""
    w = Window.partitionBy(*by).orderBy("ts")
    inside = align.between_dates(df, *test).withColumn("true_price", F.lead("close").over(w))
    return inside.filter(F.col("true_price").isNotNull()).withColumn("pred_price", F.col("close"))
