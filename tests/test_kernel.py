"""Gram sums, kernel regression and the grid solved from sums."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from barloom.operators import gram, panel, profile
from barloom.plans import kernel, models


@pytest.fixture(scope="module")
def frame(spark):
    pick = np.random.default_rng(1)
    x = pick.normal(size=(600, 4)) * [1, 50, 0.01, 3] + [0, 1000, 5, -2]
    y = np.sin(x[:, 0]) + 0.01 * x[:, 1] + 0.1 * pick.normal(size=600)
    pdf = pd.DataFrame(np.column_stack([x, y]), columns=["a", "b", "c", "d", "y"])
    pdf["ts"] = [dt.date(2015, 1, 1) + dt.timedelta(int(i)) for i in np.arange(600) // 2]
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def test_correlations_of_many_columns_with_holes(spark):
    pick = np.random.default_rng(2)
    x = pick.normal(size=(300, 400)) + pick.normal(size=(300, 1)) + 1e4 * np.arange(400)
    x[pick.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 3.5
    x[0, 8] = np.inf
    cols = [f"c{k}" for k in range(400)]
    pdf = pd.DataFrame(x, columns=cols)
    df = spark.createDataFrame(pdf).repartition(3)
    matrix = panel.correlation_matrix(df, cols)
    got = matrix.toPandas()
    assert len(got) == 400 * 400
    want = pdf.replace(np.inf, np.nan).corr()
    table = got.pivot(index="a", columns="b", values="corr").loc[cols, cols].to_numpy(float)
    assert np.allclose(table, want.to_numpy(), atol=1e-9, equal_nan=True)
    assert np.isnan(table[7]).all()
    short, long = (len(panel.correlation_matrix(df, cols[:n])._jdf.queryExecution().optimizedPlan().toString()) for n in (50, 400))
    assert long < 12 * short  # pairs grow 64 times


def test_correlations_of_no_rows(spark):
    df = spark.createDataFrame([], "x double, y double")
    assert panel.correlation_matrix(df, ["x", "y"]).count() == 0


def test_pruning_table(spark):
    corrs = spark.createDataFrame([("a", -0.95), ("b_lag1", 0.85), ("c", 0.85), ("d_lag1", 0.99), ("e", 0.3), ("f", None)], "feature string, corr double")
    got = {r["feature"]: r["dropped"] for r in profile.pruning(corrs).collect()}
    assert got == {"a": True, "b_lag1": False, "c": True, "d_lag1": True}
    drop, keep = profile.prune_high_corr(corrs)
    assert set(drop) == {k for k, v in got.items() if v} and keep == ["b_lag1"]


@pytest.mark.parametrize("reg, share", [(0.0, 0.0), (0.1, 0.0), (0.05, 0.5), (0.3, 1.0)])
def test_elastic_net_equals_the_engines(frame, reg, share):
    _, df = frame
    cols = ["a", "b", "c", "d"]
    fitted = LinearRegression(featuresCol="v", labelCol="y", regParam=reg, elasticNetParam=share, tol=1e-12, maxIter=2000).fit(
        VectorAssembler(inputCols=cols, outputCol="v").transform(df)
    )
    sums = kernel.fold_sums(df.withColumn("fold", F.lit(0)), cols, "y", 0)[0]
    weights, bias = kernel.elastic_net(sums, reg, share)
    assert np.allclose(weights, fitted.coefficients.toArray(), rtol=1e-4, atol=1e-6) and bias == pytest.approx(fitted.intercept, rel=1e-4)


def test_grid_equals_fits_one_by_one(frame):
    pdf, df = frame
    cols, grid = ["a", "b"], {"gamma": ("scale", 0.3), "C": (0.5, 20.0)}
    found = models.kernel_search(df, cols, grid, splits=3, label="y", width=20)
    fold = models.add_folds(df, 3).select("ts", "fold").distinct().toPandas().set_index("ts")["fold"]
    at = pdf["ts"].map(fold).to_numpy()
    x, y = pdf[cols].to_numpy(), pdf["y"].to_numpy()
    for gamma, c, k, n, error in found.errors:
        past, block = at < k, at == k
        phi = kernel.fourier(x[past].mean(0), x[past].std(0), gamma, 20)
        a, b = phi(x[past]), phi(x[block])
        w = np.linalg.solve((a - a.mean(0)).T @ (a - a.mean(0)) + np.eye(20) / c, (a - a.mean(0)).T @ (y[past] - y[past].mean()))
        want = np.mean((y[block] - y[past].mean() - (b - a.mean(0)) @ w) ** 2)
        assert n == block.sum() and error == pytest.approx(want, rel=1e-6)
    best = {}
    for gamma, c, _, _, error in found.errors:
        best[gamma, c] = best.get((gamma, c), 0) + error
    assert (found.params["gamma"], found.params["C"]) == min(best, key=best.get)
    again = kernel.fit(df, cols, "y", **found.params, width=20)
    assert np.allclose(again.weights, found.model.weights)


def test_features_approach_the_kernel():
    pick = np.random.default_rng(3)
    x = pick.normal(size=(40, 3))
    phi = kernel.fourier(np.zeros(3), np.ones(3), 0.2, 20_000)(x)
    exact = np.exp(-0.2 * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(phi @ phi.T - exact).max() < 0.05


def test_kernel_beats_a_line_on_a_curve(frame):
    _, df = frame
    curve = kernel.fit(df, ["a"], "y", gamma="scale", C=10.0)
    line = kernel.fit(df, ["a"], "y", gamma=None, C=10.0)
    one, two = (m.transform(df.withColumn("y", F.sin(2 * F.col("a")))).agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0] for m in (
        kernel.fit(df.withColumn("y", F.sin(2 * F.col("a"))), ["a"], "y", gamma=0.5, C=100.0),
        kernel.fit(df.withColumn("y", F.sin(2 * F.col("a"))), ["a"], "y", gamma=None, C=100.0),
    ))
    assert one < 0.1 * two and curve.map.width == kernel.WIDTH and line.map.width == 1


def test_missing_features_give_no_prediction(spark, frame):
    _, df = frame
    model = kernel.fit(df, ["a", "b"], "y", gamma=0.1)
    holed = spark.createDataFrame([(1.0, None), (None, 2.0), (0.5, 1000.0)], "a double, b double")
    assert [r["prediction"] is None for r in model.transform(holed).collect()] == [True, True, False]


def test_only_released_series_are_lagged(spark):
    rows = [("X", dt.date(2020, 1, 1) + dt.timedelta(i), 10.0 + i, float(i), float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "symbol string, ts date, close double, CPI double, VIX double")
    got = models.model_frame(df, ["CPI", "VIX"]).orderBy("ts").collect()
    assert all(r["VIX"] - r["CPI"] == 1.0 for r in got) and set(got[0].asDict()) >= {"CPI", "VIX", "LogClose", "Vol10"}
