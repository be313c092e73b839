"""Models: medians, folds, scaling, regimes, text scoring."""

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.plans import comparison, models, regimes, sentiment


def day(i):
    return dt.date(2015, 1, 1) + dt.timedelta(i)


@pytest.mark.parametrize("values", [[3.0], [1.0, 2.0], [5.0] * 9 + [1.0], [1e-9, 1e9, 2.0, -7.0], np.random.default_rng(0).normal(size=501).tolist()])
def test_exact_medians(spark, values):
    df = spark.createDataFrame([(v, None) for v in values] + [(None, None)], "x double, e double")
    got = models.exact_medians(df, ["x", "e"])
    assert got["x"] == pytest.approx(float(np.median(values)), abs=1e-15) and got["e"] is None


def test_expanding_folds(spark):
    df = spark.createDataFrame([(day(i),) for i in range(20)], "ts date")
    got = [r.fold for r in models.add_folds(df).orderBy("ts").collect()]
    assert got == [0] * 5 + [k for k in range(1, 6) for _ in range(3)]


def test_standardizer_uses_training_population(spark):
    train = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "x double, c double")
    test = spark.createDataFrame([(5.0, 4.0)], "x double, c double")
    assert tuple(models.Standardizer.fit(train, ["x", "c"]).transform(test).first()) == (3.0, 2.0)


def test_naive_baseline_drops_the_last_row(spark):
    df = spark.createDataFrame([("X", day(i), float(i)) for i in range(5)], "symbol string, ts date, close double")
    got = models.naive_baseline(df, ("2015-01-02", "2015-01-04")).orderBy("ts").collect()
    assert [(r.pred_price, r.true_price) for r in got] == [(1.0, 2.0), (2.0, 3.0)]


def brute(m, z):
    """All state paths of a short sequence."""
    k, n = m.states, len(z)
    dens = np.exp(-0.5 * (np.log(2 * np.pi * m.var).sum(1) + ((z[:, None, :] - m.mean) ** 2 / m.var).sum(2)))
    total, best, marg = 0.0, (-1, None), np.zeros((n, k))
    for p in itertools.product(range(k), repeat=n):
        w = m.start[p[0]] * dens[0, p[0]] * np.prod([m.move[p[t - 1], p[t]] * dens[t, p[t]] for t in range(1, n)])
        total += w
        best = max(best, (w, p))
        for t in range(n):
            marg[t, p[t]] += w
    return marg / total, best[1]


@pytest.fixture(scope="module")
def toy(spark):
    m = regimes.Regimes(("a", "b"), np.array([0.6, 0.4]), np.array([[0.7, 0.3], [0.2, 0.8]]), np.array([[0.0, 1.0], [1.0, -1.0]]), np.array([[1.0, 0.5], [0.3, 2.0]]))
    rng = np.random.default_rng(3)
    z = {"X": rng.normal(size=(6, 2)), "Y": rng.normal(size=(4, 2))}
    rows = [(s, day(i), float(v[0]), float(v[1]), 10.0) for s, a in z.items() for i, v in enumerate(a)]
    return m, z, spark.createDataFrame(rows, "symbol string, ts date, a double, b double, close double")


def test_regimes_equal_brute_force(toy):
    m, z, df = toy
    probs = regimes.probabilities(df, m).toPandas().sort_values(["symbol", "ts"])
    paths = regimes.path(df, m).toPandas().sort_values(["symbol", "ts"])
    for s, a in z.items():
        marg, best = brute(m, a)
        assert np.allclose(probs[probs.symbol == s][["hmm_state_0", "hmm_state_1"]], marg)
        assert tuple(paths[paths.symbol == s].state) == best


def test_filter_mode_never_looks_ahead(toy):
    m, _, df = toy
    full = regimes.probabilities(df, m, "filter").filter("symbol = 'X'").orderBy("ts").collect()
    cut = regimes.probabilities(df.filter(F.col("ts") <= day(2)), m, "filter").filter("symbol = 'X'").orderBy("ts").collect()
    assert [r.hmm_state_0 for r in full[:3]] == pytest.approx([r.hmm_state_0 for r in cut])


def test_em_gains_likelihood_and_finds_two_regimes(spark):
    rng = np.random.default_rng(5)
    rows = []
    for s in "ABC":
        state = (np.arange(240) // 60) % 2
        ret = rng.normal(np.where(state == 0, 0.01, -0.02), np.where(state == 0, 0.005, 0.03))
        rows += [(s, day(i), float(x), float(abs(x))) for i, x in enumerate(ret)]
    df = spark.createDataFrame(rows, "symbol string, ts date, r double, v double")
    m = regimes.fit(df, ["r", "v"], states=2, iterations=15)
    gains = np.diff(m.log_likelihood)
    assert (gains > -1e-6).all() and np.allclose(m.move.sum(1), 1)
    assert sorted(np.round(m.mean[:, 0], 2)) == pytest.approx([-0.02, 0.01], abs=0.011)


@pytest.fixture(scope="module")
def intraday(spark):
    """Rows by the minute with ragged ends, one symbol shorter than a block."""
    rng, rows = np.random.default_rng(8), []
    for s, n in (("X", 400), ("Y", 137), ("Z", 12)):
        state = (np.arange(n) // 25) % 2
        ret = rng.normal(np.where(state == 0, 0.3, -0.4), np.where(state == 0, 0.5, 1.5))
        rows += [(s, dt.datetime(2020, 1, 1) + dt.timedelta(minutes=i * 7), float(x), float(abs(x)), 10.0) for i, x in enumerate(ret)]
    rows.append(("X", dt.datetime(2020, 1, 1, 0, 1), None, 1.0, 10.0))
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, r double, v double, close double")
    m = regimes.Regimes(("r", "v"), np.array([0.7, 0.3]), np.array([[0.9, 0.1], [0.25, 0.75]]), np.array([[0.3, 0.4], [-0.4, 1.1]]), np.array([[0.25, 0.1], [2.0, 1.0]]))
    return df, m


def test_blocks_equal_whole_sequences(intraday):
    df, m = intraday
    whole = regimes.log_likelihood(df, m)
    for size in (10, 37, 128):
        assert regimes.log_likelihood(df, m, block_rows=size) == pytest.approx(whole, rel=1e-9)
    for read in (
        lambda size: regimes.probabilities(df, m, block_rows=size),
        lambda size: regimes.probabilities(df, m, "filter", block_rows=size),
        lambda size: regimes.path(df, m, block_rows=size),
    ):
        one, cut = (read(size).toPandas().sort_values(["symbol", "ts"]).set_index(["symbol", "ts"]) for size in (100_000, 23))
        assert one.index.equals(cut.index) and len(one) == 549 and np.allclose(one, cut, atol=1e-9)


def test_em_steps_equal_in_blocks(intraday):
    df, _ = intraday
    a, b = (regimes.fit(df, ["r", "v"], 2, 4, block_rows=size) for size in (100_000, 31))
    assert np.allclose(a.log_likelihood, b.log_likelihood, rtol=1e-9)
    for x, y in ((a.start, b.start), (a.move, b.move), (a.mean, b.mean), (a.var, b.var)):
        assert np.allclose(x, y, rtol=1e-7)


def test_joined_bounds_equal_broadcast_ones(intraday, monkeypatch):
    df, m = intraday
    want = regimes.log_likelihood(df, m, block_rows=50)
    monkeypatch.setattr(regimes, "BROADCAST_BYTES", 0)
    assert regimes.log_likelihood(df, m, block_rows=50) == pytest.approx(want, rel=1e-12)


def test_soft_forecast_is_clipped(toy):
    m, _, df = toy
    got = regimes.forecast_soft(df, m, 0.01).collect()
    assert all(10 * np.exp(-0.0300001) <= r.pred_price <= 10 * np.exp(0.0300001) for r in got)


def test_comparison_has_all_models(spark):
    rng = np.random.default_rng(7)
    n = 260
    price = 50 * np.exp(np.cumsum(rng.normal(0, 0.01, n)))
    rows = [("X", day(i), float(p), float(i // 30)) for i, p in enumerate(price)]
    df = spark.createDataFrame(rows, "symbol string, ts date, close double, CPI double")
    v = comparison.Variant(macro=("CPI",), forecast="hard", iterations=4)
    got = comparison.compare(df, v, ("2015-01-01", "2015-06-30"), ("2015-07-01", "2015-12-31"), {"regParam": (0.01,)}, splits=2)
    errors = {r.model: r.mse for r in got.collect()}
    assert set(errors) == {"naive", "regression", "regimes", "regression_with_regimes"}
    assert all(np.isfinite(e) and e >= 0 for e in errors.values())


def test_text_scores(spark):
    labelled = spark.createDataFrame([("good gain rise", 2.0), ("bad loss fall", 0.0), ("the day was", 1.0)] * 10, "text string, label double")
    model = sentiment.fit_scorer(labelled)
    news = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 9, i), i, t, None) for i, t in enumerate(["good gain", "bad loss", "rise"])], "time timestamp_ntz, id int, title string, description string"
    )
    got = sentiment.score_text(sentiment.capped_articles(news), model).orderBy("id").collect()
    assert [r.text for r in got] == ["good gain. ", "bad loss. ", "rise. "]
    assert got[0].sentiment_score > 0 > got[1].sentiment_score
    day_mean = sentiment.daily_sentiment(news, lambda x: sentiment.score_text(x, model), cap=1).collect()
    assert len(day_mean) == 1 and day_mean[0].sentiment_score == pytest.approx(got[0].sentiment_score)


def test_outside_scorer_runs_in_batches(spark):
    def load():
        return lambda s: s.str.len().astype(float)

    df = spark.createDataFrame([("ab",), ("abcd",)], "text string")
    assert sorted(r.sentiment_score for r in sentiment.score_text_with(df, load).collect()) == [2.0, 4.0]


def test_medians_take_nan_and_infinity_as_missing(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, None, inf), (2.0, None, 1.0), (3.0, nan, 2.0), (nan, inf, -inf)], "a double, b double, c double")
    assert models.exact_medians(df, ["a", "b", "c"]) == {"a": 2.0, "b": None, "c": 1.5}


def test_folds_of_a_short_series_have_one_date_each(spark):
    df = spark.createDataFrame([("2020-01-01",), ("2020-01-02",)], "ts string")
    assert [r.fold for r in models.add_folds(df, 5).orderBy("ts").collect()] == [4, 5]
