"""Feature packs on hand-made and random series, checked against plain pandas formulas."""

import datetime as dt
import io
from contextlib import redirect_stdout

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import rolling as r
from barloom.operators.lanes import Lane, needs_tiles
from barloom.operators.pieces import parts
from barloom.operators.recursive import ema
from barloom.operators.stages import Stages
from barloom.plans import technical as packs


def series(n=700, seed=0, holes=False):
    rng = np.random.default_rng(seed)
    close = 100 * np.exp(np.cumsum(rng.normal(0, 0.01, n)))
    open_ = close * np.exp(rng.normal(0, 0.005, n))
    df = pd.DataFrame(
        {
            "symbol": f"S{seed}",
            "ts": pd.date_range("2015-01-01", periods=n).date,
            "open": open_,
            "high": np.maximum(open_, close) * (1 + abs(rng.normal(0, 0.003, n))),
            "low": np.minimum(open_, close) * (1 - abs(rng.normal(0, 0.003, n))),
            "close": close,
            "volume": rng.integers(100, 1000, n).astype(float),
        }
    )
    if holes:
        df.loc[[120, 121, 122, 300], ["open", "high", "low", "close"]] = np.nan
        df.loc[400:450, "close"] = df.loc[400, "close"]
    return df


def bars(spark, *frames):
    return spark.createDataFrame(pd.concat(frames))


def run(df, *indicators, **how):
    out = packs.compute(df, *indicators, **how)
    return out.toPandas().sort_values(["symbol", "ts"]).reset_index(drop=True)


def same(got, want, tol=1e-9):
    got, want = np.asarray(got, float), np.asarray(want, float)
    assert (np.isnan(got) == np.isnan(want)).all()
    ok = ~np.isnan(want)
    assert np.allclose(got[ok], want[ok], rtol=tol, atol=1e-12)


@pytest.fixture(scope="module")
def holed(spark):
    pdf = series(holes=True)
    return pdf, run(bars(spark, pdf), packs.basic_indicators, r.realized_vol, r.autocorr, r.days_since_extreme)


def test_parts_cover_every_window():
    for n in range(2, 400):
        assert sum(s for s, _ in parts(n)) == n
        assert [o for _, o in parts(n)] == [sum(s for s, _ in parts(n)[:i]) for i in range(len(parts(n)))]


def test_ema_holds_over_gaps_and_decays(holed):
    pdf, got = holed
    for n in (5, 20, 200):
        same(got[f"EMA_{n}"], pdf.close.ewm(span=n, adjust=False, min_periods=n).mean())


def test_macd_rsi_atr(holed):
    pdf, got = holed
    c, h, l = pdf.close, pdf.high, pdf.low
    line = c.ewm(span=12, adjust=False, min_periods=26).mean() - c.ewm(span=26, adjust=False, min_periods=26).mean()
    same(got.MACD_line, line)
    same(got.MACD_signal, line.ewm(span=9, adjust=False, min_periods=34).mean())
    d = c.diff()
    up, down = (x.clip(lower=0).ewm(alpha=1 / 14, adjust=False, min_periods=14).mean() for x in (d, -d))
    same(got.RSI_14, 100 - 100 / (1 + up / down.replace(0, np.nan)))
    tr = pd.concat([h - l, (h - c.shift()).abs(), (l - c.shift()).abs()], axis=1).max(axis=1)
    same(got.ATR_14, tr.ewm(alpha=1 / 14, adjust=False, min_periods=14).mean())


def test_rolling_deviation_and_autocorrelation(holed):
    pdf, got = holed
    lr = np.log(pdf.close).diff()
    for n in (5, 20, 60, 252):
        same(got[f"RealizedVol_{n}d_ann"], np.sqrt(252) * lr.rolling(n, min_periods=n).std(ddof=0), 1e-7)

    def corr(w):
        a, b = w[1:], w[:-1]
        return np.nan if a.std() == 0 or b.std() == 0 else np.corrcoef(a, b)[0, 1]

    same(got.autocorr_ret_lag1_20d, lr.rolling(20, min_periods=20).apply(corr, raw=True), 1e-7)


def test_first_rows(spark):
    got = run(bars(spark, series(120)), packs.basic_indicators, r.roll_spread, r.skew_kurt)
    first = {c: int(got[c].first_valid_index()) for c in ("SMA_20", "RSI_14", "ATR_14", "MACD_line", "MACD_signal", "roll_spread_abs_20", "RealizedSkew_20d")}
    assert first == {"SMA_20": 19, "RSI_14": 14, "ATR_14": 13, "MACD_line": 25, "MACD_signal": 58, "roll_spread_abs_20": 21, "RealizedSkew_20d": 20}


def flat(spark, prices, volume=None):
    n = len(prices)
    return spark.createDataFrame(
        [("X", dt.date(2020, 1, 1) + dt.timedelta(i), p, p, p, p, float(volume[i]) if volume else 1.0) for i, p in enumerate(prices)],
        "symbol string, ts date, open double, high double, low double, close double, volume double",
    )


def test_flat_prices_give_null_not_errors(spark):
    got = run(flat(spark, [7.1] * 80), r.zscore_returns, r.autocorr, r.skew_kurt, r.stochastic, r.volume_surge, r.rsi)
    assert got[["zret_20d", "autocorr_ret_lag1_20d", "RealizedSkew_20d", "Stoch_%K_14", "vol_z_20", "RSI_14"]].isna().all().all()
    assert (got.vol_gt_p95_20[19:] == 1).all() and (got.vol_gt_p95_20[:19] == 0).all()


def test_pad_and_no_pad(spark):
    df = flat(spark, [1.0, None, 2.0])

    def both(b):
        b.out(r.pct_change(b, "close", 1, "pad"), r.pct_change(b, "close", 1, "raw", pad=False))

    got = run(df, both)
    same(got["pad"], [np.nan, 0.0, 1.0])
    assert got["raw"].isna().all()


def test_zero_and_negative_prices(spark):
    got = run(flat(spark, [5.0, 0.0, -1.0, 4.0, 4.0, 4.0]), r.simple_returns, r.gap_measures)
    same(got.logret_1d, [np.nan, np.nan, np.nan, np.nan, 0.0, 0.0])
    assert got.gap_pct[2:3].isna().all()


def test_total_loss_counts_as_one(spark):
    got = run(flat(spark, [10.0, 11.0, 12.0, 13.0, 14.0, 0.0]), lambda b: r.rolling_return(b, [5]))
    same(got.roll_ret_5d, [np.nan] * 5 + [14.0 / 10.0 - 1])


def test_ties_take_the_earliest_extreme(spark):
    got = run(flat(spark, [3.0, 9.0, 4.0, 9.0, 5.0, 1.0, 1.0]), lambda b: r.days_since_extreme(b, [5]))
    same(got.days_since_high_5d, [np.nan] * 4 + [3, 4, 3])
    same(got.days_since_low_5d, [np.nan] * 4 + [4, 0, 1])


def test_fast_average_uses_short_runs(spark):
    pdf = series(1200, 3)

    def quick(b):
        ema(b, "close", {"fast": 0.9, "all": 1.0})
        b.out("fast", "all")

    got = run(bars(spark, pdf), quick)
    same(got["fast"], pdf.close.ewm(alpha=0.9, adjust=False).mean())
    same(got["all"], pdf.close)


def test_symbols_do_not_mix_and_order_is_free(spark):
    one, two = series(300, 1), series(300, 2)
    alone = run(bars(spark, one), packs.gaps_overnight, r.emas)
    mixed = run(bars(spark, two, one).orderBy(F.rand(5)), packs.gaps_overnight, r.emas)
    pd.testing.assert_frame_equal(alone, mixed[mixed.symbol == "S1"].reset_index(drop=True))


def test_future_never_changes_the_past(spark):
    pdf = series(400, 4)
    full = run(bars(spark, pdf), packs.trend_meanrev)
    cut = run(bars(spark, pdf[:250]), packs.trend_meanrev)
    pd.testing.assert_frame_equal(full[:250], cut)


def test_tiles_equal_whole_symbols(spark):
    df = bars(spark, series(1500, 5, holes=True), series(900, 6)).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    want = run(df, packs.liquidity_pressure, r.rsi, r.macd, layout="key")
    got = run(df, packs.liquidity_pressure, r.rsi, r.macd, layout="tiled", tile_rows=700, halo_rows=690, bucket="month")
    for c in want.columns[2:]:
        same(got[c], want[c], 1e-7)


def test_averages_cross_tiles_with_missing_bars(spark):
    """Spans far longer than tiles and halo, tiles without a value, and gaps over tile bounds."""
    one, two = series(1500, 7, holes=True), series(700, 8)
    two.loc[100:480, "close"] = np.nan
    two.loc[:30, "close"] = np.nan
    df = bars(spark, one, two).withColumn("ts", F.col("ts").cast("timestamp_ntz"))

    def slow(b):
        ema(b, "close", {"quick": 0.9, "all": 1.0, "slow": 2 / 1001, "slower": 1e-4})
        ema(b, "high", {"_h": 2 / 301})
        line = b.col("line", "slow - _h", "slow", "_h")
        ema(b, line, {"nested": 0.05})
        b.out("quick", "all", "slow", "slower", "line", "nested")

    want = run(df, slow, layout="key")
    for tile, halo in ((60, 3), (200, 50)):
        got = run(df, slow, layout="tiled", tile_rows=tile, halo_rows=halo, bucket="month")
        for c in want.columns[2:]:
            same(got[c], want[c], 1e-9)


def test_halo_is_as_long_as_the_windows(spark):
    df = bars(spark, series(900, 9))
    want, got = (run(df, packs.volatility, layout=how, **more) for how, more in (("key", {}), ("tiled", {"tile_rows": 10, "bucket": "month"})))
    for c in want.columns[2:]:
        same(got[c], want[c], 1e-7)
    with pytest.raises(ValueError):
        packs.compute(df, packs.volatility, layout="tiled", halo_rows=100)
    with pytest.raises(ValueError):
        packs.compute(df, lambda b: (r.emas(b), b.lag("_ema5", 3)), layout="tiled")


def test_order_statistics_cross_batches(spark):
    """Lanes longer and shorter than an Arrow batch, with holes, against pandas."""
    one, two, tiny = series(900, 11), series(40, 12), series(3, 13)
    one.loc[[200, 201, 500], "volume"] = np.nan
    one.loc[600:640, "volume"] = 7.0
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = run(bars(spark, two, one, tiny), r.volume_percentile, r.volume_surge)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    want = pd.concat([one, two, tiny]).sort_values(["symbol", "ts"])
    for n in (20, 60, 252):
        share = want.groupby("symbol")["volume"].transform(lambda v: v.rolling(n).apply(lambda w: (w <= w.iloc[-1]).mean()))
        same(got[f"vol_pct_{n}"], share)
    for n in (20, 60):
        same(got[f"vol_p95_{n}"], want.groupby("symbol")["volume"].transform(lambda v: v.rolling(n).quantile(0.95)))


def test_no_arrays_behind_order_statistics(spark, tmp_path):
    bars(spark, series(50)).write.parquet(str(tmp_path / "bars"))
    text = plan(packs.compute(spark.read.parquet(str(tmp_path / "bars")), packs.liquidity_pressure))
    assert "sort_array" not in text and "filter(" not in text and text.count("Exchange hashpartitioning") == 1
    assert text.count("+- Sort [") <= 2
    with pytest.raises(ValueError):
        packs.compute(bars(spark, series(50)), lambda b: (r.volume_percentile(b), b.lag("vol_pct_20")))


def test_layout_choice(spark):
    dated = bars(spark, series(50))
    assert not needs_tiles(dated, ("symbol",), "ts", limit=10)
    assert needs_tiles(dated.withColumn("ts", F.col("ts").cast("timestamp_ntz")), ("symbol",), "ts", limit=10)


def plan(df):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_one_shuffle_for_all_packs(spark, tmp_path):
    bars(spark, series(50)).write.parquet(str(tmp_path / "bars"))
    text = plan(packs.all_features(spark.read.parquet(str(tmp_path / "bars"))))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("+- Sort [") <= 2


def test_only_needed_columns_are_read(spark, tmp_path):
    bars(spark, series(50)).write.parquet(str(tmp_path / "bars"))
    text = plan(packs.compute(spark.read.parquet(str(tmp_path / "bars")), r.sma).select("symbol", "ts", "SMA_5"))
    assert "ReadSchema: struct<symbol:string,ts:date,close:double>" in text


def test_stages_drop_unused_columns(spark):
    b = Stages(Lane(("symbol",), "ts"), ["symbol", "ts", "close"])
    r.sma(b, [5])
    assert b.outputs == ["SMA_5"]
