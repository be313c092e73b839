"""Alignment, profiles, ingest and sinks on literals."""

import datetime as dt

import pytest
from pyspark.sql import Row, functions as F

from barloom import session
from barloom.functions import cells
from barloom.operators import align, bars, panel, profile
from barloom.plans import master, options
from barloom.sources import ingest, sinks


def d(s):
    return dt.date.fromisoformat(s)


def dates(spark, *days):
    return spark.createDataFrame([(d(x),) for x in days], "ts date")


def col(df, c, *order):
    return [r[c] for r in df.orderBy(*(order or ("ts",))).collect()]


CAL = ("2015-01-02", "2015-02-02", "2015-03-02", "2015-03-03")


def macro(spark):
    rows = [(d("2015-01-01"), 1.0), (d("2015-02-01"), 2.0), (d("2015-03-02"), 3.0)]
    return spark.createDataFrame(rows, "ts date, v double")


def test_exact_reindex_loses_off_calendar_values(spark):
    cal = dates(spark, *CAL)
    assert col(align.reindex_ffill(macro(spark), cal, ["v"]), "v") == [None, None, 3.0, 3.0]
    assert col(align.reindex_ffill(macro(spark), cal, ["v"], how="asof"), "v") == [1.0, 2.0, 3.0, 3.0]
    assert col(align.reindex_ffill(macro(spark), cal, ["v"], backfill=True), "v") == [3.0] * 4


def test_stale_values_stop(spark):
    cal = dates(spark, "2015-03-02", "2015-03-03", "2015-06-01")
    assert col(align.reindex_ffill(macro(spark), cal, ["v"], max_age=30), "v") == [3.0, 3.0, None]


def test_spine_join_duplicates(spark):
    spine = dates(spark, "2020-01-01", "2020-01-02").withColumnRenamed("ts", "Date")
    right = spark.createDataFrame([(d("2020-01-01"), 1), (d("2020-01-01"), 2)], "Date date, x int")
    assert align.spine_join(spine, {"r": right}).count() == 3
    last = align.spine_join(spine, {"r": right}, dedupe="last", order="x")
    assert col(last, "x", "Date") == [2, None]
    with pytest.raises(Exception, match="duplicate"):
        align.spine_join(spine, {"r": right}, dedupe="error").collect()


def test_average_correlation_equals_the_full_matrix(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    wide = pd.DataFrame(rng.normal(size=(30, 4)), columns=list("abcd"), index=pd.date_range("2020-01-01", periods=30).date)
    wide["d"] = 1.0  # constant: not part of the matrix
    long = wide.rename_axis("ts").reset_index().melt("ts", var_name="asset", value_name="ret").assign(market="m")
    got = panel.average_correlation(spark.createDataFrame(long), 10)
    want = wide.rolling(10).corr().groupby(level=0).mean().mean(axis=1)
    assert np.allclose(np.array(col(got, "avg_corr"), float), want.values, equal_nan=True)


def test_prune_rules(spark):
    corrs = spark.createDataFrame(
        [("a", 0.95), ("b_lag1", 0.85), ("c", -0.85), ("d_lag1", -0.99), ("e", 0.5), ("f", None)], "feature string, corr double"
    )
    assert profile.prune_high_corr(corrs) == (["d_lag1", "a", "c"], ["b_lag1"])


def test_feature_with_one_gap_is_never_flagged(spark):
    df = spark.createDataFrame([(1.0, 1.0, 5.0), (None, 2.0, 5.0), (3.0, 3.0, 5.0)], "x double, y double, z double")
    got = {r.feature: r["corr"] for r in profile.feature_target_corr(df.withColumn("t", F.col("y")), ["x", "y", "z"], "t").collect()}
    assert got["x"] is None and got["z"] == 0.0 and abs(got["y"] - 1) < 1e-12


def test_feature_name_rules():
    names = ["Date", "SPY_NextDay_Return", "price_change", "t_Close", "t_close", "sector_data_Prices_X", "macro_positioning_data_CPI", "t_High_z", "ok_lag1"]
    assert profile.select_features(names) == ["t_close", "ok_lag1"]


def test_profile_and_all_null_columns(spark):
    df = spark.createDataFrame([(1, None, "7"), (None, None, "x")], "a int, b int, c string")
    got = {r["column"]: r.null_pct for r in profile.null_profile(df).collect()}
    assert got == {"a": 50.0, "b": 100.0, "c": 0.0}
    assert [r["column"] for r in profile.top_missing(profile.null_profile(df), 1).collect()] == ["b"]
    assert profile.drop_all_null(df).columns == ["a", "c"]
    assert [r.c for r in profile.coerce_text_columns(df).collect()] == [7.0, None]


def test_group_columns_is_a_full_outer_join(spark):
    a = spark.createDataFrame([(d("2020-01-01"), 1.0)], "ts date, x double")
    b = spark.createDataFrame([(d("2020-01-02"), 2.0)], "ts date, x double")
    got = profile.group_columns({"A": a, "B": b}).orderBy("ts").collect()
    assert [(r.A_x, r.B_x) for r in got] == [(1.0, None), (None, 2.0)]


def test_source_profile_counts_longer_names_too(spark):
    df = spark.createDataFrame([(1, 2)], "m_a int, m_ext_b int")
    assert profile.source_profile(df, ["m", "m_ext"]) == {"m": ["m_a", "m_ext_b"], "m_ext": ["m_ext_b"]}


def test_date_formats_first_fit_wins(spark):
    df = spark.createDataFrame([("2020-01-05",), (" 01/31/2020 ",), ("02/01/2020",)], "Day string")
    got = ingest.normalize_date(ingest.parse_dates(df, "Day"))
    assert [r.Date for r in got.collect()] == [d("2020-01-05")]
    only = df.filter("Day like '%/%'")
    assert sorted(r.Date for r in ingest.normalize_date(ingest.parse_dates(only, "Day")).collect()) == [d("2020-01-31"), d("2020-02-01")]


def test_date_column_preference():
    assert ingest.detect_date_column(["x", "QuoteDate", "Date", "TIME"]) == "TIME"
    assert ingest.detect_date_column(["x"]) is None


def test_csv_short_rows_padded_long_rows_dropped(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    rows = ingest.scan_csv_tolerant(spark, str(tmp_path / "t.csv")).orderBy("a").collect()
    assert [tuple(r) for r in rows] == [("1", "2", "3"), ("4", "5", None)]


def test_normalize_ohlcv(spark):
    df = spark.createDataFrame([("2020-01-02 09:30:00", "2019-12-31", "1", "2", "0.5", "1.5", "n/a")], "TIME string, Date string, OPEN string, High string, low string, Close string, Volume string")
    row = ingest.normalize_ohlcv(df, "X").first()
    assert row == Row(symbol="X", ts=d("2019-12-31"), open=1.0, high=2.0, low=0.5, close=1.5, volume=None)
    assert ingest.normalize_ohlcv(df.drop("Volume"), "X").first().volume is None
    with pytest.raises(ValueError):
        ingest.normalize_ohlcv(df.drop("low"))


def test_zones(spark):
    df = spark.sql("select timestamp_ntz'2024-01-10 00:00:00' as utc, '2024-01-10 09:45:00-05:00' as wall")
    row = df.select(ingest.ny_date("utc").alias("ny"), ingest.eastern_wall_time("wall").alias("w"), ingest.eastern_instant(ingest.eastern_wall_time("wall")).alias("i")).first()
    assert (row.ny, row.w, row.i) == (d("2024-01-09"), dt.datetime(2024, 1, 10, 9, 45), dt.datetime(2024, 1, 10, 14, 45))


def test_adjusted_close_is_preferred(spark):
    df = spark.createDataFrame([(d("2020-01-01"), 1.0, 2.0)], "Date date, `Close_A` double, `Adj Close_A` double")
    assert ingest.flatten_prefer_adjusted(df).first()["A"] == 2.0
    assert ingest.flatten_prefer_adjusted(df.drop("Adj Close_A")).first()["A"] == 1.0


def test_series_set_skips_broken_and_empty(spark):
    good = spark.createDataFrame([(d("2020-01-01"), 1.0)], "ts date, value double")
    with pytest.warns(UserWarning):
        got = ingest.load_series_set({"g": lambda: good, "e": lambda: good.limit(0), "b": lambda: 1 / 0})
    assert [r.name for r in got.collect()] == ["g"]


def test_option_chain_round_trip(spark, tmp_path):
    head = "contractSymbol,lastTradeDate,strike,lastPrice,bid,ask,change,percentChange,volume,openInterest,impliedVolatility,inTheMoney,contractSize,currency\n"
    line = "{},2025-01-02 15:00:00+00:00,{},1,1,1,0,0,{},0,{},True,REGULAR,USD\n"
    (tmp_path / "c.csv").write_text(head + line.format("C1", 100.0, "10.0", 0.2) + line.format("C2", 105.0, "", 0.3))
    (tmp_path / "p.csv").write_text(head + line.format("P1", 100.0, "30.0", 0.5))
    chain = ingest.load_option_chain(spark, str(tmp_path / "c.csv"), str(tmp_path / "p.csv"))
    assert options.put_call_ratio(chain).first() == Row(pcr_volume=3.0, pcr_oi=None)
    assert [(r.strike, round(r.skew, 6)) for r in options.join_strikes(chain).collect()] == [(100.0, 0.3)]


def test_session_bars(spark):
    def row(t, o, h, l, c, v=1.0):
        return ("X", dt.datetime.fromisoformat(f"2024-01-02 {t}"), o, h, l, c, v)

    schema = "symbol string, ts timestamp_ntz, open double, high double, low double, close double, volume double"
    minutes = spark.createDataFrame([row("09:10", 5.0, 99.0, 0.1, 5.0, 7.0), row("09:30", 10.0, 11.0, 9.0, 10.5), row("09:31", 10.5, 12.0, 10.0, 11.0)], schema)
    hours = spark.createDataFrame([row("10:00", 1.0, 500.0, 0.01, 1.0), row("11:00", 11.0, 13.0, 8.0, 12.0), row("16:00", 12.0, 12.5, 11.0, 12.2)], schema)
    assert tuple(bars.session_bars(minutes, hours, False).first())[2:] == (10.0, 13.0, 8.0, 12.2, 4.0)
    assert tuple(bars.session_bars(minutes, hours, True).first())[2:] == (10.0, 99.0, 0.1, 12.2, 11.0)


def test_null_cells(spark):
    df = spark.sql("select double('NaN') n, double('Infinity') i, 0d z, -4d neg, cast(null as double) u")
    row = df.select(
        cells.nan_to_null("n").alias("a"), cells.inf_to_null("i").alias("b"), cells.ratio("neg", "z").alias("c"), cells.root("neg").alias("e"),
        cells.clip("u", 0.0, 1.0).alias("f"), cells.flag(F.col("u") > 1).alias("g"), cells.ln_pos("neg").alias("h"), cells.row_max("u", "z").alias("k"),
        cells.row_mean("u", "z", "neg").alias("m"),
    ).first()
    assert tuple(row) == (None, None, None, None, None, 0.0, None, 0.0, -2.0)


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("X", d("2020-01-01"), 1.0, 2.0)], "symbol string, ts date, open double, SMA_5 double")
    sinks.write_csv(sinks.daily_table(df), str(tmp_path / "csv"))
    assert tuple(spark.read.option("header", True).csv(str(tmp_path / "csv")).first()) == ("2020-01-01", "X", "1.0", "2.0")
    sinks.write_parquet(df, str(tmp_path / "pq"), ["symbol"])
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 1
    sinks.write_if_missing(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns[0] == "Date"
    sinks.write_feature_list(spark, ["a", "b"], str(tmp_path / "list"))
    assert [r.value for r in spark.read.text(str(tmp_path / "list")).collect()] == ["a", "b"]


def test_master_dataset_end_to_end(spark, tmp_path):
    days = [f"2020-01-0{i}" for i in range(1, 7)]
    vol = spark.createDataFrame([(x, str(i)) for i, x in enumerate(days)], "Date string, v string")
    px = [10.0, 11.0, None, 12.0, 13.0, 14.0]
    ohlcv = spark.createDataFrame([(x, p, "bad") for x, p in zip(days, px)], "time string, close double, note string")
    leak = [0.1, 0.0, 0.0909, 0.0833, 0.0769, 0.5]
    feats = spark.createDataFrame([(x, v, None) for x, v in zip(days, leak)], "date string, leak double, empty double")
    mac = spark.createDataFrame([(days[0], 1.0), (days[3], 2.0)], "Date string, CPI double")
    none = spark.createDataFrame([(1,)], "k int")
    m = master.build_master(
        {"spy_ohlcv_1drth": ohlcv, "f": feats, "macro_positioning_data": mac, "undated": none, "spy_rth_volatility": vol},
        train=("2020-01-01", "2020-12-31"),
    )
    rows = m.data.orderBy("Date").collect()
    assert [round(r.SPY_NextDay_Return, 4) for r in rows] == [0.1, 0.0, 0.0909, 0.0833, 0.0769]
    assert [r.macro_positioning_data_CPI for r in rows] == [1.0, 1.0, 1.0, 2.0, 2.0]
    assert not any("empty" in c or "note" in c or "spy_rth_volatility" in c for c in m.data.columns)
    assert m.dropped == ["f_leak"] and "f_leak" not in m.features and "spy_ohlcv_1drth_close" in m.features
    assert set(m.null_before) == {"spy_ohlcv_1drth", "f", "macro_positioning_data", "spy_rth_volatility"}
    master.write_master(m, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "master_parquet")).count() == 5


def test_top_n_limits_before_the_shuffle(spark):
    import io
    from contextlib import redirect_stdout

    df = spark.range(1000).select((F.col("id") % 2).alias("date"), "id")
    out = align.top_n(df, 3, ["date"], ["id"])
    buf = io.StringIO()
    with redirect_stdout(buf):
        out.explain()
    assert "WindowGroupLimit" in buf.getvalue().split("Exchange")[1]
    assert sorted(r.id for r in out.collect()) == [0, 1, 2, 3, 4, 5]


def test_master_keeps_the_last_row_of_a_date(spark):
    vol = spark.createDataFrame([("2020-01-01", 1), ("2020-01-02", 1), ("2020-01-03", 1)], "Date string, v int")
    bars = spark.createDataFrame([("2020-01-01", 1.0, 1), ("2020-01-01", 2.0, 2), ("2020-01-02", 3.0, 1), ("2020-01-03", 6.0, 1)], "Date string, close double, n int")
    sources = {"spy_rth_volatility": vol, "spy_ohlcv_1drth": bars}
    m = master.build_master(sources, train=("2020-01-01", "2020-12-31"), dedupe="last", order={"spy_ohlcv_1drth": "n"})
    assert [r.spy_ohlcv_1drth_close for r in m.data.orderBy("Date").collect()] == [2.0, 3.0]
    with pytest.raises(ValueError):
        master.build_master(sources, dedupe="last")


def test_stacked_tables_join_in_one_shuffle(spark):
    import io
    from contextlib import redirect_stdout

    spine = spark.createDataFrame([(1, "a"), (2, "a"), (1, "b"), (1, "b")], "k int, s string")
    tables = {n: spark.createDataFrame([(1, "a", float(i)), (9, "z", 1.0)], f"k int, s string, {n}_v double") for i, n in enumerate("pqr")}
    out = align.stack_join(spine, tables, ["s", "k"])
    assert sorted(map(tuple, out.collect())) == [("a", 1, 0.0, 1.0, 2.0), ("a", 2, None, None, None), ("b", 1, None, None, None)]
    buf = io.StringIO()
    with redirect_stdout(buf):
        align.stack_join(spine.select("s", "k"), {n: t for n, t in tables.items()}, ["s", "k"]).explain()
    assert buf.getvalue().count("Exchange hashpartitioning") <= 2  # the spine's distinct rows, and the fold
    twice = {"p": tables["p"].unionByName(tables["p"].withColumn("p_v", F.lit(7.0)))}
    with pytest.raises(Exception, match="duplicate dates"):
        align.stack_join(spine, twice, ["s", "k"]).collect()
    last = align.stack_join(spine, twice, ["s", "k"], "last", {"p": "p_v"}).filter("s = 'a' AND k = 1").first()
    assert last["p_v"] == 7.0
    with pytest.raises(ValueError):
        align.stack_join(spine, twice, ["s", "k"], "last")


def test_master_of_several_symbols(spark):
    import datetime as dt

    day = [dt.date(2020, 1, i + 1) for i in range(4)]
    vol = spark.createDataFrame([(s, x, 1.0) for s in "AB" for x in day], "symbol string, Date date, v double")
    px = spark.createDataFrame([(s, x, float(i + k + 1)) for k, s in enumerate("AB") for i, x in enumerate(day)], "symbol string, Date date, close double")
    mac = spark.createDataFrame([(day[1], 5.0)], "Date date, CPI double")
    m = master.build_master({"spy_rth_volatility": vol, "spy_ohlcv_1drth": px, "macro_positioning_data": mac}, train=("2020-01-01", "2020-12-31"), dedupe="error", by=("symbol",))
    got = sorted((r["symbol"], r["Date"].day, r["spy_ohlcv_1drth_close"], r["macro_positioning_data_CPI"], round(r["SPY_NextDay_Return"], 4)) for r in m.data.collect())
    assert got == [("A", 1, 1.0, None, 1.0), ("A", 2, 2.0, 5.0, 0.5), ("A", 3, 3.0, 5.0, 0.3333), ("B", 1, 2.0, None, 0.5), ("B", 2, 3.0, 5.0, 0.3333), ("B", 3, 4.0, 5.0, 0.25)]
    report = {(r["source"], r["stage"]): r["null_pct"] for r in master.null_report(m).collect()}
    assert report["macro_positioning_data", "after"] == 75.0 and report["macro_positioning_data", "before"] == 0.0


def test_pair_sums_read_the_rows_once(spark):
    """The matrix both ways comes from one pass over the rows, and its wide expressions are compiled, not interpreted."""
    limit = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    df = spark.range(40).selectExpr("id % 7 AS a", "CASE WHEN id % 5 > 0 THEN id * id END AS b", "1.5D AS flat", "CASE WHEN id % 3 > 0 THEN id / (id % 3) END AS c")
    found = panel.correlation_matrix(df, ["a", "b", "flat", "c"])
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit
    got = {(r.a, r.b): r["corr"] for r in found.collect()}
    want = df.toPandas().astype(float).corr()
    assert len(got) == 16
    for (a, b), v in got.items():
        assert v is None if "flat" in (a, b) else v == pytest.approx(want.loc[a, b], abs=1e-9), (a, b)


def test_methods_are_short_while_a_table_settles(spark):
    with session.settings(spark, {"spark.sql.codegen.hugeMethodLimit": "65535"}):
        with session.short_methods(spark):
            assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"


def test_master_sources_read_the_ticks_for_the_assets_once(spark, data):
    """The four sources made of asset rows start from kept rows, not from the ticks again."""
    from barloom.catalog import master_rows

    found = master_rows.sources(spark, data)
    for name in ("market_indicators", "macro_risk_data", "asset_prices", "asset_volumes"):
        assert "parquet" not in found[name]._jdf.queryExecution().optimizedPlan().toString().lower(), name
