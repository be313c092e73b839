"""Readers, sinks, date parsing and column rules run over the given tables (A, B), and native text scores (J6, P13)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F, types as T

from barloom import views
from barloom.catalog.basics import ALL_ASSETS, ASSETS_CTE, CHAIN_CTE, r6, rnd
from barloom.catalog.kit import bars_cte, query
from barloom.catalog.products import SCALE
from barloom.functions.market import quote_to_percent
from barloom.operators import profile
from barloom.plans import sentiment
from barloom.session import scratch
from barloom.sources import ingest, sinks

BARS = bars_cte()
ORDERS = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderpriority", T.StringType())])


def _orders(spark, d):
    return views.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("a1_scan_csv", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def a1(spark, d):
    path = scratch(spark)
    sinks.write_csv(_orders(spark, d), path)
    return ingest.scan_csv(spark, path, ORDERS)


@query(
    "a2_scan_csv_tolerant",
    "SELECT CAST(o_orderkey AS VARCHAR) AS k, o_orderstatus AS s, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS p FROM orders WHERE o_orderkey % 7 <> 0",
)
def a2(spark, d):
    """Every seventh line has a field too many and goes, every fifth lacks one and is padded."""
    path = scratch(spark)
    o = views.table(spark, d, "orders")
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")))
    full = F.concat_ws(",", F.col("o_orderkey").cast("string"), "o_orderstatus", "o_orderpriority", F.lit("extra"))
    part = F.pmod("o_orderkey", F.lit(8)).alias("part")
    lines = o.select(part, F.lit(1).alias("o"), F.when(F.col("o_orderkey") % 7 == 0, full).otherwise(line).alias("value"))
    # Every file begins with a header, as the files of a drop do.
    heads = spark.range(8).select(F.col("id").alias("part"), F.lit(0).alias("o"), F.lit("k,s,p").alias("value"))
    files = lines.unionByName(heads).repartition("part").sortWithinPartitions("part", "o")
    files.select("part", "value").write.partitionBy("part").text(path)
    path += "/*"
    return ingest.scan_csv_tolerant(spark, path)


@query(
    "a3_normalize_ohlcv",
    f"WITH {BARS} SELECT symbol, ts, {r6('ln(open)')} AS o, {r6('ln(close)')} AS c, CASE WHEN volume % 3 <> 0 THEN volume END AS volume FROM bars",
)
def a3(spark, d):
    b = views.bars_daily(spark, d)
    text = F.when(F.col("volume") % 3 != 0, F.col("volume").cast("string")).otherwise("n/a")
    raw = b.select(F.col("symbol").alias("Symbol"), F.col("ts").cast("string").alias("DATE"), F.lit("x").alias("time"),
                   F.col("open").alias("Open"), F.col("high").alias("HIGH"), F.col("low").alias("Low"), F.col("close").alias("Close"), text.alias("Volume"))
    out = ingest.normalize_ohlcv(raw)
    return out.select("symbol", "ts", rnd(F.ln("open")).alias("o"), rnd(F.ln("close")).alias("c"), "volume")


@query(
    "a5_detect_date_col",
    "SELECT 'Time' AS picked, count(DISTINCT CAST(ts AS DATE)) AS days FROM events UNION ALL SELECT 'DATE', count(DISTINCT CAST(o_orderdate AS DATE)) FROM orders"
    " UNION ALL SELECT 'QuoteDate', count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem",
)
def a5(spark, d):
    frames = [
        views.table(spark, d, "events").select(F.col("ts").alias("Time"), F.col("ts").alias("date")),
        views.table(spark, d, "orders").select(F.col("o_orderdate").alias("DATE"), F.col("o_orderdate").alias("timestamp")),
        views.table(spark, d, "lineitem").select(F.col("l_shipdate").alias("QuoteDate"), "l_orderkey"),
    ]
    found = [(f, ingest.detect_date_column(f.columns)) for f in frames]
    rows = [f.select(F.lit(c).alias("picked"), F.to_date(c).alias("x")).groupBy("picked").agg(F.countDistinct("x").alias("days")) for f, c in found]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "a6_parse_dates_multi",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d0, CAST(o_orderdate AS DATE) AS d1, CAST(o_orderdate AS DATE) AS d2,"
    " CASE WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) END AS d3, CAST(o_orderdate AS DATE) AS d4 FROM orders",
)
def a6(spark, d):
    """A text column per format. Day first also fits month first in some rows, and then the first format decides for all."""
    o = views.table(spark, d, "orders")
    out = o.select("o_orderkey", *[F.date_format("o_orderdate", f).alias(f"t{k}") for k, f in enumerate(ingest.DATE_FORMATS)])
    for k in range(len(ingest.DATE_FORMATS)):
        out = ingest.parse_dates(out, f"t{k}", f"d{k}")
    return out.select("o_orderkey", *[F.to_date(f"d{k}").alias(f"d{k}") for k in range(len(ingest.DATE_FORMATS))])


@query("a7_normalize_date", "SELECT event_id, CAST(ts AS DATE) AS \"Date\" FROM events WHERE event_id % 5 <> 0")
def a7(spark, d):
    ev = views.table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 5 != 0, F.col("ts")).alias("Date"))
    return ingest.normalize_date(ev)


@query(
    "a8_eastern_walltime",
    "SELECT event_id, date_trunc('second', ts) AS wall, date_trunc('second', ts) + INTERVAL 5 HOUR AS utc FROM events",
)
def a8(spark, d):
    """Offsets are dropped, not converted; in January New York is five hours behind."""
    tail = F.element_at(F.array(*map(F.lit, ("-05:00", "Z", "", "+0100"))), (F.col("event_id") % 4 + 1).cast("int"))
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), tail)
    wall = ingest.eastern_wall_time(text)
    return views.table(spark, d, "events").select("event_id", wall.alias("wall"), ingest.eastern_instant(wall).alias("utc"))


WIDE_SQL = ", ".join(f"{r6(f'ln(max(close) FILTER (asset = {a!r}) * 0.5)')} AS {a}" for a in ALL_ASSETS)


@query("a11_flatten_prefer_adj", f"WITH {ASSETS_CTE} SELECT ts, {WIDE_SQL} FROM assets GROUP BY ts")
def a11(spark, d):
    """Closes and adjusted closes side by side: the adjusted ones win."""
    pick = lambda a: F.max(F.when(F.col("asset") == a, F.col("close")))
    wide = views.assets(spark, d).groupBy("ts").agg(
        *[pick(a).alias(f"Close_{a}") for a in ALL_ASSETS], *[(pick(a) * 0.5).alias(f"Adj Close_{a}") for a in ALL_ASSETS]
    )
    flat = ingest.flatten_prefer_adjusted(wide, ["ts"])
    return flat.select("ts", *[rnd(F.ln(a)).alias(a) for a in ALL_ASSETS])


@query("a11_adjusted_close", f"WITH {ASSETS_CTE} SELECT asset, ts, {r6('ln(close / 4)')} AS close FROM assets")
def a11_column(spark, d):
    a = views.assets(spark, d).select("asset", "ts", F.col("close").alias("Close"), (F.col("close") / 4).alias("Adj_Close"))
    return a.select("asset", "ts", rnd(F.ln(ingest.adjusted_close(a))).alias("close"))


@query("a13_flatten_history", f"WITH {BARS} SELECT ts AS time, {r6('ln(close)')} AS close, volume FROM bars WHERE symbol = 'R'")
def a13(spark, d):
    history = views.bars_daily(spark, d).withColumnRenamed("ts", "time").withColumn("note", F.lit(1))
    out = ingest.pick_history(history, "R")
    return out.select("time", rnd(F.ln("close")).alias("close"), "volume")


@query("a14_load_option_chain", f"WITH {CHAIN_CTE} SELECT cp, strike, volume, oi, {r6('iv')} AS iv FROM chain")
def a14_reader(spark, d):
    """Calls and puts written as the two files of a snapshot and read back."""
    path, chain = scratch(spark), views.chain(spark, d)
    for tag in "CP":
        cells = {f.name: F.lit(None).cast(f.dataType) for f in ingest.OPTION_SCHEMA}
        cells |= {c: F.col(c) for c in ("strike", "volume", "openInterest", "impliedVolatility")}
        sinks.write_csv(chain.filter(F.col("cp") == tag).select(*[c.alias(n) for n, c in cells.items()]), f"{path}/{tag}")
    out = ingest.load_option_chain(spark, f"{path}/C", f"{path}/P")
    return out.select("cp", "strike", "volume", F.col("openInterest").alias("oi"), rnd("impliedVolatility").alias("iv"))


@query(
    "a15_load_series_set",
    "SELECT 'price' AS name, o_orderkey AS ts, o_totalprice AS value FROM orders UNION ALL SELECT 'quantity', l_orderkey, sum(l_quantity) FROM lineitem GROUP BY l_orderkey",
)
def a15(spark, d):
    """A series without rows is left out."""
    o = views.table(spark, d, "orders").select(F.col("o_orderkey").alias("ts"), F.col("o_totalprice").alias("value"))
    li = views.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("ts")).agg(F.sum("l_quantity").alias("value"))
    return ingest.load_series_set({"price": lambda: o, "quantity": lambda: li, "empty": lambda: o.filter("ts < 0")}, on_error="raise")


@query("a16_sink_csv", f"WITH {BARS} SELECT strftime(ts, '%Y-%m-%d') AS \"Date\", symbol, {r6('ln(close)')} AS \"Close\", volume AS \"Volume\" FROM bars")
def a16(spark, d):
    path = scratch(spark)
    sinks.write_csv(sinks.daily_table(views.bars_daily(spark, d)), path)
    back = spark.read.option("header", True).csv(path)
    return back.select("Date", "symbol", rnd(F.ln(F.col("Close").cast("double"))).alias("Close"), F.col("Volume").cast("double").alias("Volume"))


@query("a17_sink_parquet", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def a17(spark, d):
    path = scratch(spark)
    sinks.write_parquet(_orders(spark, d), path, ["o_orderpriority"])
    return spark.read.parquet(path).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("a18_sink_if_missing", "SELECT n_nationkey, n_name FROM nation")
def a18(spark, d):
    """The second write finds the target there and changes nothing."""
    path, nations = scratch(spark), views.table(spark, d, "nation").select("n_nationkey", "n_name")
    sinks.write_if_missing(nations, path)
    sinks.write_if_missing(nations.withColumn("n_name", F.lit("other")), path)
    return spark.read.option("header", True).schema(nations.schema).csv(path)


@query("a19_sink_feature_list", "SELECT column_name AS name FROM (DESCRIBE lineitem) WHERE column_name LIKE 'l!_%' ESCAPE '!'")
def a19(spark, d):
    path = scratch(spark)
    sinks.write_feature_list(spark, views.table(spark, d, "lineitem").columns, path)
    return spark.read.text(path).select(F.col("value").alias("name"))


@query("b1_prefix_columns", "SELECT o_orderkey AS \"Date\", o_totalprice AS t_price, o_orderstatus AS t_status FROM orders")
def b1(spark, d):
    o = views.table(spark, d, "orders").select(F.col("o_orderkey").alias("Date"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    return profile.prefix_columns(o, "t")


@query("b2_rename_select", f"WITH {BARS} SELECT strftime(ts, '%Y-%m-%d') AS \"Date\", symbol, volume AS \"Volume\" FROM bars")
def b2(spark, d):
    return sinks.daily_table(views.bars_daily(spark, d).select("symbol", "ts", "volume"))


@query("b9_drop_all_null_cols", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS half FROM orders")
def b9(spark, d):
    o = views.table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")).alias("half"), F.lit(None).cast("double").alias("none"), F.when(F.col("o_orderkey") < 0, 1).alias("never")
    )
    return profile.drop_all_null(o, ())


@query("b11_select_features", "SELECT 'x_close' AS name, avg(l_tax) AS m FROM lineitem UNION ALL SELECT 'l_quantity', avg(l_quantity) FROM lineitem")
def b11(spark, d):
    """Names that would leak prices, the date, the target and macro columns are no features."""
    li = views.table(spark, d, "lineitem").select(
        F.col("l_shipdate").alias("Date"), F.col("l_tax").alias("x_close"), "l_quantity", F.col("l_tax").alias("a_Close"), F.col("l_tax").alias("macro_positioning_data_CPI"),
        F.col("l_tax").alias("sector_data_Prices_X"), F.col("l_tax").alias("SPY_NextDay_Return"), F.col("l_tax").alias("SPY_Close"),
    )
    kept = profile.select_features(li.columns)
    means = li.select(*[F.avg(c).alias(c) for c in kept])
    return means.unpivot([], kept, "name", "m")


@query("b14_unit_scale", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity / 10, 6) AS pct FROM lineitem")
def b14(spark, d):
    return views.table(spark, d, "lineitem").select(*views.TICK_ORDER, rnd(quote_to_percent("l_quantity")).alias("pct"))


@query(
    "b15_group_columns",
    "SELECT coalesce(o.ts, l.ts) AS ts, o_n, l_n FROM (SELECT CAST(o_orderdate AS DATE) AS ts, count(*) AS o_n FROM orders GROUP BY 1) AS o"
    " FULL JOIN (SELECT CAST(l_shipdate AS DATE) AS ts, count(*) AS l_n FROM lineitem GROUP BY 1) AS l ON o.ts = l.ts",
)
def b15(spark, d):
    count = lambda t, c: views.table(spark, d, t).groupBy(F.to_date(c).alias("ts")).agg(F.count("*").alias("n"))
    return profile.group_columns({"o": count("orders", "o_orderdate"), "l": count("lineitem", "l_shipdate")})


# -- text scores --------------------------------------------------------------------------
LEXICON = {"good": 1.0, "bad": -1.0}
# A checksum of a word, its letters folded through eight shift steps each.
CRC_SQL = (
    "xor(4294967295, list_reduce(list_transform(string_split(w, ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda crc, b:"
    " list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[], lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), CAST(4294967295 AS BIGINT)))"
)
WORDS_SQL = "regexp_extract_all(lower(coalesce({0}, '')), '[a-z]+')"
WEIGHTS_SQL = f"weights AS (SELECT w, CASE w WHEN 'good' THEN 1.0 WHEN 'bad' THEN -1.0 ELSE ({CRC_SQL} % 21) * 0.1 - 1.0 END AS v FROM (SELECT DISTINCT unnest(ws) AS w FROM t) AS u)"
SCORES_SQL = f"t AS (SELECT *, {WORDS_SQL} AS ws FROM src), {WEIGHTS_SQL}, s AS (SELECT id, avg(v) AS score FROM (SELECT id, unnest(ws) AS w FROM t) AS x JOIN weights USING (w) GROUP BY id)"


@query(
    "j6_score_text_hashed",
    f"WITH src AS (SELECT doc_id AS id, text FROM documents), {SCORES_SQL.format('text')} SELECT t.id AS doc_id, round(coalesce(score, 0) * {SCALE}, 6) + 0.0 AS sentiment_score FROM t LEFT JOIN s USING (id)",
)
def j6_hashed(spark, d):
    """Every document scored by fixed word weights."""
    docs = views.table(spark, d, "documents")
    return docs.select("doc_id", rnd(sentiment.hashed_score("text", lexicon=LEXICON) * SCALE).alias("sentiment_score"))


@query(
    "p13_daily_sentiment_text",
    "WITH src AS (SELECT doc_id AS id, DATE '2024-01-01' + CAST(doc_id % 40 AS INT) AS day, left(text, 60) || '. ' || coalesce(text, '') AS text FROM documents"
    " QUALIFY row_number() OVER (PARTITION BY doc_id % 40 ORDER BY doc_id) <= 10),"
    f" {SCORES_SQL.format('text')} SELECT day AS date, round(avg(coalesce(score, 0)) * {SCALE}, 6) + 0.0 AS sentiment_score FROM t LEFT JOIN s USING (id) GROUP BY day",
)
def p13_text(spark, d):
    """Documents as news of forty days: the first ten of a day, scored from their text, averaged."""
    docs = views.table(spark, d, "documents")
    time = F.timestamp_add("DAY", F.col("doc_id") % 40, F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz"))
    news = docs.select(time.alias("time"), F.col("doc_id").alias("id"), F.substring("text", 1, 60).alias("title"), F.col("text").alias("description"))
    scored = sentiment.daily_sentiment(news, lambda a: a.withColumn("sentiment_score", sentiment.hashed_score("text", lexicon=LEXICON)))
    return scored.withColumn("sentiment_score", rnd(F.col("sentiment_score") * SCALE))
