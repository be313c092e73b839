"""Sharding by proportional stratified interleaving (operator 13).

The rows of every source are shuffled by a seeded hash and ranked; the fractional rank ``(rank + 1/2) / rows of the
source`` spreads each source evenly over [0, 1). All rows sorted by it are cut into shards of equal
count, so every stretch, and with it every shard, holds the sources in their overall proportion, and reads of a shard in
slot order stay mixed. The law is ``rows``: counts of two shards differ by one at most. Equal texts are rows like
others; they may land in different shards.

No task sees a whole source: the shuffled order is cut into buckets by its leading digits, the counts of the
buckets give every bucket its first rank, and the same is done for the buckets of the fractional rank.

A null source is a source of its own, last in order. A null text has no bytes. A null id is hashed like an
empty one. Ties of the shuffle go by the id, then by a hash of all columns; rows equal in all of them may take each
other's place. Very long texts matter only where texts are carried (``interleaved`` carries all columns through its two
shuffles, the query carries lengths and checksums). With fewer rows than shards some shards are empty; an empty table
gives an empty result. Extra columns are kept; one named like an output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from barloom.llm.registry import query
from barloom.llm.tables import fill, read, settle

SHARDS = 16
SEED = 23
BUCKET_ROWS = 32_768
LEAST_BUCKETS = 64
LAW = "rows"


def starts_of(counts: DataFrame, by: list[str], bucket: str, name: str) -> DataFrame:
    """``name``: the rows in earlier buckets, from one row per bucket with its count ``_n``."""
    before = W.partitionBy(*by).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum("_n").over(before), F.lit(0)))


def interleaved(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, source: str = "source", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``shard`` (from 0), ``slot`` (from 0 in each shard, in interleaved order) and ``law``."""
    total = docs.count()
    digits = 2
    while total / 16**digits > BUCKET_ROWS:
        digits += 1
    slices = max(LEAST_BUCKETS, -(-total // BUCKET_ROWS))
    order = F.md5(F.concat(F.lit(f"{seed}:"), fill(F.col(key).cast("string"))).cast("binary"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(source).isNull().alias("s_null"),
        fill(F.col(source).cast("string")).alias("s"),
        order.alias("order"),
        F.substring(order, 1, digits).alias("bucket"),
        F.col(key).alias("key"),
        F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("tie"),
    )
    counts = rows.groupBy("s_null", "s", "bucket").agg(F.count("*").alias("_n"))
    counts = starts_of(counts, ["s_null", "s"], "bucket", "first")
    counts = counts.withColumn("rows", F.sum("_n").over(W.partitionBy("s_null", "s"))).drop("_n")
    within = W.partitionBy("s_null", "s", "bucket").orderBy("order", "key", "tie")
    ranked = rows.join(counts, ["s_null", "s", "bucket"]).withColumn("rank", F.col("first") + F.row_number().over(within) - 1)
    ranked = ranked.withColumn("fraction", (F.col("rank") + F.lit(0.5)) / F.col("rows"))
    ranked = settle(ranked.select("row", "s_null", "s", "rank", "fraction", F.floor(F.col("fraction") * slices).alias("slice")))
    sliced = starts_of(ranked.groupBy("slice").agg(F.count("*").alias("_n")), [], "slice", "above").drop("_n")
    within = W.partitionBy("slice").orderBy("fraction", "s_null", "s", "rank")
    at = F.col("above") + F.row_number().over(within) - 1
    placed = ranked.join(sliced, "slice").withColumn("at", at)
    shard = F.expr(f"at * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    placed = placed.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("at") - first)
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ("shard", "slot", "law")]
    return placed.select(*kept, "shard", "slot", F.lit(LAW).alias("law"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, file_rows: int = 1_000_000, **options) -> None:
    """The shards as Parquet folders ``shard=k``; files hold ``file_rows`` rows at most, each in slot order."""
    placed = interleaved(docs, shards, **options).withColumn("part", F.expr(f"slot div {file_rows}"))
    placed = placed.repartition(F.col("shard"), F.col("part")).sortWithinPartitions("shard", "part", "slot")
    placed.write.option("maxRecordsPerFile", file_rows).partitionBy("shard", "part").parquet(path)


def bytes_of(text: str) -> Column:
    return fill(text).cast("binary")


SQL = r"""
WITH c AS (SELECT list_transform(range(256), lambda v: list_reduce([0, 1, 2, 3, 4, 5, 6, 7]::BIGINT[],
             lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), CAST(v AS BIGINT))) AS rest),
d AS (SELECT doc_id, source, strlen(coalesce(text, '')) + 1 AS size,
        xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: CAST('0x' || b AS BIGINT)),
          lambda crc, b: xor(rest[1 + (xor(crc, b) & 255)], crc >> 8), CAST(4294967295 AS BIGINT))) AS text_crc32 FROM documents, c),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('23:' || coalesce(CAST(doc_id AS VARCHAR), '')), doc_id) - 1 AS rank,
             count(*) OVER (PARTITION BY source) AS n, count(*) OVER () AS total FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY (rank + CAST(0.5 AS DOUBLE)) / n, source NULLS LAST, rank) - 1 AS pos FROM r),
q AS (SELECT *, pos * 16 // total AS shard FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'rows' AS law, CAST(shard AS INTEGER) AS shard,
       CAST(pos - (shard * total + 15) // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM q
"""


@query("op13_interleaved_shards", SQL)
def op13_interleaved_shards(spark, sf_dir):
    """Shard and slot of every document."""
    text = bytes_of("text")
    slim = read(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    placed = interleaved(slim)
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
