"""Mixing sources to target weights by capped water-filling (operator 3).

Every source gets a share of the budget by weight, but no more than ``max_epochs`` times its own size.
What a capped source cannot take is dealt again to the others by weight, until no source is above its
cap. A source's target is then taken as whole repetitions of all its documents plus a fractional
one: the documents in seeded order up to the rest, the last of them in part. The taken words of a source
so equal its target rounded to words.

Nulls: a null text has size 0; a null source is a source of its own, last in order. Repeated rows are mixed
each on its own; among equal rows it does not matter which is taken. An empty table gives an empty result.
A source without words has target 0. Extra columns are kept by ``mixed`` and ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from barloom.llm.registry import query
from barloom.llm.tables import WORD, fill, read, settle

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3
SEED = 17
BUCKET_ROWS = 50_000


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def source_ranks(sizes: DataFrame) -> DataFrame:
    """Sources with their rank by code point, null last; ranges are counted apart, no task sees all."""
    ranged = sizes.repartitionByRange(F.col("source").isNull(), F.col("source"))
    ranged = settle(ranged.withColumn("part", F.spark_partition_id()))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per range
    parts = ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("part").orderBy(F.col("source").isNull(), "source")) - 1
    return ranged.withColumn("inside", inside).join(parts, "part").withColumn("rank", F.col("before") + F.col("inside"))


def water_fill(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``; weights repeat along the ranks.

    Each round is one aggregate over the sources: those above their cap are clamped and the level
    (words per unit of weight) rises for the rest. The level never falls, so no source is freed again.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = source_ranks(sizes).select(
        "source", "source_size", weight.alias("weight"), (F.col("source_size") * max_epochs).cast("double").alias("cap")
    )
    ranked = settle(ranked)
    level, clamped = 0.0, -1
    while True:
        full = F.lit(clamped >= 0) & (F.col("cap") < F.col("weight") * level)
        total, taken, free, n = ranked.agg(
            F.sum("source_size"),
            F.sum(F.when(full, F.col("cap"))),
            F.sum(F.when(~full, F.col("weight"))),
            F.sum(full.cast("int")),
        ).first()
        if n is None or n == clamped or not free:
            break
        clamped, level = n, ((total or 0) - (taken or 0.0)) / free
    target = F.round(F.least("cap", F.col("weight") * level), 6)
    return ranked.select("source", "source_size", target.alias("target"))


def plan(docs: DataFrame, key: list[str], weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """``key``, ``size``, ``source_size``, ``target`` and ``taken`` for rows of ``key, source, size``.

    Settled input is read several times. The seeded order of a source is cut into buckets of its leading
    digits; sums of the buckets give every bucket its offset, so a large source is ordered by many tasks.
    """
    sources = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = settle(water_fill(sources, weights, max_epochs))
    rows = docs.count()
    digits = 1
    while rows / 16**digits > BUCKET_ROWS:
        digits += 1
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key]))
    rows = docs.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, digits))
    sums = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    above = W.partitionBy("source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_sum").over(above), F.lit(0)))
    starts = starts.join(goals.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).select(
        F.col("source").alias("_source"), F.col("_bucket").alias("_b"), "_start", "source_size", "target"
    )
    joined = rows.join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_b")))
    own = W.partitionBy("source", "_bucket").orderBy("_order", *key, "size").rowsBetween(W.unboundedPreceding, -1)
    at = F.col("_start") + F.coalesce(F.sum("size").over(own), F.lit(0))
    words = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.least(F.floor(words / F.col("source_size")), F.lit(max_epochs))).otherwise(0).cast("long")
    extra = F.greatest(F.lit(0), F.least(F.col("size"), words - whole * F.col("source_size") - F.col("_at")))
    return (
        joined.withColumn("_at", at)
        .withColumn("taken", (whole * F.col("size") + extra).cast("long"))
        .select(*key, "source", "size", "source_size", "target", "taken")
    )


def sized(docs: DataFrame, *more: str) -> DataFrame:
    return settle(docs.select("doc_id", "source", size_of(fill("text")).alias("size"), *more))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Documents as the mix takes them: a row per repetition with ``repetition`` (from 1) and ``taken``
    words of it; documents of which nothing is taken are left out."""
    key = F.xxhash64(fill("text"))
    keyed = settle(docs.select("doc_id", "source", size_of(fill("text")).alias("size"), key.alias("_text")))
    took = plan(keyed, ["doc_id", "_text"], weights, max_epochs, seed)
    # Equal rows: their repetitions are handed out one by one.
    took = took.groupBy("doc_id", "_text", "source").agg(F.sum("taken").alias("taken"), F.count("*").alias("copies"), F.first("size").alias("size"))
    took = took.select(*[F.col(c).alias(f"_{c.strip('_')}") for c in took.columns])
    spread = F.greatest(F.lit(1), F.ceil(F.col("_taken") / F.greatest(F.col("_size"), F.lit(1))))
    parts = took.filter("_taken > 0").withColumn("repetition", F.explode(F.sequence(F.lit(1), spread.cast("int"))))
    parts = parts.withColumn("taken", F.least(F.col("_size"), F.col("_taken") - (F.col("repetition") - 1) * F.col("_size")))
    one = docs.withColumn("_key", key).dropDuplicates(["doc_id", "_key", "source"])
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_key") == F.col("_text")) & F.col("source").eqNullSafe(F.col("_source"))
    return one.join(parts, same).select(*docs.columns, "repetition", F.col("taken").cast("long").alias("taken"))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS w
      FROM d GROUP BY source),
lv(k, level, n) AS (
  SELECT 0, CAST((SELECT sum(source_size) / sum(w) FROM s) AS DOUBLE), CAST(0 AS BIGINT)
  UNION ALL
  SELECT k + 1, (SELECT (sum(source_size) - coalesce(sum(3.0 * source_size) FILTER (3.0 * source_size < w * level), 0))
                        / sum(w) FILTER (3.0 * source_size >= w * level) FROM s), n + 1
  FROM lv WHERE k < 40),
g AS (SELECT source, source_size, round(least(3.0 * source_size, w * (SELECT max(level) FROM lv)), 6) AS target FROM s),
o AS (SELECT d.doc_id, d.size, g.source_size, g.target, CAST(round(g.target) AS BIGINT) AS words,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5('17:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
p AS (SELECT *, CASE WHEN source_size > 0 THEN least(words // source_size, 3) ELSE 0 END AS whole FROM o)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(whole * size + greatest(0, least(size, words - whole * source_size - pos)) AS BIGINT) AS taken FROM p
"""


@query("op3_source_mix", SQL)
def op3_source_mix(spark, sf_dir):
    """Words that a mix with weights 5, 2, 1 takes from every document."""
    docs = sized(read(spark, sf_dir, "documents"))
    return plan(docs, ["doc_id"]).select("doc_id", "size", "source_size", "target", "taken")
