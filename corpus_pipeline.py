"""A corpus pipeline of five stages over ``documents``; each is written as Parquet and read again.

toxicity: documents scored as toxic go. near duplicates: one document of each component of the Jaccard
join stays. decontamination: documents that leak a benchmark item go. secrets: live credentials in the texts are
masked. mix: sources are taken by target weights; a row per repetition, with the words taken.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from barloom.llm import jaccard, mixing, secret_scan, templates, toxicity
from barloom.llm.tables import read, shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.filtered(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return templates.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redacted(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", mask_secrets),
    ("mix", mix_sources),
]

# Training a classifier and template matching have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps goes to the shared folder and is read back."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
