"""Daily sentiment: cap articles per day, score texts, average per day."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions.cells import headline_text
from barloom.operators.align import top_n
from barloom.operators.panel import daily_mean

NEGATIVE, NEUTRAL, POSITIVE = 0, 1, 2


def capped_articles(news: DataFrame, cap: int = 10, order: Sequence[str] = ("time", "id")) -> DataFrame:
    """(date, time, id, title, description, text), the first articles of each UTC day."""
    dated = news.withColumn("date", F.to_date("time"))
    kept = top_n(dated, cap, ["date"], order)
    return kept.withColumn("text", headline_text("title", "description"))


def fit_scorer(labelled: DataFrame, text: str = "text", label: str = "label", features: int = 1 << 16, iterations: int = 20) -> PipelineModel:
    """Three-class text model on hashed word counts; labels 0 negative, 1 neutral, 2 positive."""
    stages = [
        Tokenizer(inputCol=text, outputCol="_words"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        LogisticRegression(featuresCol="_tf", labelCol=label, maxIter=iterations, regParam=0.01, family="multinomial"),
    ]
    return Pipeline(stages=stages).fit(labelled.select(text, label))


def hashed_score(text: str | Column = "text", buckets: int = 21, lexicon: dict[str, float] | None = None) -> Column:
    """Mean weight of a text's words, in [-1, 1], as one expression of the engine: no model is loaded.

    Words are the runs of a-z after lower-casing. A word in ``lexicon`` has its weight there; any other has a fixed one by the
    checksum of its letters, spread evenly over ``buckets`` levels from -1 to 1. A text without words scores 0.
    """
    col = F.col(text) if isinstance(text, str) else text
    words = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit("([a-z]+)"), F.lit(1))

    def weight(w: Column) -> Column:
        level = F.crc32(w.cast("binary")) % buckets
        spread = level * F.lit(2.0 / (buckets - 1)) - F.lit(1.0)
        if not lexicon:
            return spread
        known = F.create_map(*[x for pair in lexicon.items() for x in map(F.lit, pair)])
        return F.coalesce(known[w], spread)

    total = F.aggregate(F.transform(words, weight), F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(words) > 0, total / F.size(words)).otherwise(F.lit(0.0))


def score_text(df: DataFrame, model: PipelineModel, out: str = "sentiment_score") -> DataFrame:
    """Probability of positive minus probability of negative, in [-1, 1]."""
    scored = model.transform(df)
    p = vector_to_array("probability")
    return scored.select(*df.columns, (F.get(p, F.lit(POSITIVE)) - F.get(p, F.lit(NEGATIVE))).alias(out))


def score_text_with(df: DataFrame, load: Callable[[], Callable[[pd.Series], pd.Series]], text: str = "text", out: str = "sentiment_score") -> DataFrame:
    """Score with an outside model: ``load`` runs once per task, then batches stream through."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predict = load()
        for batch in batches:
            yield predict(batch)

    return df.withColumn(out, score(F.col(text)))


def daily_sentiment(news: DataFrame, score: Callable[[DataFrame], DataFrame], cap: int = 10, order: Sequence[str] = ("time", "id")) -> DataFrame:
    """(date, sentiment_score): mean score over at most ``cap`` articles a day."""
    return daily_mean(score(capped_articles(news, cap, order)), "sentiment_score", ["date"])
