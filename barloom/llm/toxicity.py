"""Toxicity scores by non-negative positive-unlabelled learning (operator 10).

Confirmed toxic texts and unlabelled texts train a linear numpy classifier on the words and word beginnings
of a text. The risk counts the positives with the class prior, takes their share out of the unlabelled
risk, and keeps that difference from going below zero. Training sees a bounded sample: at most
``MAX_POSITIVE`` labelled toxic rows and ``MAX_UNLABELLED`` rows of any kind, drawn by a hash of the id; scoring
covers every whole text.

A third of the ids (crc32 of the id modulo 3 equal to 1) is held out: neither their labels nor their texts
are trained on. A null text is empty and gets the score of the bias; a null id is not held out and
has no label; of repeated labels the highest counts. Repeated rows get a score each; an empty table gives an
empty result; with no toxic label all scores are the prior. Extra columns are kept by ``filtered``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Collection, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from barloom.llm.registry import query
from barloom.llm.tables import fill, give_back, read, settle, ship

MAX_POSITIVE = 3000
MAX_UNLABELLED = 5000
MAX_FEATURES = 1024
PENALTY = 5e-5
BEGINNINGS = (3, 4, 5, 6, 7, 8)
THRESHOLD = 0.7
BUCKETS = 1 << 24  # bytes
TRIM = re.compile(r"^[\W_]+|[\W_]+$")


@lru_cache(maxsize=20_000)
def features_of(word: str) -> tuple[str, ...]:
    """The trimmed word and its beginnings (marked with a star)."""
    w = word if word.isalnum() else TRIM.sub("", word)
    return (w, *[w[:n] + "*" for n in BEGINNINGS if len(w) >= n]) if w else ()


def features(text: str) -> set[str]:
    return {f for w in set(text.lower().split()) for f in features_of(w)}


class Finder:
    """The features of a text that stand in ``wanted``; remembers what each word has, up to a number of words."""

    REMEMBERED = 250_000

    def __init__(self, wanted: Collection[str]):
        self.wanted = wanted
        self.starts = {f[:4] for f in wanted}  # a word or its shortest beginning starts like each of its features
        self.seen: set[str] = set()
        self.marked: set[str] = set()
        self.having: dict[str, list[str]] = {}

    def learn(self, words: set[str]) -> None:
        for word in words:
            w = word if word.isalnum() else TRIM.sub("", word)
            if w and (w[:4] in self.starts or w[:3] + "*" in self.starts) and (found := [f for f in (w, *[w[:n] + "*" for n in BEGINNINGS if len(w) >= n]) if f in self.wanted]):
                self.having[word] = found
                self.marked.add(word)
        self.seen |= words

    def __call__(self, text: str) -> set[str]:
        if len(self.seen) >= self.REMEMBERED:
            self.seen, self.marked, self.having = set(), set(), {}
        words = set(text.lower().split())
        if new := words - self.seen:
            self.learn(new)
        return {f for w in words & self.marked for f in self.having[w]}


def common_features(texts: list[str], least: int, buckets: int = BUCKETS) -> Counter[str]:
    """The features that ``least`` texts or more hold, and their number of texts.

    Features are counted in buckets by hash first; only those of buckets that reach ``least`` are ever held by name.
    """
    full = np.zeros(buckets, dtype=np.uint8)
    for t in texts:
        at = np.unique(np.fromiter((hash(f) % buckets for f in features(t)), dtype=np.int64))
        full[at] = np.minimum(full[at] + 1, least)
    counted = Counter(f for t in texts for f in features(t) if full[hash(f) % buckets] >= least)
    return Counter({f: n for f, n in counted.items() if n >= least})


def fit(positive: list[str], unlabelled: list[str], prior: float, rounds: int = 400, penalty: float = PENALTY) -> tuple[dict[str, float], float]:
    """Weights by feature and the bias, from texts; non-negative PU risk with logistic loss."""
    rest = math.log(prior / (1 - prior))
    if not positive or not unlabelled:
        return {}, rest
    # Only features of three positive texts or more are held, in a text by their numbers.
    p_df = common_features(positive, 3)
    number, present = {f: k for k, f in enumerate(p_df)}, Finder(p_df)
    rows = [np.fromiter((number[f] for f in present(t)), dtype=np.int32) for t in (*positive, *unlabelled)]
    n_p, n_u = len(positive), len(unlabelled)
    u_df = dict(zip(number, np.bincount(np.concatenate(rows[n_p:]), minlength=len(number)).tolist()))

    def contrast(f: str) -> float:
        p, u = p_df[f] / n_p, u_df[f] / n_u
        both = (p_df[f] + u_df[f] + 1) / (n_p + n_u + 2)
        return (p - u) / math.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))

    strong = sorted(((contrast(f), f) for f in p_df), key=lambda x: (-x[0], x[1]))
    # Of features that the same texts hold only the shortest counts, or one word would weigh several times.
    holders: dict[str, list[int]] = {f: [] for z, f in strong[: 4 * MAX_FEATURES] if z > 4}
    held_by = {number[f]: holders[f] for f in holders}
    for i, row in enumerate(rows):
        for k in row.tolist():
            if k in held_by:
                held_by[k].append(i)
    shortest: dict[tuple, str] = {}
    for f in sorted(holders, key=lambda f: (len(f), f)):
        shortest.setdefault(tuple(holders[f]), f)
    once = set(shortest.values())
    chosen = [f for f in holders if f in once][:MAX_FEATURES]
    at = {f: j for j, f in enumerate(chosen)}
    place = np.full(len(number) + 1, -1)
    place[[number[f] for f in chosen]] = np.arange(len(chosen))
    x = np.zeros((n_p + n_u, len(chosen) + 1), dtype=np.float32)
    for i, row in enumerate(rows):
        columns = place[row]
        x[i, columns[columns >= 0]] = 1.0
    x[:, -1] = 1.0
    xp, xu = x[:n_p], x[n_p:]
    w = np.zeros(x.shape[1], dtype=np.float64)
    w[-1] = rest
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        gp, gu = xp @ w.astype(np.float32), xu @ w.astype(np.float32)
        sp, su = sigmoid(gp), sigmoid(gu)
        negative_u, negative_p = np.logaddexp(0, gu).mean(), np.logaddexp(0, gp).mean()
        as_positive = prior * (xp.T @ (sp - 1)) / n_p
        as_negative = (xu.T @ su) / n_u - prior * (xp.T @ sp) / n_p
        # Below zero the unlabelled part has been fitted too closely: step back on it alone.
        grad = as_positive + as_negative if negative_u - prior * negative_p >= 0 else -as_negative
        grad = grad.astype(np.float64)
        grad[:-1] += penalty * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return {f: float(w[j]) for f, j in at.items()}, float(w[-1])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], float]:
    """The classifier from rows that are not held out; fitted in one task over the bounded sample."""
    ship(docs.sparkSession)
    known = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n, toxic = known.agg(F.count("*"), F.sum((F.col("toxic") == 1).cast("int"))).first()
    prior = ((toxic or 0) + 1) / (n + 10)
    drawn = lambda ids, most, cls: ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).withColumn("cls", F.lit(cls))
    ids = docs.select("doc_id").filter(F.col("doc_id").isNotNull() & ~held_out())
    sample = drawn(known.filter("toxic = 1").select("doc_id"), MAX_POSITIVE, 1).unionByName(drawn(ids, MAX_UNLABELLED, 0))
    # At most MAX_POSITIVE + MAX_UNLABELLED ids: a broadcast of fixed size.
    texts = docs.select("doc_id", fill("text").alias("text")).join(F.broadcast(settle(sample.distinct())), "doc_id")

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates().sort_values(["cls", "doc_id", "text"])
        by = {c: rows.loc[rows["cls"] == c, "text"].tolist() for c in (0, 1)}
        del rows
        weights, bias = fit(by[1], by[0], prior)
        del by
        features_of.cache_clear()
        give_back()
        return pd.DataFrame({"feature": ["", *weights], "weight": [bias, *weights.values()]})

    rows = texts.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(learn, "feature string, weight double").collect()
    weights = {r["feature"]: r["weight"] for r in rows}
    return weights, weights.pop("", math.log(prior / (1 - prior)))


class Scorer:
    """Scores texts by the weights of their features."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias, self.present = weights, bias, Finder(weights)

    def score(self, text: str) -> float:
        total = self.bias + math.fsum(self.weights[f] for f in self.present(text))
        return 0.5 * (1 + math.tanh(0.5 * total))


def scored(docs: DataFrame, weights: dict[str, float], bias: float) -> DataFrame:
    """``docs`` with ``score`` added; every whole text is scored where it is read."""
    ship(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(weights, bias)
        for b in batches:
            scores = [scorer.score(t.as_py() or "") for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(scores, pa.float64())], names=[*b.schema.names, "score"])
        del scorer
        give_back()

    return docs.mapInArrow(run, schema)


def filtered(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents scored at or above ``threshold``."""
    weights, bias = train(docs, labels)
    out = scored(docs.select(*docs.columns), weights, bias)
    return out.filter(F.col("score") < threshold).select(*docs.columns)


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    weights, bias = train(docs, read(spark, sf_dir, "labels"))
    return scored(docs, weights, bias).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
