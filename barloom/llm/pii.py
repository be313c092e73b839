"""Personal data by weak supervision (operator 5).

Candidate spans come from wide patterns. Four labelling functions vote on each: the strict form of its
kind, a gazetteer (mail domains, reserved networks, issuer digits, dialling codes), cue words before
it, and counter-cues that speak of identifiers. Expectation-maximisation over the counts of vote
patterns estimates every function's reliability per kind; a naive Bayes classifier on shape features is
then trained on the posteriors and decides which candidates beyond the base ones are reported.

Only counts of vote patterns and of feature values reach the driver; their number is fixed by the kinds,
votes and features, not by the data. Nulls: a null text is empty. Repeated rows keep a result each; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from barloom.llm import spans as S
from barloom.llm.registry import query
from barloom.llm.tables import fill, numbered, read, settle

# The base patterns, written so that long runs cost linear time (a match can only begin where
# its first run of characters begins or where the match before it ended).
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
# Wider candidates: written-out mail addresses, national phone numbers, social security numbers.
WIDE = {
    "mail_words": r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?[\[(]dot[\])]\x20?[A-Za-z0-9-]{1,63}){1,8}",
    "phone_national": r"(?<![0-9+().-])(?<!\+[0-9]{1,3}\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# Gazetteers and cues.
MAIL_ENDS = r"(?i)\.(com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu)$"
RESERVED_NET = r"^(0|10|127|169\.254|192\.168|22[4-9]|23[0-9]|24[0-9]|25[0-5])\."
ISSUER = r"^[3-6]"
DIALLING = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
CUES = {
    "email": r"(?i)(e-?mail|mail|contact|write to|schreib|correo|courriel)",
    "ip": r"(?i)(\bip\b|address|client|remote|host|from)",
    "card": r"(?i)(card|visa|mastercard|amex|payment|karte|tarjeta|carte)",
    "phone": r"(?i)(phone|tel\b|tel\.|call|mobile|fax|telefon|tel[eé]fono)",
    "mail_words": r"(?i)(e-?mail|mail|contact|write to|schreib|correo|courriel)",
    "phone_national": r"(?i)(phone|tel\b|tel\.|call|mobile|fax|telefon|tel[eé]fono)",
    "ssn": r"(?i)(ssn|social security|insurance)",
}
COUNTER = r"(?i)(version|release|order|invoice|isbn|issn|sha|build|section|commit|serial|part no)"
CONTEXT = 32
FUNCTIONS = ("form", "gazetteer", "context", "counter")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn test."""
    d = F.transform(F.split(F.reverse(digits(value)), ""), lambda x: x.cast("int"))
    twice = lambda x: F.when(x > 4, x * 2 - 9).otherwise(x * 2)
    odd = F.transform(d, lambda x, i: F.when(i % 2 == 1, twice(x)).otherwise(x))
    return F.aggregate(odd, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10 == 0


def octets_fit(value: Column) -> Column:
    """Every dotted part is at most 255, however many digits it has."""
    part = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
    return F.forall(F.split(value, r"\."), lambda p: part(p) & (F.substring(F.regexp_replace(p, "^0+(?=.)", ""), 1, 3).cast("int") <= 255))


def strict(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    return {
        "ip": octets_fit,
        "card": lambda v: (n >= 13) & (n <= 19) & luhn(v),
        "phone": lambda v: (n >= 9) & (n <= 15),
        "ssn": lambda v: ~v.rlike("^(000|666|9)|-00-|-0000$"),
    }.get(kind, lambda v: F.lit(True))(value)


PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE} | WIDE


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: ``_row``, ``doc_id`` and per kind the spans with the text before them."""
    t = fill(text)

    def spans(kind: str) -> Column:
        before = lambda s: F.substring(t, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
        field = lambda s: F.struct(s["start"], s["end"], s["value"], before(s).alias("before"))
        return F.transform(S.matches(t, PATTERNS[kind]), field).alias(kind)

    return numbered(docs.select("doc_id", *[spans(k) for k in PATTERNS]))


def votes(found: DataFrame) -> DataFrame:
    """One row per candidate: ``_row, kind, start, end``, votes of the functions (1, -1, 0) and features."""
    rows = [
        found.select("_row", F.lit(k).alias("kind"), F.explode(k).alias("s")).select("_row", "kind", "s.*") for k in PATTERNS
    ]
    each = rows[0]
    for more in rows[1:]:
        each = each.unionByName(more)
    v, kind, before = F.col("value"), F.col("kind"), F.col("before")
    per_kind = lambda f: F.coalesce(*[F.when(kind == k, f(k)) for k in PATTERNS])
    vote = lambda c: F.when(c, 1).otherwise(-1)
    gazetteer = {
        "email": vote(v.rlike(MAIL_ENDS)),
        "ip": vote(~v.rlike(RESERVED_NET)),
        "card": vote(v.rlike(ISSUER)),
        "phone": vote(v.rlike(DIALLING)),
    }
    return each.select(
        "_row",
        "kind",
        "start",
        "end",
        per_kind(lambda k: vote(strict(k, v))).alias("form"),
        per_kind(lambda k: gazetteer.get(k, F.lit(0))).alias("gazetteer"),
        per_kind(lambda k: F.when(before.rlike(CUES[k]), 1).otherwise(0)).alias("context"),
        F.when(before.rlike(COUNTER), -1).otherwise(0).alias("counter"),
        F.least(F.length(v), F.lit(40)).alias("length"),
        F.when(before == "", "begin").when(before.rlike(r"[A-Za-z0-9]$"), "glued").when(before.rlike(r"\s$"), "space").otherwise("mark").alias("edge"),
        F.when(v.rlike(r"\("), "bracket").when(v.rlike(r"\x20"), "blank").when(v.rlike("-"), "dash").otherwise("plain").alias("shape"),
    )


def reliabilities(patterns: list, rounds: int = 200, tolerance: float = 1e-9) -> dict:
    """EM per kind over rows of (kind, votes..., n): for each kind the prior, and for each function and
    class the chance of its votes. Starts from functions that are right in 8 of 10 votes."""
    model = {}
    for kind in {p["kind"] for p in patterns}:
        rows = [(tuple(p[f] for f in FUNCTIONS), p["n"]) for p in patterns if p["kind"] == kind]
        total = sum(n for _, n in rows)
        prior = 0.5
        table = {(f, c, x): {0: 0.4, c: 0.5, -c: 0.1}[x] for f in range(len(FUNCTIONS)) for c in (1, -1) for x in (-1, 0, 1)}
        for _ in range(rounds):
            post = [posterior((prior, table), votes) for votes, _ in rows]
            mass = {1: sum(p * n for p, (_, n) in zip(post, rows)), -1: sum((1 - p) * n for p, (_, n) in zip(post, rows))}
            fresh = {}
            for f, c, x in table:
                got = sum((p if c == 1 else 1 - p) * n for p, (votes, n) in zip(post, rows) if votes[f] == x)
                # Prior counts keep a function more likely right than wrong and settle kinds with few rows.
                fresh[f, c, x] = (got + {0: 0.8, c: 1.0, -c: 0.2}[x]) / (mass[c] + 2.0)
            moved = max(abs(fresh[k] - table[k]) for k in table)
            prior, table = (mass[1] + 1) / (total + 2), fresh
            if moved < tolerance:
                break
        model[kind] = (prior, table)
    return model


def posterior(model: tuple, votes: tuple) -> float:
    prior, table = model
    yes, no = math.log(prior), math.log(1 - prior)
    for f, x in enumerate(votes):
        yes, no = yes + math.log(table[f, 1, x]), no + math.log(table[f, -1, x])
    return 1 / (1 + math.exp(min(700.0, no - yes)))


def fitted(labelled: DataFrame) -> tuple[dict, Column]:
    """The reliabilities, and the trained classifier as a column over the candidates.

    The classifier is naive Bayes on kind, length, edge and shape with the votes' log odds as one more
    term; its tables are sums of posteriors, gathered in one aggregate per feature.
    """
    patterns = labelled.groupBy("kind", *FUNCTIONS).agg(F.count("*").alias("n")).collect()  # at most 81 per kind
    model = reliabilities(patterns)
    pairs = {(p["kind"], *[p[f] for f in FUNCTIONS]): posterior(model[p["kind"]], tuple(p[f] for f in FUNCTIONS)) for p in patterns}
    key = F.concat_ws("|", "kind", *FUNCTIONS)
    soft = literal_map({"|".join(map(str, k)): p for k, p in pairs.items()}, key, 0.5)
    score = F.log(F.greatest(soft, F.lit(1e-9)) / F.greatest(1 - soft, F.lit(1e-9)))
    posted = labelled.withColumn("p", soft)
    for feature in ("length", "edge", "shape"):
        value = F.concat_ws("|", "kind", F.col(feature).cast("string"))
        sums = posted.groupBy(value.alias("k"), "kind").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
        totals: dict = {}
        for r in sums:
            y, n = totals.get(r["kind"], (0.0, 0.0))
            totals[r["kind"]] = (y + r["yes"], n + r["no"])
        odds = {r["k"]: math.log((r["yes"] + 1) / (totals[r["kind"]][0] + 10)) - math.log((r["no"] + 1) / (totals[r["kind"]][1] + 10)) for r in sums}
        score = score + literal_map(odds, value, 0.0)
    return model, score


def literal_map(values: dict, key: Column, default: float) -> Column:
    """Look ``key`` up in a small fixed table."""
    if not values:
        return F.lit(default)
    entries = F.create_map(*[F.lit(x) for kv in values.items() for x in kv])
    return F.coalesce(F.try_element_at(entries, key), F.lit(default))


def personal_spans(docs: DataFrame, text: str = "text", threshold: float = 0.0) -> DataFrame:
    """Per document: base spans per kind and ``added``, the accepted wider candidates (start, end)."""
    found = settle(candidates(docs, text))
    labelled = votes(found)
    _, score = fitted(labelled)
    more = labelled.filter(F.col("kind").isin(*WIDE)).withColumn("score", score)
    more = more.filter((F.col("score") > threshold) & (F.col("form") > 0))
    by_doc = more.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("added"))
    kept = [strict_spans(k).alias(k) for k in KINDS]
    return found.select("_row", "doc_id", *kept).join(by_doc, "_row", "left").drop("_row")


def strict_spans(kind: str) -> Column:
    return F.filter(kind, lambda s: strict(kind, s["value"]))


@query("op5_personal_data")
def op5_personal_data(spark, sf_dir):
    """Personal data of every document; the added kind ``other`` holds accepted wider candidates."""
    found = personal_spans(read(spark, sf_dir, "documents"))
    base = {k: F.col(k) for k in KINDS}
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")
    taken = F.concat(*base.values())
    crosses = lambda a, s: (s["start"] < a["end"]) & (a["start"] < s["end"])
    more = F.filter(F.coalesce("added", none), lambda a: ~F.exists(taken, lambda s: crosses(a, s)))
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(S.joined(base, by_start=False), 256).alias("base_sha256"),
        S.joined(base | {"other": more}, by_start=False).alias("spans"),
        F.size(more).cast("long").alias("n_other"),
    )
