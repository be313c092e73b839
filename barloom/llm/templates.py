"""Benchmark decontamination by template canonicalisation (operator 7).

Numbers, names and units become typed placeholders and punctuation goes, so that a question keeps its
template when its values are changed. Windows of template words are hashed on both sides and joined; in
one passage at least, the slots must map values of the item to values of the document one to one. Such a
pair is a leak, word for word or re-parameterised; what else the document holds does not change that.

Windows of an item with fewer words than a window are as long as the item. An item without a window of enough
literal words is searched word for word, in windows of the same length. The first word of a window
may stand as a name or as a literal word, as the document's text before it decides that. A null text
has no words; null ids are kept as ids of their own; equal rows give one result; empty tables
give an empty result; extra columns are ignored by ``leaks`` and kept by ``decontaminated``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barloom.llm.registry import query
from barloom.llm.tables import SPACE, fill, read, settle

WINDOW = 13
MIN_LITERALS = 7
MAX_BROADCAST_HASHES = 1_000_000  # up to 90 bytes each, as Spark holds them
MAX_BROADCAST_BYTES = 16 << 20  # of item windows with their words
NUMBER, NAME, UNIT = "\ue000", "\ue001", "\ue002"  # private-use characters
# Units that may follow a number.
UNITS = (
    "mm|cm|m|km|in|ft|yd|mi|mg|g|kg|t|lb|oz|ml|l|s|sec|seconds?|min|minutes?|h|hours?|days?|weeks?|months?|years?|kmh|mph|"
    "meters?|metres?|kilometers?|kilometres?|miles?|feet|inches|grams?|kilograms?|pounds?|lit(?:er|re)s?|gallons?|"
    "dollars?|euros?|cents?|usd|eur|percent|degrees?|watts?|kw|volts?|v|amps?|hz|khz|mhz|ghz|kb|mb|gb|tb"
)
NAMED = r"\p{Lu}[\p{L}\p{N}]*"
DIGITS = r"[0-9](?:[0-9.,]*[0-9])?"
MARKS = r"[^a-z\p{L}\p{N}\uE000-\uE002\x20\x09-\x0D-]+"


def canonical(text: Column) -> Column:
    """The template of a text: one placeholder or lower-case word per word of ``plain``."""
    # A capital inside a sentence: the word before ends in a letter, digit or comma. Few places have a capital ahead.
    named = F.regexp_replace(text, rf"(?=\p{{Lu}})(?<=[\p{{L}}\p{{N}},]\x20){NAMED}", NAME)
    numbers = F.regexp_replace(named, DIGITS, NUMBER)
    units = F.regexp_replace(numbers, rf"{NUMBER}\x20(?i:{UNITS})(?![\p{{L}}\p{{N}}])", f"{NUMBER} {UNIT}")
    return F.lower(F.regexp_replace(units, MARKS, ""))


def plain(text: Column) -> Column:
    """The words behind a template, word for word."""
    return F.regexp_replace(text, MARKS, "")


def split_words(text: Column) -> Column:
    return F.split(F.btrim(text, F.lit("\x20\x09\x0a\x0b\x0c\x0d")), SPACE)


def form_of(exact: bool) -> Column:
    """The template words of a text, or its words in lower case."""
    return split_words(F.lower(plain(fill("text"))) if exact else canonical(fill("text")))


def windows(texts: DataFrame, key: str, window: int, exact: bool = False) -> DataFrame:
    """``key``, ``text``, ``form`` (its template words), ``at`` (from 1) and ``hash`` of each window.

    Words are hashed once; a window hashes the hashes of its words, in a compiled expression on its own row: inside a
    lambda it would be interpreted.
    """
    words = texts.select(key, "text", form_of(exact).alias("form"))
    coded = words.withColumn("codes", F.transform("form", lambda w: F.xxhash64(w)))
    starts = F.when(F.size("form") >= window, F.sequence(F.lit(1), F.size("form") - (window - 1))).otherwise(F.array().cast("array<int>"))
    rows = coded.select(key, "text", "form", "codes", F.explode(starts).alias("at"))
    return rows.select(key, "text", "form", "at", F.xxhash64(*[F.get("codes", F.col("at") + (k - 1)) for k in range(window)]).alias("hash"))


def is_slot(word: Column) -> Column:
    return word.isin(NUMBER, NAME, UNIT)


def values_of(form: Column, values: Column) -> Column:
    """The value of each slot, null where the word is literal."""
    return F.zip_with(form, values, lambda f, v: F.when(is_slot(f), F.lower(v)))


def leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW, min_literals: int = MIN_LITERALS) -> DataFrame:
    """``doc_id, text_key, item_id, n_windows, n_slots, consistent`` for pairs that share a template window.

    A passage is a stretch of words that matching windows cover without a gap, at one distance of document and item
    positions. Its slots must be one to one; a pair is consistent if any passage is. ``n_slots`` counts over all passages.

    Only the hashes of the items' windows are broadcast, and the windows themselves while they are small. Document windows
    lose their text before any shuffle and are never gathered by document before the join. Documents are cut into windows
    once per window length and kind that the items need, at most twice ``window`` times, and once more for every
    ``MAX_BROADCAST_HASHES`` hashes past the first.
    """
    items = settle(searched(items, window, min_literals))
    found = leaked(docs, texts_of(items), window, min_literals)
    return found.join(alike_items(items), "texts").select("doc_id", "text_key", "item_id", "n_windows", "n_slots", "consistent")


def alike_items(items: DataFrame) -> DataFrame:
    """``item_id, texts``: items of the same texts share ``texts`` and are searched once."""
    return items.groupBy("item_id").agg(F.xxhash64(F.array_sort(F.collect_set(F.xxhash64("text")))).alias("texts"))


def texts_of(items: DataFrame) -> DataFrame:
    """``texts, text, width, exact``: what is searched."""
    ids = alike_items(items).select(F.col("item_id").alias("_id"), "texts")
    return settle(items.join(ids, F.col("item_id").eqNullSafe(F.col("_id"))).select("texts", "text", "width", "exact").distinct())


def leaked(docs: DataFrame, items: DataFrame, window: int, min_literals: int) -> DataFrame:
    """``doc_id, text_key, texts, n_windows, n_slots, consistent`` for pairs that share a template window."""
    kinds = {(window, False)} | {(r["width"], r["exact"]) for r in items.select("width", "exact").distinct().collect()}
    found = None
    for width, exact in sorted(kinds):
        of_kind = items.filter((F.col("width") == width) & (F.col("exact") == exact))
        hits = matches(docs, of_kind, width, exact, min_literals).withColumn("width", F.lit(width))
        found = hits if found is None else found.unionByName(hits)
    return judged(found)


def searched(items: DataFrame, window: int, min_literals: int) -> DataFrame:
    """``item_id, text, width, exact``: the window length of each item, and whether only its own words will do."""
    width = F.least(F.size("form"), F.lit(window))
    literals = lambda i: F.size(F.filter(F.slice("form", i, F.col("width")), lambda w: ~is_slot(w)))
    usable = F.exists(F.sequence(F.lit(1), F.size("form") - F.col("width") + 1), lambda i: literals(i) >= min_literals)
    formed = items.select("item_id", "text", form_of(False).alias("form")).filter(F.array_join("form", "") != "")
    return formed.withColumn("width", width).withColumn("exact", ~usable).drop("form")


def begun(form: Column, values: Column, width: int) -> Column:
    """Each way an item's window may stand in a document: ``form, values, first``.

    A first word with a capital is a name or a literal word there; ``first`` is the word that a name must then be.
    """
    word = F.get(values, 0)
    name, plain_word = F.lower(F.regexp_replace(word, f"^{NAMED}", NAME)), F.lower(F.regexp_replace(word, DIGITS, NUMBER))
    rest = lambda c: F.slice(c, 2, width - 1)

    def way(first: Column, must: Column) -> Column:
        free = F.concat(F.array(F.lit(None).cast("string")), rest(values_of(form, values)))
        other = F.struct(F.concat(F.array(first), rest(form)).alias("form"), free.alias("values"), must.alias("first"))
        return F.when(word.rlike(r"^\p{Lu}") & (F.get(form, 0) != first), other)

    none = F.lit(None).cast("string")
    as_is = F.struct(form.alias("form"), values_of(form, values).alias("values"), none.alias("first"))
    return F.filter(F.array(as_is, way(name, F.lower(word)), way(plain_word, none)), lambda w: w.isNotNull())


def matches(docs: DataFrame, items: DataFrame, width: int, exact: bool, min_literals: int) -> DataFrame:
    """``doc_id, text_key, texts, apart, hit`` for each window of ``width`` words that a document and an item share."""
    cut = lambda c: F.slice(c, F.col("at"), width)
    literal = F.size(F.filter(cut("form"), lambda w: ~is_slot(w)))
    values = F.slice(split_words(plain(fill("text"))), F.col("at"), width)  # after the join: only where a window matched
    known = windows(items, "texts", width, exact)
    if exact:
        known = known.withColumn("w", F.struct(cut("form").alias("form"), values_of(cut("form"), values).alias("values"), F.lit(None).cast("string").alias("first")))
    else:
        known = known.filter(literal >= min_literals).withColumn("w", F.explode(begun(cut("form"), values, width)))
        known = known.withColumn("hash", F.xxhash64(F.transform("w.form", lambda w: F.xxhash64(w))))
    known = known.select("hash", "texts", F.col("at").alias("item_at"), F.col("w.form").alias("item_form"), F.col("w.values").alias("item_values"), "w.first")
    known = settle(known.distinct())
    keyed = docs.select(F.struct("doc_id", F.xxhash64(fill("text")).alias("text_key")).alias("key"), "text")
    seen = None
    for part in in_parts(known.select("hash").distinct()):
        held = windows(keyed, "key", width, exact).join(F.broadcast(part), "hash", "left_semi")
        held = held.select("hash", "key", "at", cut("form").alias("form"), values.alias("values"))
        seen = held if seen is None else seen.unionByName(held)
    seen = seen.join(F.broadcast(known) if words_bytes(known) <= MAX_BROADCAST_BYTES else known, "hash").filter(F.col("form") == F.col("item_form"))
    seen = seen.filter(F.col("first").isNull() | (F.lower(F.get("values", 0)) == F.col("first")))
    both = F.zip_with("item_values", values_of(F.col("form"), F.col("values")), lambda i, d: F.struct(i.alias("item"), d.alias("doc")))
    hit = F.struct("at", F.filter(both, lambda s: s["item"].isNotNull()).alias("s"))
    return seen.select("key.*", "texts", (F.col("at") - F.col("item_at")).alias("apart"), hit.alias("hit"))


def in_parts(hashes: DataFrame) -> list[DataFrame]:
    """``hashes`` in parts of about ``MAX_BROADCAST_HASHES`` rows."""
    n = -(-hashes.count() // MAX_BROADCAST_HASHES)
    if n < 2:
        return [hashes]
    # Written with its part: a filter on the hash itself would be asked of each document window too.
    dealt = settle(hashes.withColumn("part", F.pmod(F.xxhash64("hash"), F.lit(n))))
    return [dealt.filter(F.col("part") == k).select("hash") for k in range(n)]


def words_bytes(known: DataFrame) -> int:
    """About what the item windows take: their words, 16 bytes a word beside it, and the rest of the row."""
    each = F.octet_length(F.concat_ws("", "item_form", "item_values")) + 16 * (F.size("item_form") + F.size("item_values")) + 100
    return known.agg(F.sum(each.cast("long"))).first()[0] or 0


def judged(hits: DataFrame) -> DataFrame:
    """The pairs of ``doc_id, text_key, texts, apart, hit, width`` rows, each decided by its passages."""
    lines = hits.groupBy("doc_id", "text_key", "texts", "width", "apart").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("hit")).alias("w"))
    begins = lambda i: (i == 0) | (F.get("w", i)["at"] - F.get("w", i - 1)["at"] > F.col("width"))
    lines = lines.withColumn("cuts", F.filter(F.sequence(F.lit(0), F.size("w") - 1), begins))
    slots = lambda hits: F.array_distinct(F.flatten(F.transform(hits, lambda h: h["s"])))
    passage = lambda c, k: slots(F.slice("w", c + 1, F.coalesce(F.get("cuts", k + 1), F.size("w")) - c))
    lines = lines.withColumn("passages", F.transform("cuts", passage))
    of = lambda s, name: F.size(F.array_distinct(F.transform(s, lambda x: x[name])))
    same = F.exists("passages", lambda s: (of(s, "item") == F.size(s)) & (of(s, "doc") == F.size(s)))
    lines = lines.select("doc_id", "text_key", "texts", "n", slots("w").alias("s"), same.alias("same"))
    found = lines.groupBy("doc_id", "text_key", "texts").agg(
        F.sum("n").alias("n_windows"),
        F.size(F.array_distinct(F.flatten(F.collect_set("s")))).cast("long").alias("n_slots"),
        F.max("same").alias("consistent"),
    )
    return found.select("doc_id", "text_key", "texts", "n_windows", "n_slots", "consistent")


def decontaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without those that leak an item."""
    found = leaked(docs, texts_of(settle(searched(items, window, MIN_LITERALS))), window, MIN_LITERALS)
    found = found.filter("consistent").select(F.col("doc_id").alias("_id"), "text_key").distinct()
    keyed = docs.withColumn("_key", F.xxhash64(fill("text")))
    same = (F.col("_key") == F.col("text_key")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    return keyed.join(settle(found), same, "left_anti").select(*docs.columns)


@query("op7_template_leaks")
def op7_template_leaks(spark, sf_dir):
    """Documents that hold benchmark passages, as they are or with other values."""
    found = leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_windows", "n_slots", "consistent")
