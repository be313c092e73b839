"""Secret scan with corpus-wide ownership frequency (operator 1).

Every text is scanned for credential-like spans. The hash of each candidate value is counted over
the whole corpus by distinct repositories and distinct owners: a value found with many owners is a
widely copied example, a live-looking value of few owners is a credential. Opaque tokens without any
marker beside them are reported only if the counts call them live.

Nulls: a null text is empty; a null owner or repository counts as one owner or repository. Repeated
rows are kept, each with its own result. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barloom.llm import spans as S
from barloom.llm.registry import query
from barloom.llm.tables import fill, numbered, read, settle

# The three base kinds. ``+`` runs that must reach a length are written with that length
# where no shorter match could end elsewhere.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
# Runs of 24 to 128 characters that no marker announces.
OPAQUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,128}(?![A-Za-z0-9+/_-])"
PLACEHOLDER = r"(?i)example|changeme|placeholder|your|dummy|sample|x{6,}|0{8,}|1234567"
KINDS = ("assign", "access", "hex")


def looks_live(value: Column) -> Column:
    """Letters and digits, ten different characters or more, no placeholder word."""
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    varied = F.size(F.array_distinct(F.split(value, ""))) >= 10
    return mixed & varied & ~value.rlike(PLACEHOLDER)


def scan(docs: DataFrame, text: str = "text", owner: str = "source", repo: str = "doc_id") -> DataFrame:
    """One row per document: ``_row``, ``doc_id``, owner, repository and the spans of each kind."""
    t = fill(text)
    inside = lambda s, b: F.exists(b, lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))
    found = docs.select(
        "doc_id",
        F.xxhash64(t).alias("text_key"),
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repo).cast("string"), F.lit("")).alias("repo"),
        S.kept(S.matches(t, ASSIGN, 2), lambda v: F.length(v) >= 12).alias("assign"),
        S.matches(t, ACCESS).alias("access"),
        S.matches(t, HEX).alias("hex"),
        S.kept(S.matches(t, OPAQUE), looks_live).alias("loose"),
    )
    base = F.concat(*[F.col(k) for k in KINDS])
    loose = F.filter("loose", lambda s: ~inside(s, base))
    return numbered(found.withColumn("loose", loose))


def ownership(found: DataFrame) -> DataFrame:
    """Per hash of a candidate value: distinct repositories and owners over the whole corpus.

    Each level aggregates inside the tasks before the shuffle, so a value that a third of the
    corpus holds arrives as one row per task.
    """
    value = F.explode(F.concat(*[F.transform(k, lambda s: s["value"]) for k in (*KINDS, "loose")]))
    each = found.select("owner", "repo", value.alias("value")).select("owner", "repo", "value", F.sha2("value", 256).alias("hash"))
    repos = each.groupBy("hash", "owner", "repo").agg(F.first(looks_live(F.col("value"))).alias("live"))
    owners = repos.groupBy("hash", "owner").agg(F.count("*").alias("n"), F.first("live").alias("live"))
    return owners.groupBy("hash").agg(
        F.sum("n").alias("n_repos"), F.count("*").alias("n_owners"), F.first("live").alias("live")
    )


def classified(found: DataFrame, max_owners: int = 2) -> DataFrame:
    """Every candidate span with its counts and its class: ``live``, ``copied`` or ``weak``.

    One row per span: ``_row, kind, start, end, hash, n_repos, n_owners, class``. The join of spans and
    counts is left to adaptive execution, which splits a hash that many spans hold.
    """

    def tagged(kind: str) -> Column:
        fields = lambda s: (s["start"].alias("start"), s["end"].alias("end"), F.sha2(s["value"], 256).alias("hash"))
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), *fields(s)))

    spans = F.concat(*[tagged(k) for k in (*KINDS, "loose")])
    each = found.select("_row", F.explode(spans).alias("s")).select("_row", "s.*")
    cls = F.when(F.col("n_owners") > max_owners, "copied").when(F.col("live"), "live").otherwise("weak")
    return each.join(ownership(found), "hash").withColumn("class", cls).drop("live")


def secret_spans(docs: DataFrame, text: str = "text", owner: str = "source", repo: str = "doc_id", max_owners: int = 2) -> DataFrame:
    """Per document: the base spans of each kind, and the classified spans as an array.

    Columns: ``doc_id, text_key, assign, access, hex, found`` where ``found`` holds (kind, start, end, class,
    n_repos, n_owners) of all candidates; loose tokens are in it only if their class is ``live``.
    """
    found = settle(scan(docs, text, owner, repo))
    spans = classified(found, max_owners).filter((F.col("kind") != "loose") | (F.col("class") == "live"))
    row = F.struct("start", "kind", "end", "class", "n_repos", "n_owners")
    by_doc = spans.groupBy("_row").agg(F.array_sort(F.collect_list(row)).alias("found"))
    return found.drop("loose", "owner", "repo").join(by_doc, "_row", "left").drop("_row")


def redacted(docs: DataFrame, mark: str = "[secret]", max_owners: int = 2) -> DataFrame:
    """``docs`` with every live credential replaced by ``mark`` and ``n_chars`` counted anew.

    Copied examples and weak candidates stay. Only rows with a live credential change.
    """
    spans = secret_spans(docs.select("doc_id", "text", "source"), max_owners=max_owners)
    live = F.filter("found", lambda s: s["class"] == "live")
    # Rows are told apart by id and text; equal rows have equal spans.
    live = spans.select(F.col("doc_id").alias("_id"), "text_key", live.alias("_live")).filter(F.size("_live") > 0)
    live = live.dropDuplicates(["_id", "text_key"])
    text = fill("text")

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        # A span that overlaps the one before only moves the end on.
        out = F.when(s["start"] >= acc["at"], piece).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    new = F.aggregate("_live", begin, step, lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))))
    hit = F.col("_live").isNotNull()
    keyed = docs.withColumn("_key", F.xxhash64(text))
    joined = keyed.join(live, (F.col("_key") == F.col("text_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    changed = {"text": F.when(hit, new).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(hit, F.length(new).cast("long")).otherwise(F.col("n_chars"))
    return joined.select(*[changed.get(c, F.col(c)).alias(c) for c in docs.columns])


SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner,
                  coalesce(CAST(doc_id AS VARCHAR), '') AS repo, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT r, owner, repo, 0 AS k, string_split_regex(t, $ASSIGN) AS g, regexp_extract_all(t, $ASSIGN, 0) AS h,
         regexp_extract_all(t, $ASSIGN, 2) AS v FROM d
  UNION ALL SELECT r, owner, repo, 1, string_split_regex(t, $ACCESS), regexp_extract_all(t, $ACCESS, 0), regexp_extract_all(t, $ACCESS, 0) FROM d
  UNION ALL SELECT r, owner, repo, 2, string_split_regex(t, $HEX), regexp_extract_all(t, $HEX, 0), regexp_extract_all(t, $HEX, 0) FROM d
  UNION ALL SELECT r, owner, repo, 3, string_split_regex(t, $RUN), regexp_extract_all(t, $RUN, 0), regexp_extract_all(t, $RUN, 0) FROM d),
i AS (SELECT r, owner, repo, k, g, h, v, unnest(range(1, len(h) + 1)) AS n FROM m),
s AS (SELECT r, owner, repo, k, v[n] AS v, len(h[n]) AS len,
             sum(len(g[n])) OVER w + coalesce(sum(len(h[n])) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
      FROM i WINDOW w AS (PARTITION BY r, k ORDER BY n)),
x AS (SELECT *, b + len AS e, regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
             AND len(list_distinct(string_split(v, ''))) >= 10 AND NOT regexp_matches(v, $PLACE) AS live
      FROM s WHERE (k = 0 AND len(v) >= 12) OR (k = 1 AND len >= 18) OR (k = 2 AND len >= 16) OR (k = 3 AND len BETWEEN 24 AND 128)),
c AS (SELECT * FROM x WHERE k < 3 OR (live AND NOT EXISTS
        (SELECT 1 FROM x y WHERE y.r = x.r AND y.k < 3 AND y.b < x.e AND x.b < y.e))),
o AS (SELECT v, count(DISTINCT (owner, repo)) AS n_repos, count(DISTINCT owner) AS n_owners FROM c GROUP BY v),
f AS (SELECT c.*, CASE WHEN n_owners > 2 THEN 'copied' WHEN live THEN 'live' ELSE 'weak' END AS cls
      FROM c JOIN o USING (v) WHERE k < 3 OR n_owners <= 2),
p AS (SELECT *, ['assign', 'access', 'hex', 'live'][k + 1] || ':' || CAST(b AS BIGINT) || ':' || CAST(e AS BIGINT) AS txt FROM f),
q AS (SELECT r, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             string_agg(txt, ',' ORDER BY b, k) FILTER (k < 3) AS base, string_agg(txt, ',' ORDER BY b, k) AS spans,
             count(*) FILTER (cls = 'live') AS n_live, count(*) FILTER (cls = 'copied') AS n_copied FROM p GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
       coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN q USING (r)
"""
for _name, _pattern in {
    "$ASSIGN": ASSIGN,
    "$ACCESS": "AKIA[A-Z0-9]+",
    "$HEX": HEX,
    "$RUN": "[A-Za-z0-9+/_-]{24,}",
    "$PLACE": PLACEHOLDER,
}.items():
    SQL = SQL.replace(_name, "'" + _pattern.replace("'", "''") + "'")


@query("op1_secret_scan", SQL)
def op1_secret_scan(spark, sf_dir):
    """Secrets of every document; the added kind ``live`` holds opaque tokens of few owners."""
    s = secret_spans(read(spark, sf_dir, "documents"))
    found = F.coalesce("found", F.array())
    loose = F.filter(found, lambda x: x["kind"] == "loose")
    base = {k: F.col(k) for k in KINDS}
    of = lambda c: F.size(F.filter(found, lambda x: x["class"] == c)).cast("long")
    return s.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(S.joined(base, by_start=True), 256).alias("base_sha256"),
        S.joined(base | {"live": loose}, by_start=True).alias("spans"),
        of("live").alias("n_live"),
        of("copied").alias("n_copied"),
    )
