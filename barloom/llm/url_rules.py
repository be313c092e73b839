"""URL filter rules indexed by their rarest literal token (operator 8).

A rule is a host and path prefix or a regular expression with the literal tokens that it needs. Tokens
of all URLs are counted over the whole table; every rule is filed under its rarest token, a URL looks up
its own tokens, and only the rules found that way run their expression. The verdict of a URL is that of the
longest rule of hosts and paths that fits; else block if a pattern rule fits; else allow.

A null URL or one without ``://`` has an empty host and path, fits no host rule and is allowed. Repeated
rows keep a result each; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.llm.registry import query
from barloom.llm.tables import read, settle, sized_broadcast

# The rules of hosts and paths.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# Pattern rules: name, expression over host, a blank and path, literal tokens it cannot fit without.
PATTERNS = (
    ("casino", r"^([^\x20]*[.-])?casino[.\x20-]", ("casino",)),
    ("bet", r"(^|[./-])bet[./\x20-]", ("bet",)),
    ("betting", r"(^|[./-])betting[./\x20-]", ("betting",)),
    ("porn", r"(^|[./-])porn[./\x20-]", ("porn",)),
    ("feed trap", r"/calendar/[0-9]{4}/[0-9]{2}/", ("calendar",)),
)
MAX_BROADCAST_RULES = 100_000


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def tokens(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(lower_ascii(text), "[^0-9a-z]+"), lambda t: t != ""))


def rule_table(spark: SparkSession, rules=RULES, patterns=PATTERNS) -> DataFrame:
    """``rule, verdict, weight, expression, tokens``; a host rule outweighs every pattern."""
    rows = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        # Host and path are tested as "host path" with a blank between. A host holds no slash and a path begins
        # with one, so the part before the first slash is the host's, whatever blanks follow.
        fits = rf"^([^/]*\.)?{re.escape(host)}\x20{re.escape(slash + path)}"
        rows.append((rule, verdict, len(rule) + 1000, fits, re.findall("[0-9a-z]+", rule.lower())))
    for name, expression, needs in patterns:
        rows.append((name, "block", 0, expression, list(needs)))
    return spark.createDataFrame(rows, "rule string, verdict string, weight int, expression string, tokens array<string>")


def index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Rules by ``token``: of the tokens a rule needs, the one that the fewest URLs hold."""
    counts = urls.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    needed = rules.select("*", F.explode("tokens").alias("token"))
    needed = needed.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = needed.groupBy("rule", "expression", "tokens").agg(F.min(F.struct("n", "token")).alias("b"))
    same = ["rule", "expression", "tokens"]
    return rules.join(best, same).select("rule", "verdict", "weight", "expression", F.col("b.token").alias("token"))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` added; ``rule`` is null unless a host rule decided."""
    host, path = host_and_path(F.col(url))
    seen = pages.groupBy(F.col(url).alias("_url")).agg(F.count("*").alias("_n"))
    seen = seen.select("_url", host_and_path(F.col("_url"))[0].alias("_host"), host_and_path(F.col("_url"))[1].alias("_path"))
    seen = settle(seen.withColumn("tokens", tokens(F.concat_ws(" ", "_host", "_path"))))
    filed = sized_broadcast(settle(index(rules, seen)), MAX_BROADCAST_RULES)
    found = seen.select("_url", "_host", "_path", F.explode("tokens").alias("token")).join(filed, "token")
    hit = found.filter(F.rlike(F.concat_ws(" ", "_host", "_path"), F.col("expression")))
    best = hit.groupBy("_url").agg(F.max_by(F.struct("rule", "verdict", "weight"), F.struct("weight", "rule")).alias("b"))
    out = pages.withColumns({"host": host, "path": path}).join(best, F.col(url) == F.col("_url"), "left")
    return out.withColumns(
        {
            "verdict": F.coalesce("b.verdict", F.lit("allow")),
            "rule": F.when(F.col("b.weight") > 0, F.col("b.rule")),
            "pattern": F.when(F.col("b.weight") == 0, F.col("b.rule")),
        }
    ).drop("_url", "b")


SQL = r"""
WITH u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(verdict, rule, rh, rp) AS (VALUES ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/'))
SELECT page_id, host, path,
  (SELECT max_by(rule, len(rule)) FROM r WHERE (host = rh OR suffix(host, '.' || rh)) AND prefix(path, rp)) AS rule,
  coalesce((SELECT max_by(verdict, len(rule)) FROM r WHERE (host = rh OR suffix(host, '.' || rh)) AND prefix(path, rp)),
    CASE WHEN regexp_matches(host || ' ' || path, '^([^\x20]*[.-])?casino[.\x20-]') OR regexp_matches(host || ' ' || path, '(^|[./-])bet(ting)?[./\x20-]')
           OR regexp_matches(host || ' ' || path, '(^|[./-])porn[./\x20-]|/calendar/[0-9]{4}/[0-9]{2}/') THEN 'block' ELSE 'allow' END) AS verdict
FROM h
"""


@query("op8_url_rules", SQL)
def op8_url_rules(spark, sf_dir):
    """Host, path, deciding rule and verdict of every page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")
