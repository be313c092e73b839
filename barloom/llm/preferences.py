"""Preference formatting for chat data (operator 6).

A pair of conversations shares a prompt: the longest common prefix of turns. It is rendered once; what
follows in each conversation is its completion, rendered with the character spans that a loss should see
(texts of the assistant and their end marks). The prompt stops before the last turn of the shorter
conversation, so that neither completion is empty unless the conversation is.

Nulls: turns with a null pair, side or turn number are left out; a null role is ``user``, a null text empty.
Repeated turn numbers are ordered by role and text. A pair with one side only gives no row; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barloom.llm.registry import query
from barloom.llm.tables import read

END = "<|end|>\n"


def rendered(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"), turn["text"], F.lit(END))


def joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, rendered), "")


def masks(turns: Column, role: str = "assistant") -> Column:
    """``start:end`` (code points of the rendered turns, end exclusive) of what ``role`` says."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, t: Column) -> Column:
        end = acc["at"] + F.length(rendered(t))
        start = acc["at"] + F.length(t["role"]) + F.lit(5)
        span = F.array(F.concat_ws(":", start.cast("string"), (end - F.lit(1)).cast("string")))
        return F.struct(end.alias("at"), F.when(t["role"] == role, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    return F.array_join(F.aggregate(turns, begin, step, lambda a: a["out"]), ",")


def format_pairs(turns: DataFrame) -> DataFrame:
    """Rows of ``pair_id, side`` (chosen or rejected), ``turn, role, text`` to one row per pair.

    Both sides of a pair are gathered by one aggregate; a row of the result holds two conversations.
    """
    clean = turns.filter("pair_id IS NOT NULL AND turn IS NOT NULL AND side IN ('chosen', 'rejected')").select(
        "pair_id", "side", F.struct("turn", F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t")
    )
    side = lambda s: F.array_sort(F.collect_list(F.when(F.col("side") == s, F.col("t"))))
    pairs = clean.groupBy("pair_id").agg(side("chosen").alias("c"), side("rejected").alias("r"))
    pairs = pairs.filter((F.size("c") > 0) & (F.size("r") > 0))
    same = F.zip_with("c", "r", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    shorter = F.least(F.size("c"), F.size("r"))
    first = F.array_position(same, F.lit(False)).cast("int")
    prefix = F.when(first > 0, first - 1).otherwise(shorter)
    pairs = pairs.withColumn("n_prefix", F.least(prefix, shorter - 1))
    tail = lambda c: F.slice(F.col(c), F.col("n_prefix") + 1, F.size(c))
    return pairs.select(
        "pair_id",
        F.col("n_prefix").cast("long").alias("n_prefix"),
        joined(F.slice("c", F.lit(1), F.col("n_prefix"))).alias("prompt"),
        joined(tail("c")).alias("chosen"),
        joined(tail("r")).alias("rejected"),
        masks(tail("c")).alias("chosen_mask"),
        masks(tail("r")).alias("rejected_mask"),
    )


SQL = """
WITH t AS (SELECT conv_id // 2 AS pair_id, conv_id % 2 AS side, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n,
                  coalesce(role, 'user') AS role, coalesce(text, '') AS text,
                  '<|' || coalesce(role, 'user') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS r FROM conversations
           WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
s AS (SELECT pair_id, max(n) FILTER (side = 0) AS nc, max(n) FILTER (side = 1) AS nr FROM t GROUP BY pair_id),
d AS (SELECT pair_id, n FROM t GROUP BY pair_id, n HAVING count(*) < 2 OR min(role) <> max(role) OR min(text) <> max(text)),
p AS (SELECT s.pair_id, least(coalesce((SELECT min(n) - 1 FROM d WHERE d.pair_id = s.pair_id), least(nc, nr)), least(nc, nr) - 1) AS k
      FROM s WHERE nc > 0 AND nr > 0),
m AS (SELECT t.*, p.k, coalesce(sum(len(r)) FILTER (n > k) OVER (PARTITION BY t.pair_id, side ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
      FROM t JOIN p USING (pair_id)),
x AS (SELECT *, CAST(pos + len(role) + 5 AS BIGINT) || ':' || CAST(pos + len(r) - 1 AS BIGINT) AS span FROM m)
SELECT pair_id, CAST(any_value(k) AS BIGINT) AS n_prefix,
       coalesce(string_agg(r, '' ORDER BY n) FILTER (side = 0 AND n <= k), '') AS prompt,
       coalesce(string_agg(r, '' ORDER BY n) FILTER (side = 0 AND n > k), '') AS chosen,
       coalesce(string_agg(r, '' ORDER BY n) FILTER (side = 1 AND n > k), '') AS rejected,
       coalesce(string_agg(span, ',' ORDER BY n) FILTER (side = 0 AND n > k AND role = 'assistant'), '') AS chosen_mask,
       coalesce(string_agg(span, ',' ORDER BY n) FILTER (side = 1 AND n > k AND role = 'assistant'), '') AS rejected_mask
FROM x GROUP BY pair_id
"""


@query("op6_preference_pairs", SQL)
def op6_preference_pairs(spark, sf_dir):
    """Conversations 2k (chosen) and 2k + 1 (rejected) as preference pairs."""
    conv = read(spark, sf_dir, "conversations")
    side = F.when(F.col("conv_id") % 2 == 0, "chosen").otherwise("rejected")
    return format_pairs(conv.select(F.floor(F.col("conv_id") / 2).alias("pair_id"), side.alias("side"), "turn", "role", "text"))
