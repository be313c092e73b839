"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barloom.llm.tables import settle


def components(edges: DataFrame, rounds: int = 60, roots: bool = True) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; the root is the smallest node reached.

    Every round rewires the edges towards the smallest neighbour (large star, then small star) until
    none of them moves, which takes a number of rounds like the logarithm of the longest
    chain. A round has three shuffles: the smallest neighbours, aggregated inside the tasks first, meet the edges that end in
    a node; then the edges of each larger node stand in order, so that the first names the smallest and copies follow each other.
    Without ``roots`` the rows of nodes that are their own root are left out.
    """
    e = settle(edges.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    ordered = Window.partitionBy("u").orderBy("v")
    for _ in range(rounds):
        low = e.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("m"))
        large = e.select("u", "v").join(low, "v", "left").select("u", F.coalesce("m", "v").alias("v"), F.col("m").isNotNull().alias("moved"))
        small = large.withColumns({"m": F.first("v").over(ordered), "last": F.lag("v").over(ordered)}).filter("last IS NULL OR last != v")
        first = F.col("v") == F.col("m")
        e = settle(small.select(F.when(first, F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"), (F.col("moved") | ~first).alias("moved")))
        if not e.agg(F.max("moved")).first()[0]:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return found.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()) if roots else found


def merged(found: DataFrame, edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` of the earlier edges and ``edges`` together, without nodes that are their own root.

    ``found`` has that of the earlier edges. Only the components that the new edges touch take part in the rounds.
    """
    for end in ("a", "b"):
        to = found.select(F.col("node").alias(end), F.col("root").alias("to"))
        edges = edges.select("a", "b").join(to, end, "left").withColumn(end, F.coalesce("to", end))
    over = components(edges, rounds, roots=False)
    moved = found.join(over.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left")
    return moved.select("node", F.coalesce("to", "root").alias("root")).unionByName(over)
