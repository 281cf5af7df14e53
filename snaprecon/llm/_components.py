"""Connected components by alternating large-star and small-star contraction.

Both steps are grouped minima and equi-joins, so a node with very many
neighbours is pre-aggregated by map tasks and its join side can be split by
adaptive execution. Lineage is cut every round in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaprecon.llm._common import cut


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is the least node reachable.

    Self-links, repeats and either direction are fine; nodes without an edge
    do not appear.
    """
    hi, lo = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    now = cut(edges.select(hi, lo).filter("a <> b").distinct())
    seen = _digest(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select("a", "b", "m")
        pairs = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b")))
        now = cut(pairs.distinct())
        after = _digest(now)
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
