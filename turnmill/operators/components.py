"""Connected components by joins and partial aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnmill.session import cut


def components(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(node, root) for every node of undirected ``edges`` (a, b); root is the least node.

    Alternates large-star and small-star steps until nothing changes, in a
    number of rounds logarithmic in the longest path. Each step is one
    partial aggregate and one join, so a hub with a third of all edges is
    split by skew handling rather than gathered. Self-loops keep a lone
    node; nulls are left out; an empty input gives an empty result. Lineage
    is cut each round through the shared folder.
    """
    named = edges.select(F.col(edges.columns[0]).alias("a"), F.col(edges.columns[1]).alias("b")).where("a is not null and b is not null")
    nodes = named.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    e = cut(named.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = cut(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        seen = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b") % 1_000_000_007).alias("h")).first()
        if last == tuple(seen):
            break
        last = tuple(seen)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
