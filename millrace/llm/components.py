"""Connected components of an edge list, as joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stage


def _signature(edges: DataFrame) -> tuple:
    """A small digest of an edge set: equal sets have equal digests."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges (a long, b long)``; the root is the smallest node reachable.

    Large-star and small-star steps alternate until the edges form stars. Each step is one grouping
    with a partial minimum and one join, so a node with very many edges sends one row per task to the
    grouping, and its side of the join is split by the adaptive planner. The edges of every round are
    written to the shared folder. Nodes without an edge, null ends and loops give no row.
    """
    either = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stage(either.filter("a is not null and b is not null and a > b").distinct(), "edges")
    before = _signature(current)
    while before[0]:
        # large star: every larger neighbour of a node goes to the node's smallest neighbour
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a > b")
        # small star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")
        )
        small = small.select(F.col("e.a").alias("a"), F.col("e.m").alias("b")).filter("a > b").distinct()
        current = stage(small, "edges")
        after = _signature(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
