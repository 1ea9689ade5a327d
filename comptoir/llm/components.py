"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Each step links the neighbours of a node to the smallest of them; a few steps
leave stars whose centre is the smallest node of the component. Every step is
a grouped minimum (combined before the shuffle) and a join, and its edges are
staged, so nothing is gathered on the driver but a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from comptoir.llm.common import stage


def _step(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = (both.join(least, "a").where(F.col("b") > F.col("a"))
             .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
    down = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return small.unionByName(down.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, most_steps: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: bigint); root is the smallest node reachable.

    Nodes without an edge don't appear. Each edge may be given in either direction, any number of times.
    """
    now = stage(edges.where("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
                .distinct(), "edges")
    seen = None
    for _ in range(most_steps):
        now = stage(_step(now), "stars")
        mark = now.agg(F.count("a"), F.bit_xor(F.xxhash64("a", "b")),
                       F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        seen = mark
    raise RuntimeError(f"components not settled after {most_steps} steps")
