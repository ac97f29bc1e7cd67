"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnbeck.llm.store import stored


def _sum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return row[0], int(row[1] or 0)


def components(edges: DataFrame) -> DataFrame:
    """node and root, the smallest node reachable, for every node of an edge (a, b).

    Alternating large-star and small-star steps: each replaces edges by edges to the
    smallest neighbour, which keeps components and ends in stars after few rounds. No
    neighbour list is ever gathered; a hub's edges are joined with its one minimum.
    A round deals rows out five times: each task of each shuffle costs the driver memory.
    Edges with a null end and loops say nothing and are left out.
    """
    pairs = edges.where(F.col("a") != F.col("b"))
    now = stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _sum(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("b"), F.least("a", "m").alias("m"))
        large = now.join(least, "b").select("a", F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        now = stored(small.where(F.col("a") != F.col("b")).distinct())
        before, state = state, _sum(now)
        if state == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return roots.unionByName(now.select(F.col("a").alias("node"), F.col("b").alias("root")))
