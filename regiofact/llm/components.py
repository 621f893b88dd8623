"""Connected components of a graph given by its edges, by alternating star contractions.

Each round links every node's larger neighbours to its smallest one, then every node's smaller
neighbours to the smallest of them; the graph becomes one star per component in a number of
rounds that grows with the logarithm of its size. Only edges are shuffled, counts per node are
combined before they are, and each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import stored


def _large_star(edges: DataFrame) -> DataFrame:
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))  # from a node to a larger one
    least = edges.unionAll(back).groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = back.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # edges point from a node u to a smaller node v
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and component, the smallest node reachable, for every node that has an edge.

    ``edges`` has two columns of one orderable type; loops, repeats and null ends are ignored.
    Without edges the result is empty.
    """
    a, b = edges.columns
    ends = F.col(f"`{a}`").isNotNull() & F.col(f"`{b}`").isNotNull()
    links = edges.filter(ends).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    stars = stored(links.filter("u <> v").distinct(), "edges")
    before = None
    while True:
        stars = stored(_small_star(_large_star(stars)), "stars")
        state = stars.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40)), F.min("u"), F.max("v")
        ).first()
        if state == before:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                stars.select("v", "v").distinct().toDF("node", "component")
            )
        before = state
