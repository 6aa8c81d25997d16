"""Connected components by alternating star contractions, every round written down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.session import stage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    Large-star: each node links its larger neighbours to the smallest neighbour (itself included).
    Small-star: each node links its smaller neighbours, and itself, to the smallest. Rounds end when
    the edges no longer change, after about log n of them. Minima combine map-side; the joins on
    a hub node are plain, so that a hub's partition can be split.
    """
    now = stage(edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = stage(large, "large-star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(low, "u").select("u", "v", "m")
        small = moved.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).distinct()
        now = stage(small, "small-star")
        # Edges are a set, so count and an order-free checksum tell whether a round changed it.
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(state) == mark:
            break
        mark = tuple(state)
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
