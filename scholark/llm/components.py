"""Connected components by alternating large-star and small-star steps.

Every step is two grouped joins; labels halve their distance to the root, so the number of rounds grows with the
logarithm of the longest chain.  Each round's edges go to the shared checkpoint folder, so lost executors cost at most
a round.  A node with very many neighbours is no group in one task: the minimum is pre-aggregated before the shuffle
and joined back, where adaptive execution splits a skewed side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import cut, drop

MOST_ROUNDS = 60


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) of every node on an edge; root is the smallest node of its component.  Self links are allowed."""
    e = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct()
    e = cut(e)
    state = None
    for _ in range(MOST_ROUNDS):
        # large star: every larger neighbour of u is linked to the least node among u and its neighbours
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: smaller neighbours of u and u itself are linked to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        before, e = e, cut(small)
        drop(before)  # a round reads the last one only
        now = e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
