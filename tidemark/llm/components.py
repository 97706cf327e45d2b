"""Connected components of an edge table by alternating large-star and small-star steps.

Every round replaces edges by edges to the smallest neighbour, so the number of rounds grows with the
logarithm of the longest chain.  Rounds are cut with ``checkpoint()`` in the shared folder; only one number a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import checkpointed


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge; root is the smallest node of its component.

    Null ends and loops make no edge; repeated edges count once; no edges give no rows."""
    pair = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.isnull(a).alias("na"), F.isnull(b).alias("nb"))
    pair = pair.filter("NOT na AND NOT nb AND u <> v").select("u", "v").distinct()
    state = None
    while True:
        # large star: every larger neighbour of u points to the smallest of u and its neighbours
        both = pair.unionByName(pair.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = pair.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: u's smaller neighbours and u point to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
        pair = checkpointed(small.select("e.u", F.col("e.m").alias("v")).filter("u <> v").distinct())
        now = pair.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = pair.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(pair.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
