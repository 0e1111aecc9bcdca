"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import gathered, stored


def components(edges: DataFrame) -> DataFrame:
    """id, component: for every end of an edge (a, b) the smallest id that it reaches.

    Nothing is collected but a count and a checksum a round. A node with many edges is
    met by a partial minimum and by joins that adaptive execution can split.
    """
    edges = gathered(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"))
    parts, before = edges.rdd.getNumPartitions(), None
    while True:
        # large star: every larger neighbour of u points to the least of u and its neighbours
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(parts)
        # small star: u and its smaller neighbours point to the least of them
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(joined.union(least.select("u", F.col("m").alias("v"))).coalesce(parts).distinct()).coalesce(parts)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    # stars now: each node points to the least node of its component
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())
