"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataflux.llm.common import discard, materialise


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for each node that has a link; the root is the smallest node reachable.

    Links to oneself and links with a null end are ignored. A node of any degree is read by joins that
    can be split, never collected.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges, seen = materialise(edges), None
    while True:
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).head()
        if state == seen or not state[0]:
            out = edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
            out.strataflux_path = edges.strataflux_path
            return out
        seen = state
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u")
        new = materialise(small.select("u", F.col("m").alias("v")).union(small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct())
        discard(edges)
        edges = new
