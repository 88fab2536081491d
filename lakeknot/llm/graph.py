"""Connected components by alternating star contractions, in DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) to stars (node, component): component is the smallest id of the node's component; smallest ids have no row.

    Large-star and small-star steps (R. Kiveris et al., "Connected components in MapReduce and beyond") until nothing
    changes; each round is a table in the shared folder. Empty edges give an empty table."""
    now = stored(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    while True:
        sign = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).head()
        if sign == seen or sign["n"] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = sign
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        own = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(own, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(small.unionByName(own.select("u", F.col("m").alias("v"))).distinct())
        discard(now)
        now = after
