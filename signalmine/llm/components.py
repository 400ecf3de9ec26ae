"""Connected components by alternating large-star and small-star steps, in
Spark: every node learns the smallest node it reaches. A node of any degree is
only ever a group key of ``min`` aggregates (partial sums before the shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalmine.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (both.where("v > u").join(low, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    joined = down.join(low, "u")
    return (joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): for every node of ``edges`` the smallest node reachable.
    Empty edges give no rows; self-links and repeated links are allowed."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    e = stored(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
               .where("u > v").distinct(), "links")
    seen = None
    while True:
        e = stored(_small_star(_large_star(e)), "stars")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .distinct())
