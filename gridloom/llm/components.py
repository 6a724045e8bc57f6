"""Connected components of an edge table by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import release, stage


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """id, component: the smallest id that each end of an edge can reach.

    Each round links every node to the smallest of its neighbours and itself, first its larger
    neighbours, then its smaller ones; it ends when a round changes nothing, after about the
    logarithm of the longest path. Rounds are written to the shared folder, each deleted after the
    next. A node's neighbours are only ever summed up by their minimum, never gathered. No edges
    give no rows; loops and repeated edges add nothing.
    """
    now = stage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        last, now = now, stage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        release(last)
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
