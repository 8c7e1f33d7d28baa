"""Connected components by alternating large-star and small-star steps.

Every step is a grouping and a join; edges shrink towards stars, and each round
is written to the shared folder, so lost executors repeat one round at most.
Nothing is collected but two figures a round that tell when edges stop changing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.sparkkit import stored


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small(e: DataFrame) -> DataFrame:
    least = e.groupBy("a").agg(F.min("b").alias("m"))
    moved = e.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", "m")).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the links (a, b); root is the least node it is linked with.

    Links may come in either direction, repeat, or join a node with itself.
    """
    e = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = stored(e, name)
    last = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == last:
            break
        last = now
        e = stored(_small(_large(e)), name)
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select("b", "b").distinct())
