"""Numbering and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clipflow.operators.groups import durable


def numbered(d: DataFrame, key: str, name: str) -> DataFrame:
    """d, of distinct keys, with `name`: 1, 2, ... in the order of the key.

    Ranges of keys are numbered each on its own; the ranges' sizes, a row for
    each, give what to add.
    """
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = d.repartitionByRange(parts, key).sortWithinPartitions(key)
    # the id's upper bits tell the range, its lower ones the place in it
    placed = durable(ordered.withColumn("_at", F.monotonically_increasing_id()))
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = sizes.withColumn("_before", F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).drop("_n")
    return placed.withColumn("_part", part).join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + place + 1).drop("_part", "_before", "_at")


def dense_ids(d: DataFrame, key: str, start: int, used: DataFrame | None = None) -> DataFrame:
    """(key, new_id): distinct keys in order, with the least numbers from start on that `used` (new_id) hasn't."""
    keys = numbered(d.select(key).where(F.col(key).isNotNull()).distinct(), key, "_n")
    if used is None:
        return keys.select(key, (F.col("_n") + (start - 1)).alias("new_id"))
    taken = used.select("new_id").where(F.col("new_id") >= start).distinct()
    spark = d.sparkSession
    free = spark.range(start, start + keys.count() + taken.count()).toDF("new_id").join(taken, "new_id", "left_anti")
    return keys.join(numbered(free, "new_id", "_n"), "_n").select(key, "new_id")


def chains_merged(labels: DataFrame, first_free: int) -> DataFrame:
    """labels (frame_id, chain, place, obj_id) of all chains with new_id: an id that an earlier label of the frame has already gets the least from first_free on that no label of the frame has.

    Labels go by chain and place; those without id keep none.
    """
    order = W.partitionBy("frame_id", "obj_id").orderBy("chain", "place")
    again = labels.withColumn("_again", (F.row_number().over(order) > 1) & F.col("obj_id").isNotNull())
    late = W.partitionBy("frame_id", "_again").orderBy("chain", "place", "obj_id")
    again = again.withColumn("_k", F.when(F.col("_again"), F.row_number().over(late)))
    # the k-th free id lies beyond each used one that has fewer than k free ones before it
    used = labels.select("frame_id", "obj_id").where(F.col("obj_id") >= first_free).distinct()
    used = used.withColumn("_free", F.col("obj_id") - first_free + 1 - F.row_number().over(W.partitionBy("frame_id").orderBy("obj_id"))).drop("obj_id")
    passed = again.where("_again").select("frame_id", "_k").join(used, "frame_id").where("_free < _k").groupBy("frame_id", "_k").agg(F.count("*").alias("_passed"))
    new = F.when(F.col("_again"), F.col("_k") + (first_free - 1) + F.coalesce("_passed", F.lit(0))).otherwise(F.col("obj_id"))
    return again.join(passed, ["frame_id", "_k"], "left").withColumn("new_id", new).select(*labels.columns, "new_id")


def top_of(d: DataFrame, by: str, count: str, name: str, k: int) -> DataFrame:
    """The k rows of each `by` with the largest count, then the least name, ranked."""
    rank = F.row_number().over(W.partitionBy(by).orderBy(F.desc(count), name))
    return d.withColumn("rank", rank).where(F.col("rank") <= k)
