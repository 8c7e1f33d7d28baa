"""Aggregates of tracks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clipflow.functions.angles import axis_turn


def along():
    """The window of a track in the order of time."""
    return W.partitionBy("track_id").orderBy("t_us", "event_id")


def stepped(obs: DataFrame) -> DataFrame:
    """obs with dt (seconds), step (way) and speed from the observation before; null at the first, speed also at no time."""
    dt = (F.col("t_us") - F.lag("t_us").over(along())) / 1e6
    step = F.hypot(F.col("x") - F.lag("x").over(along()), F.col("y") - F.lag("y").over(along()))
    return obs.withColumn("dt", dt).withColumn("step", step).withColumn("speed", F.when(F.col("dt") > 0, F.col("step") / F.col("dt")))


def motion_stats(obs: DataFrame) -> DataFrame:
    """Way, spread and speed of each track of two observations or more."""
    s = stepped(obs)
    by = W.partitionBy("track_id")
    r = s.withColumn("_r", F.hypot(F.col("x") - F.median("x").over(by), F.col("y") - F.median("y").over(by)))
    at = F.struct("t_us", "event_id")
    stats = r.groupBy("track_id").agg(
        F.count("*").alias("n"),
        ((F.max("t_us") - F.min("t_us")) / 1e6).alias("duration"),
        F.sum("step").alias("path"),
        F.hypot(F.max_by("x", at) - F.min_by("x", at), F.max_by("y", at) - F.min_by("y", at)).alias("net"),
        F.median("_r").alias("median_radius"),
        F.percentile("_r", 0.9).alias("p90_radius"),
        F.max("_r").alias("max_radius"),
        F.max("step").alias("max_step"),
        F.percentile("speed", 0.9).alias("p90_speed"),
        F.median("speed").alias("median_speed"),
    )
    return stats.where("n >= 2").withColumn("concentration", F.when(F.col("path") > 0, F.col("net") / F.col("path")).otherwise(0.0))


def motion_class(stats: DataFrame, path: float, net: float, radius: float) -> DataFrame:
    """stats with motion: moving, creeping or static."""
    moving = (F.col("path") >= path) & (F.col("net") >= net)
    return stats.withColumn("motion", F.when(moving, "moving").when(F.col("p90_radius") >= radius, "creeping").otherwise("static"))


def fast_tracks(obs: DataFrame, path: float, speed: float, steps: int) -> DataFrame:
    """(track_id, path, p90_speed, max_speed, fast_steps, fast)."""
    t = stepped(obs).groupBy("track_id").agg(F.sum("step").alias("path"), F.percentile("speed", 0.9).alias("p90_speed"), F.max("speed").alias("max_speed"), F.count_if(F.col("speed") >= speed).alias("fast_steps"))
    return t.withColumn("fast", F.coalesce((F.col("path") >= path) & (F.col("p90_speed") >= speed) & (F.col("fast_steps") >= steps), F.lit(False)))


def majority_class(d: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """(track_id, class_name, votes): the class most often said, then of the best scores' sum, then by order."""
    votes = d.groupBy("track_id", "class_name").agg(F.count("*").alias("votes"), F.sum("score").alias("_sum"))
    place = F.array_position(F.array(*map(F.lit, order)), F.col("class_name"))
    rank = W.partitionBy("track_id").orderBy(F.desc("votes"), F.desc(F.round("_sum", 4)), place, "class_name")
    return votes.withColumn("_n", F.row_number().over(rank)).where("_n = 1").select("track_id", "class_name", "votes")


def size_class(d: DataFrame, long_side: float, small_long: float, small_short: float) -> DataFrame:
    """(track_id, long, short, height, class_name): tracks of several classes judged by their median size, others as they are."""
    t = d.groupBy("track_id").agg(F.median(F.greatest("dx", "dy")).alias("long"), F.median(F.least("dx", "dy")).alias("short"), F.median("dz").alias("height"), F.sort_array(F.collect_set("class_name")).alias("_all"))
    judged = F.when(F.col("long") >= long_side, "Truck").when((F.col("long") < small_long) & (F.col("short") < small_short), "Cyclist").otherwise("Car")
    return t.select("track_id", "long", "short", "height", F.when(F.size("_all") == 1, F.get("_all", 0)).otherwise(judged).alias("class_name"))


def large_cars_relabelled(d: DataFrame, length: float) -> DataFrame:
    """d with the cars of tracks whose median long side reaches length as trucks; a car without track stands for itself."""
    own = F.when(F.col("track_id").isNull(), F.struct("frame_id", "det_idx"))
    cars = d.where("class_name = 'Car'").withColumn("_m", F.median(F.greatest("dx", "dy")).over(W.partitionBy("track_id", own)))
    new = cars.withColumn("class_name", F.when(F.col("_m") >= length, "Truck").otherwise("Car")).drop("_m")
    return new.unionByName(d.where("class_name <> 'Car' OR class_name IS NULL"))


def mixed_tracks_unified(d: DataFrame, strong: str, leftover: str) -> DataFrame:
    """d with every track that is ever `strong` so throughout, and `leftover` renamed to it."""
    any_strong = F.bool_or(F.col("class_name") == strong).over(W.partitionBy("track_id"))
    return d.withColumn("class_name", F.when(F.coalesce(any_strong, F.lit(False)) | (F.col("class_name") == leftover), strong).otherwise(F.col("class_name")))


def axis_of(d: DataFrame, by: str, angle: Column) -> DataFrame:
    """(by, axis): the axis modulo pi nearest to the angles, from the median of doubled angles or a quarter turn from it."""
    return heading_of(d, by, angle).withColumn("axis", F.pmod("axis", F.lit(math.pi)))


def heading_of(d: DataFrame, by: str, angle: Column) -> DataFrame:
    """`axis_of` as a heading: the median's own, or a quarter turn on."""
    a = d.select(by, angle.alias("_a"))
    middle = a.groupBy(by).agg((F.atan2(F.median(F.sin(2 * F.col("_a"))), F.median(F.cos(2 * F.col("_a")))) / 2).alias("_m"))
    cost = a.join(middle, by).groupBy(by, "_m").agg(F.sum(axis_turn(F.col("_a"), F.col("_m"))).alias("_own"), F.sum(axis_turn(F.col("_a"), F.col("_m") + math.pi / 2)).alias("_quarter"))
    best = F.when(F.round("_own", 6) <= F.round("_quarter", 6), F.col("_m")).otherwise(F.col("_m") + math.pi / 2)
    return cost.select(by, best.alias("axis"))


def representative_class(d: DataFrame, priority: Column) -> DataFrame:
    """(track_id, class_name) of the best priority, then the most frequent."""
    n = d.groupBy("track_id", "class_name").agg(F.count("*").alias("_n"))
    return n.groupBy("track_id").agg(F.min_by("class_name", F.struct(priority, -F.col("_n"), F.col("class_name"))).alias("class_name"))


def weighted_quantile(d: DataFrame, by: str, value: str, weight: Column, q: float) -> DataFrame:
    """(by, quantile): linear between the midpoints of the weights' running sum; weights up to 0 are left out."""
    w = d.select(by, F.col(value).alias("_v"), weight.alias("_w")).where("_w > 0")
    merged = w.groupBy(by, "_v").agg(F.sum("_w").alias("_w"))
    order = W.partitionBy(by).orderBy("_v")
    run = F.sum("_w").over(order.rowsBetween(W.unboundedPreceding, 0))
    c = merged.withColumn("_c", (run - F.col("_w") / 2) / F.sum("_w").over(W.partitionBy(by)))
    c = c.withColumn("_pv", F.lag("_v").over(order)).withColumn("_pc", F.lag("_c").over(order))
    at = F.when(F.col("_pc").isNull(), F.col("_v")).otherwise(F.col("_pv") + (F.col("_v") - F.col("_pv")) * (q - F.col("_pc")) / (F.col("_c") - F.col("_pc")))
    return c.groupBy(by).agg(F.coalesce(F.min_by(F.when(F.col("_c") >= q, at), F.when(F.col("_c") >= q, F.col("_c"))), F.max("_v")).alias("quantile"))


def stop_line(d: DataFrame, by: str, first: str, every: str, reach: float) -> DataFrame:
    """(by, line): the farthest first stop, but the upper quartile if that is far beyond their median; without any, the median of all."""
    a = d.groupBy(by).agg(F.count(first).alias("_n"), F.max(first).alias("_max"), F.median(first).alias("_mid"), F.percentile(first, 0.75).alias("_q"), F.median(every).alias("_all"))
    return a.select(by, F.when(F.col("_n") == 0, F.col("_all")).when((F.col("_n") > 1) & (F.col("_max") - F.col("_mid") > reach), F.col("_q")).otherwise(F.col("_max")).alias("line"))


def binned_evidence(obs: DataFrame, width_us: int, high: Column) -> DataFrame:
    """(class_name, bin, active, samples, high): tracks once a bin, samples each, and those for which `high` holds."""
    return obs.groupBy("class_name", F.floor(F.col("t_us") / width_us).alias("bin")).agg(F.count_distinct("track_id").alias("active"), F.count("*").alias("samples"), F.count_if(high).alias("high"))


def stage_summary(d: DataFrame) -> DataFrame:
    """Counts by class and by all, of rows, tracks and frames."""
    return d.groupingSets([["class_name"], []], "class_name").agg(F.coalesce("class_name", F.lit("all")).alias("group"), F.count("*").alias("n_rows"), F.count_distinct("track_id").alias("tracks"), F.count_distinct("frame_id").alias("frames")).drop("class_name")
