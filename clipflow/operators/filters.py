"""Filters of detections and tracks."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: The order in which the first reason of a rejected detection is told.
REASONS = ("invalid_box", "score", "class_whitelist", "annotation_range", "distant_pedestrian", "sparse_points")


@dataclass(frozen=True)
class HardFilter:
    """Thresholds of `hard_filtered`; forward is -y."""

    scores: dict[str, float] = field(default_factory=dict)
    score: float = 0.1
    classes: tuple[str, ...] = ("Car", "Truck", "Bus", "Pedestrian", "Nonmotorized_vehicle")
    side: float = 40.0
    front: float = 60.0
    rear: float = 20.0
    pedestrian: float = 30.0


def by_class(class_name: Column, values: dict[str, float], otherwise: float) -> Column:
    """The class's value of a short table, else the general one."""
    out = F.lit(otherwise)
    for name, value in values.items():
        out = F.when(class_name == name, F.lit(value)).otherwise(out)
    return out


def hard_filtered(d: DataFrame, config: HardFilter) -> DataFrame:
    """d with all reasons against a detection, the first of them, and whether it stays.

    Every rule is looked at, but for a box that isn't one, of which no more is asked.
    """
    n = F.col("class_name")
    ok = F.lit(True)
    for c in ("x", "y", "z", "dx", "dy", "dz", "yaw"):
        ok &= F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    ok &= (F.col("dx") > 0) & (F.col("dy") > 0) & (F.col("dz") > 0)
    inside = (F.abs("x") <= config.side) & (F.col("y") >= -config.front) & (F.col("y") <= config.rear)
    rules = [
        F.when(F.col("score") < by_class(n, config.scores, config.score), "score"),
        F.when(~n.isin(*config.classes), "class_whitelist"),
        F.when(~inside, "annotation_range"),
        F.when((n == "Pedestrian") & (F.hypot("x", "y") > config.pedestrian), "distant_pedestrian"),
    ]
    reasons = F.when(ok, F.array_compact(F.array(*rules))).otherwise(F.array(F.lit("invalid_box")))
    return d.withColumn("reasons", reasons).withColumn("primary", F.get("reasons", 0)).withColumn("kept", F.size("reasons") == 0)


def reason_counts(filtered: DataFrame) -> DataFrame:
    """How often each reason was the first, and how often it was one of them."""
    each = filtered.select("primary", F.explode("reasons").alias("reason"))
    return each.groupBy("reason").agg(F.count("*").alias("n_any"), F.count_if(F.col("primary") == F.col("reason")).alias("n_primary"))


def short_tracks_dropped(d: DataFrame, least: dict[str, int], otherwise: int) -> DataFrame:
    """d without tracks seen in as many distinct frames as their class's number, or fewer; the class is that seen first."""
    life = d.groupBy("track_id").agg(F.count_distinct("t_us").alias("_frames"), F.min_by("class_name", F.struct("t_us", "event_id")).alias("_class"))
    gone = life.where(F.col("_frames") <= by_class(F.col("_class"), least, otherwise)).select("track_id")
    return d.join(gone, "track_id", "left_anti")


def unmoved_tracks(obs: DataFrame, class_name: str, least: int, net: float, radius: float, step: float) -> DataFrame:
    """Tracks of a class without evidence that they moved: too few observations, or net way, radius and steps all short."""
    by = W.partitionBy("track_id")
    own = obs.where(F.col("class_name") == class_name)
    o = own.withColumn("_mx", F.median("x").over(by)).withColumn("_my", F.median("y").over(by))
    order = by.orderBy("t_us", "event_id")
    o = o.withColumn("_step", F.hypot(F.col("x") - F.lag("x").over(order), F.col("y") - F.lag("y").over(order)))
    at = F.struct("t_us", "event_id")
    stats = o.groupBy("track_id").agg(
        F.count("*").alias("n_obs"),
        F.hypot(F.max_by("x", at) - F.min_by("x", at), F.max_by("y", at) - F.min_by("y", at)).alias("net"),
        F.percentile(F.hypot(F.col("x") - F.col("_mx"), F.col("y") - F.col("_my")), 0.9).alias("p90_radius"),
        F.max("_step").alias("max_step"),
    )
    moved = (F.col("n_obs") >= least) & ((F.col("net") >= net) | (F.col("p90_radius") >= radius) | (F.col("max_step") >= step))
    return stats.where(~F.coalesce(moved, F.lit(False)))


def low_boxes_dropped(d: DataFrame, class_name: str, height: float) -> DataFrame:
    """d without boxes of a class lower than height; an unknown height stays."""
    return d.where(~F.coalesce((F.col("class_name") == class_name) & (F.col("dz") < height), F.lit(False)))


def axis_spans(obs: DataFrame, step: float) -> DataFrame:
    """(track_id, n_obs, span, flips): the largest angle between two axes of a track, and its turns of `step` or more from row to row.

    The axis farthest from another is the last before a quarter turn on, or the
    first after it, so two windows over the sorted axes find it.
    """
    from clipflow.functions.angles import axis_turn

    order = W.partitionBy("track_id").orderBy("t_us", "event_id")
    o = obs.withColumn("_turn", axis_turn(F.col("yaw"), F.lag("yaw").over(order)))
    turns = o.groupBy("track_id").agg(F.count("*").alias("n_obs"), F.count_if(F.col("_turn") >= step).alias("flips"))
    a = obs.select("track_id", F.pmod("yaw", F.lit(math.pi)).alias("_a")).where("_a IS NOT NULL").distinct()
    # up to a quarter turn on: the farthest axis ahead; those beyond are nearer the other way round
    over = "OVER (PARTITION BY track_id ORDER BY _a RANGE BETWEEN {} AND {}D FOLLOWING)"
    a = a.withColumn("_far", F.expr("last(_a) " + over.format("CURRENT ROW", math.pi / 2)))
    a = a.withColumn("_next", F.expr("first(_a) " + over.format(f"{math.pi / 2}D FOLLOWING", math.pi)))
    wide = a.groupBy("track_id").agg(F.max(F.greatest(F.col("_far") - F.col("_a"), F.coalesce(math.pi - (F.col("_next") - F.col("_a")), F.lit(0.0)))).alias("span"))
    return turns.join(wide, "track_id", "left").select("track_id", "n_obs", F.coalesce("span", F.lit(0.0)).alias("span"), "flips")


def spinning_tracks(obs: DataFrame, classes: tuple[str, ...] | None, least: int, span: float, step: float, flips: int) -> DataFrame:
    """(track_id, n_obs, span, flips): tracks whose axis turns about as no vehicle's does (of all classes if classes is None)."""
    o = obs if classes is None else obs.where(F.col("class_name").isin(*classes))
    return axis_spans(o, step).where((F.col("n_obs") >= least) & (F.col("span") >= span) & (F.col("flips") >= flips))


def class_view(d: DataFrame, keep: tuple[str, ...], folded: dict[str, str]) -> DataFrame:
    """Rows of the kept classes, others folded into them by `folded` first; a frame without any stays as one row of nulls."""
    name = F.col("class_name")
    for old, new in folded.items():
        name = F.when(F.col("class_name") == old, F.lit(new)).otherwise(name)
    rows = d.withColumn("class_name", name).where(F.col("class_name").isin(*keep))
    return d.select("frame_id").distinct().join(rows, "frame_id", "left")


def low_confidence_dropped(d: DataFrame, classes: tuple[str, ...], unmoved: DataFrame, class_name: str) -> DataFrame:
    """d without the classes, and without the unmoved tracks' rows of a class."""
    gone = unmoved.select("track_id", F.lit(class_name).alias("class_name"))
    return d.where(~F.col("class_name").isin(*classes)).join(gone, ["track_id", "class_name"], "left_anti").select(*d.columns)
