"""Sizes, splits, unions and headings of tracks' boxes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clipflow.functions.angles import axis_turn, turn, wrap
from clipflow.operators.aggregates import along, axis_of, weighted_quantile
from clipflow.operators.sorting import numbered


def union_box(p: dict[str, Column], q: dict[str, Column], apart: float = math.pi / 6) -> dict[str, Column]:
    """The box around two boxes (x, y, dx, dy, yaw), along the longer one's axis, or along their centres where the axes differ by more than `apart`."""
    longer = F.when(F.greatest(p["dx"], p["dy"]) >= F.greatest(q["dx"], q["dy"]), p["yaw"]).otherwise(q["yaw"])
    yaw = F.when(axis_turn(p["yaw"], q["yaw"]) <= apart, longer).otherwise(F.atan2(q["y"] - p["y"], q["x"] - p["x"]))
    c, s = F.cos(yaw), F.sin(yaw)

    def reach(b: dict[str, Column]) -> tuple[Column, Column, Column, Column]:
        mid_u, mid_v = b["x"] * c + b["y"] * s, b["y"] * c - b["x"] * s
        t = b["yaw"] - yaw
        u = (b["dx"] * F.abs(F.cos(t)) + b["dy"] * F.abs(F.sin(t))) / 2
        v = (b["dx"] * F.abs(F.sin(t)) + b["dy"] * F.abs(F.cos(t))) / 2
        return mid_u - u, mid_u + u, mid_v - v, mid_v + v

    a, b = reach(p), reach(q)
    low_u, high_u, low_v, high_v = F.least(a[0], b[0]), F.greatest(a[1], b[1]), F.least(a[2], b[2]), F.greatest(a[3], b[3])
    u, v = (low_u + high_u) / 2, (low_v + high_v) / 2
    return {"x": u * c - v * s, "y": u * s + v * c, "dx": high_u - low_u, "dy": high_v - low_v, "yaw": yaw}


def long_boxes_split(d: DataFrame, longest: float, front: float) -> DataFrame:
    """d with boxes longer than `longest` cut in two along their heading: the front keeps the track, the rest becomes a track of its own.

    A track's rests have one id, above all ids, in the order of the tracks.
    """
    tails = numbered(d.where(F.col("dx") > longest).select("track_id").distinct(), "track_id", "_tail")
    tails = tails.withColumn("_tail", F.col("_tail") + d.agg(F.max("track_id")).scalar())
    rest = F.col("dx") - front
    move = lambda k: F.struct((F.col("x") + k * F.cos("yaw")).alias("x"), (F.col("y") + k * F.sin("yaw")).alias("y"))
    part = lambda tail, at, size: F.struct(F.lit(tail).alias("tail"), at.alias("at"), size.alias("dx"))
    whole = F.array(part(0, move(F.lit(0.0)), F.col("dx")))
    halves = F.array(part(0, move(rest / 2), F.lit(front)), part(1, move(-F.lit(front) / 2), rest))
    e = d.join(tails, "track_id", "left").withColumn("_p", F.explode(F.when(F.col("dx") > longest, halves).otherwise(whole)))
    out = e.withColumns({"track_id": F.when(F.col("_p.tail") == 1, F.col("_tail")).otherwise(F.col("track_id")), "x": F.col("_p.at.x"), "y": F.col("_p.at.y"), "dx": F.col("_p.dx")})
    return out.select(*d.columns, F.col("_p.tail").alias("tail"))


def common_axis(d: DataFrame, width: float) -> DataFrame:
    """(track_id, axis, votes): the mean axis of the fullest bin of `width` of the half circle; of as full ones the first."""
    a = d.select("track_id", F.pmod("yaw", F.lit(math.pi)).alias("_a")).withColumn("_bin", F.floor(F.col("_a") / width))
    n = a.groupBy("track_id", "_bin").agg(F.count("*").alias("votes"), F.avg("_a").alias("axis"))
    rank = W.partitionBy("track_id").orderBy(F.desc("votes"), "_bin")
    return n.withColumn("_n", F.row_number().over(rank)).where("_n = 1").select("track_id", "axis", "votes")


def long_side(d: DataFrame, share: float) -> DataFrame:
    """(track_id, long, near): the median long side, and how many boxes reach `share` of it."""
    m = d.withColumn("_l", F.greatest("dx", "dy")).withColumn("_m", F.median("_l").over(W.partitionBy("track_id")))
    return m.groupBy("track_id").agg(F.first("_m").alias("long"), F.count_if(F.col("_l") >= share * F.col("_m")).alias("near"))


def stacked(d: DataFrame) -> DataFrame:
    """(track_id, x, y, z, dx, dy, dz, axis): the box a still track stands for, by medians and its common axis."""
    middle = d.groupBy("track_id").agg(*(F.median(c).alias(c) for c in ("x", "y", "z", "dx", "dy", "dz")))
    return middle.join(axis_of(d, "track_id", F.col("yaw")), "track_id")


def agreed_sizes(d: DataFrame, value: str, weight: Column, near: float, share: float, least: int, low: float, high: float) -> DataFrame:
    """(track_id, size, inliers): the weighted median of what lies within `near` of the median, between the bounds.

    Tracks with fewer inliers than `least` or than `share` of their rows agree on nothing.
    """
    by = W.partitionBy("track_id")
    m = d.withColumn("_m", F.median(value).over(by)).withColumn("_all", F.count(value).over(by))
    inner = m.where(F.abs(F.col(value) - F.col("_m")) <= near * F.col("_m"))
    enough = inner.groupBy("track_id").agg(F.count("*").alias("inliers"), F.first("_all").alias("_all")).where((F.col("inliers") >= least) & (F.col("inliers") >= share * F.col("_all")))
    q = weighted_quantile(inner, "track_id", value, weight, 0.5)
    return q.join(enough, "track_id").select("track_id", F.least(F.greatest("quantile", F.lit(low)), F.lit(high)).alias("size"), "inliers")


def class_sizes(d: DataFrame, value: str, weight: Column, quantiles: dict[str, float], bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """(class_name, size): each class's own weighted quantile, within its bounds."""
    out = None
    for name, q in quantiles.items():
        low, high = bounds[name]
        own = weighted_quantile(d.where(F.col("class_name") == name), "class_name", value, weight, q).select("class_name", F.least(F.greatest("quantile", F.lit(low)), F.lit(high)).alias("size"))
        out = own if out is None else out.union(own)
    return out


def static_axes(d: DataFrame, near: float) -> DataFrame:
    """(track_id, axis, inliers): the axis of the rows near the median one; without any, the median one itself."""
    first = axis_of(d, "track_id", F.col("yaw")).withColumnRenamed("axis", "_first")
    inner = d.join(first, "track_id").where(axis_turn(F.col("yaw"), F.col("_first")) <= near)
    best = axis_of(inner, "track_id", F.col("yaw")).join(inner.groupBy("track_id").agg(F.count("*").alias("_n")), "track_id")
    return first.join(best, "track_id", "left").select("track_id", F.coalesce("axis", "_first").alias("axis"), F.coalesce("_n", F.lit(0)).alias("inliers"))


def directions(d: DataFrame, axes: DataFrame, least: int, margin: float) -> DataFrame:
    """(track_id, axis, heading, ahead, behind): the axis, and the way along it that the rows' headings vote for; null without enough votes or a margin."""
    side = turn(F.col("yaw"), F.col("axis")) <= math.pi / 2
    v = d.join(axes.select("track_id", "axis"), "track_id").groupBy("track_id", "axis").agg(F.count_if(side).alias("ahead"), F.count_if(~side).alias("behind"))
    total = F.col("ahead") + F.col("behind")
    clear = (total >= least) & (F.abs(F.col("ahead") - F.col("behind")) >= margin * total)
    return v.select("track_id", "axis", F.when(clear, F.when(F.col("ahead") >= F.col("behind"), F.col("axis")).otherwise(F.col("axis") + math.pi)).alias("heading"), "ahead", "behind")


def settled(d: DataFrame, votes: DataFrame, dwelling: DataFrame) -> DataFrame:
    """d with the voted heading, or at least the axis the near way round, in the rows of `dwelling` (track_id, t_us)."""
    v = votes.select("track_id", "axis", "heading")
    e = d.join(dwelling.select("track_id", "t_us").distinct().withColumn("_in", F.lit(True)), ["track_id", "t_us"], "left").join(v, "track_id", "left")
    near = F.when(turn(F.col("yaw"), F.col("axis")) <= math.pi / 2, F.col("axis")).otherwise(F.col("axis") + math.pi)
    return e.withColumn("yaw", F.when(F.col("_in"), wrap(F.coalesce("heading", near, "yaw"))).otherwise(F.col("yaw"))).select(*d.columns)


def turned_about(d: DataFrame, net: float) -> DataFrame:
    """d with headings turned by pi where they point against the way from a track's first place to its last, if that is `net` or more."""
    by = along().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    way = lambda c: F.last(c).over(by) - F.first(c).over(by)
    e = d.withColumn("_wx", way("x")).withColumn("_wy", way("y"))
    against = (F.hypot("_wx", "_wy") >= net) & (turn(F.col("yaw"), F.atan2("_wy", "_wx")) > math.pi / 2)
    return e.withColumn("yaw", F.when(against, wrap(F.col("yaw") + math.pi)).otherwise(F.col("yaw"))).drop("_wx", "_wy")


def step_yaws(d: DataFrame, least: float) -> DataFrame:
    """d with target: the heading of the step to a row, a quarter turn less for boxes wider than long; null for short steps."""
    dx, dy = F.col("x") - F.lag("x").over(along()), F.col("y") - F.lag("y").over(along())
    own = F.when(F.hypot(dx, dy) >= least, F.atan2(dy, dx))
    return d.withColumn("target", wrap(own - F.when(F.col("dx") < F.col("dy"), math.pi / 2).otherwise(0.0)))
