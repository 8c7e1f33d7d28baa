"""Joins by frame, by time and by place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clipflow.functions.boxes import aligned_intersection, iou
from clipflow.operators.groups import linked_groups


def nearest_in_time(left: DataFrame, right: DataFrame, by: str, tolerance_us: int) -> DataFrame:
    """left with match_us, the nearest time of right within the tolerance, the earlier of two as near, else null.

    Both sides are ordered together once a key: the neighbours on either side
    come from two window functions, with no pairs in between.
    """
    marks = left.select("*", F.lit(1).alias("_side")).unionByName(right.select(by, "t_us", F.lit(0).alias("_side")), allowMissingColumns=True)
    order = W.partitionBy(by).orderBy("t_us", "_side")
    other = F.when(F.col("_side") == 0, F.col("t_us"))
    back = W.partitionBy(by).orderBy(F.desc("t_us"), F.desc("_side"))
    both = marks.withColumn("_before", F.last(other, True).over(order)).withColumn("_after", F.last(other, True).over(back)).where("_side = 1")
    ahead, behind = F.col("_after") - F.col("t_us"), F.col("t_us") - F.col("_before")
    near = F.when(behind.isNull() | (ahead < behind), F.col("_after")).otherwise(F.col("_before"))
    return both.withColumn("match_us", F.when(F.abs(near - F.col("t_us")) <= tolerance_us, near)).drop("_side", "_before", "_after")


def interpolated(stamps: DataFrame, poses: DataFrame, by: str, most_gap_us: int) -> DataFrame:
    """stamps with px, py: the poses on either side blended by time; beyond the ends, and across long gaps, the nearer pose."""
    marks = stamps.select("*", F.lit(1).alias("_side")).unionByName(poses.select(by, "t_us", "px", "py", F.lit(0).alias("_side")), allowMissingColumns=True)
    pose = F.when(F.col("_side") == 0, F.struct("t_us", "px", "py"))
    order = W.partitionBy(by).orderBy("t_us", "_side", "px", "py")
    back = W.partitionBy(by).orderBy(F.desc("t_us"), F.desc("_side"), F.desc("px"), F.desc("py"))
    b = marks.withColumn("_a", F.last(pose, True).over(order)).withColumn("_b", F.last(pose, True).over(back)).where("_side = 1")
    gap, into = F.col("_b.t_us") - F.col("_a.t_us"), F.col("t_us") - F.col("_a.t_us")
    alpha = F.when(F.col("_a").isNull(), 1.0).when(F.col("_b").isNull() | (gap == 0), 0.0).when(gap > most_gap_us, F.when(into * 2 <= gap, 0.0).otherwise(1.0)).otherwise(into / gap)
    blend = lambda k: F.when(alpha == 0, F.col(f"_a.{k}")).when(alpha == 1, F.col(f"_b.{k}")).otherwise(F.col(f"_a.{k}") * (1 - alpha) + F.col(f"_b.{k}") * alpha).alias(k)
    return b.select(*[c for c in stamps.columns], blend("px"), blend("py"))


def merged_back(all_rows: DataFrame, refined: DataFrame, class_name: str) -> DataFrame:
    """all_rows with the refined values of a class; its rows without a refined one go, other classes stay as they are.

    refined is (frame_id, track_id, det_idx, new_score); of several the last counts, of as late ones the best.
    """
    last = refined.groupBy("frame_id", "track_id").agg(F.max(F.struct("det_idx", "new_score")).alias("_last"))
    last = last.select("frame_id", "track_id", "_last.new_score")
    own = F.col("class_name") == class_name
    joined = all_rows.join(last.withColumn("_found", F.lit(True)), ["frame_id", "track_id"], "left")
    return joined.where(~own | F.col("_found")).withColumn("score", F.when(own, F.col("new_score")).otherwise(F.col("score"))).drop("new_score", "_found")


def pairs_of_frame(d: DataFrame, condition) -> DataFrame:
    """The pairs a, b of a frame's detections, a before b, for which condition(a, b) holds."""
    a, b = d.alias("a"), d.alias("b")
    col = lambda s: {c: F.col(f"{s}.{c}") for c in d.columns}
    return a.join(b, (F.col("a.frame_id") == F.col("b.frame_id")) & (F.col("a.det_idx") < F.col("b.det_idx")) & condition(col("a"), col("b")))


def same_centre_pairs(d: DataFrame, gate: float) -> DataFrame:
    """(frame_id, det_a, det_b, distance) of detections that stand within the gate of each other."""
    away = lambda a, b: F.hypot(a["x"] - b["x"], a["y"] - b["y"])
    col = lambda s: {c: F.col(f"{s}.{c}") for c in ("x", "y")}
    p = pairs_of_frame(d, lambda a, b: away(a, b) <= gate)
    return p.select("a.frame_id", F.col("a.det_idx").alias("det_a"), F.col("b.det_idx").alias("det_b"), away(col("a"), col("b")).alias("distance"))


def same_centre_kept(d: DataFrame, gate: float, priority: Column) -> DataFrame:
    """One detection of each group of a frame that hangs together within the gate.

    Kept is the one of the best class, then of the track with the longest life,
    then of the best score, then the first.
    """
    life = d.groupBy("track_id").agg(F.count_distinct("frame_id").alias("_life"))
    end = lambda c: F.struct("frame_id", F.col(c).alias("det_idx"))
    links = same_centre_pairs(d, gate).select(end("det_a").alias("a"), end("det_b").alias("b"))
    grouped = linked_groups(links).select("node.frame_id", "node.det_idx", F.col("root.det_idx").alias("_group"))
    rank = W.partitionBy("frame_id", F.coalesce("_group", "det_idx")).orderBy(priority.asc(), F.desc("_life"), F.desc("score"), "det_idx")
    joined = d.join(life, "track_id", "left").join(grouped, ["frame_id", "det_idx"], "left")
    return joined.withColumn("_n", F.row_number().over(rank)).where("_n = 1").select(*d.columns)


def cover_pairs(d: DataFrame, inner: str, outer: str) -> DataFrame:
    """(frame_id, track_id, det_idx, cover, iou) of each pair of an inner class's box and an outer one's, sides along the axes."""
    a, b = d.where(F.col("class_name") == inner).alias("a"), d.where(F.col("class_name") == outer).alias("b")
    col = lambda s: {c: F.col(f"{s}.{c}") for c in ("x", "y", "dx", "dy")}
    p, q = col("a"), col("b")
    common = aligned_intersection(p, q)
    near = (F.abs(p["x"] - q["x"]) * 2 < p["dx"] + q["dx"]) & (F.abs(p["y"] - q["y"]) * 2 < p["dy"] + q["dy"])
    area_p, area_q = p["dx"] * p["dy"], q["dx"] * q["dy"]
    return a.join(b, (F.col("a.frame_id") == F.col("b.frame_id")) & near).select("a.frame_id", "a.track_id", "a.det_idx", (common / area_p).alias("cover"), iou(common, area_p, area_q).alias("iou"))


def covered_in_frame_dropped(d: DataFrame, inner: str, outer: str, threshold: float) -> DataFrame:
    """d without boxes of the inner class covered by more than the threshold, in that frame alone."""
    gone = cover_pairs(d, inner, outer).where(F.col("cover") > threshold).select("frame_id", "det_idx").distinct()
    return d.join(gone, ["frame_id", "det_idx"], "left_anti")


def overlapping_tracks_dropped(d: DataFrame, inner: str, outer: str, threshold: float) -> DataFrame:
    """d without the inner class's tracks that reach the threshold of intersection over union in any frame; 0 turns it off."""
    if threshold <= 0:
        return d
    gone = cover_pairs(d, inner, outer).groupBy("track_id").agg(F.max("iou").alias("m")).where(F.col("m") >= threshold).select("track_id")
    own = d.where(F.col("class_name") == inner).join(gone, "track_id", "left_anti").select(*d.columns)
    return own.unionByName(d.where(F.col("class_name") != inner))


def reused(existing: DataFrame, fresh: DataFrame) -> DataFrame:
    """Existing rows of the classes that weren't made anew, and the fresh rows; `part` tells which come first."""
    old = existing.join(fresh.select("class_name").distinct(), "class_name", "left_anti")
    return old.withColumn("part", F.lit(0)).unionByName(fresh.withColumn("part", F.lit(1)))


def frame_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(frame_id, side): frames that one side has and the other hasn't; none if the sides agree."""
    seen = a.select("frame_id", F.lit("left").alias("side")).union(b.select("frame_id", F.lit("right").alias("side")))
    return seen.groupBy("frame_id").agg(F.min("side").alias("side"), F.max("side").alias("_other")).where("side = _other").drop("_other")
