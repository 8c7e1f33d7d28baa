"""Oriented boxes that overlap: pairs of a frame, and what such pairs decide.

Pairs are found by a join of a frame's boxes and a test of their bounding
circles; only what passes goes, in Arrow batches, through the one kernel that
computes the common area.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import DoubleType

from clipflow.functions.boxes import LEAST_HALF
from clipflow.operators.groups import linked_groups

#: Corners of a box in half extents, counter-clockwise.
_CORNERS = np.array([(1.0, 1.0), (-1.0, 1.0), (-1.0, -1.0), (1.0, -1.0)])
_FIELDS = ("x", "y", "dx", "dy", "yaw")


def _shape(x, y, dx, dy, yaw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Corners (n, 4, 2), half extents (n, 2), and the axes (n, 2, 2) of boxes."""
    half = np.maximum(np.stack([dx, dy], axis=1) / 2, LEAST_HALF)
    c, s = np.cos(yaw), np.sin(yaw)
    axes = np.stack([np.stack([c, s], axis=1), np.stack([-s, c], axis=1)], axis=1)
    # rounded in the order that the SQL has, so that boxes of exactly a threshold's share fall on its side
    u, v = (_CORNERS[:, i] * half[:, i, None] for i in range(2))
    c, s = c[:, None], s[:, None]
    return np.stack([np.asarray(x)[:, None] + u * c - v * s, np.asarray(y)[:, None] + u * s + v * c], axis=2), half, axes


def _in_turn(terms: np.ndarray) -> np.ndarray:
    """Sums along the second axis, one term after the other."""
    return np.cumsum(terms, axis=1)[:, -1]


def common_area(p: tuple, q: tuple) -> np.ndarray:
    """The common area of each two boxes (x, y, dx, dy, yaw): the hull of corners inside the other and of crossing sides."""
    (a, half_a, axes_a), (b, half_b, axes_b) = _shape(*p), _shape(*q)
    within = lambda v, o, half, axes: (np.abs((v - o.mean(axis=1)[:, None]) @ axes.transpose(0, 2, 1)) <= half[:, None] + 1e-9).all(axis=2)
    da, db = np.roll(a, -1, axis=1) - a, np.roll(b, -1, axis=1) - b
    cross = lambda u, v: u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]
    gap = b[:, None] - a[:, :, None]
    turn = cross(da[:, :, None], db[:, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        t, u = cross(gap, db[:, None]) / turn, cross(gap, da[:, :, None]) / turn
    meets = (np.abs(turn) > 1e-12) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
    at = a[:, :, None] + np.where(meets, t, 0.0)[..., None] * da[:, :, None]
    points = np.concatenate([a, b, at.reshape(len(a), 16, 2)], axis=1)
    real = np.concatenate([within(a, b, half_b, axes_b), within(b, a, half_a, axes_a), meets.reshape(len(a), 16)], axis=1)
    n = np.maximum(real.sum(axis=1), 1)[:, None]
    middle = _in_turn(np.where(real[..., None], points, 0.0)) / n
    away = points - middle[:, None]
    order = np.argsort(np.where(real, np.arctan2(away[..., 1], away[..., 0]), np.inf), axis=1)
    ring = np.take_along_axis(away, order[..., None], axis=1)
    ring = np.where(np.take_along_axis(real, order, axis=1)[..., None], ring, ring[:, :1])
    area = np.abs(_in_turn(cross(ring, np.roll(ring, -1, axis=1)))) / 2
    return np.where(real.sum(axis=1) >= 3, area, 0.0)


@F.pandas_udf(DoubleType())
def _common(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
    for s in parts:
        v = [x.to_numpy(float) for x in s]
        yield pd.Series(common_area(tuple(v[:5]), tuple(v[5:])))


def area(box: dict[str, Column]) -> Column:
    return F.greatest(box["dx"] / 2, F.lit(LEAST_HALF)) * F.greatest(box["dy"] / 2, F.lit(LEAST_HALF)) * 4


def overlaps(left: DataFrame, right: DataFrame, by: str = "frame_id", ordered: bool = False) -> DataFrame:
    """Pairs of boxes of the same `by` that overlap: columns a_*, b_*, `by`, inter, and iou (0 to 1; 0 for a vanishing union).

    ordered leaves each two boxes of one relation once, the lesser det_idx as a.
    """
    a = left.select(by, *(F.col(c).alias(f"a_{c}") for c in left.columns if c != by))
    b = right.select(by, *(F.col(c).alias(f"b_{c}") for c in right.columns if c != by))
    reach = (F.hypot("a_dx", "a_dy") + F.hypot("b_dx", "b_dy")) / 2 + 4 * LEAST_HALF
    near = a.join(b, by).where(F.hypot(F.col("a_x") - F.col("b_x"), F.col("a_y") - F.col("b_y")) <= reach)
    near = near.where("a_det_idx < b_det_idx") if ordered else near
    d = near.withColumn("inter", _common(*(f"a_{k}" for k in _FIELDS), *(f"b_{k}" for k in _FIELDS))).where("inter > 1e-9")
    own = [area({k: F.col(f"{s}_{k}") for k in _FIELDS}) for s in "ab"]
    union = own[0] + own[1] - F.col("inter")
    return d.withColumn("iou", F.when(union <= 1e-9, 0.0).otherwise(F.least(F.lit(1.0), F.col("inter") / union))).withColumn("cover", F.col("inter") / own[0])


def lives(d: DataFrame, *keys: str) -> DataFrame:
    """(keys, life): in how many frames a track is seen."""
    return d.groupBy(*keys).agg(F.count_distinct("frame_id").alias("life"))


def absorbed(d: DataFrame, first: str, second: str, iou: float) -> DataFrame:
    """d without the tracks of two classes that nearly coincide with a track of the other class that lives longer; of as long ones the first class stays."""
    p = overlaps(d.where(F.col("class_name") == first), d.where(F.col("class_name") == second)).where(F.col("iou") >= iou).select("a_track_id", "b_track_id").distinct()
    life = lives(d.where(F.col("class_name").isin(first, second)), "class_name", "track_id")
    mine = lambda c, s: life.where(F.col("class_name") == c).select(F.col("track_id").alias(f"{s}_track_id"), F.col("life").alias(f"{s}_life"))
    p = p.join(mine(first, "a"), "a_track_id").join(mine(second, "b"), "b_track_id")
    lost = F.when(F.col("a_life") >= F.col("b_life"), F.struct(F.lit(second).alias("class_name"), F.col("b_track_id").alias("track_id"))).otherwise(F.struct(F.lit(first).alias("class_name"), F.col("a_track_id").alias("track_id")))
    return d.join(p.select(lost.alias("lost")).select("lost.*").distinct(), ["class_name", "track_id"], "left_anti").select(*d.columns)


def covered_boxes_dropped(d: DataFrame, inner: str, outer: str, threshold: float) -> DataFrame:
    """d without the inner class's boxes of which more than the threshold lies in one of the outer class, in that frame alone."""
    gone = overlaps(d.where(F.col("class_name") == inner), d.where(F.col("class_name") == outer)).where(F.col("cover") > threshold)
    return d.join(gone.select("frame_id", F.col("a_det_idx").alias("det_idx")).distinct(), ["frame_id", "det_idx"], "left_anti").select(*d.columns)


def matched_tracks_dropped(d: DataFrame, inner: str, outer: str, threshold: float, measure: str = "iou") -> DataFrame:
    """d without the inner class's tracks that reach the threshold of `measure` (iou or cover) in any frame; 0 or less turns it off."""
    if threshold <= 0:
        return d
    p = overlaps(d.where(F.col("class_name") == inner), d.where(F.col("class_name") == outer)).where(F.col(measure) >= threshold)
    gone = p.select(F.col("a_track_id").alias("track_id"), F.lit(inner).alias("class_name")).distinct()
    return d.join(gone, ["track_id", "class_name"], "left_anti").select(*d.columns)


def same_objects(d: DataFrame, classes: tuple[str, ...] = ("Car", "Truck"), near: float = 0.8) -> DataFrame:
    """(track_id, kept_id): tracks that the evidence of their common frames makes one, and the one they become.

    Two tracks are one if their boxes coincide (0.8 of the union), if a truck
    and a car do by 0.6, if any do once by 0.5, twice by 0.25, or stand twice
    within `near`.  Kept is the track with the longest life, then the larger
    class, the best median score, and the least id.
    """
    own = d.where(F.col("class_name").isin(*classes)).select("frame_id", "det_idx", "track_id", "class_name", "score", *_FIELDS)
    mixed = F.col("a_class_name") != F.col("b_class_name")
    pair = [F.least("a_track_id", "b_track_id").alias("a"), F.greatest("a_track_id", "b_track_id").alias("b")]
    p = overlaps(own, own, ordered=True).where("a_track_id <> b_track_id").withColumn("close", F.hypot(F.col("a_x") - F.col("b_x"), F.col("a_y") - F.col("b_y")) <= near)
    said = p.groupBy(*pair).agg(F.max("iou").alias("best"), F.max(F.when(mixed, F.col("iou"))).alias("best_mixed"), F.count_if(F.col("iou") >= 0.25).alias("moderate"), F.count_if("close").alias("near"))
    links = said.where("best >= 0.5 OR best_mixed >= 0.6 OR moderate >= 2 OR near >= 2").select("a", "b")
    size = F.array_position(F.array(*map(F.lit, classes)), F.col("class_name"))
    worth = own.groupBy("track_id").agg(F.count_distinct("frame_id").alias("life"), F.max(size).alias("size"), F.round(F.median("score"), 6).alias("score"))
    roots = linked_groups(links)
    ranked = roots.withColumnRenamed("node", "track_id").join(worth, "track_id")
    best = ranked.groupBy("root").agg(F.max_by("track_id", F.struct("life", "size", "score", -F.col("track_id"))).alias("kept_id"))
    return ranked.join(best, "root").select("track_id", "kept_id")


def steady_spinners(obs: DataFrame, least: int, radius: float, overlap: float, span: float, step: float, flips: int) -> DataFrame:
    """(track_id, n, radius, mean_iou, span, flips): tracks that stay in place, box over box, while their axis turns about."""
    from clipflow.operators.filters import axis_spans

    order = W.partitionBy("track_id").orderBy("t_us", "event_id")
    o = obs.withColumn("_before", F.lag(F.struct(*_FIELDS)).over(order))
    o = o.withColumn("_inter", _common(*_FIELDS, *(F.coalesce(f"_before.{k}", k) for k in _FIELDS)))
    union = area({k: F.col(k) for k in _FIELDS}) + area({k: F.col(f"_before.{k}") for k in _FIELDS}) - F.col("_inter")
    iou = F.when(F.col("_before").isNotNull(), F.least(F.lit(1.0), F.col("_inter") / union))
    by = W.partitionBy("track_id")
    o = o.withColumn("_iou", iou).withColumn("_r", F.hypot(F.col("x") - F.median("x").over(by), F.col("y") - F.median("y").over(by)))
    still = o.groupBy("track_id").agg(F.max("_r").alias("radius"), F.avg("_iou").alias("mean_iou")).where((F.col("radius") <= radius) & (F.col("mean_iou") >= overlap))
    turned = axis_spans(obs, step).where((F.col("n_obs") >= least) & (F.col("span") >= span) & (F.col("flips") >= flips))
    return still.join(turned, "track_id").select("track_id", "n_obs", "radius", "mean_iou", "span", "flips")


def fewer_points_dropped(d: DataFrame, threshold: float) -> DataFrame:
    """d without boxes that a box of their frame overlaps by more than the threshold and beats in n_points.

    Pairs are decided in the order of their detections, and a box that has gone
    decides no more; as many points keep both.  Frames are independent, so the
    pairs of each are folded in one row.
    """
    p = overlaps(d, d, ordered=True).where((F.col("iou") > threshold) & (F.col("a_n_points") != F.col("b_n_points")))
    lost = F.when(F.col("a_n_points") < F.col("b_n_points"), F.col("a_det_idx")).otherwise(F.col("b_det_idx"))
    lists = p.groupBy("frame_id").agg(F.sort_array(F.collect_list(F.struct(F.col("a_det_idx").alias("a"), F.col("b_det_idx").alias("b"), lost.alias("lost")))).alias("_pairs"))
    gone = F.aggregate("_pairs", F.array().cast("array<int>"), lambda g, e: F.when(F.array_contains(g, e["a"]) | F.array_contains(g, e["b"]), g).otherwise(F.array_append(g, e["lost"])))
    return d.join(lists.select("frame_id", F.explode(gone).alias("det_idx")), ["frame_id", "det_idx"], "left_anti").select(*d.columns)
