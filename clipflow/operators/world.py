"""The base relation of observations: boxes with the pose of their frame, placed in the world."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clipflow.functions.rotations import matrix, moved, moved_yaw, quaternion, slerp, times_turned
from clipflow.operators.groups import durable

_POSE = ("px", "py", "pz", "qx", "qy", "qz", "qw")


#: Length of the bins of time in which times meet poses.
BIN_US = 60_000_000


def posed(stamps: DataFrame, poses: DataFrame, by: str, most_gap_us: int, sensor: tuple[tuple[float, ...], ...] | None = None) -> DataFrame:
    """stamps with the pose of their time: places blended, rotations along the shorter arc.

    Beyond the ends the nearest pose stands, and in a gap longer than the limit
    the nearer one (the earlier of equally near ones).  Each time of a `by` is
    posed once, in the partition of its bin of time.  `sensor` is a fixed rotation and place (3 rows of 4) of the
    sensor in the posed frame; without it they are the same.
    """
    times = stamps.select(by, "t_us").distinct()
    marks = times.select("*", F.lit(1).alias("_side")).unionByName(poses.select(by, "t_us", *_POSE, F.lit(0).alias("_side")), allowMissingColumns=True)
    marks = marks.withColumn("_bin", F.floor(F.col("t_us") / BIN_US))
    pose = F.when(F.col("_side") == 0, F.struct("t_us", *_POSE))
    # a bin's own poses, and the last one of the bins before and the first of those after
    ends = marks.groupBy(by, "_bin").agg(F.min(pose).alias("_first"), F.max(pose).alias("_last"))
    others = lambda order: W.partitionBy(by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select(by, "_bin", F.last("_last", True).over(others("_bin")).alias("_before"), F.last("_first", True).over(others(F.desc("_bin"))).alias("_after"))
    order = W.partitionBy(by, "_bin").orderBy("t_us", "_side")
    back = W.partitionBy(by, "_bin").orderBy(F.desc("t_us"), F.desc("_side"))
    b = marks.join(ends, [by, "_bin"]).withColumn("_a", F.coalesce(F.last(pose, True).over(order), "_before")).withColumn("_b", F.coalesce(F.last(pose, True).over(back), "_after"))
    b = b.where("_side = 1").where("_a IS NOT NULL OR _b IS NOT NULL")
    b = b.withColumn("_a", F.coalesce("_a", "_b")).withColumn("_b", F.coalesce("_b", "_a"))
    gap, into = F.col("_b.t_us") - F.col("_a.t_us"), F.col("t_us") - F.col("_a.t_us")
    alpha = F.when(gap <= 0, 0.0).when(gap > most_gap_us, F.when(2 * into <= gap, 0.0).otherwise(1.0)).otherwise(into / gap)
    b = b.select(by, "t_us", "_a", "_b", alpha.alias("_alpha"))
    blend = [(F.col(f"_a.{k}") * (1 - F.col("_alpha")) + F.col(f"_b.{k}") * F.col("_alpha")).alias(k) for k in _POSE[:3]]
    unit = lambda s: F.struct(*(q.alias(k) for q, k in zip(_unit(tuple(F.col(f"{s}.{k}") for k in _POSE[3:])), _POSE[3:], strict=True)))
    b = durable(b.select(by, "t_us", "_alpha", *blend, unit("_a").alias("_p"), unit("_b").alias("_q")))
    turned = slerp(tuple(F.col(f"_p.{k}") for k in _POSE[3:]), tuple(F.col(f"_q.{k}") for k in _POSE[3:]), F.col("_alpha"))
    b = b.select(by, "t_us", *_POSE[:3], *(q.alias(k) for q, k in zip(turned, _POSE[3:], strict=True)))
    if sensor is not None:
        at = moved(matrix(tuple(F.col(k) for k in _POSE[3:])), tuple(F.col(k) for k in _POSE[:3]), tuple(F.lit(row[3]) for row in sensor))
        q = tuple(F.lit(v) for v in quaternion(sensor))
        b = b.select(by, "t_us", *(c.alias(k) for c, k in zip((*at, *times_turned(tuple(F.col(k) for k in _POSE[3:]), q)), _POSE, strict=True)))
    return stamps.join(durable(b), [by, "t_us"]).select(*stamps.columns, *_POSE)


def _unit(q: tuple[Column, ...]) -> tuple[Column, ...]:
    norm = F.sqrt(sum((a * a for a in q[1:]), q[0] * q[0]))
    return tuple(F.when(norm > 1e-12, a / norm).otherwise(1.0 if k == 3 else 0.0) for k, a in enumerate(q))


def in_world(boxes: DataFrame) -> DataFrame:
    """Posed boxes with wx, wy, wz and wyaw, their centre and heading in the world."""
    m = matrix(tuple(F.col(k) for k in _POSE[3:]))
    x, y, z = moved(m, tuple(F.col(k) for k in _POSE[:3]), tuple(F.col(k) for k in ("x", "y", "z")))
    return boxes.withColumns({"wx": x, "wy": y, "wz": z, "wyaw": moved_yaw(m, F.col("yaw"))})


def yaw_from_world(m: list[list[Column]], wyaw: Column) -> Column:
    """The heading that the rotation turns into wyaw: the solution of its planar part, by least squares where that is singular."""
    a, b, c, d = m[0][0], m[0][1], m[1][0], m[1][1]
    u, v = F.cos(wyaw), F.sin(wyaw)
    det = a * d - b * c
    exact = (d * u - b * v, a * v - c * u)  # times the determinant
    least = (a * u + c * v, b * u + d * v)
    sign = F.when(det < 0, -1.0).otherwise(1.0)
    return F.when(F.abs(det) > 1e-9, F.atan2(sign * exact[1], sign * exact[0])).otherwise(F.atan2(least[1], least[0]))


def to_base(boxes: DataFrame, base_from_lidar: tuple[tuple[float, ...], ...], classes: dict[str, str]) -> DataFrame:
    """Boxes moved by a fixed 3x4 matrix: centres and headings change, extents stay; classes by their names in `classes`, others go."""
    m = [[F.lit(v) for v in row[:3]] for row in base_from_lidar]
    x, y, z = moved(m, tuple(F.lit(row[3]) for row in base_from_lidar), tuple(F.col(k) for k in ("x", "y", "z")))
    name = F.create_map(*(F.lit(v) for pair in classes.items() for v in pair))[F.col("class_name")]
    return boxes.withColumns({"class_name": name, "bx": x, "by": y, "bz": z, "byaw": moved_yaw(m, F.col("yaw"))}).where("class_name IS NOT NULL")


def centred(d: DataFrame) -> DataFrame:
    """Boxes given by the middle of their bottom, by their centre."""
    return d.withColumn("z", F.col("z") + F.col("dz") / 2)


def observations_of(frames: DataFrame, poses: DataFrame, by: str, classes: tuple[str, ...], most_gap_us: int) -> DataFrame:
    """(track_id, t_us, wx, wy, wz, wyaw, ...): valid tracked boxes of the classes in the world; frames without a pose give none."""
    ok = F.lit(True)
    for c in ("x", "y", "z", "dx", "dy", "dz", "yaw"):
        ok &= F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    some = frames.where(F.col("class_name").isin(*classes) & F.col("track_id").isNotNull() & ok & (F.col("dx") > 0) & (F.col("dy") > 0) & (F.col("dz") > 0))
    return in_world(posed(some, poses, by, most_gap_us))
