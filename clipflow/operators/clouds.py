"""Clouds of several sensors of a clip as one, at the times and in the frame of a reference sensor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipflow.functions.rotations import matrix
from clipflow.operators.groups import durable
from clipflow.operators.joins import nearest_in_time
from clipflow.operators.world import posed


def _at(m: Column, i: int, j: int) -> Column:
    return F.lit(1.0 if i == j else 0.0) if i == 3 else m[4 * i + j]


def times(a: Column, b: Column) -> Column:
    """The rigid transform b, then a; each is twelve numbers row by row."""
    cell = lambda i, j: _at(a, i, 0) * _at(b, 0, j) + _at(a, i, 1) * _at(b, 1, j) + _at(a, i, 2) * _at(b, 2, j) + (_at(a, i, 3) if j == 3 else F.lit(0.0))
    return F.array(*(cell(i, j) for i in range(3) for j in range(4)))


def inverse(m: Column) -> Column:
    """The rigid transform back."""
    shift = [-(m[i] * m[3] + m[4 + i] * m[7] + m[8 + i] * m[11]) for i in range(3)]
    return F.array(*(shift[i] if j == 3 else m[4 * j + i] for i in range(3) for j in range(4)))


def world_of(stamps: DataFrame, poses: DataFrame, by: str, most_gap_us: int) -> DataFrame:
    """(by, t_us, world): the transform from the posed sensor's frame to the world at each time."""
    p = posed(stamps.select(by, "t_us").distinct(), poses, by, most_gap_us)
    rotation = matrix(tuple(F.col(k) for k in ("qx", "qy", "qz", "qw")))
    return p.select(by, "t_us", F.array(*(c for row, k in zip(rotation, ("px", "py", "pz"), strict=True) for c in (*row, F.col(k)))).alias("world"))


def attached(clouds: DataFrame, extrinsics: DataFrame, poses: DataFrame, by: str, reference: str, tolerance_us: int, most_gap_us: int) -> DataFrame:
    """(by, sensor, t_us, stamp_us, way): for each time of the reference sensor and each other sensor its nearest time within the tolerance, and the transform of its points.

    extrinsics (by, sensor, base): the transform from a sensor to the vehicle.
    The vehicle's own way between both times is made up for where both have a
    pose; else sensors are as if at rest.
    """
    stamps = durable(clouds.select(by, "sensor", "t_us").distinct())
    others = extrinsics.where(F.col("sensor") != reference).select(by, "sensor", "base")
    home = extrinsics.where(F.col("sensor") == reference).select(by, F.col("base").alias("home"))
    key = F.struct(by, "sensor").alias("of")
    wanted = stamps.where(F.col("sensor") == reference).select(by, "t_us").join(others, by)
    near = nearest_in_time(wanted.select(key, "t_us"), stamps.where(F.col("sensor") != reference).select(key, "t_us"), "of", tolerance_us).where("match_us IS NOT NULL")
    pairs = near.select(F.col(f"of.{by}").alias(by), F.col("of.sensor").alias("sensor"), "t_us", F.col("match_us").alias("stamp_us"))
    still = pairs.join(others, [by, "sensor"]).join(home, by).withColumn("still", times(inverse(F.col("home")), F.col("base"))).drop("home", "base")
    world = durable(world_of(stamps, poses, by, most_gap_us))
    there = world.select(by, F.col("t_us").alias("stamp_us"), F.col("world").alias("there"))
    both = still.join(world, [by, "t_us"], "left").join(there, [by, "stamp_us"], "left")
    both = both.withColumn("went", times(inverse(F.col("world")), F.col("there")))
    return durable(both.select(by, "sensor", "t_us", "stamp_us", F.when(F.col("world").isNotNull() & F.col("there").isNotNull(), times(F.col("went"), F.col("still"))).otherwise(F.col("still")).alias("way")))


def fused(clouds: DataFrame, extrinsics: DataFrame, poses: DataFrame, by: str, reference: str, tolerance_us: int, most_gap_us: int) -> DataFrame:
    """(by, t_us, sensor, px, py, pz, others...): the points of all sensors at the reference's times, in its frame.

    clouds (by, sensor, t_us, px, py, pz, others...).  The reference's own
    points stay; a sensor without a time near enough adds none.  Points are
    joined with their cloud's few transforms, and nothing else is moved.
    """
    ways = attached(clouds, extrinsics, poses, by, reference, tolerance_us, most_gap_us)
    more = [c for c in clouds.columns if c not in (by, "sensor", "t_us", "px", "py", "pz")]
    met = clouds.where(F.col("sensor") != reference).withColumnRenamed("t_us", "stamp_us").join(ways, [by, "sensor", "stamp_us"])
    at = lambda i: F.col("way")[4 * i] * F.col("px") + F.col("way")[4 * i + 1] * F.col("py") + F.col("way")[4 * i + 2] * F.col("pz") + F.col("way")[4 * i + 3]
    moved = met.select(by, "t_us", "sensor", *(at(i).alias(k) for i, k in enumerate(("px", "py", "pz"))), *more)
    return clouds.where(F.col("sensor") == reference).select(by, "t_us", "sensor", "px", "py", "pz", *more).union(moved)
