"""Views of the supplied tables as detections, observations, poses and labels, each with the SQL that says the same.

Events are observations of a track (the user) over time; line items are boxes
of a frame (the order).  The operators themselves take any relation with these columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLASSES = {"A": "Car", "N": "Pedestrian", "R": "Truck"}


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, track_id, t_us, x, y, class_name): places of tracks over time."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select(
        "event_id",
        F.col("user_id").alias("track_id"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"),
        F.col("value").cast("double").alias("x"),
        F.regexp_extract("props", "-?[0-9]+", 0).try_cast("double").alias("y"),
        F.col("event_type").alias("class_name"),
    )


OBSERVATIONS = "obs AS (SELECT event_id, user_id AS track_id, epoch_us(ts)::BIGINT AS t_us, value::DOUBLE AS x, try_cast(regexp_extract(props, '-?[0-9]+') AS DOUBLE) AS y, event_type AS class_name FROM events)"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(frame_id, det_idx, track_id, class_name, score, x, y, z, dx, dy, dz, yaw): boxes of frames."""
    d = lambda c: F.col(c).cast("double")
    name = F.when(F.col("l_returnflag") == "A", "Car").when(F.col("l_returnflag") == "R", "Truck").otherwise("Pedestrian")
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_orderkey").cast("long").alias("frame_id"),
        F.col("l_linenumber").cast("int").alias("det_idx"),
        F.col("l_suppkey").cast("long").alias("track_id"),
        name.alias("class_name"),
        (d("l_discount") * 10).alias("score"),
        (d("l_quantity") - 25).alias("x"),
        (d("l_extendedprice") / 1000 - 30).alias("y"),
        (d("l_tax") * 10).alias("z"),
        (d("l_quantity") / 5 + 1).alias("dx"),
        (d("l_tax") * 20 + 1).alias("dy"),
        (d("l_discount") * 10 + 1).alias("dz"),
        (d("l_tax") * 30).alias("yaw"),
    )


BOXES = "box AS (SELECT l_orderkey::BIGINT AS frame_id, l_linenumber::INT AS det_idx, l_suppkey::BIGINT AS track_id, CASE l_returnflag WHEN 'A' THEN 'Car' WHEN 'R' THEN 'Truck' ELSE 'Pedestrian' END AS class_name, l_discount::DOUBLE * 10 AS score, l_quantity::DOUBLE - 25 AS x, l_extendedprice::DOUBLE / 1000 - 30 AS y, l_tax::DOUBLE * 10 AS z, l_quantity::DOUBLE / 5 + 1 AS dx, l_tax::DOUBLE * 20 + 1 AS dy, l_discount::DOUBLE * 10 + 1 AS dz, l_tax::DOUBLE * 30 AS yaw FROM lineitem)"


def tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes with the time of their frame (t_us) and a number of their own (event_id), as observations of their track."""
    b = boxes(spark, sf_dir)
    return b.withColumn("t_us", F.col("frame_id") * 200_000).withColumn("event_id", (F.col("frame_id") * 10 + F.col("det_idx")) * 100_000_000 + F.round((F.col("y") + 30) * 100_000).cast("long"))


TRACKED = f"{BOXES}, trk AS (SELECT *, frame_id * 200000 AS t_us, (frame_id * 10 + det_idx) * 100000000 + round((y + 30) * 100000)::BIGINT AS event_id FROM box)"


def cloud(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """(frame_id, px, py, pz): three points for each box, on a line through its centre; dealt by frame, where asked for, while they still are one row."""
    b = boxes(spark, sf_dir).select("frame_id", "x", "y", "z")
    b = (b.repartition("frame_id") if dealt else b).select("*", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("k"))
    return b.select("frame_id", (F.col("x") + F.col("k") * 0.7).alias("px"), (F.col("y") + F.col("k") * 0.4).alias("py"), (F.col("z") + F.col("k") * 0.45).alias("pz"))


def clip_poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(clip, t_us, place, quaternion): poses of ten clips over the time of the frames."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    half = (F.col("o_orderkey") % 63) / F.lit(20.0)
    return o.select(
        (F.col("o_custkey") % 10).alias("clip"), (F.col("o_orderkey") * 200_000 + 70_000).alias("t_us"), (F.col("o_totalprice").cast("double") / 1000).alias("px"), (F.col("o_custkey").cast("double") / 10).alias("py"), F.lit(1.0).alias("pz"),
        ((F.col("o_orderkey") % 3) / F.lit(10.0)).alias("qx"), F.lit(0.0).alias("qy"), F.sin(half).alias("qz"), F.cos(half).alias("qw"),
    )


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(track_id, class_name, score, frame_id): what a model said of each track, by frame."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select(F.col("o_custkey").cast("long").alias("track_id"), F.col("o_orderpriority").alias("class_name"), F.col("o_totalprice").cast("double").alias("score"), F.col("o_orderkey").cast("long").alias("frame_id"))


CLASSIFIED = "det AS (SELECT o_custkey::BIGINT AS track_id, o_orderpriority AS class_name, o_totalprice::DOUBLE AS score, o_orderkey::BIGINT AS frame_id FROM orders)"
