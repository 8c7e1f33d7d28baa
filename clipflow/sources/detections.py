"""Readers of detection JSON, poses and point clouds, and the label writer; schemas are never inferred."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

DETECTION = T.StructType([
    T.StructField("class_name", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("box_lidar", T.ArrayType(T.DoubleType())),
    T.StructField("track_id", T.LongType()),
    T.StructField("region", T.StringType()),
])
FRAME = T.StructType([
    T.StructField("frame_id", T.StringType()),
    T.StructField("num_points", T.LongType()),
    T.StructField("num_detections", T.LongType()),
    T.StructField("detections", T.ArrayType(DETECTION)),
])
POSE = "ts_ns long, x double, y double, z double, qx double, qy double, qz double, qw double"


def frames(spark: SparkSession, path: str) -> DataFrame:
    """One row for each frame of the JSON files; those without detections stay."""
    return spark.read.schema(FRAME).json(path, multiLine=True)


def detections(frames: DataFrame) -> DataFrame:
    """One row for each detection, with its place in the frame's list, which ties are decided by."""
    each = frames.select("frame_id", F.posexplode("detections").alias("det_idx", "d"))
    return each.select("frame_id", "det_idx", "d.*")


def poses(spark: SparkSession, path: str) -> DataFrame:
    """Poses by time; malformed lines are left out, and of a repeated time the last line counts."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("line"))
    part = F.split("value", ",")
    names = [f.split()[0] for f in POSE.split(", ")]
    kinds = [f.split()[1] for f in POSE.split(", ")]
    rows = lines.select("line", *(F.trim(F.get(part, i)).try_cast(k).alias(n) for i, (n, k) in enumerate(zip(names, kinds, strict=True)))).na.drop("any")
    return rows.withColumn("_n", F.row_number().over(W.partitionBy("ts_ns").orderBy(F.desc("line")))).where("_n = 1").select(*names)


def points(spark: SparkSession, path: str, columns: int = 4) -> DataFrame:
    """(path, x, y, z) of raw float32 clouds; a file whose size doesn't fit is an error."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if len(content) % (4 * columns):
                    raise ValueError(f"{name}: {len(content)} bytes are no points of {columns} numbers")
                cloud = np.frombuffer(content, np.float32).reshape(-1, columns)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(cloud), pa.string()), *(pa.array(np.ascontiguousarray(cloud[:, k])) for k in range(3))], ["path", "x", "y", "z"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(decode, "path string, x float, y float, z float")


def label(obj_id: Column, obj_type: Column, score: Column, box: dict[str, Column]) -> Column:
    """The label of a box: numbers to four places, rotation about z alone."""
    r = lambda k: F.bround(box[k], 4).alias(k)
    xyz = lambda *k: F.struct(*(F.bround(box[n], 4).alias(a) for n, a in zip(k, "xyz", strict=True)))
    turned = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), r("yaw").alias("z"))
    psr = F.struct(xyz("x", "y", "z").alias("position"), turned.alias("rotation"), xyz("dx", "dy", "dz").alias("scale"))
    return F.struct(obj_id.cast("string").alias("obj_id"), obj_type.alias("obj_type"), F.bround(score, 4).alias("score"), psr.alias("psr"))


def write_labels(labels: DataFrame, path: str) -> None:
    """JSON by clip; only the clips written are replaced."""
    labels.write.option("partitionOverwriteMode", "dynamic").partitionBy("clip_id").mode("overwrite").json(path)
