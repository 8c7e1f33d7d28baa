"""A stream of frames by clip, stopped and restarted from its checkpoint, against the batch."""

import random

from pyspark.sql import functions as F

from clipflow.streaming import clips

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def test_boxes_go_to_the_nearest_way_on():
    tracks = [(1, 0, 0.0, 0.0, 1.0, 0.0), (2, 0, 5.0, 0.0, 0.0, 0.0)]
    now, of, n = clips.tied(tracks, [(7, 1.1, 0.0), (8, 5.2, 0.0), (9, 20.0, 0.0)], 1_000_000, 3, 1.0, 0.0)
    assert of == {7: 1, 8: 2, 9: 3} and n == 4 and [t[0] for t in now] == [1, 2, 3]
    assert clips.tied(tracks, [], 1_000_000, 3, 1.0, 0.0) == (tracks, {}, 3)
    assert clips.tied([], [(1, 0.0, 0.0), (2, 0.0, 0.0)], 0, 1, 1.0, 0.0)[1] == {1: 1, 2: 2}


def test_a_restarted_stream_equals_the_batch(spark, tmp_path):
    r = random.Random(3)
    rows = []
    for clip in (1, 2):
        for frame in range(24):
            for det in range(3):
                if r.random() < 0.8 and not (frame in (9, 10, 11, 12) and det == 0):
                    rows.append((clip, 3600 + frame, det, det * 10.0 + frame * 0.5 * (det - 1) + r.uniform(-0.2, 0.2), clip * 1.0))
    d = spark.createDataFrame(rows, "clip long, s long, det long, x double, y double").withColumn("ts", F.timestamp_seconds("s"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    try:
        got = []
        for part, (low, high) in enumerate(((0, 8), (8, 16), (16, 99))):  # each with a query of its own, from one checkpoint
            d.where(f"s - 3600 >= {low} AND s - 3600 < {high}").drop("s").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(d.drop("s").schema).parquet(str(tmp_path / "in"))
            out = clips.followed(stream, 3.0, 1.0, 0.5, "1 minute")
            q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "check")).outputMode("append").trigger(availableNow=True).start()
            q.awaitTermination(120)
            assert q.exception() is None
        got = sorted((x.clip, x.ts, x.det, x.track) for x in spark.read.parquet(str(tmp_path / "out")).collect())
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    want = sorted((x.clip, x.ts, x.det, x.track) for x in clips.followed_batch(d, 3.0, 1.0, 0.5).collect())
    assert got == want and len({x[3] for x in want}) > 3
