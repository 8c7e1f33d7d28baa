"""Operators of tracks, boxes and frames on rows whose results are known."""

import json
import math
import struct

import pytest
from pyspark.sql import functions as F

from clipflow.functions import angles, boxes, rotations
from clipflow.operators import aggregates, filters, joins, windows
from clipflow.sources import detections
from clipflow.streaming import online

OBS = "event_id long, track_id long, t_us long, x double, y double, class_name string"
BOX = "frame_id long, det_idx int, track_id long, class_name string, score double, x double, y double, z double, dx double, dy double, dz double, yaw double"
SECOND = 1_000_000


def obs(spark, points, track=1, dt=SECOND):
    return spark.createDataFrame([(i, track, i * dt, float(x), float(y), "Car") for i, (x, y) in enumerate(points)], OBS)


def box(spark, *rows):
    """(frame, det, track, class, score, x, y, dx, dy)"""
    return spark.createDataFrame([(f, d, t, c, float(s), float(x), float(y), 0.0, float(dx), float(dy), 1.5, 0.0) for f, d, t, c, s, x, y, dx, dy in rows], BOX)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_valid_box(spark):
    inf = float("inf")
    rows = [([0.0] * 3 + [1.0] * 3 + [0.0], True), ([0.0] * 3 + [1.0, 0.0, 1.0, 0.0], False), ([inf] + [0.0] * 2 + [1.0] * 3 + [0.0], False), ([0.0] * 6, False), (None, False)]
    d = spark.createDataFrame(rows, "box array<double>, ok boolean")
    assert all(r[0] == r[1] for r in d.select(boxes.valid(F.col("box")), "ok").collect())


def test_angles(spark):
    r = one(spark, angles.wrap(F.lit(math.pi)), angles.axis_turn(F.lit(0.1), F.lit(math.pi - 0.1)), angles.turn(F.lit(-3.0), F.lit(3.0)))
    assert r[0] == pytest.approx(-math.pi) and r[1] == pytest.approx(0.2) and r[2] == pytest.approx(2 * math.pi - 6)


def test_slerp_takes_the_shorter_arc(spark):
    half = math.sqrt(0.5)
    p, q = tuple(F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)), tuple(F.lit(v) for v in (0.0, 0.0, -half, -half))
    r = one(spark, *rotations.slerp(p, q, F.lit(0.5)))
    assert list(r) == pytest.approx([0, 0, math.sin(math.pi / 8), math.cos(math.pi / 8)])
    assert one(spark, *rotations.matrix(tuple(F.lit(0.0) for _ in range(4)))[0])[:] == (1.0, 0.0, 0.0)


def test_hard_filter_tells_all_reasons_and_the_first(spark):
    d = box(spark, (1, 0, 1, "Car", 0.9, 0, 0, 4, 2), (1, 1, 1, "Boat", 0.0, 90, 0, 4, 2), (1, 2, 1, "Car", 0.9, 0, 0, 0, 2), (1, 3, 1, "Pedestrian", 0.9, 30, 10, 1, 1))
    got = {r.det_idx: r for r in filters.hard_filtered(d, filters.HardFilter()).collect()}
    assert got[0].kept and got[1].reasons == ["score", "class_whitelist", "annotation_range"] and got[1].primary == "score"
    assert got[2].reasons == ["invalid_box"] and got[3].reasons == ["distant_pedestrian"]


def test_height_exactly_at_the_threshold_stays(spark):
    d = box(spark, (1, 0, 1, "Nmv", 1, 0, 0, 1, 1))
    assert filters.low_boxes_dropped(d, "Nmv", 1.5).count() == 1 and filters.low_boxes_dropped(d, "Nmv", 1.51).count() == 0


def test_short_tracks_go_at_the_threshold(spark):
    d = obs(spark, [(0, 0)] * 3).union(obs(spark, [(0, 0)] * 4, track=2))
    assert {r.track_id for r in filters.short_tracks_dropped(d, {"Car": 3}, 0).collect()} == {2}


def test_nearest_time_takes_the_earlier_of_two_as_near(spark):
    left = spark.createDataFrame([(1, 10), (1, 100), (2, 5)], "k long, t_us long")
    right = spark.createDataFrame([(1, 8), (1, 12), (1, 151)], "k long, t_us long")
    assert {(r.k, r.t_us): r.match_us for r in joins.nearest_in_time(left, right, "k", 50).collect()} == {(1, 10): 8, (1, 100): None, (2, 5): None}


def test_poses_are_blended_held_and_clamped(spark):
    poses = spark.createDataFrame([(1, 0, 0.0, 0.0), (1, 100, 10.0, 0.0), (1, 1000, 20.0, 0.0)], "k long, t_us long, px double, py double")
    stamps = spark.createDataFrame([(1, t) for t in (-5, 25, 100, 300, 700, 5000)], "k long, t_us long")
    assert [r.px for r in joins.interpolated(stamps, poses, "k", 600).orderBy("t_us").collect()] == [0.0, 2.5, 10.0, 10.0, 20.0, 20.0]


def test_refined_rows_come_back(spark):
    d = box(spark, (1, 0, 1, "Car", 0.1, 0, 0, 1, 1), (1, 1, 2, "Car", 0.1, 0, 0, 1, 1), (1, 2, 3, "Truck", 0.1, 0, 0, 1, 1))
    refined = spark.createDataFrame([(1, 1, 0, 0.5), (1, 1, 1, 0.7)], "frame_id long, track_id long, det_idx int, new_score double")
    assert {r.track_id: r.score for r in joins.merged_back(d, refined, "Car").collect()} == {1: 0.7, 3: 0.1}


def test_same_centre_groups_keep_one(spark):
    d = box(spark, (1, 0, 1, "Truck", 0.9, 0, 0, 4, 2), (1, 1, 2, "Car", 0.5, 0.3, 0, 4, 2), (1, 2, 3, "Car", 0.5, 0.6, 0, 4, 2), (1, 3, 4, "Car", 0.5, 9, 0, 4, 2), (2, 0, 3, "Car", 0.5, 0, 0, 4, 2))
    priority = F.when(F.col("class_name") == "Car", 0).otherwise(1)
    assert {(r.frame_id, r.det_idx) for r in joins.same_centre_kept(d, 0.35, priority).collect()} == {(1, 2), (1, 3), (2, 0)}


def test_cover_drops_in_one_frame_or_everywhere(spark):
    d = box(spark, (1, 0, 1, "Car", 1, 0, 0, 2, 2), (1, 1, 2, "Truck", 1, 0, 0, 2.2, 2), (2, 0, 1, "Car", 1, 9, 0, 2, 2))
    assert {(r.frame_id, r.det_idx) for r in joins.covered_in_frame_dropped(d, "Car", "Truck", 0.5).collect()} == {(1, 1), (2, 0)}
    assert {(r.frame_id, r.det_idx) for r in joins.overlapping_tracks_dropped(d, "Car", "Truck", 0.5).collect()} == {(1, 1)}
    assert joins.overlapping_tracks_dropped(d, "Car", "Truck", 0).count() == 3


def test_frame_sets_that_differ_are_told(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "frame_id long"), spark.createDataFrame([(2,), (3,)], "frame_id long")
    assert {tuple(r) for r in joins.frame_difference(a, b).collect()} == {(1, "left"), (3, "right")}


def test_motion_of_a_straight_track(spark):
    r = aggregates.motion_stats(obs(spark, [(0, 0), (3, 4), (6, 8)])).first()
    assert (r.n, r.duration, r.path, r.net, r.concentration, r.max_step, r.median_speed) == (3, 2.0, 10.0, 10.0, 1.0, 5.0, 5.0)
    assert aggregates.motion_stats(obs(spark, [(0, 0)])).count() == 0


def test_classes_of_tracks(spark):
    d = box(spark, (1, 0, 1, "Car", 0.2, 0, 0, 7, 2), (2, 0, 1, "Truck", 0.9, 0, 0, 7, 2), (1, 1, 2, "Car", 1, 0, 0, 7, 2), (1, 2, None, "Car", 1, 0, 0, 7, 2))
    assert {r.track_id: r.class_name for r in aggregates.majority_class(d.where("track_id = 1"), ("Car", "Truck")).collect()} == {1: "Truck"}
    assert {r.track_id: r.class_name for r in aggregates.size_class(d, 6, 3.5, 1.5).collect()} == {1: "Truck", 2: "Car", None: "Car"}
    assert {r.class_name for r in aggregates.large_cars_relabelled(d, 7).collect()} == {"Truck"}
    assert {r.class_name for r in aggregates.mixed_tracks_unified(d.where("track_id = 1"), "Truck", "Trailer").collect()} == {"Truck"}


def test_axis_has_period_pi(spark):
    d = spark.createDataFrame([(1, 0.1), (1, math.pi + 0.1), (1, 0.12), (1, 1.5)], "k long, a double")
    assert aggregates.axis_of(d, "k", F.col("a")).first().axis == pytest.approx(0.11, abs=0.03)


def test_weighted_quantile_is_linear_between_midpoints(spark):
    d = spark.createDataFrame([(1, 0.0, 1.0), (1, 10.0, 1.0), (1, 99.0, 0.0)], "k long, v double, w double")
    assert aggregates.weighted_quantile(d, "k", "v", F.col("w"), 0.5).first()["quantile"] == 5.0
    assert aggregates.weighted_quantile(d, "k", "v", F.col("w"), 0.9).first()["quantile"] == 10.0


def test_stops_and_holes(spark):
    d = obs(spark, [(0, 0), (5, 0), (5.1, 0), (5.2, 0), (9, 0), (9, 0)])
    assert [(r.start_us, r.end_us, round(r.mx, 3)) for r in windows.stop_intervals(d, 0.8, SECOND).orderBy("start_us").collect()] == [(SECOND, 3 * SECOND, 5.1), (4 * SECOND, 5 * SECOND, 9.0)]
    assert windows.explicit_stop(d, 0.3, SECOND).first().start_us == SECOND
    holes = windows.hole_runs(spark.createDataFrame([(1, 0), (1, 1), (1, 4), (1, 4)], "track_id long, frame long")).collect()
    assert [tuple(r) for r in holes] == [(1, 2, 3, 1, 4)]


def test_headings_and_velocities(spark):
    d = obs(spark, [(0, 0), (0, 1), (0, 2), (0, 2), (0, 2), (0, 2), (0, 2), (0, 2)])
    assert {round(r.heading, 4) for r in windows.regression_heading(d, 2, 0.1).collect()} == {round(math.pi / 2, 4)}
    v = windows.endpoint_velocity(d, 3).first()
    assert (v.vy0, v.vy1) == (1.0, 0.0)


def test_short_unknowns_are_filled(spark):
    states = [None, "go", None, None, "go", None, "stop", None, None, None]
    d = spark.createDataFrame([(i, 1, i * 10, s) for i, s in enumerate(states)], "event_id long, track_id long, t_us long, state string")
    assert [r.held for r in windows.filled(d, 10, 30).orderBy("t_us").collect()] == [None, "go", "go", "go", "go", "go", "stop", "stop", None, None]


def test_a_turn_back_is_found(spark):
    assert windows.first_break(obs(spark, [(0, 0), (1, 0), (2, 0), (1, 0)]), 99).first().break_at == 4


def test_readers(spark, tmp_path):
    frames = [{"frame_id": "100", "num_points": 0, "num_detections": 1, "detections": [{"class_name": "Car", "score": 0.9, "box_lidar": [0, 0, 0, 4.5, 2, 1.6, 0]}]}, {"frame_id": "200", "num_points": 0, "num_detections": 0, "detections": []}]
    (tmp_path / "d.json").write_text(json.dumps(frames))
    f = detections.frames(spark, str(tmp_path / "d.json"))
    assert f.count() == 2 and [tuple(r)[:4] for r in detections.detections(f).collect()] == [("100", 0, "Car", 0.9)]
    (tmp_path / "p.txt").write_text("1,0,0,0,0,0,0,1\nbad,line\n1,5,0,0,0,0,0,1,extra\n")
    assert [(r.ts_ns, r.x) for r in detections.poses(spark, str(tmp_path / "p.txt")).collect()] == [(1, 5.0)]
    (tmp_path / "c.bin").write_bytes(struct.pack("8f", *range(8)))
    assert sorted(tuple(r)[1:] for r in detections.points(spark, str(tmp_path / "c.bin")).collect()) == [(0, 1, 2), (4, 5, 6)]


def test_streams_agree_with_batches(spark, tmp_path):
    rows = [(i % 3, "Car", i / 10, i * 40) for i in range(30)]
    d = spark.createDataFrame(rows, "track_id long, class_name string, score double, s long").withColumn("ts", F.timestamp_seconds("s")).drop("s")
    d.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(d.schema).parquet(str(tmp_path / "in"))

    def rows_of(out, name):
        q = out.writeStream.format("memory").queryName(name).outputMode("complete" if name == "bins" else "append").start()
        q.processAllAvailable()
        q.stop()
        return sorted(tuple(r) for r in spark.table(name).collect())

    assert len(rows_of(online.filtered(stream, 1.0), "kept")) == 20
    assert rows_of(online.binned(stream, "5 minutes", "1 hour"), "bins") == sorted(tuple(r) for r in online.binned(d, "5 minutes", "1 hour").collect())
