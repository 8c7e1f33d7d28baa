"""Overlap, groups, regions, states and streams on rows whose results are known."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipflow.operators import cells, contracts, groups, joins, overlap, points, shapes, signals, sorting, stitching, windows, world
from clipflow.streaming import online

BOX = "frame_id long, det_idx int, track_id long, class_name string, score double, n_points int, x double, y double, z double, dx double, dy double, dz double, yaw double"
SECOND = 1_000_000


def box(spark, *rows):
    """(frame, det, track, class, points, x, y, dx, dy, yaw)"""
    return spark.createDataFrame([(f, d, t, c, 0.5, n, float(x), float(y), 0.0, float(dx), float(dy), 1.5, float(yaw)) for f, d, t, c, n, x, y, dx, dy, yaw in rows], BOX)


def obs(spark, points):
    return spark.createDataFrame([(i, 1, i * SECOND, float(x), float(y)) for i, (x, y) in enumerate(points)], "event_id long, track_id long, t_us long, x double, y double")


def test_common_area_against_sampling():
    r = np.random.default_rng(0)
    p, q = (tuple(r.uniform(lo, hi, 40) for lo, hi in ((-1, 1), (-1, 1), (0.5, 4), (0.5, 3), (-4, 4))) for _ in range(2))
    at = r.uniform(-5, 5, (200_000, 2))

    def inside(b, k):
        dx, dy = at[:, 0] - b[0][k], at[:, 1] - b[1][k]
        c, s = math.cos(b[4][k]), math.sin(b[4][k])
        return (abs(dx * c + dy * s) <= b[2][k] / 2) & (abs(dy * c - dx * s) <= b[3][k] / 2)

    sampled = [100 * (inside(p, k) & inside(q, k)).mean() for k in range(40)]
    assert overlap.common_area(p, q) == pytest.approx(sampled, abs=0.15)
    same = tuple(np.array([v]) for v in (1.0, 2.0, 4.0, 2.0, 0.7))
    assert overlap.common_area(same, same) == pytest.approx([8.0])


def test_what_overlaps_decide(spark):
    d = box(spark, (1, 1, 7, "Car", 9, 0, 0, 4, 2, 0), (1, 2, 8, "Truck", 3, 0.1, 0, 4, 2, 0), (2, 1, 7, "Car", 9, 20, 0, 4, 2, 0), (2, 2, 9, "Car", 5, 50, 0, 4, 2, 0))
    assert overlap.matched_tracks_dropped(d, "Car", "Truck", 0.5).count() == 2
    assert overlap.matched_tracks_dropped(d, "Car", "Truck", 0.0).count() == 4
    assert overlap.covered_boxes_dropped(d, "Car", "Truck", 0.5).count() == 3
    assert {r.class_name for r in overlap.absorbed(d, "Car", "Truck", 0.8).collect()} == {"Car"}
    assert {r.track_id: r.kept_id for r in overlap.same_objects(d).collect()} == {7: 7, 8: 7}
    assert sorted(r.det_idx for r in overlap.fewer_points_dropped(d, 0.02).where("frame_id = 1").collect()) == [1]
    assert overlap.overlaps(d.where("false"), d).count() == 0


def test_groups_match_a_search(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1100)]
    parent = {n: n for pair in links for n in pair}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {x.node: x.root for x in groups.linked_groups(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: find(n) for a, b in links for n in (a, b) if a != b}


def test_same_centre_keeps_the_best(spark):
    d = box(spark, (1, 1, 7, "Truck", 0, 0, 0, 4, 2, 0), (1, 2, 8, "Car", 0, 0.3, 0, 4, 2, 0), (1, 3, 9, "Car", 0, 0.6, 0, 4, 2, 0), (2, 1, 9, "Car", 0, 0, 0, 4, 2, 0))
    priority = F.when(F.col("class_name") == "Car", 0).otherwise(1)
    assert sorted((r.frame_id, r.det_idx) for r in joins.same_centre_kept(d, 0.35, priority).collect()) == [(1, 3), (2, 1)]


def test_points_on_the_border_count(spark):
    d = box(spark, (1, 1, 7, "Car", 0, 0, 0, 4, 2, math.pi / 2)).drop("n_points")
    cloud = spark.createDataFrame([(1, 1.0, 2.0, 0.75), (1, 1.01, 0.0, 0.0), (2, 0.0, 0.0, 0.0)], "frame_id long, px double, py double, pz double")
    r = points.counted(d, cloud).first()
    assert (r.n_points, r.low, r.high) == (1, 0.75, 0.75)
    assert points.counted(d, cloud.where("false")).first().n_points == 0


def test_world_and_back(spark):
    poses = spark.createDataFrame([(1, 0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0), (1, 1000, 10.0, 0.0, 0.0, 0.0, 0.0, 2.0, 0.0)], "clip long, t_us long, px double, py double, pz double, qx double, qy double, qz double, qw double")
    d = spark.createDataFrame([(1, 500, 1.0, 0.0, 0.0, 0.0), (1, 5000, 1.0, 0.0, 0.0, 0.0), (2, 0, 1.0, 0.0, 0.0, 0.0)], "clip long, t_us long, x double, y double, z double, yaw double")
    got = {r.t_us: r for r in world.in_world(world.posed(d, poses, "clip", 10_000)).collect()}
    assert len(got) == 2  # a clip without poses has no place
    assert (got[500].wx, got[500].wy, got[500].wyaw) == pytest.approx((5.0, 1.0, math.pi / 2))
    assert (got[5000].wx, got[5000].wy) == pytest.approx((9.0, 0.0))
    held = world.posed(d.where("t_us = 500 AND clip = 1"), poses, "clip", 100).first()
    assert held.px == 0.0  # a long gap keeps the earlier pose


def test_long_boxes_are_split(spark):
    d = box(spark, (1, 1, 7, "Truck", 0, 0, 0, 26, 2, 0), (1, 2, 8, "Truck", 0, 0, 50, 21, 2, 0), (1, 3, 9, "Truck", 0, 0, 90, 20, 2, 0))
    got = sorted((r.track_id, r.dx, r.x) for r in shapes.long_boxes_split(d, 20.0, 17.0).collect())
    assert got == [(7, 17.0, 4.5), (8, 17.0, 2.0), (9, 20.0, 0.0), (10, 9.0, -8.5), (11, 4.0, -8.5)]


def test_cells_close_and_hang_together(spark):
    c = spark.createDataFrame([(0, 0), (2, 0), (9, 9), (10, 10)], "cx long, cy long")
    ring = {(i, j) for i in range(3) for j in range(3)}
    gap = spark.createDataFrame(sorted(ring - {(1, 1)}), "cx long, cy long")
    assert {(r.cx, r.cy) for r in cells.closed(gap, 1).collect()} == ring
    sizes = sorted(r.n for r in cells.components(c, 1).groupBy("root").agg(F.count("*").alias("n")).collect())
    assert sizes == [1, 1, 2]
    square = F.array(*(F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 4), (0, 4))))
    at = lambda x, y: cells.in_polygon(square, F.lit(float(x)), F.lit(float(y)))
    assert list(spark.range(1).select(at(2, 2), at(4, 1), at(0, 0), at(5, 2), at(-1, 4)).first()) == [True, True, True, False, False]


def test_numbers_avoid_used_ones(spark):
    d = spark.createDataFrame([(k,) for k in (30, 10, 20, 10, None)], "k long")
    used = spark.createDataFrame([(6,), (1,)], "new_id long")
    assert {r.k: r.new_id for r in sorting.dense_ids(d, "k", 5, used).collect()} == {10: 5, 20: 7, 30: 8}
    labels = spark.createDataFrame([(1, 0, 0, 5), (1, 1, 0, 5), (1, 1, 1, 5), (2, 0, 0, 5)], "frame_id long, chain int, place int, obj_id long")
    assert sorted(r.new_id for r in sorting.chains_merged(labels, 900_000).collect()) == [5, 5, 900_000, 900_001]


def test_states_switch_late_and_creeping_counts(spark):
    d = spark.createDataFrame([(1, i, s) for i, s in enumerate("aabaabbbb")], "k long, bin long, state string")
    assert "".join(r.steady for r in signals.hysteresis(d, "k", 3).orderBy("bin").collect()) == "aaaaaaabb"
    creep = obs(spark, [(0.4 * i, 0) for i in range(12)]).withColumn("ahead", F.col("x"))
    assert [r.event_id for r in signals.crossings(creep, 2.0, 2 * SECOND, 1.0, 0.5).collect()] == [6, 11]


def test_greedy_matching_takes_the_best_first(spark):
    r = random.Random(5)
    pairs = [(a, 100 + b, round(r.random(), 6)) for a in range(12) for b in range(12) if r.random() < 0.5]
    want, left, right = set(), set(), set()
    for a, b, s in sorted(pairs, key=lambda p: p[2]):
        if a not in left and b not in right:
            want.add((a, b))
            left.add(a)
            right.add(b)
    assert {(x.a, x.b) for x in stitching.greedily_matched(spark.createDataFrame(pairs, "a long, b long, score double")).collect()} == want


def test_windows_of_motion(spark):
    d = obs(spark, [(0, 0), (0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, 0)])
    first = windows.steady_windows(d, 4, 2.5, 0.5, 0.9, 3, 2 * SECOND).first()
    assert (first.event_id, first.path) == (1, 3.0)
    levels = spark.createDataFrame([(i, 1, i * SECOND, v) for i, v in enumerate([0.0, 0.1, 5.0, 0.2, 5.1, 5.2, 0.3])], "event_id long, track_id long, t_us long, z double")
    assert [round(r.level, 3) for r in windows.repaired_levels(levels, "z", 3, 1.0).orderBy("event_id").collect()] == [0.0, 0.1, 0.15, 0.2, 0.233, 0.267, 0.3]


def test_contracts_tell_breaches(spark):
    a = spark.createDataFrame([(1, "Car", 1.0, 0.0), (2, "Truck", 1.0, 0.0)], "k long, class_name string, dz double, yaw double")
    b = a.withColumn("yaw", F.lit(1.0))
    assert contracts.changed_besides(a, b, ("yaw",)).count() == 0 and contracts.changed_besides(a, b, ()).count() == 4
    assert [tuple(r) for r in contracts.forbidden_changes(a, b, "k", {"Car": ("yaw",)}).collect()] == [(2, "Truck", "yaw")]
    assert contracts.frozen_broken(a, b, ("k",), F.col("class_name") == "Car").count() == 1


def test_streams_follow_tracks(spark, tmp_path):
    rows = [(1, s) for s in (0, 1, 2, 10, 11)] + [(2, 5)] + [(2, 5)]
    d = spark.createDataFrame(rows, "track_id long, s long").withColumn("ts", F.timestamp_seconds(F.col("s") + 3600)).withColumn("class_name", F.lit("Car")).drop("s")
    d.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(d.schema).parquet(str(tmp_path / "in"))

    def rows_of(out, name, mode="append"):
        q = out.writeStream.format("memory").queryName(name).outputMode(mode).start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name).collect()

    got = sorted((r.track_id, r.ts.second, r.started.second, r.n, r.late) for r in rows_of(online.followed(stream, 3.0, "1 minute"), "followed"))
    assert got == [(1, 0, 0, 1, False), (1, 1, 0, 2, False), (1, 2, 0, 3, False), (1, 10, 10, 1, False), (1, 11, 10, 2, False), (2, 5, 5, 1, False), (2, 5, 5, 2, False)]
    assert len(rows_of(online.once(stream, ("track_id", "ts"), "1 minute"), "once")) == 6
    smooth = lambda x: sorted(tuple(r) for r in x)
    assert smooth(rows_of(online.smoothed(stream, "4 seconds", "2 seconds", "1 minute"), "smooth", "complete")) == smooth(online.smoothed(d, "4 seconds", "2 seconds", "1 minute").collect())
    assert len(rows_of(online.segments(stream, "3 seconds", "1 second"), "segments")) >= 1
