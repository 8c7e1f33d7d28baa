"""Work that grows with the input, and rows that share a key."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from clipflow.operators import cells, contracts, joins, overlap, points, signals, visibility, world
from clipflow.plans.visibility import _id


def test_boxes_are_in_few_cells(spark):
    d = spark.createDataFrame([(1, k, 0.37 * k, -0.71 * k, 0.0, 11.0, 2.6, 2.0, 0.3) for k in range(60)], "frame_id long, det_idx int, x double, y double, z double, dx double, dy double, dz double, yaw double")
    assert points.reached(d, F.hypot("dx", "dy") / 2, points.WIDE).count() <= 2.5 * 60
    p = d.select("frame_id", F.col("x").alias("px"), F.col("y").alias("py"), F.col("z").alias("pz"))
    met = d.join(p, "frame_id").where(points.inside()).groupBy("det_idx").count()
    plan = points.counted(d, p)
    assert {(r.det_idx, r.n_points) for r in plan.collect()} == {(r.det_idx, r["count"]) for r in met.collect()}
    assert f"/ {points.WIDE}" in plan._jdf.queryExecution().toString()


def test_sides_without_exceptall(spark):
    d = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b"), (3, "b"), (None, "a")], "frame_id int, s string")
    out = joins.frame_difference(d.where("s = 'a'"), d.where("s = 'b'"))
    assert {tuple(r) for r in out.collect()} == {(1, "left"), (3, "right"), (None, "left")}
    assert "ReplicateRows" not in out._jdf.queryExecution().optimizedPlan().toString() and "Except" not in out._jdf.queryExecution().analyzed().toString()


def test_rows_that_share_a_key(spark):
    b = spark.createDataFrame([(1, "Car", 1.0, 0.5), (1, "Car", 3.0, 0.1), (2, "Bus", 1.0, 1.0), (2, "Bus", 2.0, 1.0)], "k int, class_name string, dz double, yaw double")
    assert contracts.forbidden_changes(b, b, "k", {}).count() == 0
    a = b.withColumn("yaw", F.when(F.col("k") == 1, F.col("yaw") + 1).otherwise(F.col("yaw")))
    assert [tuple(r) for r in contracts.forbidden_changes(b, a, "k", {"Car": ("dz",)}).collect()] == [(1, "Car", "yaw")] * 2


def test_share_near_looks_at_near_cells_only(spark):
    d = spark.createDataFrame([(k % 7, k, (k * 37 % 101) / 7.0, (k * 53 % 97) / 5.0) for k in range(400)], "track_id long, event_id long, x double, y double")
    places = d.where("event_id % 9 = 0").unionByName(d.where("event_id = 0"))
    near = d.alias("a").crossJoin(places.select("x", "y").distinct().alias("b")).where("sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)) <= 0.8").select("a.event_id").distinct()
    want = d.join(near.withColumn("h", F.lit(1)), "event_id", "left").groupBy("track_id").agg(F.avg(F.coalesce("h", F.lit(0))).alias("share"))
    got = cells.share_near(d, places, 0.8)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    assert "LeftSemi" in got._jdf.queryExecution().optimizedPlan().toString()


def test_pixels_are_no_rows(spark):
    d = spark.createDataFrame([(0, 1, k % 4, 2.0 * k, 9.0 + k, 0.0, 3.0, 2.0, 1.5, 0.2 * k) for k in range(8)], "clip int, frame_id long, det int, x double, y double, z double, dx double, dy double, dz double, yaw double")
    cameras = spark.createDataFrame([(0, "front", 0, [1.0, 0.0, 0.0, 0.2, 0.0, 0.0, -1.0, 1.0, 0.0, 1.0, 0.0, 2.0], [50.0, 40.0, 50.0, 30.0], [0.02, -0.01, 0.0, 0.0], 80, 60)], "clip int, camera string, place int, t array<double>, k array<double>, d array<double>, width int, height int")
    e = visibility.in_cameras(d, cameras, ("clip",), ("frame_id", "det"), 2)
    assert "Generate" not in e._jdf.queryExecution().optimizedPlan().toString()
    got = e.collect()
    assert all(abs(r.ratio + r.occluded + r.truncated - 1) < 1e-9 for r in got) and len(got) == 8 and len({tuple(r) for r in got}) == 4  # boxes of one key count as one


def test_images_beyond_what_is_held(monkeypatch):
    r = np.random.default_rng(4)
    n = 60
    b = {k: r.uniform(*e, n) for k, e in {"x": (-6, 6), "y": (4, 20), "z": (-1, 1), "dx": (1, 5), "dy": (1, 3), "dz": (1, 2), "yaw": (0, 6)}.items()}
    b |= {k: np.full(n, v) for k, v in zip(visibility._T + visibility._K + visibility._D + ["width", "height"], [1, 0, 0, 0, 0, 0, -1, 1, 0, 1, 0, 2, 50, 40, 50, 30, 0.02, -0.01, 0, 0, 80, 60], strict=True)}
    image = np.repeat(np.arange(6), 10)
    want = visibility.shares(b, image, 1, 0.3)
    monkeypatch.setattr(visibility, "HELD", 500)
    assert all((p == q).all() for p, q in zip(visibility.shares(b, image, 1, 0.3), want, strict=True)) and want[3].sum() > 0


def test_frames_stay_whole():
    d = pd.DataFrame({"f": [1, 1, 2, 2, 2, 2, 3, 4, 4, 4], "i": range(10)})
    out = list(visibility._whole_frames((d[i : i + 3] for i in range(0, 10, 3)), ["f"]))
    assert [list(o.f.unique()) for o in out] and list(pd.concat(out).i) == list(range(10))
    assert sum(o.f.nunique() for o in out) == 4


def test_ids_are_rounded_as_by_the_sql(spark):
    d = spark.createDataFrame([(56264.5 / 1000 - 30,), (-9.1635,), (1.0,)], "id double")
    assert [r.id for r in d.select(_id()).collect()][0] == 26.265


def test_directions_over_several_heads(spark, monkeypatch):
    rows = [(k % 2, k, k, round((k * 0.731) % 6.28 - 3.14, 3), (k * 37 % 101) / 2.0, (k * 53 % 97) / 2.0) for k in range(120)]
    tracks = spark.createDataFrame(rows, "clip int, id long, place long, heading double, x double, y double")
    seen = []
    monkeypatch.setattr(signals, "HEAD", 4)
    monkeypatch.setattr(signals, "leaders", lambda nodes, covers, own=signals.leaders: (seen.append(nodes.count()), own(nodes, covers))[1])
    got = {r.id: r.leader for r in signals.directions(tracks, ("clip",), 0.6, 8.0).collect()}
    turned = lambda a, b: abs((a - b + np.pi) % (2 * np.pi) - np.pi)
    lead, want = [], {}
    for c, i, _, h, x, y in rows:
        want[i] = next((j for d, j, _, g, u, v in lead if d == c and turned(g, h) <= 0.6 and abs((x - u) * np.sin(g) - (y - v) * np.cos(g)) <= 8), i)
        if want[i] == i:
            lead.append((c, i, i, h, x, y))
    assert got == want
    assert seen[0] == 8 and len(seen) > 1  # leaders are sought among the first few, not among all


def test_halves_fall_where_the_sql_has_them():
    """The common area of a box within another, rounded term by term as the SQL does."""
    r = np.random.default_rng(7)
    n = 500
    x, y, dx = r.integers(-22, -16, n) + 0.0, np.round(r.uniform(-10, 50, n), 5), np.round(r.integers(2, 7, n) / 5 + 1, 6)
    inner = (x, y, dx, np.full(n, 1.2), np.full(n, 0.3))
    outer = (x, y + np.round(r.uniform(-0.1, 0.1, n), 5), dx * 3, np.full(n, 4.0), np.full(n, 2.1))
    got = overlap.common_area(inner, outer)
    for k in range(n):
        a, b, w, h, c, s = x[k], y[k], dx[k] / 2, 0.6, np.cos(0.3), np.sin(0.3)
        p = [(a + i * w * c - j * h * s, b + i * w * s + j * h * c) for i, j in ((1, 1), (-1, 1), (-1, -1), (1, -1))]
        mx, my = sum(u for u, _ in p) / 4, sum(v for _, v in p) / 4
        p = sorted(((u - mx, v - my) for u, v in p), key=lambda q: np.arctan2(q[1], q[0]))
        assert got[k] == abs(sum(u * q - v * o for (u, v), (o, q) in zip(p, p[1:] + p[:1], strict=True))) / 2

def test_poses_across_bins(spark):
    bins = world.BIN_US
    at = [0, 10, bins - 1, 5 * bins, 5 * bins + 7]
    poses = spark.createDataFrame([("c", t, float(i), 0.0, 0.0, 0.0, 0.0, 0.0, 1.0) for i, t in enumerate(at)], "clip string, t_us long, px double, py double, pz double, qx double, qy double, qz double, qw double")
    times = [-bins, 5, bins, 3 * bins, 5 * bins + 7, 9 * bins]
    d = world.posed(spark.createDataFrame([("c", t) for t in times], "clip string, t_us long"), poses, "clip", 100 * bins)
    want = np.interp(times, at, range(len(at)))
    assert np.allclose([r.px for r in d.orderBy("t_us").collect()], want)
