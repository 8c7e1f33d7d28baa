"""Visible shares against filling every pixel of every hull."""

import math
import random

import numpy as np
import pytest

from clipflow.operators import visibility

BOX = "clip int, frame_id long, det int, x double, y double, z double, dx double, dy double, dz double, yaw double"
# camera x to the right, y down, z ahead along the boxes' y
FRONT = ([1.0, 0.0, 0.0, 0.2, 0.0, 0.0, -1.0, 1.0, 0.0, 1.0, 0.0, 2.0], [50.0, 40.0, 50.0, 30.0], [0.02, -0.01, 0.0, 0.0], 80, 60)
BACK = ([-1.0, 0.0, 0.0, 0.0, 0.0, 0.0, -1.0, 1.0, 0.0, -1.0, 0.0, 4.0], [30.0, 20.0, 30.0, 20.0], [0.0, 0.0, 0.0, 0.0], 40, 40)


def pixels(points, inside=None):
    """Grid places in the hull of integer points, by testing all half planes."""
    pts = sorted(set(points))
    us, vs = [p[0] for p in pts], [p[1] for p in pts]
    edges = [(p, q) for p in pts for q in pts if p != q and all((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]) >= 0 for r in pts)]
    return {(u, v) for u in range(min(us), max(us) + 1) for v in range(min(vs), max(vs) + 1) if all((q[0] - p[0]) * (v - p[1]) - (q[1] - p[1]) * (u - p[0]) >= 0 for p, q in edges)}, edges


def shares(boxes, camera, tolerance=0.3):
    t, k, d, w, h = camera
    t = np.array(t).reshape(3, 4)
    seen = []
    for _, _, _, x, y, z, dx, dy, dz, yaw in boxes:
        pts = []
        for i, j, m in ((i, j, m) for i in (-1, 1) for j in (-1, 1) for m in (-1, 1)):
            a, b = i * dx / 2, j * dy / 2
            p = t @ np.array([x + a * math.cos(yaw) - b * math.sin(yaw), y + a * math.sin(yaw) + b * math.cos(yaw), z + m * dz / 2, 1.0])
            r = math.hypot(p[0], p[1])
            th = math.atan2(r, p[2])
            bent = th * (1 + sum(c * th ** (2 * n + 2) for n, c in enumerate(d)))
            pts.append(None if p[2] <= 0.1 else (int(np.float32(k[0] * p[0] * bent / r + k[1])), int(np.float32(k[2] * p[1] * bent / r + k[3]))))
        seen.append(None if None in pts else (pts, (t @ np.array([x, y, z, 1.0]))[2]))
    filled = [None if s is None else pixels(s[0]) for s in seen]
    out = []
    for i, s in enumerate(seen):
        if s is None:
            out.append(None)
            continue
        hull, edges = filled[i]
        own, _ = pixels([(min(max(u, 0), w - 1), min(max(v, 0), h - 1)) for e in edges for u, v in e] or [(min(max(u, 0), w - 1), min(max(v, 0), h - 1)) for u, v in s[0]])
        over = set().union(*(f[0] for f, o in zip(filled, seen, strict=True) if f and o[1] <= s[1] - tolerance)) if any(filled) else set()
        out.append((len(own - over) / len(hull), len(own & over) / len(hull), (len(hull) - len(own)) / len(hull)))
    return out


@pytest.fixture(scope="module")
def scene(spark):
    r = random.Random(2)
    rows = [(c, f, i, r.uniform(-6, 6), r.uniform(2, 14), r.uniform(0, 2), r.uniform(0.5, 4), r.uniform(0.5, 2), r.uniform(0.5, 2), r.uniform(-3, 3)) for c in (0, 1) for f in (1, 2) for i in range(7)]
    cameras = [(c, n, p, *camera) for c in (0, 1) for n, p, camera in (("front", 0, FRONT), ("back", 1, BACK))]
    return rows, spark.createDataFrame(rows, BOX), spark.createDataFrame(cameras, "clip int, camera string, place int, t array<double>, k array<double>, d array<double>, width int, height int")


def test_shares_of_pixels(scene):
    rows, boxes, cameras = scene
    got = {(e.clip, e.frame_id, e.det, e.camera): (e.ratio, e.occluded, e.truncated) for e in visibility.in_cameras(boxes, cameras, ("clip",), ("frame_id", "det")).collect()}
    want = {}
    for clip in (0, 1):
        for frame in (1, 2):
            some = [x for x in rows if x[:2] == (clip, frame)]
            for name, camera in (("front", FRONT), ("back", BACK)):
                want |= {(clip, frame, x[2], name): s for x, s in zip(some, shares(some, camera), strict=True) if s}
    assert got.keys() == want.keys() and len(want) > 20 and any(s[1] > 0 for s in want.values()) and any(s[2] > 0 for s in want.values())
    for k, s in want.items():
        assert got[k] == pytest.approx(s), k


def test_best_camera_points_and_filter(spark, scene):
    _, _, cameras = scene
    rows = [(0, 1, 0, 0.0, 8.0, 1.0, 2.0, 2.0, 2.0, 0.0), (0, 1, 1, 0.0, 12.0, 1.0, 1.0, 1.0, 1.0, 0.0), (0, 1, 2, 0.0, -30.0, 1.0, 2.0, 2.0, 2.0, 0.0), (0, 1, 3, 0.0, 3.0, 1.0, -2.0, 2.0, 2.0, 0.0), (0, 1, 4, None, 3.0, 1.0, 2.0, 2.0, 2.0, 0.0)]
    boxes = spark.createDataFrame(rows, BOX)
    got = {r.det: r for r in visibility.finally_visible(boxes, cameras.where("camera = 'front'"), ("clip",), ("frame_id", "det")).collect()}
    assert got[0].tag == 1 and got[0].ratio == 1 and got[0].best_cam == "front"
    assert got[1].tag == 2 and got[1].occluded == 1  # behind the first
    assert (got[2].tag, got[2].ratio, got[2].truncated, got[2].best_cam) == (2, 0, 1, None)
    assert got[3].tag is None and got[4].tag is None  # not whole: as they are, hiding nothing
    points = spark.createDataFrame([(0, 1, 0.0, 8.0, z) for z in (0.0, 0.5, 1.2)], "clip int, frame_id long, px double, py double, pz double")
    spanned = {r.det: r for r in visibility.visible(boxes.where("det < 3"), cameras.where("camera = 'front'"), ("clip",), ("frame_id", "det"), points).collect()}
    assert spanned[0].occluded == pytest.approx(0.4) and spanned[0].ratio == pytest.approx(0.6)
    kept = visibility.finally_visible(boxes, cameras.where("camera = 'front'"), ("clip",), ("frame_id", "det"), 0.2)
    assert sorted(r.det for r in kept.collect()) == [0, 3, 4]


def test_points_meet_boxes_by_cells(spark):
    """The same counts whatever the cells, for boxes over many cells and points on borders."""
    from clipflow.operators import points as p

    r = random.Random(4)
    boxes = [(c, f, i, r.uniform(-20, 20), r.uniform(-20, 20), 0.0, r.choice([0.5, 4.0, 15.0]), 2.0, 4.0, r.uniform(-3, 3)) for c in (0, 1) for f in (1, 2) for i in range(10)]
    at = [(c, f, float(r.randrange(-22, 22)), float(r.randrange(-22, 22)), 0.5) for c in (0, 1) for f in (1, 2) for _ in range(300)]
    got = {(x.clip, x.frame_id, x.det): x.n_points for x in p.counted(spark.createDataFrame(boxes, BOX), spark.createDataFrame(at, "clip int, frame_id long, px double, py double, pz double"), ("clip", "frame_id", "det"), shared=2).collect()}

    def inside(b, q):
        dx, dy, c, s = q[2] - b[3], q[3] - b[4], math.cos(b[9]), math.sin(b[9])
        return b[:2] == q[:2] and abs(dx * c + dy * s) <= b[6] / 2 and abs(dy * c - dx * s) <= b[7] / 2

    assert got == {b[:3]: sum(inside(b, q) for q in at) for b in boxes}


def _written(spark, folder, rows):
    names = "l_orderkey long, l_linenumber int, l_suppkey long, l_returnflag string, l_discount double, l_quantity double, l_extendedprice double, l_tax double"
    spark.createDataFrame(rows, names).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_cameras_take_all_frames(spark, tmp_path):
    from clipflow.plans import visibility as plans

    sf = _written(spark, tmp_path, [(f, 1, 5, "A", 0.0, 25.0, 40000.0, 0.0) for f in range(7)])
    for found in (plans.camera_shares(spark, sf), plans.camera_visible(spark, sf)):
        assert {r.frame_id for r in found.collect()} == set(range(7))


def test_boxes_of_one_key_are_one_row_each(spark, tmp_path):
    from clipflow.plans import visibility as plans

    sf = _written(spark, tmp_path, [(f, n, 5, "A", 0.06, 25.0 + 4 * n, 40000.0, 0.0) for f in range(2) for n in (1, 2)])
    got = [(r.frame_id, r.id) for r in plans.camera_visible(spark, sf).collect()]
    assert sorted(got) == [(0, 10.0), (0, 10.0), (1, 10.0), (1, 10.0)]


def test_shares_are_rounded_as_in_the_sql(spark):
    d = spark.createDataFrame([(57 / 800,), (1 - 0.03125 - 0.55,), (0.0,), (None,), (-0.25,), (0.49999999999999994e-4,)], "v double")
    assert [r.v for r in d.select(visibility.halved_up("v", 4).alias("v")).collect()] == [0.0712, 0.4188, 0.0, None, -0.25, 0.0]
