"""Grounds, roofs and sides of boxes against the same in numpy, a box at a time."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipflow.operators import fits

BOX = "clip int, frame long, det int, x double, y double, z double, dx double, dy double, dz double, yaw double, ground double"
POINT = "clip int, frame long, px double, py double, pz double"
KEYS = ("clip", "frame", "det")


def scene(seed, slope=0.05):
    """Two clips of equal frames: each box on a sloping ground, with a body of points of its own kind."""
    r = random.Random(seed)
    boxes, points = [], []
    for clip in (0, 1):
        for frame in (1, 2):
            for det in range(4):
                x, y, yaw, dx, dy, dz = det * 12.0 + r.random(), r.random() * 5, r.uniform(-3, 3), 4.2, 1.8, 1.5
                level = lambda px, py, x=x: slope * (px - x)
                boxes.append((clip, frame, det, x, y, dz / 2 + 0.1, dx, dy, dz, yaw, 0.02 if det % 2 else None))
                c, s = math.cos(yaw), math.sin(yaw)
                for _ in range(r.choice([15, 120, 250])):
                    a, b = r.uniform(-3.4, 3.4), r.uniform(-2.2, 2.2)
                    px, py = x + a * c - b * s, y + a * s + b * c
                    points.append((clip, frame, px, py, level(px, py) + r.gauss(0, 0.02) + (r.random() < 0.1) * r.uniform(0, 1)))
                for _ in range(r.choice([0, 60, 200])):  # a body: its top, one side, or all of it
                    a, b, h = r.uniform(-1.9, 1.9), r.choice([-0.85, r.uniform(-0.8, 0.8)]), r.choice([1.45, r.uniform(0.2, 1.4)])
                    points.append((clip, frame, x + a * c - b * s, y + a * s + b * c, h + r.gauss(0, 0.01)))
    return boxes, points


def in_box(box, points):
    clip, frame, _, x, y, z, dx, dy, dz, yaw, ground = box
    p = np.array([q[2:] for q in points if q[:2] == (clip, frame)])
    c, s = math.cos(yaw), math.sin(yaw)
    return p, (p[:, 0] - x) * c + (p[:, 1] - y) * s, (p[:, 1] - y) * c - (p[:, 0] - x) * s


def ground_of(box, points):
    *_, x, y, z, dx, dy, dz, _, _ = box
    p, a, b = in_box(box, points)
    inside = (abs(a) <= dx / 2 + 0.18) & (abs(b) <= dy / 2 + 0.18)
    low = z - dz / 2
    q = p[(abs(a) <= dx / 2 + 1.2) & (abs(b) <= dy / 2 + 1.2) & ~inside & (p[:, 2] >= low - 0.75) & (p[:, 2] <= low + 0.45)]
    if len(q) < 18:
        return None
    h, first = np.percentile(q[:, 2], 70), q[:, 2].min()
    bins = np.floor((q[q[:, 2] <= h, 2] - first) / 0.06).astype(int)
    middle = first + (np.bincount(bins).argmax() + 0.5) * 0.06
    q = q if h - first < 0.04 else q[abs(q[:, 2] - middle) <= 0.12]
    if len(q) < 10:
        return None
    keep = np.ones(len(q), bool)
    for _ in range(3):
        if keep.sum() < 8:
            break
        design = np.column_stack((q[:, 0] - x, q[:, 1] - y, np.ones(len(q))))
        plane = np.linalg.lstsq(design[keep], q[keep, 2], rcond=None)[0]
        off = q[:, 2] - design @ plane
        mid = np.median(off[keep])
        keep = abs(off - mid) <= max(0.07, 3 * 1.4826 * np.median(abs(off[keep] - mid)))
    ok = keep.sum() >= 8 and math.hypot(*plane[:2]) <= 0.35 and abs(plane[2] - low) <= 0.75
    return plane[2] if ok else None


def patch(cells):
    """The size of the largest group of (i, j) that touch."""
    best, left = 0, set(cells)
    while left:
        group, front = set(), {left.pop()}
        while front:
            group |= front
            front = {c for c in left if any(abs(c[0] - f[0]) <= 1 and abs(c[1] - f[1]) <= 1 for f in front)}
            left -= front
        best = max(best, len(group))
    return best


def roof_of(box, points):
    *_, x, y, z, dx, dy, dz, _, ground = box
    p, a, b = in_box(box, points)
    bottom = ground if ground is not None else z - dz / 2
    top, hx, hy = max(z + dz / 2, bottom + dz) + 0.35, dx / 2 - 0.05, dy / 2 - 0.05
    m = (abs(a) <= hx) & (abs(b) <= hy) & (p[:, 2] >= bottom) & (p[:, 2] <= top)
    a, b, h = a[m], b[m], p[m, 2]
    if len(h) < 6:
        return None
    n = max(1, math.floor((top - bottom - 0.1) / 0.05) + 1)
    good = []
    for k in range(n):
        w = (h >= bottom + k * 0.05) & (h < bottom + k * 0.05 + 0.1)
        if w.sum() < 6:
            continue
        u, v = a[w], b[w]
        wide = np.percentile(u, 95) - np.percentile(u, 5) >= max(0.6, 0.28 * hx) and np.percentile(v, 95) - np.percentile(v, 5) >= max(0.25, 0.24 * hy)
        central = ((abs(u) <= 0.4 * hx) & (abs(v) <= 0.4 * hy)).sum() >= 2 and abs(np.median(u)) <= 0.35 * hx and abs(np.median(v)) <= 0.35 * hy
        cells = {(min(int((i + hx) / (2 * hx) * 6), 5), min(int((j + hy) / (2 * hy) * 4), 3)) for i, j in zip(u, v, strict=True)}
        if wide and central and patch(cells) >= 3:
            good.append((k, np.percentile(h[w], 95)))
    at = dict(good)
    ends = [k for k in at if k + 1 not in at and k - 1 in at and k + 1 < n]
    return at[max(ends)] if ends else None


def sides_of(box, points):
    *_, x, y, z, dx, dy, dz, _, ground = box
    p, a, b = in_box(box, points)
    bottom = ground if ground is not None else z - dz / 2 - 0.2
    m = (abs(a) <= dx / 2 + 0.22) & (abs(b) <= dy / 2 + 0.22) & (p[:, 2] >= bottom + 0.12) & (p[:, 2] <= max(z + dz / 2, bottom + dz) + 0.55)
    if m.sum() < 10:
        return dx, dy, "none", "none"
    out, modes = [], []
    for v, size, long in ((a[m], dx, dx >= dy), (b[m], dy, dy > dx)):
        lo, hi = np.percentile(v, 2), np.percentile(v, 98)
        band = min(max(0.12 * size, 0.18), 0.6)
        dense = len(v) / max(hi - lo, 1e-6)
        low, high = (n >= 8 and n >= 0.1 * len(v) and n / band >= 1.6 * dense for n in ((v <= lo + band).sum(), (v >= hi - band).sum()))
        pad, least = (0.15, min(3.2, size)) if long else (0.1, min(1.45, size))
        f, t = (max(-size / 2, lo - pad) if low else -size / 2), (min(size / 2, hi + pad) if high else size / 2)
        mode = "both" if low and high else "low" if low else "high" if high else "none"
        if t - f < least:
            if mode == "both":
                middle = (f + t) / 2
                f, t = max(-size / 2, middle - least / 2), min(size / 2, middle + least / 2)
                if t - f < least:
                    f, t, mode = -size / 2, size / 2, "none"
            else:
                f, t = (t - least, t) if mode == "low" else (f, f + least)
        out.append(t - f)
        modes.append(mode)
    return (*out, *modes)


@pytest.fixture(scope="module", params=[1, 2])
def both(request, spark):
    boxes, points = scene(request.param, 0.05 if request.param == 1 else 0.5)
    return boxes, points, spark.createDataFrame(boxes, BOX).repartition(3), spark.createDataFrame(points, POINT).repartition(3)


def test_grounds(both):
    boxes, points, b, p = both
    got = {(r.clip, r.frame, r.det): r.ground for r in fits.grounds(b, p, KEYS, 2).collect()}
    want = {x[:3]: ground_of(x, points) for x in boxes}
    assert {k: v is None for k, v in got.items()} == {k: v is None for k, v in want.items()}
    assert all(got[k] == pytest.approx(v, abs=1e-6) for k, v in want.items() if v is not None)


def test_roofs(both):
    boxes, points, b, p = both
    got = {(r.clip, r.frame, r.det): r.roof for r in fits.roofs(b, p, KEYS, 2).collect()}
    want = {x[:3]: roof_of(x, points) for x in boxes}
    assert got.keys() == want.keys() and any(v is not None for v in want.values())
    assert all(got[k] is None if v is None else got[k] == pytest.approx(v) for k, v in want.items())


def test_sides(both):
    boxes, points, b, p = both
    got = {(r.clip, r.frame, r.det): (r.dx, r.dy, r.mode_x, r.mode_y) for r in fits.shrunk(b, p, KEYS, 2).collect()}
    want = {x[:3]: sides_of(x, points) for x in boxes}
    assert {m for w in want.values() for m in w[2:]} > {"none"}
    for k, w in want.items():
        assert got[k][:2] == pytest.approx(w[:2]) and got[k][2:] == w[2:]
        assert got[k][0] <= 4.2 and got[k][1] <= 1.8  # never wider


def test_patches_of_cells(spark):
    r = random.Random(3)
    sets = [{(i, j) for i in range(6) for j in range(4) if r.random() < share} for share in (0.2, 0.35, 0.5, 0.8) for _ in range(12)] + [set(), {(0, 3), (1, 0)}, {(i, 0 if i % 2 else 1) for i in range(6)}]
    rows = spark.createDataFrame([(n, sum(1 << (4 * i + j) for i, j in cells)) for n, cells in enumerate(sets)], "n int, cells int")
    got = {x.n: x.size for x in rows.select("n", fits.largest_patch(F.col("cells")).alias("size")).collect()}
    assert got == {n: patch(cells) for n, cells in enumerate(sets)}


def test_no_points_and_points_on_a_line(spark):
    box = spark.createDataFrame([(0, 1, 0, 0.0, 0.0, 0.75, 4.0, 2.0, 1.5, 0.0, None)], BOX)
    none = spark.createDataFrame([], POINT)
    assert fits.grounds(box, none, KEYS, 2).first().ground is None and fits.roofs(box, none, KEYS, 2).first().roof is None
    assert fits.shrunk(box, none, KEYS, 2).first().mode_x == "none"
    line = spark.createDataFrame([(0, 1, 2.5 + 0.01 * i, 0.0, 0.0) for i in range(40)], POINT)
    assert fits.grounds(box, line, KEYS, 2).first().ground is None


def test_boxes_and_points_are_dealt_once(spark):
    from clipflow.operators.points import counted, finally_filtered
    from clipflow.plans.world import fit_top, points_in_boxes

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString() for query in (points_in_boxes, fit_top)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [plan.count("Exchange") for plan in plans] == [2, 2]
    # what is counted stays where its frame is, also of boxes that share a key, have none, or no place
    box = "frame_id long, det_idx int, x double, y double, z double, dx double, dy double, dz double, yaw double, name string"
    rows = [(1, 1, 0.0, 0.0, 0.0, 2.0, 2.0, 2.0, 0.0, "a"), (1, 1, 40.0, 40.0, 0.0, 2.0, 2.0, 2.0, 0.0, "b"), (1, None, 0.0, 0.0, 0.0, 2.0, 2.0, 2.0, 0.0, None), (None, 1, 0.0, 0.0, 0.0, 2.0, 2.0, 2.0, 0.0, "d"), (1, 2, None, 0.0, 0.0, 2.0, 2.0, 2.0, 0.0, "e")]
    at = [(1, 0.5, 0.5, 0.5), (1, 0.0, 0.0, -1.0), (1, 40.0, 40.9, 0.0), (1, None, 0.0, 0.0), (None, 0.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0)]
    got = counted(spark.createDataFrame(rows, box), spark.createDataFrame(at, "frame_id long, px double, py double, pz double"))
    assert {(r.name, r.n_points, r.low, r.high) for r in got.collect()} == {("a", 3, -1.0, 0.5), ("b", 3, -1.0, 0.5), (None, 0, None, None), ("d", 0, None, None), ("e", 0, None, None)}
    d = spark.createDataFrame([(t, f, n, c) for t, f, n, c in [(1, 1, 5, "Car"), (1, 1, 5, "Bus"), (1, 2, 5, "Car"), (1, None, 5, "Car"), (2, 1, 5, "Car"), (2, 1, 5, "Car"), (2, None, 5, "Car"), (3, 1, 5, "Car"), (3, 2, 1, "Car"), (None, 1, 5, "Car"), (None, 2, 5, "Car")]], "track_id int, frame_id int, n_points long, class_name string")
    final = finally_filtered(d, 1, 1, "Car")
    assert sorted((r.track_id, r.frame_id or 0) for r in final.collect()) == [(1, 0), (1, 1), (1, 2)]
