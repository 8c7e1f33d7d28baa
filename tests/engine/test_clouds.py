"""Fused clouds against numpy matrices."""

import math

import numpy as np
import pytest

from clipflow.operators import clouds

POINT = "clip int, sensor string, t_us long, px double, py double, pz double, intensity double"


def rigid(yaw, roll, *place):
    c, s, d, e = math.cos(yaw), math.sin(yaw), math.cos(roll), math.sin(roll)
    m = np.eye(4)
    m[:3, :3] = np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]]) @ np.array([[1, 0, 0], [0, d, -e], [0, e, d]])
    m[:3, 3] = place
    return m


def pose(m, yaw, roll):
    a, b = yaw / 2, roll / 2
    q = (math.cos(a) * math.sin(b), math.sin(a) * math.sin(b), math.sin(a) * math.cos(b), math.cos(a) * math.cos(b))
    return (*map(float, m[:3, 3]), *q)


def test_fused_frames(spark):
    bases = {"top": rigid(0.1, 0.02, 0.5, 0, 2), "front": rigid(1.4, 0.1, 2, 0.3, 1), "rear": rigid(-2.0, 0, -2, 0, 1)}
    world = {0: (0.3, 0.05), 100_000: (0.5, 0.1)}
    w = {t: rigid(*a, 10.0 + t / 50_000, 5.0, 0.0) for t, a in world.items()}
    poses = spark.createDataFrame([(1, t, *pose(w[t], *world[t])) for t in w], "clip int, t_us long, px double, py double, pz double, qx double, qy double, qz double, qw double")
    ext = spark.createDataFrame([(c, k, [float(x) for x in m[:3].ravel()]) for c in (1, 2) for k, m in bases.items()], "clip int, sensor string, base array<double>")
    # front is seen at the later pose's time, 100 ms off; rear 300 ms off; clip 2 has no poses
    rows = [(c, "top", 0, 1.0, 2.0, 3.0, 0.5) for c in (1, 2)] + [(c, "front", 100_000, 4.0, -1.0, 0.5, 0.7) for c in (1, 2)] + [(1, "front", -150_000, 9.0, 9.0, 9.0, 0.1), (1, "rear", 300_000, 1.0, 1.0, 1.0, 0.2)]
    got = {(r.clip, r.sensor): r for r in clouds.fused(spark.createDataFrame(rows, POINT), ext, poses, "clip", "top", 150_000, 600_000).collect()}
    assert set(got) == {(1, "top"), (2, "top"), (1, "front"), (2, "front")} and all(r.t_us == 0 for r in got.values())
    assert (got[1, "top"].px, got[1, "top"].py, got[1, "top"].pz) == (1.0, 2.0, 3.0) and got[1, "front"].intensity == 0.7
    still = np.linalg.inv(bases["top"]) @ bases["front"]
    went = np.linalg.inv(w[0]) @ w[100_000] @ still
    for clip, m in ((1, went), (2, still)):
        r = got[clip, "front"]
        assert (r.px, r.py, r.pz) == pytest.approx(tuple((m @ [4.0, -1.0, 0.5, 1.0])[:3]))


def test_no_reference_frames(spark):
    none = spark.createDataFrame([(1, "front", 0, 1.0, 1.0, 1.0, 0.0)], POINT)
    ext = spark.createDataFrame([(1, k, [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0]) for k in ("top", "front")], "clip int, sensor string, base array<double>")
    poses = spark.createDataFrame([], "clip int, t_us long, px double, py double, pz double, qx double, qy double, qz double, qw double")
    assert clouds.fused(none, ext, poses, "clip", "top", 50_000, 600_000).count() == 0
