"""Kernels of arrays over whole frames: the same in blocks of any size, and no rows of pairs."""

import numpy as np

from clipflow.operators import fits, ragged
from tests.engine.test_fits import BOX, KEYS, POINT, ground_of, roof_of, scene


def test_percentiles_of_rows():
    r = np.random.default_rng(2)
    count = np.array([1, 2, 7, 30])
    v = np.sort(np.where(np.arange(30) < count[:, None], r.normal(size=(4, 30)), np.inf), axis=1)
    for share in (0.05, 0.5, 0.7, 0.95):
        assert np.allclose(ragged.percentile(v, count, share), [np.percentile(v[i, :n], 100 * share) for i, n in enumerate(count)])


def test_grounds_make_no_rows_of_pairs(spark):
    boxes, points = scene(3)
    d, p = spark.createDataFrame(boxes, BOX), spark.createDataFrame(points, POINT)
    out = fits.grounds(d, p, KEYS, shared=2)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    got = {tuple(r[k] for k in KEYS): r.ground for r in out.collect()}
    want = {b[:3]: ground_of(b, points) for b in boxes}
    assert got.keys() == want.keys() and any(v is not None for v in want.values())
    assert all((got[k] is None) == (v is None) and (v is None or abs(got[k] - v) < 1e-6) for k, v in want.items())


def _kernels(monkeypatch):
    made = []
    monkeypatch.setattr(fits.ragged, "by_frames", lambda d, points, keys, shared, extra, kernel, schema: made.append(kernel) or 1 / 0)
    for f in (fits.grounds, fits.roof_windows):
        try:
            f(None, None, KEYS, 2)
        except ZeroDivisionError:
            pass
    return made


def test_blocks_of_any_size(monkeypatch):
    boxes, points = scene(5)
    number = lambda r: r[0] * 10 + r[1]
    boxes.sort(key=number)
    points.sort(key=lambda q: (number(q), q[3]))
    b = {k: np.array([r[3 + i] if r[3 + i] is not None else np.nan for r in boxes], float) for i, k in enumerate((*ragged.BOX, "ground"))}
    frame, of = np.array([number(r) for r in boxes]), np.array([number(q) for q in points])
    p = tuple(np.array([q[i] for q in points]) for i in (2, 3, 4))
    for kernel in _kernels(monkeypatch):
        seen = []
        for held in (1 << 18, 300, 1):
            monkeypatch.setattr(ragged, "HELD", held)
            parts = list(kernel(b, frame, p, of))
            seen.append({k: np.concatenate([q[k] for q in parts]) for k in parts[0]})
        assert len(seen[0]["_at"]) > 3 and all(np.allclose(s[k], seen[0][k], 1e-9, 1e-9, equal_nan=True) for s in seen[1:] for k in s)


def test_roofs_make_no_rows_of_pairs(spark):
    boxes, points = scene(8)
    d, p = spark.createDataFrame(boxes, BOX), spark.createDataFrame(points, POINT)
    windows = fits.roof_windows(d, p, KEYS, shared=2)
    plan = windows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan
    got = {tuple(r[k] for k in KEYS): r.roof for r in fits.roofs(d, p, KEYS, shared=2).collect()}
    want = {b[:3]: roof_of(b, points) for b in boxes}
    assert all((got[k] is None) == (v is None) and (v is None or abs(got[k] - v) < 1e-6) for k, v in want.items()) and any(v is not None for v in want.values())


def test_unknown_frames_and_places(spark):
    """A box of no frame has no points, and points of no place are none."""
    boxes, points = scene(3)
    none = (0, None, 9, *boxes[0][3:])
    d, p = spark.createDataFrame([*boxes, none], BOX), spark.createDataFrame([*points, (0, 1, None, 1.0, 0.0), *((0, None, *q[2:]) for q in points[:200])], POINT)
    got = {tuple(r[k] for k in KEYS): r.ground for r in fits.grounds(d, p, KEYS, shared=2).collect()}
    assert len(got) == len(boxes) + 1 and got[none[:3]] is None
