"""Blocks of tracks and cells that meet once, whatever their size."""

import numpy as np
import pandas as pd

from clipflow.operators import matching, stitching
from clipflow.operators.groups import whole_groups


def test_groups_stay_whole():
    d = pd.DataFrame({"f": [1, 1, 2, 2, 2, 2, 3, 4, 4, 4], "i": range(10)})
    out = list(whole_groups((d[i : i + 3] for i in range(0, 10, 3)), ["f"]))
    assert [list(o.f.unique()) for o in out] == [[1], [2], [3], [4]] and list(pd.concat(out).i) == list(range(10))


def test_tracks_that_never_meet_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(stitching, "BLOCK", 3)
    r = np.random.default_rng(6)
    rows = [(k, int(f), float(x) + k % 3 * 0.1, float(y)) for k in range(60) for x, y in [r.uniform(-30, 30, 2)] for f in r.integers(0, 25, 4)] + [(99, None, 0.0, 0.0), (None, 3, 0.0, 0.0), (98, 2, None, 1.0)]
    d = spark.createDataFrame(rows, "track_id long, frame_id long, x double, y double")
    out = stitching.never_together(d, 12.0)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" in plan and "Join" not in plan.split("Repartition")[0]  # no pair is a row before it is a result
    p = pd.DataFrame(rows, columns=["t", "f", "x", "y"]).dropna(subset=["t"])
    m, frames = p.groupby("t")[["x", "y"]].median().dropna(), {t: set(g.dropna()) for t, g in p.groupby("t").f}
    want = {(a, b): np.sqrt((m.x[a] - m.x[b]) ** 2 + (m.y[a] - m.y[b]) ** 2) for a in m.index for b in m.index if a < b and not frames[a] & frames[b]}
    want = {k: v for k, v in want.items() if v <= 12}
    got = [tuple(q) for q in out.collect()]
    assert len(got) == len(want) > 50 and all(abs(want[a, b] - s) < 1e-12 for a, b, s in got) and any(99 in k for k in want)


def test_seeds_by_lines_and_by_pairs(spark, monkeypatch):
    """Counts about each row are those of all pairs, with many rows on a line and with none, and rows that share an id count as one."""
    r = np.random.default_rng(9)
    n = 900
    rows = [(k - k % 50 if k % 100 == 1 else k, int(f), int(f) * 7, "ab"[k % 2], float(x), float(y), float(w)) for k, (f, x, y, w) in enumerate(zip(r.integers(0, 60, n), r.integers(-2, 3, n) * 0.4, np.round(r.uniform(-3, 3, n), 1), r.integers(0, 6, n) * 0.6, strict=True))]
    p = pd.DataFrame(rows, columns=["event_id", "frame_id", "t_us", "class_name", "x", "y", "yaw"])
    want = {}
    for e, g in p.groupby("event_id"):
        near = np.zeros(n, bool)
        for a in g.itertuples():
            turn = np.fmod(np.abs(a.yaw - p.yaw), np.pi)
            near |= (p.class_name == a.class_name) & (np.sqrt((a.x - p.x) * (a.x - p.x) + (a.y - p.y) * (a.y - p.y)) <= 0.8) & (np.minimum(turn, np.pi - turn) <= np.pi / 6)
        want[e] = (p.frame_id[near].nunique(), int(p.t_us[near].max() - p.t_us[near].min()))
    want = {(e, *v) for e, v in want.items() if v[0] >= 9 and v[1] >= 100}
    assert {tuple(q) for q in matching.seeds(spark.createDataFrame(p), 0.8, 9, 100).collect()} == want
    # workers have their own modules, so both ways are asked here
    alone = p.drop_duplicates("event_id", keep=False)
    for line, other in ((1, "_pairs"), (10**6, "_around")):
        with monkeypatch.context() as m:
            m.setattr(matching, "LINE", line)
            m.setattr(matching, other, None)
            parts = pd.concat([matching._neighbours(g.assign(_own=g.event_id.isin(alone.event_id)), 0.8, np.pi / 6) for _, g in p.groupby("class_name")])
        assert {tuple(q) for q in parts[(parts.n_frames >= 9) & (parts.span_us >= 100)].itertuples(index=False)} == {w for w in want if w[0] in set(alone.event_id)}
    assert 100 < len(want) < n


def test_blocks_of_tracks_grow_with_their_cell(spark, monkeypatch):
    """A track is dealt no more often as its cell fills, and frames go along as numbers of four bytes."""
    monkeypatch.setattr(stitching, "BLOCK", 4)
    monkeypatch.setattr(stitching, "BLOCKS", 2, raising=False)
    dealt = {}
    for n in (40, 160):
        rows = [(k, 10_000_000_000 + (k * 7 + i * 13) % 97, k % 10 + 0.5, k % 7 + 0.5) for k in range(n) for i in range(3)]
        out = stitching.never_together(spark.createDataFrame(rows, "track_id long, frame_id long, x double, y double"), 20.0)
        frames = {k: {f for t, f, *_ in rows if t == k} for k in range(n)}
        assert sorted((r.a, r.b) for r in out.collect()) == [(a, b) for a in range(n) for b in range(a + 1, n) if not frames[a] & frames[b]]
        plan = out._jdf.queryExecution()
        met = plan.optimizedPlan().children().apply(0)  # what goes into the kernel
        dealt[n] = out.sparkSession._jvm.org.apache.spark.sql.classic.Dataset.ofRows(out.sparkSession._jsparkSession, met).count() / n
        assert "cast((lambda" in plan.optimizedPlan().toString() and "as int)" in plan.optimizedPlan().toString()
    assert dealt[160] <= dealt[40]
