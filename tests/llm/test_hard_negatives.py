"""Hard negatives against all pairs, on odd vectors and on buckets so small that pruning matters."""

import math
import random

import numpy as np
import pytest

from llm import hard_negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, row string, shard string"


def brute(rows, every=5):
    some = [(i, [math.floor(256 * float(np.float32(x))) for x in e], y) for i, e, y, *_ in rows if i is not None and y is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for n, (i, v, y) in enumerate(some):
        if i % every:
            continue
        others = sorted((-score(v, w), j, z == y) for m, (j, w, z) in enumerate(some) if m != n)
        for s, p, _ in [x for x in others if x[2]][:5]:
            hard = [x for x in others if not x[2] and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, p, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(hard)]
    return sorted(out)


def vectors(n, seed, labels=4, dim=12):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(labels, dim))
    out = []
    for i in range(n):
        y = int(r.integers(labels)) if r.random() < 0.6 else 0
        v = (centres[y] + centres[0] + r.normal(size=dim)) * r.choice([0.1, 0.3, 1])
        out.append((i, [float(np.float32(x)) for x in v], y, "clash", "clash"))
    return out


@pytest.mark.parametrize(("shard", "bucket", "fan"), [(1 << 16, 4096, 100_000), (64, 16, 3)])
def test_all_pairs_agree(spark, monkeypatch, shard, bucket, fan):
    for name, value in (("SHARD", shard), ("BUCKET", bucket), ("FAN", fan)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vectors(500, 3)
    odd = [(500, None, 1), (505, [1.0, None], 1), (510, [float("nan")] * 12, 1), (515, [float("inf")] * 12, 0), (None, [1.0] * 12, 0), (520, [1.0] * 12, None), (525, [], 1), (530, [0.0] * 12, 2), (535, [2.0, 1.0], 1), (540, [-3.0] * 12, 3)]
    same = [(545 + i, rows[7][1], i % 4, "", "") for i in range(40)]  # ties
    rows += [(*x, "", "") for x in odd] + same + [rows[10], rows[10]]
    random.Random(1).shuffle(rows)
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(tuple(x) for x in hard_negatives.mined(d, F.col("vec_id") % 5 == 0).collect())
    assert got == brute(rows)


def test_empty_tables_and_lone_labels(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mined(none, F.col("vec_id") % 5 == 0).count() == 0
    one = spark.createDataFrame([(i, [1.0, 2.0], 0, "", "") for i in range(6)], SCHEMA)
    assert hard_negatives.mined(one, F.col("vec_id") % 5 == 0).count() == 0


def test_feasible_ranges_hold_every_row_that_reaches_the_score():
    r = np.random.default_rng(4)
    v = np.floor(r.normal(size=(400, 16)) * 100).astype(np.int64)
    b = hard_negatives.Bucket(v, np.arange(400), np.arange(400))
    pruned = 0
    for _ in range(50):
        q = np.floor(r.normal(size=16) * 100).astype(np.int64)
        scores, focus = v @ q, np.argsort(-np.abs(q))[:6]
        for share in (0.5, 0.7, 0.95):
            least = int(share * np.linalg.norm(q) * b.length)
            at = b.feasible(q, float(np.linalg.norm(q)), focus, least)
            assert at is None or set(np.flatnonzero(scores >= least)) <= set(at)
            pruned += at is not None
    assert pruned > 50


def test_scores_beyond_doubles_are_exact():
    v = np.array([[1 << 30, 3], [1, 2]], np.int64)
    assert hard_negatives.exact_scores(v, np.array([1 << 30, 1], np.int64)).tolist() == [(1 << 60) + 3, (1 << 30) + 2]
    with pytest.raises(OverflowError):
        hard_negatives.exact_scores(v, np.array([1 << 40, 1], np.int64))
