"""Regions of slots against linking all pairs and splitting one region after the other."""

import math
import random

import numpy as np
import pytest

from clipflow.operators import parking

RULES = parking.Parking(most_slots=12, most_extent=20.0)


def one_by_one(slots):
    """slots {id: (clip, x, y, dx, dy, yaw)}: the sets of ids of the regions."""
    root = {i: i for i in slots}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    turned = lambda a, b: min((a - b) % math.pi, math.pi - (a - b) % math.pi)
    far = lambda s, w: abs(math.cos(w - s[5])) * (s[3] / 2 + 0.3) + abs(math.sin(w - s[5])) * (s[4] / 2 + 0.3)
    for i, a in slots.items():
        for j, b in slots.items():
            if i < j and a[0] == b[0]:
                d, w = math.hypot(b[1] - a[1], b[2] - a[2]), math.atan2(b[2] - a[2], b[1] - a[1])
                alike = turned(a[5], b[5]) <= 0.8 and math.hypot(a[3] - b[3], a[4] - b[4]) / max(math.hypot(*a[3:5]), math.hypot(*b[3:5]), 1.0) <= 0.6
                if d <= 1e-6 or (alike and d - far(a, w) - far(b, w) <= 1.0):
                    root[find(j)] = find(i)
    groups = {}
    for i in slots:
        groups.setdefault(find(i), []).append(i)

    def split(ids):
        n = len(ids)
        if n < 8:
            return [ids]
        yaws = np.array([slots[i][5] for i in ids])
        m = math.atan2(np.median(np.sin(2 * yaws)), np.median(np.cos(2 * yaws))) / 2
        m = min((m, m + math.pi / 2), key=lambda c: round(sum(turned(y, c) for y in yaws), 6))
        at = np.array([slots[i][1:3] for i in ids])
        axes = [at[:, 1] * math.cos(m) - at[:, 0] * math.sin(m), at[:, 0] * math.cos(m) + at[:, 1] * math.sin(m)]
        extents = [float(np.ptp(v)) for v in axes]
        if n <= RULES.most_slots and max(extents) <= RULES.most_extent:
            return [ids]
        cuts = []
        for k, v in enumerate(axes):
            s = np.sort(v)
            cuts += [(s[i + 1] - s[i], -k, -i, (s[i] + s[i + 1]) / 2) for i in range(3, n - 4) if s[i + 1] - s[i] >= 4.5]
        if cuts:
            _, k, _, cut = max(cuts)
            v = axes[-k]
        else:
            v = axes[0] if extents[0] >= extents[1] else axes[1]
            s, i = np.sort(v), min(max(n // 2, 4), n - 4)
            cut = (s[i - 1] + s[i]) / 2
        low, high = [i for i, x in zip(ids, v, strict=True) if x <= cut], [i for i, x in zip(ids, v, strict=True) if x > cut]
        return split(low) + split(high) if min(len(low), len(high)) >= 4 else [ids]

    return sorted(sorted(part) for ids in groups.values() for part in split(ids))


@pytest.mark.parametrize("seed", [1, 2])
def test_regions(spark, seed):
    r = random.Random(seed)
    slots = {}
    for clip in (0, 1):
        for row in range(5):
            yaw, x, y = r.uniform(-1.5, 1.5), r.uniform(-60, 60), r.uniform(-60, 60)
            step = r.choice([2.6, 2.9])
            for k in range(r.choice([3, 7, 17, 30])):
                if r.random() < 0.85:
                    a = yaw + math.pi / 2
                    slots[len(slots)] = (clip, x + k * step * math.cos(a) + r.gauss(0, 0.1), y + k * step * math.sin(a) + r.gauss(0, 0.1), r.uniform(4, 5), r.uniform(1.7, 2), yaw + r.gauss(0, 0.05) + r.choice([0, math.pi]))
    slots[len(slots)] = slots[0]  # two of one place
    d = spark.createDataFrame([(i, *s) for i, s in slots.items()], "id long, clip int, x double, y double, dx double, dy double, yaw double").repartition(3)
    placed = parking.regions(d, ("clip",), RULES)
    got = {}
    for x in placed.collect():
        got.setdefault(x.region, []).append(x.id)
    want = one_by_one(slots)
    assert sorted(sorted(v) for v in got.values()) == want and max(map(len, want)) > 4
    boxes = parking.rectangles(d, placed, RULES).collect()
    assert sorted(b.n for b in boxes) == sorted(len(w) for w in want if len(w) >= 4)
    for b in boxes:  # every slot's middle lies well inside its rectangle
        for i in got[b.region]:
            u, v = slots[i][1] - b.x, slots[i][2] - b.y
            assert abs(u * math.cos(b.heading) + v * math.sin(b.heading)) < b.along / 2 and abs(v * math.cos(b.heading) - u * math.sin(b.heading)) < b.across / 2


def test_no_slots(spark):
    none = spark.createDataFrame([], "id long, clip int, x double, y double, dx double, dy double, yaw double")
    placed = parking.regions(none, ("clip",))
    assert placed.count() == 0 and parking.rectangles(none, placed).count() == 0
