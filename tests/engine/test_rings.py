"""Rings of cell sets against walking them, and polygons against plain recursion."""

import math
import random

import pytest

from clipflow.operators import rings
from clipflow.operators.cells import key
from pyspark.sql import functions as F

AHEAD = ((1, 0), (0, 1), (-1, 0), (0, -1))


def walked(cells):
    """{ring: [(cell, direction)]} by walking each border with the set on the left, right turns first."""
    number = lambda c, d: ((c[0] + 2**20) * 2**21 + c[1] + 2**20) * 4 + d
    start = lambda c, d: (c[0] + (d in (1, 2)), c[1] + (d in (2, 3)))
    behind = ((0, -1), (1, 0), (0, 1), (-1, 0))
    edges = {(c, d) for c in cells for d in range(4) if (c[0] + behind[d][0], c[1] + behind[d][1]) not in cells}
    by_start = {}
    for c, d in edges:
        by_start.setdefault(start(c, d), {})[d] = (c, d)
    out = {}
    while edges:
        first = min(edges, key=lambda e: number(*e))
        ring, at = [], first
        while at in edges:
            edges.discard(at)
            ring.append(at)
            c, d = at
            x, y = start(c, d)
            ways = by_start[x + AHEAD[d][0], y + AHEAD[d][1]]
            at = next(ways[(d + turn) % 4] for turn in (3, 0, 1) if (d + turn) % 4 in ways)
        out[number(*first)] = ring
    return out


def disc(radius, hole, x=0, y=0):
    span = range(-radius, radius + 1)
    return {(i + x, j + y) for i in span for j in span if hole**2 <= i * i + j * j <= radius**2}


SETS = {
    1: disc(6, 3) | {(7, 7), (20, 20), (21, 21), (21, 19)},
    2: {(i, j) for i in range(12) for j in range(12) if random.Random(i * 12 + j).random() < 0.6},
    3: {(i, 0) for i in range(40)} | {(0, j) for j in range(-5, 5)},
    4: disc(9, 0, -30, -30) - disc(2, 0, -30, -30) | {(-30, -30)},
}


@pytest.fixture(scope="module")
def ranked(spark):
    rows = [(clip, *c) for clip, cells in SETS.items() for c in cells] * 2
    return rings.ranked(rings.border_edges(spark.createDataFrame(rows, "clip int, cx long, cy long"), ("clip",)), ("clip",)).cache()


def test_rings_follow_the_border(ranked):
    got = {}
    for e in ranked.orderBy("place").collect():
        got.setdefault((e.clip, e.ring), []).append(((e.cx, e.cy), e.dir))
    assert got == {(clip, ring): way for clip, cells in SETS.items() for ring, way in walked(cells).items()}


def test_areas_of_rings_sum_to_the_cells(ranked):
    m = rings.measured(ranked, ("clip",))
    areas = {r.clip: r.area for r in m.groupBy("clip").agg(F.sum("area").alias("area")).collect()}
    assert areas == {clip: len(cells) for clip, cells in SETS.items()}
    one = {(r.edges, r.corners, r.area, r.outline_area) for r in m.where("clip = 1").collect()}
    assert (20, 4, -25.0, -34.0) in one and (52, 36, 113.0, 96.0) in one and any(r[2] == 3 for r in one)


def by_recursion(points, tolerance):
    """The places kept of a closed ring of (place, x, y)."""
    far = lambda p: max(points, key=lambda q: (math.hypot(q[1] - p[1], q[2] - p[2]), -q[0]))
    a = far(points[0])
    b = far(a)
    lo, hi = sorted((points.index(a), points.index(b)))

    def off(q, p, r):
        dx, dy = r[1] - p[1], r[2] - p[2]
        return math.hypot(q[1] - p[1], q[2] - p[2]) if dx == dy == 0 else abs((q[1] - p[1]) * dy - (q[2] - p[2]) * dx) / math.hypot(dx, dy)

    def inner(stretch):
        ends = stretch[0], stretch[-1]
        some = [(off(q, *ends), -i) for i, q in enumerate(stretch)][1:-1]
        if not some or max(some)[0] <= tolerance:
            return []
        i = -max(some)[1]
        return [*inner(stretch[: i + 1]), stretch[i], *inner(stretch[i:])]

    kept = [points[lo], points[hi], *inner(points[lo : hi + 1]), *inner(points[hi:] + points[: lo + 1])]
    return sorted({p[0] for p in kept})


@pytest.mark.parametrize("tolerance", [0.6, 1.5])
def test_simplified_outlines(ranked, tolerance):
    m = rings.measured(ranked, ("clip",))
    o = rings.outlines(ranked, m, ("clip",))
    points = {}
    for p in o.orderBy("place").collect():
        points.setdefault((p.clip, p.ring), []).append((p.place, p.x, p.y))
    # each cell along an outer ring, without repeating the one before
    for (clip, ring), way in points.items():
        cells = [c for c, _ in walked(SETS[clip])[ring]]
        assert [(x - 0.5, y - 0.5) for _, x, y in way] == ([c for i, c in enumerate(cells) if c != cells[i - 1]] or cells[:1])
    got = {}
    for p in rings.simplified(o, tolerance, ("clip",)).orderBy("place").collect():
        got.setdefault((p.clip, p.ring), []).append(p.place)
    assert got == {k: by_recursion(way, tolerance) for k, way in points.items()}


def test_polygons_keep_large_rings_and_scale(ranked):
    m = rings.measured(ranked, ("clip",))
    p = rings.polygons(rings.simplified(rings.outlines(ranked, m, ("clip",), 90.0), 1.0, ("clip",)), 0.5, ("clip",), 100.0, 200.0)
    assert {r.clip for r in p.collect()} == {1, 2, 4}
    assert p.where("clip = 4").agg(F.min("x"), F.max("y")).first() == (100 - 19.25, 200 - 10.25)
    empty = ranked.where("false")
    assert rings.polygons(rings.simplified(rings.outlines(empty, rings.measured(empty, ("clip",)), ("clip",)), 1.0, ("clip",)), 1.0, ("clip",)).count() == 0


def test_cells_are_numbered_once(spark):
    rows = spark.createDataFrame([(-5, 7), (3, -2)], "cx long, cy long").select(key(F.col("cx"), F.col("cy")).alias("k")).distinct()
    assert rows.count() == 2
