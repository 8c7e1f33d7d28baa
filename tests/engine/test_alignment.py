"""Matches of rows against trying every alignment."""

import itertools
import random

from clipflow.operators import alignment


def tried(pairs, n, m):
    """The most matches and the least cost of them, over all rising choices."""
    best = (0, 0.0)
    for k in range(1, min(n, m) + 1):
        for a in itertools.combinations(range(n), k):
            for b in itertools.combinations(range(m), k):
                if all((i, j) in pairs for i, j in zip(a, b, strict=True)):
                    best = min(best, (-k, sum(pairs[i, j] for i, j in zip(a, b, strict=True))))
    return best


def test_rows_of_up_to_six(spark):
    r = random.Random(9)
    groups, rows = {}, []
    for g in range(120):
        n, m = r.randrange(1, 7), r.randrange(1, 7)
        pairs = {(i, j): round(r.choice([0.5, r.random()]), 3) for i in range(n) for j in range(m) if r.random() < 0.6}
        groups[g] = (pairs, n, m)
        names = r.sample(range(1000), 12)  # ids say nothing about the order
        rows += [(g % 3, g, names[i], float(i), names[6 + j], float(j), c) for (i, j), c in pairs.items()]
    r.shuffle(rows)
    d = spark.createDataFrame(rows, "clip int, row long, seen long, seen_at double, slot long, slot_at double, cost double").repartition(3)
    at = {(x[1], x[2]): x[3] for x in rows} , {(x[1], x[4]): x[5] for x in rows}
    got = {}
    for x in alignment.row_matches(d, ("clip", "row")).collect():
        got.setdefault(x.row, []).append((at[0][x.row, x.seen], at[1][x.row, x.slot], x.cost))
    for g, (pairs, n, m) in groups.items():
        way = sorted(got.get(g, []))
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(way, way[1:], strict=False))
        assert all(pairs[int(i), int(j)] == c for i, j, c in way)
        k, cost = tried(pairs, n, m)
        assert len(way) == -k and abs(sum(c for *_, c in way) - cost) < 1e-9
    assert alignment.row_matches(d.limit(0), ("clip", "row")).count() == 0
