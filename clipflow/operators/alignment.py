"""Rows of places and what is seen of them, matched without crossing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def aligned(n_seen: np.ndarray, n_slots: np.ndarray, group: np.ndarray, i: np.ndarray, j: np.ndarray, cost: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, i, j) of the matches of many small rows at once.

    Group g has n_seen[g] by n_slots[g] places in order, and the allowed pairs
    (i, j) with their costs.  In each, matches rise in both; there are as many
    as can be, and of as many the cheapest.  A table of all groups is filled
    place by place.
    """
    groups, rows, columns = len(n_seen), int(n_seen.max(initial=0)), int(n_slots.max(initial=0))
    price = np.full((groups, rows, columns), np.inf)
    np.minimum.at(price, (group, i, j), cost)
    count, total = np.zeros((groups, rows + 1, columns + 1), np.int64), np.zeros((groups, rows + 1, columns + 1))
    step = np.zeros((groups, rows + 1, columns + 1), np.int8)  # 0: what is seen is left out, 1: the slot is, 2: both match
    for a in range(1, rows + 1):
        for b in range(1, columns + 1):
            n, c, s = count[:, a - 1, b].copy(), total[:, a - 1, b].copy(), np.zeros(groups, np.int8)
            for k, (m, d) in enumerate(((count[:, a, b - 1], total[:, a, b - 1]), (count[:, a - 1, b - 1] + 1, total[:, a - 1, b - 1] + price[:, a - 1, b - 1])), 1):
                better = np.isfinite(d) & ((m > n) | ((m == n) & (d < c)))
                n[better], c[better], s[better] = m[better], d[better], k
            count[:, a, b], total[:, a, b], step[:, a, b] = n, c, s
    g, a, b, out = np.arange(groups), n_seen.copy(), n_slots.copy(), []
    while len(g):
        going = (a > 0) & (b > 0)
        g, a, b = g[going], a[going], b[going]
        s = step[g, a, b]
        out.append((g[s == 2], a[s == 2] - 1, b[s == 2] - 1))
        a, b = a - (s != 1), b - (s != 0)
    return tuple(np.concatenate(x) if out else np.zeros(0, np.int64) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3


def row_matches(pairs: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(*by, seen, slot, cost): the matches of each row (by) among its allowed pairs (*by, seen, seen_at, slot, slot_at, cost).

    Both sides are in the order of their places (then ids) along the row;
    matches don't cross, are as many as can be, and of as many the cheapest.
    The allowed pairs of one row, a frame's boxes by a row of slots, are one
    record; an Arrow batch of them is solved together.
    """
    side = lambda at, k: F.transform(F.sort_array(F.collect_set(F.struct(F.col(at).alias("at"), F.col(k).alias("id")))), lambda x: x["id"])
    rows = pairs.groupBy(*by).agg(side("seen_at", "seen").alias("_seen"), side("slot_at", "slot").alias("_slots"), F.collect_list(F.struct("seen", "slot", "cost")).alias("_pairs"))
    placed = rows.withColumn("_pairs", F.transform("_pairs", lambda p: F.struct((F.array_position("_seen", p["seen"]) - 1).alias("i"), (F.array_position("_slots", p["slot"]) - 1).alias("j"), p["cost"].cast("double").alias("cost"))))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, slots, pairs = (batch.column(k) for k in ("_seen", "_slots", "_pairs"))
            sizes = [np.diff(x.offsets.to_numpy()) for x in (seen, slots, pairs)]
            each = pairs.flatten()
            owner = np.repeat(np.arange(len(pairs)), sizes[2])
            i, j, cost = (each.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            # rows of about one size together, so that the table stays small
            kind = np.ceil(np.log2(np.maximum(sizes[0], 1))) * 64 + np.ceil(np.log2(np.maximum(sizes[1], 1)))
            for k in np.unique(kind):
                some = np.flatnonzero(kind == k)
                for first in range(0, len(some), 2048):
                    part = some[first : first + 2048]
                    new = np.full(len(pairs), -1)
                    new[part] = np.arange(len(part))
                    mine = new[owner] >= 0
                    g, a, b = aligned(sizes[0][part], sizes[1][part], new[owner[mine]], i[mine], j[mine], cost[mine])
                    price = {(o, x, y): c for o, x, y, c in zip(new[owner[mine]].tolist(), i[mine].tolist(), j[mine].tolist(), cost[mine].tolist(), strict=True)}
                    at = lambda x, n: x.flatten().take(pa.array(x.offsets.to_numpy()[part[g]] - x.offsets.to_numpy()[0] + n))
                    columns = [*(batch.column(c).take(pa.array(part[g])) for c in by), at(seen, a), at(slots, b), pa.array([price[x] for x in zip(g.tolist(), a.tolist(), b.tolist(), strict=True)], pa.float64())]
                    yield pa.RecordBatch.from_arrays(columns, [*by, "seen", "slot", "cost"])

    fields = ", ".join(f"`{c}` {pairs.schema[c].dataType.simpleString()}" for c in (*by, "seen", "slot"))
    return placed.mapInArrow(solve, f"{fields}, cost double")
