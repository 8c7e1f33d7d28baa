"""Boxes and the points about them as arrays: whole frames at a time, in blocks of bounded size.

Boxes and points are dealt and sorted by frame once; pairs of a box and a point
never are rows.  A frame's points are held together, those of all frames never are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipflow.operators.visibility import _changes, _parts, _whole_frames

Columns = tuple[str, ...]
BOX = ("x", "y", "z", "dx", "dy", "dz", "yaw")
#: Pairs of a box and a point that the kernels hold at once, but for a single box of more.
HELD = 1 << 18


def percentile(ordered: np.ndarray, count: np.ndarray, share: float) -> np.ndarray:
    """The share's percentile of each row's first `count` values, which are in order, as Spark interpolates it."""
    at = (count - 1) * share
    low, high = np.floor(at), np.ceil(at)
    value = lambda k: np.take_along_axis(ordered, np.clip(k, 0, ordered.shape[1] - 1).astype(np.int64)[:, None], axis=1)[:, 0]
    with np.errstate(invalid="ignore"):
        return np.where(low == high, value(low), (high - at) * value(low) + (at - low) * value(high))


def blocks(count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(which, places, real): groups of neighbouring values, of `count` each, as rows of blocks of about one length; places past a group's end aren't real."""
    start = np.cumsum(count) - count
    order = np.argsort(-count, kind="stable")
    i = 0
    while i < len(order) and count[order[i]]:
        long = int(count[order[i]])
        which = order[i : i + max(1, HELD // long)]
        which = which[count[which] > 0]
        step = np.arange(long)
        real = step < count[which][:, None]
        yield which, np.where(real, start[which][:, None] + step, start[which][:, None]), real
        i += max(1, HELD // long)


def about(b: dict[str, np.ndarray], frame: np.ndarray, p: tuple[np.ndarray, ...], of: np.ndarray, margin: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(box, point, along, across): the points p (x, y, z) of a box's own frame that lie in it, taken larger by the margin to its sides, box by box.

    frame and of number the boxes' and the points' frames; points are in the order of frame and y.
    """
    reach = np.hypot(b["dx"], b["dy"]) / 2 + 1.5 * margin + 1e-9
    first, last = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int64)
    for f in np.unique(frame):
        own, (s, e) = frame == f, np.searchsorted(of, (f, f + 1))
        first[own] = s + np.searchsorted(p[1][s:e], (b["y"] - reach)[own], "left")
        last[own] = s + np.searchsorted(p[1][s:e], (b["y"] + reach)[own], "right")
    n = np.where(np.isfinite(reach + b["x"] + b["y"]), np.maximum(last - first, 0), 0)
    c, s = np.cos(b["yaw"]), np.sin(b["yaw"])
    for part in _parts(n, HELD):
        m = n[part]
        box = np.repeat(np.arange(part.start, part.stop), m)
        point = np.arange(len(box)) - np.repeat(np.cumsum(m) - m, m) + np.repeat(first[part], m)
        dx, dy = p[0][point] - b["x"][box], p[1][point] - b["y"][box]
        along, across = dx * c[box] + dy * s[box], dy * c[box] - dx * s[box]
        near = np.flatnonzero((np.abs(along) <= (b["dx"] / 2 + margin)[box]) & (np.abs(across) <= (b["dy"] / 2 + margin)[box]))
        yield box[near], point[near], along[near], across[near]


def by_frames(d: DataFrame, points: DataFrame, keys: Columns, shared: int, extra: Columns, kernel: Callable, schema: str) -> DataFrame:
    """The rows that kernel(boxes, frame, points, of) makes, as dicts of arrays with `_at`, the box of each, with the boxes' keys before them.

    Points of unknown place or frame are left out.
    """
    frame, kinds = list(keys[:shared]), dict(d.dtypes)
    numbers = [*BOX, *extra]
    own = d.select(*keys, *(F.col(c).cast("double") for c in numbers), F.lit(True).alias("_own"))
    place = {"x": "px", "y": "py", "z": "pz"}
    known = points.dropna(subset=[*frame, *place.values()])
    cloud = known.select(*frame, *(F.lit(0).cast(kinds[k]).alias(k) for k in keys[shared:]), *(F.col(place[c]).cast("double").alias(c) if c in place else F.lit(None).cast("double").alias(c) for c in numbers), F.lit(False).alias("_own"))
    dealt = own.unionByName(cloud).repartition(*frame).sortWithinPartitions(*frame)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _whole_frames(batches, frame):
            at, mine = _changes(g, frame), g["_own"].to_numpy(bool)
            if not mine.any():
                continue
            p = [g[c].to_numpy(float)[~mine] for c in "xyz"]
            order = np.lexsort((p[1], at[~mine]))
            boxes = g.loc[mine, list(keys)].reset_index(drop=True)
            for rows in kernel({c: g[c].to_numpy(float)[mine] for c in numbers}, at[mine], tuple(c[order] for c in p), at[~mine][order]):
                yield pd.concat([boxes.iloc[rows.pop("_at")].reset_index(drop=True), pd.DataFrame(rows)], axis=1)

    return dealt.mapInPandas(run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", {schema}")
