"""Ground, roof and sides of boxes from the points about them.

For grounds and roofs, boxes and points are dealt by frame, and kernels of arrays
take whole frames.  For sides, points meet boxes by frame and cell; after that
everything of a box is in one partition, where windows over the box's own points
give percentiles without another shuffle.  keys name a box, the first `shared`
of them are the points' too (a frame, or a clip and a frame).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipflow.operators import ragged
from clipflow.operators.points import local, near_points

Columns = tuple[str, ...]
BOX = ragged.BOX


def about(d: DataFrame, points: DataFrame, keys: Columns, shared: int, margin: float, extra: Columns = ()) -> DataFrame:
    """Boxes (keys, box, extra) with each point (px, py, pz) near them, its place in the box's frame (along, across), all of a box in one partition."""
    frame = list(keys[:shared])
    met = near_points(d.select(*keys, *BOX, *extra), points.select(*frame, "px", "py", "pz"), frame, F.hypot("dx", "dy") / 2 + 1.5 * margin)
    along, across = local(F.col("px"), F.col("py"), F.col("x"), F.col("y"), F.col("yaw"))
    near = met.withColumns({"along": along, "across": across}).where((F.abs("along") <= F.col("dx") / 2 + margin) & (F.abs("across") <= F.col("dy") / 2 + margin))
    return near.repartition(*keys)


@dataclass(frozen=True)
class Ground:
    inner: float = 0.18
    outer: float = 1.20
    below: float = 0.75
    above: float = 0.45
    least: int = 18
    slope: float = 0.35


#: Height of a histogram's bin, what lies about its middle, least residual, points of a plane, and rounds of trimming.
BIN, ABOUT, TRIM, PLANE, ROUNDS = 0.06, 0.12, 0.07, 8, 3


def _planes(u: np.ndarray, v: np.ndarray, q: np.ndarray, keep: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Slopes along both axes and the height at the centre that fit each row's kept points least squares; nan where they lie on a line."""
    with np.errstate(divide="ignore", invalid="ignore"):
        k = {"u": np.where(keep, u, 0.0), "v": np.where(keep, v, 0.0), "z": np.where(keep, q, 0.0)}
        s = {a: c.sum(axis=1) for a, c in k.items()}
        uu, uv, vv, uz, vz = (np.einsum("ij,ij->i", k[a], k[b]) - s[a] * s[b] / n for a, b in ("uu", "uv", "vv", "uz", "vz"))
        det = uu * vv - uv * uv
        fits = (n >= PLANE) & (det > 1e-9 * uu * vv)
        a, b = np.where(fits, (uz * vv - vz * uv) / det, np.nan), np.where(fits, (vz * uu - uz * uv) / det, np.nan)
        return a, b, (s["z"] - a * s["u"] - b * s["v"]) / n


def _trimmed(z: np.ndarray, dz: np.ndarray, u: np.ndarray, v: np.ndarray, h: np.ndarray, real: np.ndarray, config: Ground) -> tuple[np.ndarray, np.ndarray]:
    """The ground (nan where there is none) and the number of its points, -1 where too few tell it, for boxes whose rings' real points are the rows of u, v and h."""
    n = real.sum(axis=1)
    ordered = np.sort(np.where(real, h, np.inf), axis=1)
    low, high = ordered[:, :1], ragged.percentile(ordered, n, 0.7)[:, None]
    under = real & (h <= high)
    bins = np.where(under, np.floor((h - low) / BIN), 0).astype(np.int64)
    wide = int(bins.max()) + 1
    full = np.bincount((np.arange(len(n))[:, None] * wide + bins)[under], minlength=len(n) * wide).reshape(-1, wide)
    middle = low + (full.argmax(axis=1) + 0.5)[:, None] * BIN
    real = real & ((high - low < 0.04) | (np.abs(h - middle) <= ABOUT))
    told = real.sum(axis=1) >= max(10, config.least // 2)
    q, keep = h - z[:, None], real
    a, b, c = (np.full(len(n), np.nan) for _ in range(3))
    for _ in range(ROUNDS):
        kept = keep.sum(axis=1)
        # with too few points left, the plane and the points of the round before stay
        more = kept >= PLANE
        a, b, c = (np.where(more, new, old) for new, old in zip(_planes(u, v, q, keep, kept), (a, b, c), strict=True))
        off = q - a[:, None] * u - b[:, None] * v - c[:, None]
        median = lambda x: ragged.percentile(np.sort(np.where(keep, x, np.inf), axis=1), kept, 0.5)  # noqa: B023, E731
        with np.errstate(invalid="ignore"):
            off -= median(off)[:, None]
            np.abs(off, out=off)
            keep = np.where(more[:, None], real & (off <= np.maximum(TRIM, 3 * 1.4826 * median(off))[:, None]), keep)
    kept = keep.sum(axis=1)
    with np.errstate(invalid="ignore"):
        good = (kept >= PLANE) & (np.hypot(a, b) <= config.slope) & (np.abs(c + dz / 2) <= config.below)
    return np.where(good & told, z + c, np.nan), np.where(told, kept, -1)


def grounds(d: DataFrame, points: DataFrame, keys: Columns, shared: int = 1, config: Ground = Ground()) -> DataFrame:
    """(keys, ground, n_ground): the height of the ground below each box's centre, null where points don't tell it.

    Points in a ring around the box and near its bottom; of their lower 70 % the
    fullest bin of 6 cm (of equal ones the lowest) chooses the surface, and a
    plane is fitted to what is near, three times, each time without residuals
    beyond three median deviations.  Steep planes and those far from the box's
    bottom don't count, nor do points that lie on a line.
    """
    def kernel(b, frame, p, of):
        ground, number = np.full(len(frame), np.nan), np.full(len(frame), -1)
        bottom = b["z"] - b["dz"] / 2
        for box, point, along, across in ragged.about(b, frame, p, of, config.outer):
            inside = (np.abs(along) <= (b["dx"] / 2 + config.inner)[box]) & (np.abs(across) <= (b["dy"] / 2 + config.inner)[box])
            h = p[2][point]
            ring = np.flatnonzero(~inside & (h >= (bottom - config.below)[box]) & (h <= (bottom + config.above)[box]))
            box, point = box[ring], point[ring]
            whose, count = np.unique(box, return_counts=True)
            enough = count >= config.least
            kept = np.repeat(enough, count)
            whose, count, point = whose[enough], count[enough], point[kept]
            for which, at, real in ragged.blocks(count):
                w, at = whose[which], point[at]
                ground[w], number[w] = _trimmed(b["z"][w], b["dz"][w], p[0][at] - b["x"][w][:, None], p[1][at] - b["y"][w][:, None], p[2][at], real, config)
        yield {"_at": np.arange(len(frame)), "ground": ground, "n_ground": number}

    found = ragged.by_frames(d, points, keys, shared, (), kernel, "ground double, n_ground long")
    return found.select(*keys, F.when(~F.isnan("ground"), F.col("ground")).alias("ground"), F.when(F.col("n_ground") >= 0, F.col("n_ground")).alias("n_ground"))


@dataclass(frozen=True)
class Roof:
    least: int = 6
    inset: float = 0.05
    step: float = 0.05
    height: float = 0.10
    above: float = 0.35
    run: int = 2
    gap: float = 0.05
    long_span: float = 0.60
    short_span: float = 0.25
    long_ratio: float = 0.14
    short_ratio: float = 0.12
    centre: float = 0.40
    centroid: float = 0.35
    in_centre: int = 2
    cells: int = 3
    connected: int = 3


#: A footprint's cells along its long and its short side; cell (i, j) is bit SHORT * i + j.
LONG, SHORT = 6, 4


def _bit(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), k)


def _spread(cells: Column) -> Column:
    """Cells and their eight neighbours."""
    column = lambda js: F.lit(sum(1 << (SHORT * i + j) for i in range(LONG) for j in js))
    wide = cells.bitwiseOR(F.shiftleft(cells.bitwiseAND(column(range(SHORT - 1))), 1)).bitwiseOR(F.shiftright(cells.bitwiseAND(column(range(1, SHORT))), 1))
    return wide.bitwiseOR(F.shiftleft(wide, SHORT)).bitwiseOR(F.shiftright(wide, SHORT))


def largest_patch(cells: Column) -> Column:
    """The size of the largest group of set cells that touch, corners included."""
    steps = F.sequence(F.lit(1), F.lit(LONG * SHORT // 2))
    patch = lambda k: F.aggregate(steps, _bit(k).bitwiseAND(cells), lambda m, _: _spread(m).bitwiseAND(cells))
    seeds = F.filter(F.sequence(F.lit(0), F.lit(LONG * SHORT - 1)), lambda k: cells.bitwiseAND(_bit(k)) != 0)
    return F.coalesce(F.array_max(F.transform(seeds, lambda k: F.bit_count(patch(k)))), F.lit(0))


def roof_windows(d: DataFrame, points: DataFrame, keys: Columns, shared: int = 1, config: Roof = Roof()) -> DataFrame:
    """(keys, window, n_windows, support, top): the windows of each box, from its bottom up, whose points make a roof's patch.

    d has `ground`, where known, besides the box.  Windows overlap; a patch is
    wide along both sides, about the footprint's middle, and of cells that touch.
    `top` is the 95th percentile of the window's heights.
    """
    c = config

    def kernel(b, frame, p, of):
        bottom = np.where(np.isnan(b["ground"]), b["z"] - b["dz"] / 2, b["ground"])
        top = np.maximum(b["z"] + b["dz"] / 2, bottom + b["dz"]) + c.above
        hx, hy = (np.maximum(b[k] / 2 - c.inset, 0.05) for k in ("dx", "dy"))
        long = b["dx"] >= b["dy"]
        hl, hs = np.where(long, hx, hy), np.where(long, hy, hx)
        windows = np.maximum(1, np.nan_to_num(np.floor((top - bottom - c.height) / c.step)).astype(np.int64) + 1)
        for box, point, along, across in ragged.about(b, frame, p, of, 0.0):
            h = p[2][point]
            crop = np.flatnonzero((np.abs(along) <= hx[box]) & (np.abs(across) <= hy[box]) & (h >= bottom[box]) & (h <= top[box]))
            crop = crop[(np.bincount(box[crop], minlength=len(frame)) >= c.least)[box[crop]]]
            box, h, along, across = box[crop], h[crop], along[crop], across[crop]
            l, s = np.where(long[box], along, across), np.where(long[box], across, along)
            last = np.floor((h - bottom[box]) / c.step).astype(np.int64) + 1
            rows, seen = [], []
            for back in range(int(c.height / c.step) + 3):
                start = bottom[box] + (last - back) * c.step
                one = np.flatnonzero((last >= back) & (last - back < windows[box]) & (h >= start) & (h < start + c.height))
                rows.append(one)
                seen.append(last[one] - back)
            row, window = np.concatenate(rows), np.concatenate(seen)
            order = np.lexsort((window, box[row]))
            row, window = row[order], window[order]
            new = np.flatnonzero(np.diff(box[row], prepend=-1).astype(bool) | np.diff(window, prepend=-1).astype(bool))
            support = np.diff(np.append(new, len(row)))
            enough = support >= c.least
            kept = np.repeat(enough, support)
            row, window, support = row[kept], window[new[enough]], support[enough]
            if not len(support):
                continue
            new = np.cumsum(support) - support
            w = box[row[new]]
            cell = lambda v, half, bins: np.clip(np.floor((v + half) / np.maximum(2 * half, 1e-6) * bins), 0, bins - 1).astype(np.int64)
            whose = box[row]
            cells = np.bitwise_or.reduceat(1 << (cell(l[row], hl[whose], LONG) * SHORT + cell(s[row], hs[whose], SHORT)), new)
            middle = (np.abs(l[row]) <= np.maximum(hl[whose] * c.centre, 1e-6)) & (np.abs(s[row]) <= np.maximum(hs[whose] * c.centre, 1e-6))
            some, tops = np.add.reduceat(middle.astype(np.int64), new) >= c.in_centre, np.zeros(len(support))
            for which, at, real in ragged.blocks(support):
                ordered = lambda v: np.sort(np.where(real, v[row[at]], np.inf), axis=1)  # noqa: B023, E731
                n, lo, so = support[which], ordered(l), ordered(s)
                share = lambda v, k: ragged.percentile(v, n, k)  # noqa: B023, E731
                half_l, half_s = hl[w[which]], hs[w[which]]
                # the whole size of a side is its half, the inset left out, twice
                wide = (share(lo, 0.95) - share(lo, 0.05) >= np.maximum(c.long_span, c.long_ratio * 2 * half_l)) & (share(so, 0.95) - share(so, 0.05) >= np.maximum(c.short_span, c.short_ratio * 2 * half_s))
                central = (np.abs(share(lo, 0.5)) <= np.maximum(half_l * c.centroid, 1e-6)) & (np.abs(share(so, 0.5)) <= np.maximum(half_s * c.centroid, 1e-6))
                some[which] &= wide & central
                tops[which] = share(ordered(h), 0.95)
            yield {"_at": w[some], "window": window[some], "n_windows": windows[w][some], "support": support[some], "top": tops[some], "_cells": cells[some].astype(np.int32)}

    some = ragged.by_frames(d, points, keys, shared, ("ground",), kernel, "window long, n_windows long, support long, top double, _cells int")
    return some.where((F.bit_count("_cells") >= c.cells) & (largest_patch(F.col("_cells")) >= c.connected)).select(*keys, "window", "n_windows", "support", "top")


def roofs(d: DataFrame, points: DataFrame, keys: Columns, shared: int = 1, config: Roof = Roof()) -> DataFrame:
    """(keys, roof, n_roof): the roof of each box, null where there is none.

    The highest run of neighbouring windows, of two or more, that ends below a
    gap inside the searched heights; its last window's 95th percentile.
    """
    gap = max(1, math.ceil(config.gap / config.step - 1e-9))
    windows = roof_windows(d, points, keys, shared, config)
    order = W.partitionBy(*keys).orderBy("window")
    w = windows.withColumn("_run", F.col("window") - F.row_number().over(order)).withColumn("_next", F.lead("window").over(order))
    ends = w.withColumn("_size", F.count("*").over(W.partitionBy(*keys, "_run"))).where((F.col("_next").isNull() | (F.col("_next") > F.col("window") + gap)) & (F.col("_size") >= config.run) & (F.col("window") + gap < F.col("n_windows")))
    best = ends.groupBy(*keys).agg(F.max(F.struct("window", "top", "support")).alias("_b")).select(*keys, F.col("_b.top").alias("roof"), F.col("_b.support").alias("n_roof"))
    return d.select(*keys).join(best, list(keys), "left")


@dataclass(frozen=True)
class Sides:
    crop: float = 0.22
    least: int = 10
    above: float = 0.55
    band_ratio: float = 0.12
    band_least: float = 0.18
    band_most: float = 0.60
    face_least: int = 8
    face_ratio: float = 0.10
    density: float = 1.60
    pad_long: float = 0.15
    pad_short: float = 0.10
    extent_long: float = 3.20
    extent_short: float = 1.45


def shrunk(d: DataFrame, points: DataFrame, keys: Columns, shared: int = 1, config: Sides = Sides()) -> DataFrame:
    """d (with `ground`, where known) with x, y, dx, dy fitted, and mode_x, mode_y: which faces of each axis the points show.

    A face shows where a band below the 2nd or above the 98th percentile is
    denser than the whole; a face that shows moves in to its percentile and a
    pad, the others stay.  No face ever moves out, and a side keeps a least
    extent (or its own, if less).  Boxes of few points stay as they are.
    """
    c = config
    bottom = F.coalesce("ground", F.col("z") - F.col("dz") / 2 - 0.20)
    top = F.greatest(F.col("z") + F.col("dz") / 2, bottom + F.col("dz")) + c.above
    box = W.partitionBy(*keys)
    n = about(d, points, keys, shared, c.crop, ("ground",)).where(F.col("pz").between(bottom + 0.12, top))
    axes = {"x": "along", "y": "across"}
    n = n.withColumns({f"_{e}{a}": F.percentile(v, F.lit(q)).over(box) for a, v in axes.items() for e, q in (("lo", 0.02), ("hi", 0.98))})
    band = {a: F.least(F.greatest(F.col(f"d{a}") * c.band_ratio, F.lit(c.band_least)), F.lit(c.band_most)) for a in axes}
    counts = [F.sum((F.col(v) <= F.col(f"_lo{a}") + band[a]).cast("long")).alias(f"_below{a}") for a, v in axes.items()] + [F.sum((F.col(v) >= F.col(f"_hi{a}") - band[a]).cast("long")).alias(f"_over{a}") for a, v in axes.items()]
    g = n.groupBy(*keys).agg(F.count("*").alias("_n"), *(F.first(f"_{e}{a}").alias(f"_{e}{a}") for a in axes for e in ("lo", "hi")), *counts).where(F.col("_n") >= c.least)
    e = d.join(g, list(keys), "left")
    for a, other in (("x", "y"), ("y", "x")):
        size = F.col(f"d{a}")
        long = size >= F.col(f"d{other}") if a == "x" else size > F.col(f"d{other}")
        pad = F.when(long, c.pad_long).otherwise(c.pad_short)
        whole = F.col("_n") / F.greatest(F.col(f"_hi{a}") - F.col(f"_lo{a}"), F.lit(1e-6))
        shows = lambda k, whole=whole, a=a: F.coalesce((F.col(k) >= c.face_least) & (F.col(k) >= F.col("_n") * c.face_ratio) & (F.col(k) / band[a] >= c.density * whole), F.lit(False))
        low, high = shows(f"_below{a}"), shows(f"_over{a}")
        e = e.withColumn(f"mode_{a}", F.when(low & high, "both").when(low, "low").when(high, "high").otherwise("none"))
        e = e.withColumn("_l", F.when(low, F.greatest(-size / 2, F.col(f"_lo{a}") - pad)).otherwise(-size / 2)).withColumn("_h", F.when(high, F.least(size / 2, F.col(f"_hi{a}") + pad)).otherwise(size / 2))
        least = F.least(F.when(long, c.extent_long).otherwise(c.extent_short), size)
        mode, middle = F.col(f"mode_{a}"), (F.col("_l") + F.col("_h")) / 2
        slim = F.col("_h") - F.col("_l") < least
        wide_l, wide_h = F.greatest(-size / 2, middle - least / 2), F.least(size / 2, middle + least / 2)
        cut = slim & (mode == "both") & (wide_h - wide_l < least)  # against a side of the box: as it was
        new_l = F.when(~slim, F.col("_l")).when(cut, -size / 2).when(mode == "both", wide_l).when(mode == "low", F.col("_h") - least).otherwise(F.col("_l"))
        new_h = F.when(~slim, F.col("_h")).when(cut, size / 2).when(mode == "both", wide_h).when(mode == "low", F.col("_h")).otherwise(F.col("_l") + least)
        e = e.withColumns({f"_f{a}": new_l, f"_t{a}": new_h, f"mode_{a}": F.when(cut, "none").otherwise(mode)})
    cx, cy = ((F.col(f"_f{a}") + F.col(f"_t{a}")) / 2 for a in "xy")
    cos, sin = F.cos("yaw"), F.sin("yaw")
    new = {"x": F.col("x") + cx * cos - cy * sin, "y": F.col("y") + cx * sin + cy * cos, **{f"d{a}": F.greatest(F.col(f"_t{a}") - F.col(f"_f{a}"), F.lit(1e-6)) for a in "xy"}}
    return e.withColumns(new).select(*d.columns, "mode_x", "mode_y")
