"""Boxes seen from above: centre x, y, extents dx, dy, and yaw, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Half extents count as this much at least.
LEAST_HALF = 0.5e-3


def valid(box: Column) -> Column:
    """Whether an array is a box: seven finite numbers or more, extents above 0."""
    finite = F.forall(F.slice(box, 1, 7), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    extents = F.forall(F.slice(box, 4, 3), lambda v: v > 0)
    return F.coalesce(F.when(F.size(box) >= 7, finite & extents), F.lit(False))


def overlap(a: Column, half_a: Column, b: Column, half_b: Column) -> Column:
    """The common length of two intervals given by centres and half lengths."""
    return F.greatest(F.lit(0.0), F.least(a + half_a, b + half_b) - F.greatest(a - half_a, b - half_b))


def aligned_intersection(p: dict[str, Column], q: dict[str, Column]) -> Column:
    """The common area of two boxes whose sides lie along the axes."""
    return overlap(p["x"], p["dx"] / 2, q["x"], q["dx"] / 2) * overlap(p["y"], p["dy"] / 2, q["y"], q["dy"] / 2)


def iou(intersection: Column, area_a: Column, area_b: Column) -> Column:
    union = area_a + area_b - intersection
    return F.when(union <= 1e-9, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), intersection / union)))


def corners(x: Column, y: Column, dx: Column, dy: Column, yaw: Column) -> Column:
    """The corners of an oriented box, counter-clockwise, as an array of (x, y)."""
    a, b = F.greatest(dx / 2, F.lit(LEAST_HALF)), F.greatest(dy / 2, F.lit(LEAST_HALF))
    c, s = F.cos(yaw), F.sin(yaw)
    at = lambda i, j: F.struct((x + i * a * c - j * b * s).alias("x"), (y + i * a * s + j * b * c).alias("y"))
    return F.array(at(1, 1), at(-1, 1), at(-1, -1), at(1, -1))


def area(polygon: Column) -> Column:
    """The area of a polygon by the shoelace sum; 0 for fewer than three corners."""
    after = F.concat(F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0))), F.slice(polygon, 1, 1))
    terms = F.zip_with(polygon, after, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
    return F.when(F.size(polygon) < 3, 0.0).otherwise(F.abs(F.aggregate(terms, F.lit(0.0), lambda t, v: t + v)) / 2)
