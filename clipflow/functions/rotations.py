"""Quaternions (x, y, z, w) and rigid transforms, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

Quaternion = tuple[Column, Column, Column, Column]


def dot(p: Quaternion, q: Quaternion) -> Column:
    return sum((a * b for a, b in zip(p[1:], q[1:], strict=True)), p[0] * q[0])


def matrix(q: Quaternion) -> list[list[Column]]:
    """The 3x3 rotation of a quaternion of any length; a vanishing one gives the identity."""
    norm = F.sqrt(dot(q, q))
    ok = norm >= 1e-12
    x, y, z = (F.when(ok, a / norm).otherwise(0.0) for a in q[:3])
    w = F.when(ok, q[3] / norm).otherwise(1.0)
    return [
        [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)],
        [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)],
        [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)],
    ]


def slerp(p: Quaternion, q: Quaternion, alpha: Column) -> Quaternion:
    """The rotation at alpha between p and q along the shorter arc; close ones are blended and normalised."""
    near = dot(p, q)
    q = tuple(F.when(near < 0, -b).otherwise(b) for b in q)
    cos = F.abs(near)
    angle = F.acos(F.least(cos, F.lit(1.0)))
    close = cos > 0.9995
    first = F.when(close, 1 - alpha).otherwise(F.sin((1 - alpha) * angle) / F.sin(angle))
    second = F.when(close, alpha).otherwise(F.sin(alpha * angle) / F.sin(angle))
    raw = tuple(a * first + b * second for a, b in zip(p, q, strict=True))
    norm = F.sqrt(dot(raw, raw))
    return tuple(F.when(close, a / norm).otherwise(a) for a in raw)


def moved(m: list[list[Column]], shift: tuple[Column, Column, Column], point: tuple[Column, Column, Column]) -> list[Column]:
    """The point rotated by m and shifted."""
    return [row[0] * point[0] + row[1] * point[1] + row[2] * point[2] + s for row, s in zip(m, shift, strict=True)]


def moved_yaw(m: list[list[Column]], yaw: Column) -> Column:
    """The heading of the rotated heading vector."""
    c, s = F.cos(yaw), F.sin(yaw)
    return F.atan2(m[1][0] * c + m[1][1] * s, m[0][0] * c + m[0][1] * s)


def times_turned(p: Quaternion, q: Quaternion) -> Quaternion:
    """The rotation q followed by p."""
    (a, b, c, d), (x, y, z, w) = p, q
    return (d * x + a * w + b * z - c * y, d * y - a * z + b * w + c * x, d * z + a * y - b * x + c * w, d * w - a * x - b * y - c * z)


def quaternion(rows: tuple[tuple[float, ...], ...]) -> tuple[float, float, float, float]:
    """The quaternion of a rotation matrix of numbers (further columns are left out)."""
    m = [row[:3] for row in rows]
    # squares of four times each part; the largest is safe to divide by
    squares = [1 + m[0][0] - m[1][1] - m[2][2], 1 - m[0][0] + m[1][1] - m[2][2], 1 - m[0][0] - m[1][1] + m[2][2], 1 + m[0][0] + m[1][1] + m[2][2]]
    k = max(range(4), key=squares.__getitem__)
    sums = {(0, 1): m[0][1] + m[1][0], (0, 2): m[0][2] + m[2][0], (1, 2): m[1][2] + m[2][1], (0, 3): m[2][1] - m[1][2], (1, 3): m[0][2] - m[2][0], (2, 3): m[1][0] - m[0][1]}
    root = 2 * math.sqrt(squares[k])
    return tuple(root / 4 if i == k else sums[min(i, k), max(i, k)] / root for i in range(4))
