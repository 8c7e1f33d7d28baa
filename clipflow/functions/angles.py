"""Angles in radians, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def wrap(a: Column) -> Column:
    """a brought into [-pi, pi)."""
    return F.pmod(a + math.pi, F.lit(2 * math.pi)) - math.pi


def turn(a: Column, b: Column) -> Column:
    """The absolute angle between two headings, 0 to pi."""
    return F.abs(wrap(a - b))


def axis_turn(a: Column, b: Column) -> Column:
    """The absolute angle between two axes, headings modulo pi, 0 to pi/2."""
    d = F.pmod(a - b, F.lit(math.pi))
    return F.least(d, math.pi - d)
