"""Queries on parking regions, with their SQL where it says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.operators import parking
from clipflow.plans.catalog import QUERIES, query, rounded
from clipflow.sources.tables import TRACKED, tracked

_RULES = parking.Parking(extra=0.1, gap=0.2, most_slots=12, most_extent=12.0, split_gap=1.5)


def _slots(spark, sf):
    d = tracked(spark, sf).where("frame_id % 4 = 1").withColumn("clip", F.floor(F.col("frame_id") / 37))
    return d.select(F.col("event_id").alias("id"), "clip", "x", "y", "dx", "dy", F.round("yaw", 4).alias("yaw"))


@query("parking_close_slots", f"""WITH {TRACKED}, s AS (SELECT event_id AS id, frame_id // 37 AS clip, x, y, dx, dy, round(yaw, 4) AS yaw FROM trk WHERE frame_id % 4 = 1), p AS (SELECT a.id AS a, b.id AS b, sqrt((b.x - a.x) ** 2 + (b.y - a.y) ** 2) AS d, atan2(b.y - a.y, b.x - a.x) AS w, a.yaw AS ya, b.yaw AS yb, a.dx AS ax, a.dy AS ay, b.dx AS bx, b.dy AS by_ FROM s a JOIN s b ON a.clip = b.clip AND a.id < b.id AND abs(a.x - b.x) < 20 AND abs(a.y - b.y) < 20)
SELECT DISTINCT a, b FROM p WHERE d <= 1e-6 OR (d - (abs(cos(w - ya)) * (ax / 2 + 0.1) + abs(sin(w - ya)) * (ay / 2 + 0.1)) - (abs(cos(w - yb)) * (bx / 2 + 0.1) + abs(sin(w - yb)) * (by_ / 2 + 0.1)) <= 0.2
 AND least(fmod(fmod(ya - yb, pi()) + pi(), pi()), pi() - fmod(fmod(ya - yb, pi()) + pi(), pi())) <= 0.8 AND sqrt((ax - bx) ** 2 + (ay - by_) ** 2) / greatest(sqrt(ax * ax + ay * ay), sqrt(bx * bx + by_ * by_), 1.0) <= 0.6)""")
def parking_close_slots(spark, sf):
    return parking.close_slots(_slots(spark, sf), ("clip",), _RULES)


def parking_rectangles(spark, sf):
    """Splitting level by level has no SQL here; it is tested against splitting one region after the other."""
    s = _slots(spark, sf)
    return rounded(parking.rectangles(s, parking.regions(s, ("clip",), _RULES), _RULES))


QUERIES["parking_rectangles"] = parking_rectangles
