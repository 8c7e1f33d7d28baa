"""Queries on queues, with their SQL where it says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.operators import queues
from clipflow.plans.catalog import QUERIES, query
from clipflow.sources.tables import TRACKED, tracked

#: Lanes and queues of the supplied boxes, which lie closer together than vehicles do.
_RULES = queues.Queue(lane=0.3, gap=8.0, back=1.5, aside=0.4, lane_change=0.25, around=2.0)


def _observed(spark, sf):
    d = tracked(spark, sf).withColumn("clip", F.floor(F.col("frame_id") / 3000))
    block = F.floor(F.col("frame_id") / 300)
    turn = F.col("track_id") % 4
    movement = F.when(F.col("track_id") % 5 == 0, "left").when(F.col("track_id") % 5 == 1, "right").when(F.col("track_id") % 5 < 4, "straight")
    return d.select(
        "clip", turn.alias("direction"), (turn * 0.7).alias("way"), (F.col("track_id") * 1000000 + block).alias("id"), movement.alias("movement"), "t_us", "x", "y",
        (F.col("x") > -15).alias("inside"), (F.col("track_id") % 3 > 0).alias("dynamic"), (F.col("class_name") == "Truck").alias("isolated"),
    )


_FRAGMENTS = f"""{TRACKED}, ob AS (SELECT frame_id // 3000 AS clip, track_id % 4 AS direction, (track_id % 4) * 0.7::DOUBLE AS way, track_id * 1000000 + frame_id // 300 AS id, CASE WHEN track_id % 5 = 0 THEN 'left' WHEN track_id % 5 = 1 THEN 'right' WHEN track_id % 5 < 4 THEN 'straight' END AS movement, t_us, x, y, x > -15 AS inside FROM trk WHERE class_name <> 'Truck'),
g AS (SELECT clip, direction, id, min(movement) AS movement, median(x) * cos(min(way)) + median(y) * sin(min(way)) AS u, median(x) * sin(min(way)) - median(y) * cos(min(way)) AS v,
 min((t_us, x, y, inside)) AS f, max((t_us, x, y, inside)) AS l, min(way) AS way FROM ob GROUP BY 1, 2, 3),
fr AS (SELECT clip, direction, id, movement, u, v, f[1] AS began, f[2] * cos(way) + f[3] * sin(way) AS u_began, f[4] AS in_began, l[1] AS ended, l[2] * cos(way) + l[3] * sin(way) AS u_ended, l[4] AS in_ended FROM g),
l1 AS (SELECT *, coalesce((v - lag(v) OVER (PARTITION BY clip, direction ORDER BY v, id) > 0.3)::INT, 0) AS n FROM fr),
l2 AS (SELECT * EXCLUDE (n), sum(n) OVER (PARTITION BY clip, direction ORDER BY v, id ROWS UNBOUNDED PRECEDING)::BIGINT AS lane FROM l1),
q1 AS (SELECT *, coalesce((u - lag(u) OVER (PARTITION BY clip, direction, lane ORDER BY u, v, id) > 8)::INT, 0) AS n FROM l2),
q AS (SELECT * EXCLUDE (n), sum(n) OVER (PARTITION BY clip, direction, lane ORDER BY u, v, id ROWS UNBOUNDED PRECEDING)::BIGINT AS queue FROM q1)"""


@query("queue_members", f"WITH {_FRAGMENTS} SELECT clip, direction, lane, queue, id, row_number() OVER (PARTITION BY clip, direction, lane, queue ORDER BY u, v, id)::INT AS position FROM q")
def queue_members(spark, sf):
    parts = queues.fragments(_observed(spark, sf), ("clip",))
    return queues.queued(parts, ("clip",), _RULES).select("clip", "direction", "lane", "queue", "id", "position")


@query("queue_links", f"""WITH {_FRAGMENTS}, m AS (SELECT a.clip, a.direction, a.lane, a.queue, a.id AS a, b.id AS b, a.ended AS after, b.began AS before, least(a.u_ended, b.u_began) - 2 AS low, greatest(a.u_ended, b.u_began) + 2 AS high
 FROM q a JOIN q b ON a.clip = b.clip AND a.direction = b.direction AND a.lane = b.lane AND a.queue = b.queue AND a.ended < b.began AND abs(a.v - b.v) <= 0.4 AND b.u_began + 1.5 >= a.u_ended AND (a.in_ended OR b.in_began)
 WHERE CASE WHEN a.movement IS NULL OR b.movement IS NULL OR a.movement = b.movement THEN (coalesce(a.movement, '') <> 'right' AND coalesce(b.movement, '') <> 'right') OR abs(a.v - b.v) <= 0.25
  WHEN (a.movement, b.movement) IN (('left', 'straight'), ('straight', 'right')) THEN abs(a.v - b.v) <= 0.25 AND a.v <= b.v WHEN (a.movement, b.movement) IN (('straight', 'left'), ('right', 'straight')) THEN abs(a.v - b.v) <= 0.25 AND b.v <= a.v ELSE false END)
SELECT clip, direction, a, b FROM m WHERE NOT EXISTS (SELECT 1 FROM q c WHERE c.clip = m.clip AND c.direction = m.direction AND c.lane = m.lane AND c.queue = m.queue AND c.began > after AND c.ended < before AND c.u BETWEEN low AND high)""")
def queue_links(spark, sf):
    parts = queues.queued(queues.fragments(_observed(spark, sf), ("clip",)), ("clip",), _RULES)
    return queues.links(parts, ("clip",), _RULES).select("clip", "direction", "a", "b")


def queue_stitched(spark, sf):
    """Merging link by link has no SQL here; it is tested against merging one link after the other."""
    return queues.stitched(queues.fragments(_observed(spark, sf), ("clip",)), ("clip",), _RULES)


QUERIES["queue_stitched"] = queue_stitched
