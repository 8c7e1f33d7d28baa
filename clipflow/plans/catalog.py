"""The registered queries: operators over views of the supplied tables, and the SQL that says the same.

Times between events are hours, so thresholds are scaled to them; each query
reads whole tables.  Figures are rounded on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipflow.functions import angles, boxes, rotations
from clipflow.operators import aggregates, filters, joins, sorting, windows
from clipflow.sources.detections import label
from clipflow.sources.tables import BOXES, CLASSIFIED, OBSERVATIONS, classified, observations
from clipflow.sources.tables import boxes as box_table

QUERIES: dict = {}
SQL: dict[str, str] = {}

HOUR = 3_600_000_000
_W = "WINDOW w AS (PARTITION BY track_id ORDER BY t_us, event_id)"
STEPS = f"st AS (SELECT *, CASE WHEN dt > 0 THEN step / dt END AS speed FROM (SELECT *, (t_us - lag(t_us) OVER w) / 1e6 AS dt, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS step FROM obs {_W}))"


def query(name: str, sql: str):
    def add(f):
        QUERIES[name] = f
        SQL[name] = sql
        return f

    return add


def rounded(d: DataFrame, places: int = 4) -> DataFrame:
    """d with its doubles rounded, and no negative zero."""
    return d.select(*[(F.round(c, places) + 0.0).alias(c) if kind == "double" else F.col(c) for c, kind in d.dtypes])


def r(column: str, places: int = 4, name: str = "") -> str:
    return f"round({column}, {places}) + 0.0 AS {name or column}"


# -- filters ---------------------------------------------------------------------------------

HARD = filters.HardFilter(scores={"Car": 0.2, "Truck": 0.15}, score=0.1, classes=("Car", "Truck"), side=20.0, front=25.0, rear=40.0, pedestrian=15.0)
_HARD = f"""f AS (SELECT *, list_filter([CASE WHEN score < CASE class_name WHEN 'Car' THEN 0.2 WHEN 'Truck' THEN 0.15 ELSE 0.1 END THEN 'score' END,
 CASE WHEN class_name NOT IN ('Car', 'Truck') THEN 'class_whitelist' END, CASE WHEN NOT (abs(x) <= 20 AND y >= -25 AND y <= 40) THEN 'annotation_range' END,
 CASE WHEN class_name = 'Pedestrian' AND sqrt(x * x + y * y) > 15 THEN 'distant_pedestrian' END], lambda v: v IS NOT NULL) AS reasons FROM box)"""


@query("filter_hard", f"WITH {BOXES}, {_HARD} SELECT frame_id, det_idx, array_to_string(reasons, ',') AS reasons, reasons[1] AS first_reason, len(reasons) = 0 AS kept FROM f")
def filter_hard(spark, sf):
    d = filters.hard_filtered(box_table(spark, sf), HARD)
    return d.select("frame_id", "det_idx", F.array_join("reasons", ",").alias("reasons"), F.col("primary").alias("first_reason"), "kept")


@query("filter_hard_reasons", f"WITH {BOXES}, {_HARD} SELECT reason, count(*) AS n_any, count(*) FILTER (first_reason = reason) AS n_primary FROM (SELECT reasons[1] AS first_reason, unnest(reasons) AS reason FROM f) GROUP BY reason")
def filter_hard_reasons(spark, sf):
    return filters.reason_counts(filters.hard_filtered(box_table(spark, sf), HARD))


@query("filter_valid_box", f"WITH {BOXES} SELECT frame_id, det_idx, isfinite(x / dz) AND dx > 0 AND dy > 1 AS valid FROM box")
def filter_valid_box(spark, sf):
    b = box_table(spark, sf)
    box = F.array("x", "y", "z", "dx", F.col("dy") - 1, "dz", "yaw")
    return b.select("frame_id", "det_idx", boxes.valid(box).alias("valid"))


@query("filter_low_boxes", f"WITH {BOXES} SELECT frame_id, det_idx, {r('dz')} FROM box WHERE NOT (class_name = 'Pedestrian' AND dz < 1.45)")
def filter_low_boxes(spark, sf):
    return rounded(filters.low_boxes_dropped(box_table(spark, sf), "Pedestrian", 1.45).select("frame_id", "det_idx", "dz"))


@query("filter_short_tracks", f"WITH {OBSERVATIONS}, l AS (SELECT track_id, count(DISTINCT t_us) AS n, arg_min(class_name, (t_us, event_id)) AS c FROM obs GROUP BY track_id) SELECT o.event_id, o.track_id FROM obs o JOIN l USING (track_id) WHERE n > CASE c WHEN 'click' THEN 70 WHEN 'view' THEN 66 ELSE 60 END")
def filter_short_tracks(spark, sf):
    return filters.short_tracks_dropped(observations(spark, sf), {"click": 70, "view": 66}, 60).select("event_id", "track_id")


@query("filter_unmoved_tracks", f"""WITH {OBSERVATIONS}, o AS (SELECT *, median(x) OVER (PARTITION BY track_id) AS mx, median(y) OVER (PARTITION BY track_id) AS my, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS s FROM obs WHERE class_name = 'click' {_W}),
t AS (SELECT track_id, count(*) AS n_obs, sqrt((arg_max(x, (t_us, event_id)) - arg_min(x, (t_us, event_id))) ** 2 + (arg_max(y, (t_us, event_id)) - arg_min(y, (t_us, event_id))) ** 2) AS net, quantile_cont(sqrt((x - mx) ** 2 + (y - my) ** 2), 0.9) AS p90_radius, max(s) AS max_step FROM o GROUP BY track_id)
SELECT track_id, n_obs, {r('net')}, {r('p90_radius')}, {r('max_step')} FROM t WHERE NOT coalesce(n_obs >= 12 AND (net >= 60 OR p90_radius >= 120 OR max_step >= 200), false)""")
def filter_unmoved_tracks(spark, sf):
    return rounded(filters.unmoved_tracks(observations(spark, sf), "click", 12, 60, 120, 200))


@query("filter_spinning_tracks", f"""WITH {OBSERVATIONS}, o AS (SELECT *, (event_id * 37 % 100) / 31.0::DOUBLE AS yaw FROM obs), a AS (SELECT track_id, yaw, lag(yaw) OVER w AS p FROM o {_W}),
d AS (SELECT *, fmod(fmod(yaw - p, pi()) + pi(), pi()) AS m FROM a), s AS (SELECT track_id, count(*) AS n_obs, count(*) FILTER (least(m, pi() - m) >= 0.8) AS flips FROM d GROUP BY track_id),
u AS (SELECT DISTINCT track_id, fmod(yaw, pi()) AS a FROM o), w AS (SELECT p.track_id, max(least(abs(p.a - q.a), pi() - abs(p.a - q.a))) AS span FROM u p JOIN u q USING (track_id) GROUP BY 1)
SELECT track_id, n_obs, {r('span')}, flips FROM s JOIN w USING (track_id) WHERE n_obs >= 4 AND span >= 1.1 AND flips >= 1""")
def filter_spinning_tracks(spark, sf):
    o = observations(spark, sf).withColumn("yaw", (F.col("event_id") * 37 % 100) / F.lit(31.0))
    return rounded(filters.spinning_tracks(o, None, 4, 1.1, 0.8, 1))


# -- joins -----------------------------------------------------------------------------------

@query("join_nearest_time", f"""WITH {OBSERVATIONS}, l AS (SELECT * FROM obs WHERE class_name = 'click'), p AS (SELECT DISTINCT track_id, t_us FROM obs WHERE class_name = 'view'),
b AS (SELECT l.event_id, l.track_id, l.t_us, max(p.t_us) FILTER (p.t_us <= l.t_us) AS x, min(p.t_us) FILTER (p.t_us >= l.t_us) AS y FROM l LEFT JOIN p USING (track_id) GROUP BY ALL),
n AS (SELECT *, CASE WHEN x IS NULL OR y - t_us < t_us - x THEN y ELSE x END AS m FROM b) SELECT event_id, track_id, CASE WHEN abs(m - t_us) <= {12 * HOUR} THEN m END AS match_us FROM n""")
def join_nearest_time(spark, sf):
    o = observations(spark, sf)
    left = o.where("class_name = 'click'").select("event_id", "track_id", "t_us")
    return joins.nearest_in_time(left, o.where("class_name = 'view'").select("track_id", "t_us"), "track_id", 12 * HOUR).select("event_id", "track_id", "match_us")


@query("join_pose_between", f"""WITH {OBSERVATIONS}, l AS (SELECT event_id, track_id, t_us FROM obs WHERE class_name = 'click'), p AS (SELECT track_id, t_us, x AS px, y AS py FROM obs WHERE class_name = 'view'),
a AS (SELECT l.*, arg_max((p.t_us, px, py), (p.t_us, px, py)) FILTER (p.t_us <= l.t_us) AS a, arg_min((p.t_us, px, py), (p.t_us, px, py)) FILTER (p.t_us >= l.t_us) AS b FROM l LEFT JOIN p USING (track_id) GROUP BY ALL),
g AS (SELECT *, (b[1] - a[1]) AS gap, (t_us - a[1]) AS part FROM a),
f AS (SELECT *, CASE WHEN a IS NULL THEN 1.0 WHEN b IS NULL OR gap = 0 THEN 0.0 WHEN gap > {24 * HOUR} THEN CASE WHEN part * 2 <= gap THEN 0.0 ELSE 1.0 END ELSE part / gap::DOUBLE END AS k FROM g)
SELECT event_id, track_id, round(CASE k WHEN 0 THEN a[2] WHEN 1 THEN b[2] ELSE a[2] * (1 - k) + b[2] * k END, 4) + 0.0 AS px, round(CASE k WHEN 0 THEN a[3] WHEN 1 THEN b[3] ELSE a[3] * (1 - k) + b[3] * k END, 4) + 0.0 AS py FROM f""".replace("arg_max((p.t_us, px, py), (p.t_us, px, py))", "max(row(p.t_us, px, py))").replace("arg_min((p.t_us, px, py), (p.t_us, px, py))", "min(row(p.t_us, px, py))"))
def join_pose_between(spark, sf):
    o = observations(spark, sf)
    stamps = o.where("class_name = 'click'").select("event_id", "track_id", "t_us")
    poses = o.where("class_name = 'view'").select("track_id", "t_us", F.col("x").alias("px"), F.col("y").alias("py"))
    return rounded(joins.interpolated(stamps, poses, "track_id", 24 * HOUR).select("event_id", "track_id", "px", "py"))


@query("join_merge_back", f"""WITH {BOXES}, v AS (SELECT frame_id, track_id, max(row(det_idx, score + 1))[2] AS s FROM box WHERE class_name = 'Car' AND det_idx <> 2 GROUP BY ALL)
SELECT frame_id, det_idx, class_name, round(CASE class_name WHEN 'Car' THEN s ELSE score END, 4) + 0.0 AS score FROM box LEFT JOIN v USING (frame_id, track_id) WHERE class_name <> 'Car' OR s IS NOT NULL""")
def join_merge_back(spark, sf):
    b = box_table(spark, sf)
    refined = b.where("class_name = 'Car' AND det_idx <> 2").select("frame_id", "track_id", "det_idx", (F.col("score") + 1).alias("new_score"))
    return rounded(joins.merged_back(b, refined, "Car").select("frame_id", "det_idx", "class_name", "score"))


@query("join_same_centre", f"WITH {BOXES} SELECT * FROM (SELECT a.frame_id, a.det_idx AS det_a, b.det_idx AS det_b, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 4) + 0.0 AS distance FROM box a JOIN box b ON a.frame_id = b.frame_id AND a.det_idx < b.det_idx AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 6)")
def join_same_centre(spark, sf):
    return rounded(joins.same_centre_pairs(box_table(spark, sf), 6.0))


@query("join_same_centre_kept", f"""WITH RECURSIVE {BOXES}, p AS (SELECT a.frame_id, a.det_idx AS i, b.det_idx AS j FROM box a JOIN box b ON a.frame_id = b.frame_id AND a.det_idx <> b.det_idx AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 6),
c AS (SELECT frame_id, det_idx AS i, det_idx AS j FROM box UNION SELECT c.frame_id, c.i, p.j FROM c JOIN p ON c.frame_id = p.frame_id AND c.j = p.i),
g AS (SELECT frame_id, i AS det_idx, min(j) AS grp FROM c GROUP BY 1, 2), life AS (SELECT track_id, count(DISTINCT frame_id) AS n FROM box GROUP BY 1)
SELECT frame_id, det_idx, class_name FROM (SELECT box.*, row_number() OVER (PARTITION BY box.frame_id, grp ORDER BY CASE class_name WHEN 'Car' THEN 0 WHEN 'Truck' THEN 1 ELSE 3 END, n DESC, score DESC, det_idx) AS k FROM box JOIN g USING (frame_id, det_idx) JOIN life USING (track_id)) WHERE k = 1""")
def join_same_centre_kept(spark, sf):
    priority = F.when(F.col("class_name") == "Car", 0).when(F.col("class_name") == "Truck", 1).otherwise(3)
    return joins.same_centre_kept(box_table(spark, sf), 6.0, priority).select("frame_id", "det_idx", "class_name")


_COVER = """cp AS (SELECT a.frame_id, a.track_id, a.det_idx, i / (a.dx * a.dy) AS cover, i / (a.dx * a.dy + b.dx * b.dy - i) AS iou FROM (SELECT a, b, greatest(0, least(a.x + a.dx / 2, b.x + b.dx / 2) - greatest(a.x - a.dx / 2, b.x - b.dx / 2)) * greatest(0, least(a.y + a.dy / 2, b.y + b.dy / 2) - greatest(a.y - a.dy / 2, b.y - b.dy / 2)) AS i
FROM box a JOIN box b ON a.frame_id = b.frame_id AND a.class_name = 'Car' AND b.class_name = 'Truck') WHERE i > 0)"""


@query("join_covered_in_frame", f"WITH {BOXES}, {_COVER} SELECT frame_id, det_idx, class_name FROM box ANTI JOIN (SELECT * FROM cp WHERE cover > 0.25) USING (frame_id, det_idx)")
def join_covered_in_frame(spark, sf):
    return joins.covered_in_frame_dropped(box_table(spark, sf), "Car", "Truck", 0.25).select("frame_id", "det_idx", "class_name")


@query("join_overlapping_tracks", f"WITH {BOXES}, {_COVER} SELECT frame_id, det_idx, class_name FROM box WHERE class_name <> 'Car' OR track_id NOT IN (SELECT track_id FROM cp GROUP BY track_id HAVING max(iou) >= 0.2)")
def join_overlapping_tracks(spark, sf):
    return joins.overlapping_tracks_dropped(box_table(spark, sf), "Car", "Truck", 0.2).select("frame_id", "det_idx", "class_name")


@query("join_reused_labels", f"WITH {BOXES}, n AS (SELECT * FROM box WHERE class_name = 'Truck' AND det_idx = 1) SELECT frame_id, det_idx, class_name, 0 AS part FROM box WHERE class_name NOT IN (SELECT class_name FROM n) UNION ALL SELECT frame_id, det_idx, class_name, 1 FROM n")
def join_reused_labels(spark, sf):
    b = box_table(spark, sf).select("frame_id", "det_idx", "class_name")
    return joins.reused(b, b.where("class_name = 'Truck' AND det_idx = 1")).select("frame_id", "det_idx", "class_name", "part")


@query("set_frame_difference", f"WITH {BOXES}, a AS (SELECT DISTINCT frame_id FROM box WHERE class_name = 'Car'), b AS (SELECT DISTINCT frame_id FROM box WHERE class_name = 'Truck') SELECT frame_id, 'left' AS side FROM (FROM a EXCEPT FROM b) UNION ALL SELECT frame_id, 'right' FROM (FROM b EXCEPT FROM a)")
def set_frame_difference(spark, sf):
    b = box_table(spark, sf)
    return joins.frame_difference(b.where("class_name = 'Car'"), b.where("class_name = 'Truck'"))


# -- aggregates ------------------------------------------------------------------------------

_MOTION = f"""{STEPS}, rr AS (SELECT *, sqrt((x - median(x) OVER (PARTITION BY track_id)) ** 2 + (y - median(y) OVER (PARTITION BY track_id)) ** 2) AS rad FROM st),
ms AS (SELECT track_id, count(*) AS n, (max(t_us) - min(t_us)) / 1e6 AS duration, sum(step) AS path, sqrt((arg_max(x, (t_us, event_id)) - arg_min(x, (t_us, event_id))) ** 2 + (arg_max(y, (t_us, event_id)) - arg_min(y, (t_us, event_id))) ** 2) AS net,
median(rad) AS median_radius, quantile_cont(rad, 0.9) AS p90_radius, max(rad) AS max_radius, max(step) AS max_step, quantile_cont(speed, 0.9) AS p90_speed, median(speed) AS median_speed FROM rr GROUP BY track_id HAVING count(*) >= 2)"""
_STATS = ("duration", "path", "net", "median_radius", "p90_radius", "max_radius", "max_step", "p90_speed", "median_speed")


@query("track_motion", f"WITH {OBSERVATIONS}, {_MOTION} SELECT track_id, n, {', '.join(map(r, _STATS))}, round(CASE WHEN path > 0 THEN net / path ELSE 0 END, 4) + 0.0 AS concentration FROM ms")
def track_motion(spark, sf):
    return rounded(aggregates.motion_stats(observations(spark, sf)))


@query("track_motion_class", f"WITH {OBSERVATIONS}, {_MOTION} SELECT track_id, CASE WHEN path >= 2000 AND net >= 30 THEN 'moving' WHEN p90_radius >= 100 THEN 'creeping' ELSE 'static' END AS motion FROM ms")
def track_motion_class(spark, sf):
    return aggregates.motion_class(aggregates.motion_stats(observations(spark, sf)), 2000, 30, 100).select("track_id", "motion")


@query("track_fast", f"WITH {OBSERVATIONS}, {STEPS}, t AS (SELECT track_id, sum(step) AS path, quantile_cont(speed, 0.9) AS p90_speed, max(speed) AS max_speed, count(*) FILTER (speed >= 0.004) AS fast_steps FROM st GROUP BY track_id) SELECT track_id, {r('path')}, {r('p90_speed')}, {r('max_speed')}, fast_steps, coalesce(path >= 1500 AND p90_speed >= 0.004 AND fast_steps >= 3, false) AS fast FROM t")
def track_fast(spark, sf):
    return rounded(aggregates.fast_tracks(observations(spark, sf), 1500, 0.004, 3))


@query("track_majority_class", f"WITH {CLASSIFIED}, v AS (SELECT track_id, class_name, count(*) AS votes, sum(score) AS s FROM det GROUP BY ALL) SELECT track_id, class_name, votes FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY votes DESC, round(s, 4) DESC, list_position(['2-HIGH', '1-URGENT'], class_name), class_name) AS k FROM v) WHERE k = 1")
def track_majority_class(spark, sf):
    return aggregates.majority_class(classified(spark, sf), ("2-HIGH", "1-URGENT"))


@query("track_size_class", f"WITH {BOXES}, t AS (SELECT track_id % 37 AS track_id, median(greatest(dx, dy)) AS long, median(least(dx, dy)) AS short, median(dz) AS height, list_sort(list_distinct(list(class_name))) AS c FROM box WHERE frame_id % 3 = 0 OR class_name = 'Car' GROUP BY 1) SELECT track_id, {r('long')}, {r('short')}, {r('height')}, CASE WHEN len(c) = 1 THEN c[1] WHEN long >= 6 THEN 'Truck' WHEN long < 3.5 AND short < 1.5 THEN 'Cyclist' ELSE 'Car' END AS class_name FROM t".replace(" WHERE frame_id % 3 = 0 OR class_name = 'Car'", ""))
def track_size_class(spark, sf):
    return rounded(aggregates.size_class(box_table(spark, sf).withColumn("track_id", F.col("track_id") % 37), 6.0, 3.5, 1.5))


@query("track_large_cars", f"WITH {BOXES} SELECT frame_id, det_idx, CASE WHEN class_name = 'Car' AND median(greatest(dx, dy)) OVER (PARTITION BY track_id, class_name) >= 6 THEN 'Truck' ELSE class_name END AS class_name FROM box")
def track_large_cars(spark, sf):
    return aggregates.large_cars_relabelled(box_table(spark, sf), 6.0).select("frame_id", "det_idx", "class_name")


@query("track_mixed_unified", f"WITH {CLASSIFIED} SELECT track_id, frame_id, CASE WHEN bool_or(class_name = '1-URGENT') OVER (PARTITION BY track_id) OR class_name = '5-LOW' THEN '1-URGENT' ELSE class_name END AS class_name FROM det")
def track_mixed_unified(spark, sf):
    return aggregates.mixed_tracks_unified(classified(spark, sf), "1-URGENT", "5-LOW").select("track_id", "frame_id", "class_name")


@query("track_axis", f"""WITH {OBSERVATIONS}, a AS (SELECT track_id, (event_id % 60) / 20.0::DOUBLE AS a FROM obs), m AS (SELECT track_id, atan2(median(sin(2 * a)), median(cos(2 * a))) / 2 AS m FROM a GROUP BY 1),
d AS (SELECT track_id, m, fmod(fmod(a - m, pi()) + pi(), pi()) AS p, fmod(fmod(a - m - pi() / 2, pi()) + pi(), pi()) AS q FROM a JOIN m USING (track_id)), c AS (SELECT track_id, m, sum(least(p, pi() - p)) AS own, sum(least(q, pi() - q)) AS quarter FROM d GROUP BY 1, 2),
b AS (SELECT track_id, CASE WHEN round(own, 6) <= round(quarter, 6) THEN m ELSE m + pi() / 2 END AS b FROM c) SELECT track_id, round(fmod(fmod(b, pi()) + pi(), pi()), 4) + 0.0 AS axis FROM b""")
def track_axis(spark, sf):
    o = observations(spark, sf)
    return rounded(aggregates.axis_of(o, "track_id", (F.col("event_id") % 60) / F.lit(20.0)))


@query("track_representative_class", f"WITH {CLASSIFIED}, n AS (SELECT track_id, class_name, count(*) AS n FROM det GROUP BY ALL) SELECT track_id, class_name FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY class_name IN ('4-NOT SPECIFIED', '5-LOW'), n DESC, class_name) AS k FROM n) WHERE k = 1")
def track_representative_class(spark, sf):
    return aggregates.representative_class(classified(spark, sf), F.col("class_name").isin("4-NOT SPECIFIED", "5-LOW"))


@query("track_weighted_length", f"""WITH {BOXES}, w AS (SELECT track_id, dx AS v, sum(score * sqrt(dz)) AS w FROM box WHERE score * sqrt(dz) > 0 GROUP BY 1, 2), c AS (SELECT track_id, v, (sum(w) OVER (PARTITION BY track_id ORDER BY v) - w / 2) / sum(w) OVER (PARTITION BY track_id) AS c FROM w),
p AS (SELECT *, lag(v) OVER (PARTITION BY track_id ORDER BY v) AS pv, lag(c) OVER (PARTITION BY track_id ORDER BY v) AS pc FROM c) SELECT track_id, round(coalesce(arg_min(CASE WHEN pc IS NULL THEN v ELSE pv + (v - pv) * (0.75 - pc) / (c - pc) END, c) FILTER (c >= 0.75), max(v)), 4) + 0.0 AS quantile FROM p GROUP BY track_id""")
def track_weighted_length(spark, sf):
    return rounded(aggregates.weighted_quantile(box_table(spark, sf), "track_id", "dx", F.col("score") * F.sqrt("dz"), 0.75))


@query("direction_stop_line", f"WITH {OBSERVATIONS}, a AS (SELECT track_id, count(f) AS n, max(f) AS m, median(f) AS mid, quantile_cont(f, 0.75) AS q, median(x) AS every FROM (SELECT *, CASE WHEN class_name = 'click' THEN x END AS f FROM obs) GROUP BY 1) SELECT track_id, round(CASE WHEN n = 0 THEN every WHEN n > 1 AND m - mid > 40 THEN q ELSE m END, 4) + 0.0 AS line FROM a")
def direction_stop_line(spark, sf):
    o = observations(spark, sf).withColumn("first_stop", F.when(F.col("class_name") == "click", F.col("x")))
    return rounded(aggregates.stop_line(o, "track_id", "first_stop", "x", 40))


@query("signal_bins", f"WITH {OBSERVATIONS} SELECT class_name, floor(t_us / {6 * HOUR}.0)::BIGINT AS bin, count(DISTINCT track_id) AS active, count(*) AS samples, count(*) FILTER (x >= 50) AS high FROM obs GROUP BY 1, 2")
def signal_bins(spark, sf):
    return aggregates.binned_evidence(observations(spark, sf), 6 * HOUR, F.col("x") >= 50)


@query("stage_summary", f"WITH {BOXES} SELECT coalesce(class_name, 'all') AS \"group\", count(*) AS n_rows, count(DISTINCT track_id) AS tracks, count(DISTINCT frame_id) AS frames FROM box GROUP BY GROUPING SETS ((class_name), ())")
def stage_summary(spark, sf):
    return aggregates.stage_summary(box_table(spark, sf))


# -- ordered computations --------------------------------------------------------------------

def _islands(flag: str, where: str) -> str:
    return f"i0 AS (SELECT *, {flag} AS fl FROM {where}), i1 AS (SELECT *, lag(fl) OVER w AS pf FROM i0 {_W}), isl AS (SELECT *, sum(CASE WHEN pf IS NULL OR pf <> fl THEN 1 ELSE 0 END) OVER w AS island FROM i1 {_W})"


@query("window_heading", f"""WITH {OBSERVATIONS}, o AS (SELECT *, t_us / 1e6 - min(t_us / 1e6) OVER (PARTITION BY track_id) AS t FROM obs), v AS (SELECT *, regr_slope(x, t) OVER k AS vx, regr_slope(y, t) OVER k AS vy FROM o WINDOW k AS (PARTITION BY track_id ORDER BY t_us, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
h AS (SELECT *, CASE WHEN sqrt(vx * vx + vy * vy) >= 0.0008 THEN atan2(vy, vx) END AS own FROM v) SELECT event_id, track_id, round(coalesce(last_value(own IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(own IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 4) + 0.0 AS heading FROM h {_W}""")
def window_heading(spark, sf):
    return rounded(windows.regression_heading(observations(spark, sf), 2, 0.0008).select("event_id", "track_id", "heading"))


@query("window_stationary_runs", f"WITH {OBSERVATIONS}, {STEPS}, ld AS (SELECT *, lead(speed) OVER w AS ns FROM st {_W}), {_islands('coalesce(least(speed, ns) <= 0.0006, false)', 'ld')} SELECT track_id, min(t_us) AS first_us, max(t_us) AS last_us, count(*) AS n FROM isl WHERE fl GROUP BY track_id, island HAVING count(*) >= 2")
def window_stationary_runs(spark, sf):
    return windows.stationary_runs(observations(spark, sf), 0.0006, 2)


@query("window_stop_intervals", f"""WITH {OBSERVATIONS}, {STEPS}, f0 AS (SELECT *, lag(t_us) OVER w AS ft, lag(x) OVER w AS fx, lag(y) OVER w AS fy FROM st {_W}), f1 AS (SELECT * FROM f0 WHERE speed IS NOT NULL), {_islands('speed <= 0.001', 'f1')},
g AS (SELECT track_id, min(ft) AS start_us, max(t_us) AS end_us, (arg_min(fx, (t_us, event_id)) + arg_max(x, (t_us, event_id))) / 2 AS mx, (arg_min(fy, (t_us, event_id)) + arg_max(y, (t_us, event_id))) / 2 AS my FROM isl WHERE fl GROUP BY track_id, island) SELECT track_id, start_us, end_us, {r('mx')}, {r('my')} FROM g WHERE end_us - start_us >= {10 * HOUR}""")
def window_stop_intervals(spark, sf):
    return rounded(windows.stop_intervals(observations(spark, sf), 0.001, 10 * HOUR))


@query("window_explicit_stop", f"""WITH {OBSERVATIONS}, {STEPS}, f0 AS (SELECT *, lag(t_us) OVER w AS ft FROM st {_W}), f1 AS (SELECT * FROM f0 WHERE step IS NOT NULL), {_islands('step < 40', 'f1')},
g AS (SELECT track_id, min(ft) AS start_us, max(t_us) AS end_us, avg(x) AS cx, avg(y) AS cy FROM isl WHERE fl GROUP BY track_id, island) SELECT track_id, start_us, end_us, {r('cx')}, {r('cy')} FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY end_us - start_us DESC, start_us) AS k FROM g WHERE end_us - start_us >= {10 * HOUR}) WHERE k = 1""")
def window_explicit_stop(spark, sf):
    return rounded(windows.explicit_stop(observations(spark, sf), 40, 10 * HOUR))


@query("window_endpoint_velocity", f"""WITH {OBSERVATIONS}, o AS (SELECT *, (t_us - min(t_us) OVER (PARTITION BY track_id)) / 1e6 AS t, row_number() OVER (PARTITION BY track_id ORDER BY t_us, event_id) AS i, row_number() OVER (PARTITION BY track_id ORDER BY t_us DESC, event_id DESC) AS j FROM obs)
SELECT track_id, {', '.join(f"round(regr_slope({k}, t) FILTER ({i} <= 4), 6) + 0.0 AS v{k}{n}" for n, i in enumerate("ij") for k in "xy")} FROM o GROUP BY track_id""")
def window_endpoint_velocity(spark, sf):
    return rounded(windows.endpoint_velocity(observations(spark, sf), 4), 6)


@query("window_isolated_last", f"WITH {OBSERVATIONS}, o AS (SELECT *, t_us - lag(t_us) OVER w AS gap, row_number() OVER (PARTITION BY track_id ORDER BY t_us DESC, event_id DESC) AS j FROM obs {_W}) SELECT track_id, event_id FROM o WHERE j = 1 AND gap >= {6 * HOUR}")
def window_isolated_last(spark, sf):
    return windows.isolated_last(observations(spark, sf), 6 * HOUR)


@query("window_smoothed_bins", f"WITH {OBSERVATIONS}, c AS (SELECT class_name, floor(t_us / {6 * HOUR}.0)::BIGINT AS bin, count(*) AS samples FROM obs GROUP BY 1, 2) SELECT class_name, bin, round(sum(samples) OVER (PARTITION BY class_name ORDER BY bin ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) / 4, 4) + 0.0 AS smooth FROM c")
def window_smoothed_bins(spark, sf):
    return rounded(windows.smoothed(aggregates.binned_evidence(observations(spark, sf), 6 * HOUR, F.col("x") >= 50), "class_name", "samples", 4).select("class_name", "bin", "smooth"))


@query("window_filled_states", f"""WITH {OBSERVATIONS}, s AS (SELECT *, CASE WHEN class_name = 'click' THEN 'go' WHEN class_name = 'view' THEN 'stop' END AS state FROM obs),
n AS (SELECT *, last_value(CASE WHEN state IS NOT NULL THEN row(t_us, state) END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b, first_value(CASE WHEN state IS NOT NULL THEN row(t_us, state) END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a FROM s {_W})
SELECT event_id, track_id, coalesce(state, CASE WHEN t_us - b[1] <= {3 * HOUR} THEN b[2] END, CASE WHEN b[2] = a[2] AND a[1] - b[1] <= {30 * HOUR} THEN b[2] END) AS held FROM n""")
def window_filled_states(spark, sf):
    state = F.when(F.col("class_name") == "click", "go").when(F.col("class_name") == "view", "stop")
    return windows.filled(observations(spark, sf).withColumn("state", state), 3 * HOUR, 30 * HOUR).select("event_id", "track_id", "held")


@query("window_hole_runs", f"WITH {OBSERVATIONS}, s AS (SELECT DISTINCT track_id, floor(t_us / {12 * HOUR}.0)::BIGINT AS f FROM obs), g AS (SELECT *, lead(f) OVER (PARTITION BY track_id ORDER BY f) AS nx FROM s) SELECT track_id, f + 1 AS first_missing, nx - 1 AS last_missing, f AS before, nx AS after FROM g WHERE nx > f + 1")
def window_hole_runs(spark, sf):
    return windows.hole_runs(observations(spark, sf).withColumn("frame", F.floor(F.col("t_us") / (12 * HOUR))))


@query("window_first_break", f"""WITH {OBSERVATIONS}, {STEPS}, v AS (SELECT *, row_number() OVER w AS i, CASE WHEN dt > 0 THEN (x - lag(x) OVER w) / dt END AS vx, CASE WHEN dt > 0 THEN (y - lag(y) OVER w) / dt END AS vy FROM st {_W}),
q AS (SELECT *, vx * lag(vx) OVER w + vy * lag(vy) OVER w AS d, sqrt((vx - lag(vx) OVER w) ** 2 + (vy - lag(vy) OVER w) ** 2) / CASE WHEN dt = 0 THEN NULL ELSE dt END AS acc FROM v {_W}) SELECT track_id, min(i) AS break_at FROM q WHERE d < 0 OR acc > 0.0000001 GROUP BY track_id""")
def window_first_break(spark, sf):
    return windows.first_break(observations(spark, sf), 1e-7)


@query("window_interval_speeds", f"""WITH {OBSERVATIONS}, {STEPS}, iv AS (SELECT track_id, min(t_us) + {24 * HOUR} AS a, min(t_us) + {96 * HOUR} AS z FROM obs GROUP BY 1)
SELECT track_id, a AS start_us, count(speed) AS n, round(avg(speed), 6) + 0.0 AS mean_speed, round(max(speed), 6) + 0.0 AS max_speed FROM iv LEFT JOIN st ON st.track_id = iv.track_id AND t_us BETWEEN a - {2 * HOUR} AND z + {2 * HOUR} GROUP BY ALL""".replace("SELECT track_id, a AS", "SELECT iv.track_id, a AS"))
def window_interval_speeds(spark, sf):
    o = observations(spark, sf)
    i = o.groupBy("track_id").agg((F.min("t_us") + 24 * HOUR).alias("start_us"), (F.min("t_us") + 96 * HOUR).alias("end_us"))
    return rounded(windows.interval_speeds(o, i, 2 * HOUR), 6)


@query("window_radial_departure", f"""WITH {OBSERVATIONS}, o AS (SELECT *, row_number() OVER w AS i, sqrt((x - first_value(x) OVER w) ** 2 + (y - first_value(y) OVER w) ** 2) AS rad FROM obs {_W}), u AS (SELECT *, rad - lag(rad) OVER w AS up FROM o {_W}),
t AS (SELECT track_id, max(rad) AS m, count(*) FILTER (i <= 8 AND up > 5) AS n, sum(up) FILTER (i <= 8 AND up > 5) AS s, min(t_us) FILTER (rad >= 50) AS confirmed_us FROM u GROUP BY 1) SELECT track_id, confirmed_us FROM t WHERE m >= 60 AND n >= 3 AND s >= 40""")
def window_radial_departure(spark, sf):
    return windows.radial_departures(observations(spark, sf), 50, 60, 5, 8, 3, 40)


@query("track_principal_axis", f"WITH {OBSERVATIONS}, a AS (SELECT track_id, atan2(2 * covar_pop(x, y), var_pop(x) - var_pop(y)) / 2 AS axis FROM obs GROUP BY 1) SELECT track_id, round(axis, 4) + 0.0 AS axis, round(max(x * cos(axis) + y * sin(axis)) - min(x * cos(axis) + y * sin(axis)), 4) + 0.0 AS span FROM obs JOIN a USING (track_id) GROUP BY track_id, axis")
def track_principal_axis(spark, sf):
    return rounded(windows.principal_axis(observations(spark, sf)))


# -- numbering -------------------------------------------------------------------------------

@query("sort_dense_ids", f"WITH {CLASSIFIED} SELECT track_id, row_number() OVER (ORDER BY track_id) + 999 AS new_id FROM (SELECT DISTINCT track_id FROM det)")
def sort_dense_ids(spark, sf):
    return sorting.dense_ids(classified(spark, sf), "track_id", 1000)


@query("sort_top_axes", f"WITH {CLASSIFIED}, c AS (SELECT track_id, class_name, count(*) AS n FROM det GROUP BY ALL) SELECT track_id, class_name, n, k AS rank FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY n DESC, class_name) AS k FROM c) WHERE k <= 2")
def sort_top_axes(spark, sf):
    counts = classified(spark, sf).groupBy("track_id", "class_name").agg(F.count("*").alias("n"))
    return sorting.top_of(counts, "track_id", "n", "class_name", 2).withColumn("rank", F.col("rank").cast("long"))


# -- geometry and labels ---------------------------------------------------------------------

@query("geometry_angles", f"WITH {BOXES}, a AS (SELECT *, yaw * 5 - 7 AS a, score - 3 AS b FROM box), d AS (SELECT *, fmod(fmod(a - b, pi()) + pi(), pi()) AS m FROM a) SELECT frame_id, det_idx, round(fmod(fmod(a + pi(), 2 * pi()) + 2 * pi(), 2 * pi()) - pi(), 4) + 0.0 AS wrapped, round(abs(fmod(fmod(a - b + pi(), 2 * pi()) + 2 * pi(), 2 * pi()) - pi()), 4) + 0.0 AS turn, round(least(m, pi() - m), 4) + 0.0 AS axis_turn FROM d")
def geometry_angles(spark, sf):
    a, b = F.col("yaw") * 5 - 7, F.col("score") - 3
    return rounded(box_table(spark, sf).select("frame_id", "det_idx", angles.wrap(a).alias("wrapped"), angles.turn(a, b).alias("turn"), angles.axis_turn(a, b).alias("axis_turn")))


@query("geometry_world_centre", f"""WITH {BOXES}, q AS (SELECT *, sqrt(score * score + 2 + dy * dy) AS n FROM box), u AS (SELECT *, score / n AS qx, 1 / n AS qy, dy / n AS qz, 1 / n AS qw FROM q)
SELECT frame_id, det_idx, round((1 - 2 * (qy * qy + qz * qz)) * x + 2 * (qx * qy - qz * qw) * y + 2 * (qx * qz + qy * qw) * z + 5, 6) + 0.0 AS wx, round(2 * (qx * qy + qz * qw) * x + (1 - 2 * (qx * qx + qz * qz)) * y + 2 * (qy * qz - qx * qw) * z - 3, 6) + 0.0 AS wy, round(2 * (qx * qz - qy * qw) * x + 2 * (qy * qz + qx * qw) * y + (1 - 2 * (qx * qx + qy * qy)) * z + 1, 6) + 0.0 AS wz,
round(atan2(2 * (qx * qy + qz * qw) * cos(yaw) + (1 - 2 * (qx * qx + qz * qz)) * sin(yaw), (1 - 2 * (qy * qy + qz * qz)) * cos(yaw) + 2 * (qx * qy - qz * qw) * sin(yaw)), 6) + 0.0 AS wyaw FROM u""")
def geometry_world_centre(spark, sf):
    m = rotations.matrix((F.col("score"), F.lit(1.0), F.col("dy"), F.lit(1.0)))
    wx, wy, wz = rotations.moved(m, (F.lit(5.0), F.lit(-3.0), F.lit(1.0)), (F.col("x"), F.col("y"), F.col("z")))
    return rounded(box_table(spark, sf).select("frame_id", "det_idx", wx.alias("wx"), wy.alias("wy"), wz.alias("wz"), rotations.moved_yaw(m, F.col("yaw")).alias("wyaw")), 6)


@query("export_labels", f"WITH {BOXES} SELECT frame_id, (track_id + 1000)::VARCHAR AS obj_id, class_name AS obj_type, round_even(x, 4) + 0.0 AS px, round_even(dx, 4) + 0.0 AS sx, round_even(yaw, 4) + 0.0 AS rz FROM box WHERE track_id IS NOT NULL")
def export_labels(spark, sf):
    b = box_table(spark, sf).where("track_id IS NOT NULL")
    made = label(F.col("track_id") + 1000, F.col("class_name"), F.col("score"), {k: F.col(k) for k in ("x", "y", "z", "dx", "dy", "dz", "yaw")})
    d = b.select("frame_id", made.alias("l"))
    return d.select("frame_id", "l.obj_id", "l.obj_type", (F.col("l.psr.position.x") + 0.0).alias("px"), (F.col("l.psr.scale.x") + 0.0).alias("sx"), (F.col("l.psr.rotation.z") + 0.0).alias("rz"))
