"""Queries on the sizes and headings of tracks, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.operators import overlap, shapes
from clipflow.plans.catalog import query, r, rounded
from clipflow.plans.overlap import _ALL, _boxes
from clipflow.sources.tables import TRACKED, tracked

_AX = "least(fmod(abs({a} - {b}), pi()), pi() - fmod(abs({a} - {b}), pi()))"
_TURN = "abs(fmod(fmod({a} - {b} + pi(), 2 * pi()) + 2 * pi(), 2 * pi()) - pi())"
_T = "WINDOW w AS (PARTITION BY track_id ORDER BY t_us, event_id)"


def _axis(source: str, name: str) -> str:
    """CTEs that end in `name`(track_id, axis): the axis of a relation's rows, as `aggregates.axis_of` finds it."""
    return f"""{name}m AS (SELECT track_id, atan2(median(sin(2 * yaw)), median(cos(2 * yaw))) / 2 AS m FROM {source} GROUP BY 1),
{name}c AS (SELECT track_id, any_value(m) AS m, round(sum({_AX.format(a="yaw", b="m")}), 6) AS own, round(sum({_AX.format(a="yaw", b="(m + pi() / 2)")}), 6) AS quarter FROM {source} JOIN {name}m USING (track_id) GROUP BY track_id),
{name} AS (SELECT track_id, fmod(fmod(CASE WHEN own <= quarter THEN m ELSE m + pi() / 2 END, pi()) + pi(), pi()) AS axis FROM {name}c)"""


@query("geometry_union_box", f"""{_ALL}, p AS (SELECT frame_id, a, b, x, y, dx, dy, yaw, x2, y2, dx2, dy2, yaw2 FROM (SELECT iou.frame_id, iou.a, iou.b, fx AS x, fy AS y, 2 * fw AS dx, 2 * fh AS dy, atan2(fs, fc) AS yaw, gx AS x2, gy AS y2, 2 * gw AS dx2, 2 * gh AS dy2, atan2(gs, gc) AS yaw2 FROM iou WHERE round(iou, 6) > 0.0001)),
u AS (SELECT *, CASE WHEN {_AX.format(a="yaw", b="yaw2")} <= pi() / 6 THEN CASE WHEN greatest(dx, dy) >= greatest(dx2, dy2) THEN yaw ELSE yaw2 END ELSE atan2(y2 - y, x2 - x) END AS g FROM p),
v AS (SELECT *, x * cos(g) + y * sin(g) AS a1, y * cos(g) - x * sin(g) AS b1, x2 * cos(g) + y2 * sin(g) AS a2, y2 * cos(g) - x2 * sin(g) AS b2, (dx * abs(cos(yaw - g)) + dy * abs(sin(yaw - g))) / 2 AS u1, (dx * abs(sin(yaw - g)) + dy * abs(cos(yaw - g))) / 2 AS v1,
 (dx2 * abs(cos(yaw2 - g)) + dy2 * abs(sin(yaw2 - g))) / 2 AS u2, (dx2 * abs(sin(yaw2 - g)) + dy2 * abs(cos(yaw2 - g))) / 2 AS v2 FROM u)
SELECT frame_id, a AS det_a, b AS det_b, {r("greatest(a1 + u1, a2 + u2) - least(a1 - u1, a2 - u2)", 3, "dx")}, {r("greatest(b1 + v1, b2 + v2) - least(b1 - v1, b2 - v2)", 3, "dy")} FROM v""")
def geometry_union_box(spark, sf):
    b = _boxes(spark, sf)
    d = overlap.overlaps(b, b, ordered=True).where(F.round("iou", 6) > 0.0001)
    box = lambda s: {k: F.col(f"{s}_{k}") for k in ("x", "y", "dx", "dy", "yaw")}
    u = shapes.union_box(box("a"), box("b"))
    return rounded(d.select("frame_id", F.col("a_det_idx").alias("det_a"), F.col("b_det_idx").alias("det_b"), u["dx"].alias("dx"), u["dy"].alias("dy")), 3)


@query("geometry_split_long", f"""WITH {TRACKED}, l AS (SELECT *, dx > 9 AS far FROM trk), t AS (SELECT track_id, (SELECT max(track_id) FROM trk) + row_number() OVER (ORDER BY track_id) AS tail_id FROM (SELECT DISTINCT track_id FROM l WHERE far)),
p AS (SELECT event_id, track_id, 0 AS tail, x + CASE WHEN far THEN (dx - 6) / 2 ELSE 0 END * cos(yaw) AS x, CASE WHEN far THEN 6 ELSE dx END AS dx FROM l UNION ALL SELECT event_id, tail_id, 1, x - 3 * cos(yaw), dx - 6 FROM l JOIN t USING (track_id) WHERE far)
SELECT event_id, track_id, tail, {r("x")}, {r("dx")} FROM p""")
def geometry_split_long(spark, sf):
    return rounded(shapes.long_boxes_split(tracked(spark, sf), 9.0, 6.0).select("event_id", "track_id", "tail", "x", "dx"))


@query("yaw_common_axis", f"""WITH {TRACKED}, a AS (SELECT track_id, fmod(yaw, pi()) AS a FROM trk), n AS (SELECT track_id, floor(a / 0.1) AS b, count(*) AS votes, avg(a) AS axis FROM a GROUP BY 1, 2),
k AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY votes DESC, b) AS i FROM n) SELECT track_id, {r("axis")}, votes FROM k WHERE i = 1""")
def yaw_common_axis(spark, sf):
    return rounded(shapes.common_axis(tracked(spark, sf), 0.1))


@query("track_long_side", f"WITH {TRACKED}, m AS (SELECT track_id, greatest(dx, dy) AS l, median(greatest(dx, dy)) OVER (PARTITION BY track_id) AS m FROM trk) SELECT track_id, any_value(m) AS long, count(*) FILTER (l >= 0.9 * m) AS near FROM m GROUP BY 1")
def track_long_side(spark, sf):
    return rounded(shapes.long_side(tracked(spark, sf), 0.9))


@query("track_stacked_box", f"WITH {TRACKED}, {_axis('trk', 'ax')}, s AS (SELECT track_id, {', '.join(f'median({c}) AS {c}' for c in ('x', 'y', 'z', 'dx', 'dy', 'dz'))} FROM trk GROUP BY 1) SELECT track_id, {', '.join(r(c, 3) for c in ('x', 'y', 'z', 'dx', 'dy', 'dz', 'axis'))} FROM s JOIN ax USING (track_id)")
def track_stacked_box(spark, sf):
    return rounded(shapes.stacked(tracked(spark, sf)), 3)


_WQ = """{n}g AS (SELECT {by}, {v} AS v, sum({w}) AS w FROM {src} WHERE {w} > 0 GROUP BY 1, 2), {n}c AS (SELECT {by}, v, (sum(w) OVER (PARTITION BY {by} ORDER BY v) - w / 2) / sum(w) OVER (PARTITION BY {by}) AS c FROM {n}g),
{n}l AS (SELECT *, lag(v) OVER (PARTITION BY {by} ORDER BY v) AS pv, lag(c) OVER (PARTITION BY {by} ORDER BY v) AS pc FROM {n}c),
{n} AS (SELECT {by}, coalesce(arg_min(CASE WHEN pc IS NULL THEN v ELSE pv + (v - pv) * ({q} - pc) / (c - pc) END, c) FILTER (c >= {q}), max(v)) AS quantile FROM {n}l GROUP BY 1)"""


@query("track_agreed_sizes", f"""WITH {TRACKED}, m AS (SELECT *, median(dx) OVER (PARTITION BY track_id) AS m, count(dx) OVER (PARTITION BY track_id) AS n FROM trk), i AS (SELECT * FROM m WHERE abs(dx - m) <= 0.45 * m),
{_WQ.format(n="q", by="track_id", v="dx", w="(score + 1)", src="i", q=0.5)}, e AS (SELECT track_id, count(*) AS inliers, any_value(n) AS n FROM i GROUP BY 1)
SELECT track_id, {r("least(greatest(quantile, 3), 9)", 4, "size")}, inliers FROM q JOIN e USING (track_id) WHERE inliers >= 2 AND inliers >= 0.4 * n""")
def track_agreed_sizes(spark, sf):
    return rounded(shapes.agreed_sizes(tracked(spark, sf), "dx", F.col("score") + 1, 0.45, 0.4, 2, 3.0, 9.0))


@query("class_sizes", f"""WITH {TRACKED}, a AS (SELECT * FROM trk WHERE class_name = 'Car'), b AS (SELECT * FROM trk WHERE class_name = 'Truck'), {_WQ.format(n="p", by="class_name", v="dx", w="score", src="a", q=0.7)}, {_WQ.format(n="q", by="class_name", v="dx", w="score", src="b", q=0.9)}
SELECT class_name, {r("least(greatest(quantile, 2), 7)", 4, "size")} FROM p UNION ALL SELECT class_name, {r("least(greatest(quantile, 5), 9.5)", 4, "size")} FROM q""")
def class_sizes(spark, sf):
    return rounded(shapes.class_sizes(tracked(spark, sf), "dx", F.col("score"), {"Car": 0.7, "Truck": 0.9}, {"Car": (2.0, 7.0), "Truck": (5.0, 9.5)}))


_STATIC = f"{TRACKED}, {_axis('trk', 'fa')}, inn AS (SELECT trk.* FROM trk JOIN fa USING (track_id) WHERE {_AX.format(a='yaw', b='axis')} <= 0.35), {_axis('inn', 'na')}, ct AS (SELECT track_id, count(*) AS n FROM inn GROUP BY 1), sa AS (SELECT track_id, coalesce(na.axis, fa.axis) AS axis, coalesce(n, 0) AS inliers FROM fa LEFT JOIN na USING (track_id) LEFT JOIN ct USING (track_id))"
_VOTES = f"vt AS (SELECT track_id, any_value(axis) AS axis, count(*) FILTER ({_TURN.format(a='yaw', b='axis')} <= pi() / 2) AS ahead, count(*) FILTER ({_TURN.format(a='yaw', b='axis')} > pi() / 2) AS behind FROM trk JOIN sa USING (track_id) GROUP BY 1), vh AS (SELECT *, CASE WHEN ahead + behind >= 4 AND abs(ahead - behind) >= 0.15 * (ahead + behind) THEN CASE WHEN ahead >= behind THEN axis ELSE axis + pi() END END AS heading FROM vt)"


def _axes(d):
    return shapes.static_axes(d, 0.35)


@query("yaw_static_axes", f"WITH {_STATIC} SELECT track_id, {r('axis', 3)}, inliers FROM sa")
def yaw_static_axes(spark, sf):
    return rounded(_axes(tracked(spark, sf)), 3)


@query("yaw_directions", f"WITH {_STATIC}, {_VOTES} SELECT track_id, {r('axis', 3)}, {r('heading', 3)}, ahead, behind FROM vh")
def yaw_directions(spark, sf):
    d = tracked(spark, sf)
    return rounded(shapes.directions(d, _axes(d), 4, 0.15), 3)


@query("yaw_settled", f"""WITH {_STATIC}, {_VOTES}, dw AS (SELECT DISTINCT track_id, t_us FROM trk WHERE dx < 5), e AS (SELECT trk.*, dw.track_id IS NOT NULL AS inside, coalesce(heading, CASE WHEN {_TURN.format(a='yaw', b='axis')} <= pi() / 2 THEN axis ELSE axis + pi() END) AS g FROM trk LEFT JOIN dw USING (track_id, t_us) LEFT JOIN vh USING (track_id))
SELECT event_id, {r("cos(CASE WHEN inside THEN g ELSE yaw END)", 3, "c")}, {r("sin(CASE WHEN inside THEN g ELSE yaw END)", 3, "s")} FROM e""")
def yaw_settled(spark, sf):
    d = tracked(spark, sf)
    s = shapes.settled(d, shapes.directions(d, _axes(d), 4, 0.15), d.where("dx < 5"))
    return rounded(s.select("event_id", F.cos("yaw").alias("c"), F.sin("yaw").alias("s")), 3)


@query("yaw_turned_about", f"""WITH {TRACKED}, w AS (SELECT track_id, arg_max(x, (t_us, event_id)) - arg_min(x, (t_us, event_id)) AS wx, arg_max(y, (t_us, event_id)) - arg_min(y, (t_us, event_id)) AS wy FROM trk GROUP BY 1),
e AS (SELECT event_id, yaw + CASE WHEN sqrt(wx * wx + wy * wy) >= 10 AND {_TURN.format(a='yaw', b='atan2(wy, wx)')} > pi() / 2 THEN pi() ELSE 0 END AS g FROM trk JOIN w USING (track_id)) SELECT event_id, {r("cos(g)", 3, "c")}, {r("sin(g)", 3, "s")} FROM e""")
def yaw_turned_about(spark, sf):
    return rounded(shapes.turned_about(tracked(spark, sf), 10.0).select("event_id", F.cos("yaw").alias("c"), F.sin("yaw").alias("s")), 3)


@query("yaw_of_steps", f"""WITH {TRACKED}, s AS (SELECT event_id, x - lag(x) OVER w AS sx, y - lag(y) OVER w AS sy, dx < dy AS wide FROM trk {_T}), g AS (SELECT event_id, CASE WHEN sqrt(sx * sx + sy * sy) >= 20 THEN atan2(sy, sx) - CASE WHEN wide THEN pi() / 2 ELSE 0 END END AS g FROM s)
SELECT event_id, {r("cos(g)", 3, "c")}, {r("sin(g)", 3, "s")} FROM g""")
def yaw_of_steps(spark, sf):
    return rounded(shapes.step_yaws(tracked(spark, sf), 20.0).select("event_id", F.cos("target").alias("c"), F.sin("target").alias("s")), 3)
