"""Queries on oriented boxes that overlap, with the SQL that says the same by corners and crossing sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.operators import overlap
from clipflow.plans.catalog import query, r, rounded
from clipflow.sources.tables import BOXES, boxes, tracked

_SHAPE = "greatest(dx / 2, 0.5e-3) AS w, greatest(dy / 2, 0.5e-3) AS h, cos(yaw) AS c, sin(yaw) AS s"


def overlap_sql(left: str, right: str, on: str) -> str:
    """CTEs that end in iou(frame_id, a, b, ta, tb, ca, cb, na, nb, inter, iou, cover) of the overlapping boxes of two relations."""
    corner = lambda p, u, v: f"{p}x + {u} * {p}w * {p}c - {v} * {p}h * {p}s AS x{u[1]}, {p}y + {u} * {p}w * {p}s + {v} * {p}h * {p}c AS y{u[1]}"
    side = lambda p: f"{corner(p, 'u0', 'v0')}, {corner(p, 'u1', 'v1')}"
    within = lambda p: f"abs((x0 - {p}x) * {p}c + (y0 - {p}y) * {p}s) <= {p}w + 1e-9 AND abs((y0 - {p}y) * {p}c - (x0 - {p}x) * {p}s) <= {p}h + 1e-9"
    own = lambda t, p: ", ".join(f"{t}.{k} AS {p}{k}" for k in "xywhcs")
    return f"""lb AS (SELECT *, {_SHAPE} FROM {left}), rb AS (SELECT *, {_SHAPE} FROM {right}),
pr AS (SELECT row_number() OVER () AS pid, p.frame_id, p.det_idx AS a, q.det_idx AS b, p.track_id AS ta, q.track_id AS tb, p.class_name AS ca, q.class_name AS cb, p.n_points AS na, q.n_points AS nb, sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2) AS apart, {own("p", "f")}, {own("q", "g")}
 FROM lb p JOIN rb q ON p.frame_id = q.frame_id AND {on} AND sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2) <= (sqrt(p.dx ** 2 + p.dy ** 2) + sqrt(q.dx ** 2 + q.dy ** 2)) / 2 + 0.002),
e(u0, v0, u1, v1) AS (VALUES (1, 1, -1, 1), (-1, 1, -1, -1), (-1, -1, 1, -1), (1, -1, 1, 1)),
ea AS (SELECT pid, {side("f")} FROM pr, e), eb AS (SELECT pid, {side("g")} FROM pr, e),
xs AS (SELECT ea.pid, ea.x0, ea.y0, ea.x1, ea.y1, (ea.x1 - ea.x0) * (eb.y1 - eb.y0) - (ea.y1 - ea.y0) * (eb.x1 - eb.x0) AS turn,
 (eb.x0 - ea.x0) * (eb.y1 - eb.y0) - (eb.y0 - ea.y0) * (eb.x1 - eb.x0) AS t, (eb.x0 - ea.x0) * (ea.y1 - ea.y0) - (eb.y0 - ea.y0) * (ea.x1 - ea.x0) AS u FROM ea JOIN eb USING (pid)),
pt AS (SELECT pid, x0 AS x, y0 AS y FROM ea JOIN pr USING (pid) WHERE {within("g")}
 UNION ALL SELECT pid, x0, y0 FROM eb JOIN pr USING (pid) WHERE {within("f")}
 UNION ALL SELECT pid, x0 + t / turn * (x1 - x0), y0 + t / turn * (y1 - y0) FROM xs WHERE abs(turn) > 1e-12 AND t / turn BETWEEN 0 AND 1 AND u / turn BETWEEN 0 AND 1),
am AS (SELECT *, avg(x) OVER (PARTITION BY pid) AS mx, avg(y) OVER (PARTITION BY pid) AS my FROM pt),
rg AS (SELECT pid, x - mx AS x, y - my AS y, atan2(y - my, x - mx) AS g, row_number() OVER () AS k FROM am),
nx AS (SELECT pid, x, y, coalesce(lead(x) OVER o, first_value(x) OVER o) AS x1, coalesce(lead(y) OVER o, first_value(y) OVER o) AS y1 FROM rg WINDOW o AS (PARTITION BY pid ORDER BY g, k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
ar AS (SELECT pid, abs(sum(x * y1 - y * x1)) / 2 AS inter FROM nx GROUP BY pid),
iou AS (SELECT pr.*, inter, CASE WHEN 4 * (fw * fh + gw * gh) - inter <= 1e-9 THEN 0 ELSE least(1, inter / (4 * (fw * fh + gw * gh) - inter)) END AS iou, inter / (4 * fw * fh) AS cover FROM pr JOIN ar USING (pid) WHERE inter > 1e-9)"""


_BOX = f"{BOXES}, tr AS (SELECT *, det_idx * 3 % 7 AS n_points FROM box)"
_ALL = f"WITH RECURSIVE {_BOX}, {overlap_sql('tr', 'tr', 'p.det_idx < q.det_idx')}"
_CAR_TRUCK = f"WITH {_BOX}, {overlap_sql('(SELECT * FROM tr WHERE class_name = $$Car$$)', '(SELECT * FROM tr WHERE class_name = $$Truck$$)', 'true')}"


def _boxes(spark, sf):
    return boxes(spark, sf).withColumn("n_points", F.col("det_idx") * 3 % 7)


@query("geometry_oriented_overlap", f"{_ALL} SELECT frame_id, a AS det_a, b AS det_b, {r('iou')}, {r('cover')} FROM iou WHERE round(iou, 6) > 0.0001")
def geometry_oriented_overlap(spark, sf):
    b = _boxes(spark, sf)
    d = overlap.overlaps(b, b, ordered=True).where(F.round("iou", 6) > 0.0001)
    return rounded(d.select("frame_id", F.col("a_det_idx").alias("det_a"), F.col("b_det_idx").alias("det_b"), "iou", "cover"))


_LIFE = "l AS (SELECT class_name, track_id, count(DISTINCT frame_id) AS life FROM tr WHERE class_name IN ('Car', 'Truck') GROUP BY 1, 2)"


@query("join_absorbed_tracks", f"""{_CAR_TRUCK}, {_LIFE}, p AS (SELECT DISTINCT ta, tb FROM iou WHERE round(iou, 6) >= 0.6),
g AS (SELECT CASE WHEN a.life >= b.life THEN 'Truck' ELSE 'Car' END AS class_name, CASE WHEN a.life >= b.life THEN tb ELSE ta END AS track_id FROM p JOIN l a ON a.class_name = 'Car' AND a.track_id = ta JOIN l b ON b.class_name = 'Truck' AND b.track_id = tb)
SELECT frame_id, det_idx, class_name, track_id FROM tr ANTI JOIN g USING (class_name, track_id)""")
def join_absorbed_tracks(spark, sf):
    return overlap.absorbed(_boxes(spark, sf), "Car", "Truck", 0.6).select("frame_id", "det_idx", "class_name", "track_id")


@query("join_covered_boxes", f"{_CAR_TRUCK} SELECT frame_id, det_idx FROM tr ANTI JOIN (SELECT frame_id, a AS det_idx FROM iou WHERE cover > 0.5) USING (frame_id, det_idx)")
def join_covered_boxes(spark, sf):
    return overlap.covered_boxes_dropped(_boxes(spark, sf), "Car", "Truck", 0.5).select("frame_id", "det_idx")


@query("join_matched_tracks", f"{_CAR_TRUCK} SELECT frame_id, det_idx FROM tr ANTI JOIN (SELECT ta AS track_id, 'Car' AS class_name FROM iou WHERE iou >= 0.5) USING (track_id, class_name)")
def join_matched_tracks(spark, sf):
    return overlap.matched_tracks_dropped(_boxes(spark, sf), "Car", "Truck", 0.5).select("frame_id", "det_idx")


@query("join_tracks_covered_by_trucks", f"{_CAR_TRUCK} SELECT frame_id, det_idx FROM tr ANTI JOIN (SELECT ta AS track_id, 'Car' AS class_name FROM iou WHERE cover >= 0.9) USING (track_id, class_name)")
def join_tracks_covered_by_trucks(spark, sf):
    return overlap.matched_tracks_dropped(_boxes(spark, sf), "Car", "Truck", 0.9, "cover").select("frame_id", "det_idx")


@query("join_same_objects", f"""{_ALL}, ev AS (SELECT least(ta, tb) AS a, greatest(ta, tb) AS b, max(iou) AS best, max(iou) FILTER (ca <> cb) AS mixed, count(*) FILTER (iou >= 0.25) AS moderate, count(*) FILTER (apart <= 0.8) AS near
 FROM iou WHERE ta <> tb AND ca IN ('Car', 'Truck') AND cb IN ('Car', 'Truck') GROUP BY 1, 2),
k AS (SELECT a, b FROM ev WHERE best >= 0.5 OR mixed >= 0.6 OR moderate >= 2 OR near >= 2), k2 AS (SELECT a, b FROM k UNION SELECT b, a FROM k),
rc AS (SELECT a AS n, a AS m FROM k2 UNION SELECT rc.n, k2.b FROM rc JOIN k2 ON rc.m = k2.a), rt AS (SELECT n AS track_id, min(m) AS root FROM rc GROUP BY n),
w AS (SELECT track_id, count(DISTINCT frame_id) AS life, max(CASE class_name WHEN 'Car' THEN 1 ELSE 2 END) AS size, round(median(score), 6) AS score FROM tr WHERE class_name IN ('Car', 'Truck') GROUP BY 1),
z AS (SELECT root, arg_max(track_id, (life, size, score, -track_id)) AS kept_id FROM rt JOIN w USING (track_id) GROUP BY root) SELECT track_id, kept_id FROM rt JOIN z USING (root)""")
def join_same_objects(spark, sf):
    return overlap.same_objects(_boxes(spark, sf))


@query("filter_fewer_points", f"""{_ALL}, c AS (SELECT frame_id, list({{'a': a, 'b': b, 'l': CASE WHEN na < nb THEN a ELSE b END}} ORDER BY a, b) AS ps FROM iou WHERE iou > 0.02 AND na <> nb GROUP BY frame_id),
g AS (SELECT frame_id, ps, 1 AS i, []::INT[] AS gone FROM c UNION ALL SELECT frame_id, ps, i + 1, CASE WHEN list_contains(gone, ps[i].a) OR list_contains(gone, ps[i].b) THEN gone ELSE list_append(gone, ps[i].l) END FROM g WHERE i <= len(ps)),
x AS (SELECT frame_id, unnest(gone) AS det_idx FROM g WHERE i = len(ps) + 1) SELECT frame_id, det_idx, n_points FROM tr ANTI JOIN x USING (frame_id, det_idx)""")
def filter_fewer_points(spark, sf):
    return overlap.fewer_points_dropped(_boxes(spark, sf), 0.02).select("frame_id", "det_idx", "n_points")


@query("filter_steady_spinners", f"""WITH tb AS (SELECT l_suppkey::BIGINT AS track_id, l_orderkey::BIGINT AS frame_id, l_orderkey::BIGINT * 200000 AS t_us, (l_orderkey::BIGINT * 10 + l_linenumber) * 100000000 + round(l_extendedprice * 100)::BIGINT AS event_id, (l_linenumber / 10.0)::DOUBLE AS x, (l_tax * 2)::DOUBLE AS y, 4.5::DOUBLE AS dx, 2.0::DOUBLE AS dy, l_tax::DOUBLE * 30 AS yaw FROM lineitem),
cl AS (SELECT track_id, frame_id, t_us, event_id, x, y, dx, dy, yaw, {_SHAPE} FROM tb), lg AS (SELECT *, lag(event_id) OVER (PARTITION BY track_id ORDER BY t_us, event_id) AS prev FROM cl),
tr AS (SELECT event_id AS frame_id, 1 AS det_idx, track_id, 'Car' AS class_name, 0 AS n_points, x, y, dx, dy, yaw FROM tb), t2 AS (SELECT g.event_id AS frame_id, 2 AS det_idx, p.track_id, 'Car' AS class_name, 0 AS n_points, p.x, p.y, p.dx, p.dy, p.yaw FROM lg g JOIN tb p ON p.event_id = g.prev),
{overlap_sql('tr', 't2', 'true')}, j AS (SELECT l.track_id, l.event_id, l.prev, coalesce(iou, 0) AS iou FROM lg l LEFT JOIN iou ON iou.frame_id = l.event_id),
m AS (SELECT track_id, median(x) AS mx, median(y) AS my FROM tb GROUP BY 1), rr AS (SELECT track_id, max(sqrt((x - mx) ** 2 + (y - my) ** 2)) AS radius FROM tb JOIN m USING (track_id) GROUP BY 1),
mi AS (SELECT track_id, avg(iou) AS mean_iou FROM j WHERE prev IS NOT NULL GROUP BY 1),
sp AS (SELECT track_id, count(*) AS n_obs, count(*) FILTER (least(fmod(abs(yaw - py), pi()), pi() - fmod(abs(yaw - py), pi())) >= 0.8) AS flips FROM (SELECT *, lag(yaw) OVER (PARTITION BY track_id ORDER BY t_us, event_id) AS py FROM tb) GROUP BY 1),
ua AS (SELECT DISTINCT track_id, fmod(yaw, pi()) AS a FROM tb), ws AS (SELECT p.track_id, max(least(abs(p.a - q.a), pi() - abs(p.a - q.a))) AS span FROM ua p JOIN ua q USING (track_id) GROUP BY 1)
SELECT track_id, n_obs, {r('radius')}, {r('mean_iou')}, {r('span')}, flips FROM sp JOIN ws USING (track_id) JOIN rr USING (track_id) JOIN mi USING (track_id) WHERE n_obs >= 5 AND span >= 1.3 AND flips >= 2 AND radius <= 3 AND mean_iou >= 0.35""")
def filter_steady_spinners(spark, sf):
    o = tracked(spark, sf).select("track_id", "frame_id", "t_us", "event_id", (F.col("det_idx") / 10.0).alias("x"), (F.col("z") / 5).alias("y"), F.lit(4.5).alias("dx"), F.lit(2.0).alias("dy"), "yaw")
    return rounded(overlap.steady_spinners(o, 5, 3.0, 0.35, 1.3, 0.8, 2))
