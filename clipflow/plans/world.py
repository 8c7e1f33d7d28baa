"""Queries on points in boxes and on boxes placed in the world, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.functions.rotations import matrix
from clipflow.operators import filters, points, world
from clipflow.plans.catalog import HARD, _HARD, query, r, rounded
from clipflow.sources.tables import TRACKED, clip_poses, cloud, tracked

_INSIDE = "abs((px - x) * cos(yaw) + (py - y) * sin(yaw)) <= dx / 2 AND abs((py - y) * cos(yaw) - (px - x) * sin(yaw)) <= dy / 2 AND abs(pz - z) <= dz / 2"
_COUNTED = f"""{TRACKED}, pts AS (SELECT frame_id, x + (k - 1) * 0.7::DOUBLE AS px, y + (k - 1) * 0.4::DOUBLE AS py, z + (k - 1) * 0.45::DOUBLE AS pz FROM trk, range(3) t(k)),
cnt AS (SELECT b.frame_id, event_id, count(*) AS n, min(pz) AS low, max(pz) AS high FROM trk b JOIN pts p ON b.frame_id = p.frame_id AND {_INSIDE} GROUP BY 1, 2),
cb AS (SELECT trk.*, coalesce(n, 0) AS n_points, low, high FROM trk LEFT JOIN cnt USING (frame_id, event_id))"""
_KEYS = ("frame_id", "event_id")


def _counted(spark, sf, *more):
    """Boxes with these columns besides their keys and sizes, and with what the points in them say."""
    return points.counted(tracked(spark, sf).select(*_KEYS, "x", "y", "z", "dx", "dy", "dz", "yaw", *more), cloud(spark, sf, dealt=True), _KEYS)


@query("points_in_boxes", f"WITH {_COUNTED} SELECT frame_id, event_id, n_points, {r('low')}, {r('high')} FROM cb")
def points_in_boxes(spark, sf):
    return rounded(_counted(spark, sf).select(*_KEYS, "n_points", "low", "high"))


@query("filter_sparse", f"""WITH {_COUNTED}, {_HARD.replace('FROM box)', 'FROM cb)')}, g AS (SELECT frame_id, event_id, CASE WHEN n_points <= 1 THEN list_append(reasons, 'sparse_points') ELSE reasons END AS reasons FROM f)
SELECT frame_id, event_id, array_to_string(reasons, ',') AS reasons, reasons[1] AS first_reason, len(reasons) = 0 AS kept FROM g""")
def filter_sparse(spark, sf):
    f = points.sparse_filtered(_counted(spark, sf, "class_name", "score"), HARD, 1)
    return f.select(*_KEYS, F.array_join("reasons", ",").alias("reasons"), F.col("primary").alias("first_reason"), "kept")


@query("filter_final", f"""WITH {_COUNTED}, d AS (SELECT * FROM cb WHERE n_points > 1), l AS (SELECT track_id FROM d GROUP BY 1 HAVING count(DISTINCT frame_id) > 350)
SELECT frame_id, event_id FROM d SEMI JOIN l USING (track_id) WHERE class_name = 'Car'""")
def filter_final(spark, sf):
    return points.finally_filtered(_counted(spark, sf, "track_id", "class_name"), 1, 350, "Car").select(*_KEYS)


@query("fit_bottom", f"""WITH {_COUNTED}, g AS (SELECT *, z + dz / 2 AS top, z - dz / 2 AS bottom FROM cb), h AS (SELECT *, top - greatest(low - 0.01, bottom) AS hh FROM g),
o AS (SELECT *, coalesce(class_name = 'Truck' AND abs(dz - 1.7) <= 0.11 AND low - bottom > 1e-6 AND hh >= 1.2, false) AS fits FROM h)
SELECT frame_id, event_id, round(CASE WHEN fits THEN hh ELSE dz END, 4) + 0.0 AS dz, round(CASE WHEN fits THEN top - hh / 2 ELSE z END, 4) + 0.0 AS z FROM o""")
def fit_bottom(spark, sf):
    return rounded(points.bottom_fitted(_counted(spark, sf, "class_name"), "Truck", 1.7, 0.11, 1.2, 0.01).select(*_KEYS, "dz", "z"))


@query("fit_top", f"""WITH {_COUNTED}, g AS (SELECT *, greatest(dz, 1.9) AS tall FROM cb), h AS (SELECT *, CASE WHEN low - (high - tall) > 0.05 THEN least(low - (high - tall), 0.2) ELSE 0 END AS up, coalesce(class_name = 'Pedestrian' AND n_points >= 2, false) AS fits FROM g)
SELECT frame_id, event_id, round(CASE WHEN fits THEN tall - up ELSE dz END, 4) + 0.0 AS dz, round(CASE WHEN fits THEN high - (tall - up) / 2 ELSE z END, 4) + 0.0 AS z FROM h""")
def fit_top(spark, sf):
    return rounded(points.top_fitted(_counted(spark, sf, "class_name"), "Pedestrian", 2, 1.9, 0.2, 0.05).select(*_KEYS, "dz", "z"))


@query("points_occlusion", f"WITH {_COUNTED} SELECT frame_id, event_id, round(CASE WHEN n_points = 0 THEN 1 ELSE 1 - least(1, greatest(0, (high - low) / dz)) END, 4) + 0.0 AS occluded FROM cb")
def points_occlusion(spark, sf):
    return rounded(points.occlusion(_counted(spark, sf)).select(*_KEYS, "occluded"))


@query("track_heights", f"WITH {_COUNTED} SELECT track_id, round(coalesce(median(high - low) FILTER (high - low BETWEEN 0.5 AND 1.2), median(dz), 1.5), 4) + 0.0 AS height FROM cb GROUP BY 1")
def track_heights(spark, sf):
    return rounded(points.track_heights(_counted(spark, sf, "track_id"), 0.5, 1.2, 1.5))


@query("fit_z", f"""WITH {_COUNTED}, m AS (SELECT *, CASE WHEN low IS NULL THEN 'raw' WHEN abs(high - low - 1.0) <= 0.15 THEN 'both' WHEN abs(low - (z - dz / 2)) <= 0.15 THEN 'ground' WHEN abs(high - (z + dz / 2)) <= 0.15 THEN 'roof' ELSE 'raw' END AS mode FROM cb),
n AS (SELECT *, CASE mode WHEN 'both' THEN (low + high) / 2 WHEN 'ground' THEN low + 0.5 WHEN 'roof' THEN high - 0.5 ELSE z END AS nz FROM m) SELECT frame_id, event_id, mode, round(CASE WHEN abs(nz - z) <= 0.03 THEN z ELSE nz END, 4) + 0.0 AS z FROM n""")
def fit_z(spark, sf):
    return rounded(points.z_fitted(_counted(spark, sf), 1.0, 0.15).select(*_KEYS, "mode", "z"))


_POSES = "pose AS (SELECT o_custkey % 10 AS clip, o_orderkey * 200000 + 70000 AS t_us, o_totalprice::DOUBLE / 1000 AS px, o_custkey::DOUBLE / 10 AS py, 1.0::DOUBLE AS pz, (o_orderkey % 3) / 10.0::DOUBLE AS qx, 0.0::DOUBLE AS qy, sin((o_orderkey % 63) / 20.0::DOUBLE) AS qz, cos((o_orderkey % 63) / 20.0::DOUBLE) AS qw FROM orders)"
_U = lambda s, k: f"{s}.{k} / sqrt({s}.qx ** 2 + {s}.qy ** 2 + {s}.qz ** 2 + {s}.qw ** 2)"
_M = [["1 - 2 * (qy * qy + qz * qz)", "2 * (qx * qy - qz * qw)", "2 * (qx * qz + qy * qw)"], ["2 * (qx * qy + qz * qw)", "1 - 2 * (qx * qx + qz * qz)", "2 * (qy * qz - qx * qw)"], ["2 * (qx * qz - qy * qw)", "2 * (qy * qz + qx * qw)", "1 - 2 * (qx * qx + qy * qy)"]]
_WORLD = f"""{TRACKED}, {_POSES}, fr AS (SELECT *, track_id % 10 AS clip FROM trk WHERE class_name IN ('Car', 'Truck')),
ab AS (SELECT fr.*, a.clip IS NOT NULL AS has_a, b.clip IS NOT NULL AS has_b, a.t_us AS t_a, b.t_us AS t_b, {', '.join(f'coalesce(a.{k}, b.{k}) AS a{k}, coalesce(b.{k}, a.{k}) AS b{k}' for k in ('px', 'py', 'pz'))},
 {', '.join(f'coalesce({_U("a", k)}, {_U("b", k)}) AS a{k}, coalesce({_U("b", k)}, {_U("a", k)}) AS b{k}' for k in ('qx', 'qy', 'qz', 'qw'))} FROM fr ASOF LEFT JOIN pose a ON fr.clip = a.clip AND fr.t_us >= a.t_us ASOF LEFT JOIN pose b ON fr.clip = b.clip AND fr.t_us <= b.t_us),
al AS (SELECT *, CASE WHEN NOT has_a OR NOT has_b OR t_b - t_a <= 0 THEN 0 WHEN t_b - t_a > 3000000 THEN CASE WHEN 2 * (t_us - t_a) <= t_b - t_a THEN 0 ELSE 1 END ELSE (t_us - t_a) / (t_b - t_a)::DOUBLE END AS alpha, aqx * bqx + aqy * bqy + aqz * bqz + aqw * bqw AS dot FROM ab WHERE has_a OR has_b),
an AS (SELECT *, abs(dot) > 0.9995 AS close, acos(least(abs(dot), 1)) AS angle, CASE WHEN dot < 0 THEN -1 ELSE 1 END AS sg FROM al),
fs AS (SELECT *, CASE WHEN close THEN 1 - alpha ELSE sin((1 - alpha) * angle) / sin(angle) END AS f1, sg * CASE WHEN close THEN alpha ELSE sin(alpha * angle) / sin(angle) END AS f2 FROM an),
rw AS (SELECT *, {', '.join(f'a{k} * f1 + b{k} * f2 AS r{k}' for k in ('qx', 'qy', 'qz', 'qw'))} FROM fs),
nm AS (SELECT *, sqrt(rqx ** 2 + rqy ** 2 + rqz ** 2 + rqw ** 2) AS norm FROM rw),
qn AS (SELECT *, {', '.join(f'r{k} / norm AS {k}' for k in ('qx', 'qy', 'qz', 'qw'))}, {', '.join(f'a{k} * (1 - alpha) + b{k} * alpha AS {k}' for k in ('px', 'py', 'pz'))} FROM nm),
mt AS (SELECT *, {', '.join(f'{_M[i][j]} AS m{i}{j}' for i in range(3) for j in range(3))} FROM qn),
wo AS (SELECT *, m00 * x + m01 * y + m02 * z + px AS wx, m10 * x + m11 * y + m12 * z + py AS wy, m20 * x + m21 * y + m22 * z + pz AS wz, atan2(m10 * cos(yaw) + m11 * sin(yaw), m00 * cos(yaw) + m01 * sin(yaw)) AS wyaw FROM mt)"""


def _world(spark, sf):
    d = tracked(spark, sf).withColumn("clip", F.col("track_id") % 10)
    return world.observations_of(d, clip_poses(spark, sf), "clip", ("Car", "Truck"), 3_000_000)


@query("world_observations", f"WITH {_WORLD} SELECT event_id, track_id, {r('wx', 3)}, {r('wy', 3)}, {r('wz', 3)}, {r('cos(wyaw)', 3, 'c')}, {r('sin(wyaw)', 3, 's')} FROM wo")
def world_observations(spark, sf):
    return rounded(_world(spark, sf).select("event_id", "track_id", "wx", "wy", "wz", F.cos("wyaw").alias("c"), F.sin("wyaw").alias("s")), 3)


@query("geometry_yaw_from_world", f"""WITH {_WORLD}, iv AS (SELECT *, cos(yaw / 2) AS u, sin(yaw / 2) AS v, m00 * m11 - m01 * m10 AS det FROM wo),
h AS (SELECT event_id, atan2(sign(det) * (m00 * v - m10 * u), sign(det) * (m11 * u - m01 * v)) AS back FROM iv) SELECT event_id, {r('cos(back)', 3, 'c')}, {r('sin(back)', 3, 's')} FROM h""")
def geometry_yaw_from_world(spark, sf):
    m = matrix(tuple(F.col(k) for k in ("qx", "qy", "qz", "qw")))
    d = _world(spark, sf).withColumn("back", world.yaw_from_world(m, F.col("yaw") / 2))
    return rounded(d.select("event_id", F.cos("back").alias("c"), F.sin("back").alias("s")), 3)


_BASE = ((0.0, -1.0, 0.0, 1.5), (1.0, 0.0, 0.0, 0.0), (0.0, 0.0, 1.0, 2.0))


@query("geometry_to_base", f"""WITH {TRACKED} SELECT event_id, CASE class_name WHEN 'Car' THEN 'vehicle' ELSE 'walker' END AS class_name, {r('1.5 - y', 5, 'bx')}, {r('x', 5, 'by_')}, {r('z + 2', 5, 'bz')}, {r('cos(yaw)', 5, 's')} FROM trk WHERE class_name IN ('Car', 'Pedestrian')""")
def geometry_to_base(spark, sf):
    d = world.to_base(tracked(spark, sf), _BASE, {"Car": "vehicle", "Pedestrian": "walker"})
    return rounded(d.select("event_id", "class_name", "bx", F.col("by").alias("by_"), "bz", F.sin("byaw").alias("s")), 5)


@query("convert_bottom_centres", f"WITH {TRACKED} SELECT event_id, {r('z + dz / 2', 4, 'z')} FROM trk")
def convert_bottom_centres(spark, sf):
    return rounded(world.centred(tracked(spark, sf)).select("event_id", "z"))


@query("filter_class_view", f"""WITH {TRACKED}, v AS (SELECT frame_id, CASE class_name WHEN 'Pedestrian' THEN 'Truck' ELSE class_name END AS class_name FROM trk), s AS (SELECT frame_id, count(*) AS n FROM v WHERE class_name = 'Car' GROUP BY 1)
SELECT frame_id, coalesce(n, 0) AS n FROM (SELECT DISTINCT frame_id FROM trk) LEFT JOIN s USING (frame_id)""")
def filter_class_view(spark, sf):
    d = filters.class_view(tracked(spark, sf), ("Car",), {"Pedestrian": "Truck"})
    return d.groupBy("frame_id").agg(F.count("det_idx").alias("n"))
