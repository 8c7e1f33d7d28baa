"""Queries on what cameras see of boxes, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.operators import visibility
from clipflow.plans.catalog import query, r, rounded
from clipflow.sources.tables import BOXES, boxes, cloud

#: Two cameras on one place, one looking along y, the other along x.
CAMERAS = (
    ("front", 0, (1.0, 0.0, 0.0, 0.5, 0.0, 0.0, -1.0, 1.5, 0.0, 1.0, 0.0, 6.0), (60.0, 64.0, 60.0, 48.0), (0.05, -0.01, 0.002, -0.0003), 128, 96),
    ("side", 1, (0.0, -1.0, 0.0, 0.0, 0.0, 0.0, -1.0, 1.5, 1.0, 0.0, 0.0, 8.0), (40.0, 48.0, 40.0, 36.0), (0.0, 0.0, 0.0, 0.0), 96, 72),
)
STEP = 4
_HALVES = "[" + ", ".join(f"{{'i': {i / 2}, 'j': {j / 2}, 'k': {k / 2}}}" for i, j, k in visibility._SIGNS) + "]"
_LIST = lambda v: "[" + ", ".join(f"{x}::DOUBLE" for x in v) + "]"
_CAMS = "cam AS (" + " UNION ALL ".join(f"SELECT '{n}' AS camera, {p} AS place, {_LIST(t)} AS t, {_LIST(k)} AS k, {_LIST(d)} AS d, {w} AS width, {h} AS height" for n, p, t, k, d, w, h in CAMERAS) + ")"
_MOVED = ", ".join(f"'{n}': t[{4 * i + 1}] * p.x + t[{4 * i + 2}] * p.y + t[{4 * i + 3}] * p.z + t[{4 * i + 4}]" for i, n in enumerate("xyz"))
_EDGES = "list_filter(flatten(list_transform({p}, lambda p: list_transform({p}, lambda q: {{'pu': p.u, 'pv': p.v, 'qu': q.u, 'qv': q.v}}))), lambda e: (e.pu <> e.qu OR e.pv <> e.qv) AND len(list_filter({p}, lambda r: (e.qu - e.pu) * (r.v - e.pv) - (e.qv - e.pv) * (r.u - e.pu) < 0)) = 0)"
_AT = f"(e.pu + (e.qu - e.pu) * (v * {STEP} - e.pv) / (e.qv - e.pv)::DOUBLE)"
_SPANS = """SELECT *, ceil(greatest(list_min(list_transform({p}, lambda p: p.u)), list_max(list_transform(list_filter({e}, lambda e: e.qv < e.pv), lambda e: {at}))) / {step}.0 - 1e-9)::BIGINT AS low,
 floor(least(list_max(list_transform({p}, lambda p: p.u)), list_min(list_transform(list_filter({e}, lambda e: e.qv > e.pv), lambda e: {at}))) / {step}.0 + 1e-9)::BIGINT AS high
 FROM (SELECT *, unnest(range(ceil(list_min(list_transform({p}, lambda p: p.v)) / {step}.0)::BIGINT, floor(list_max(list_transform({p}, lambda p: p.v)) / {step}.0)::BIGINT + 1)) AS v FROM h)"""
_SHARES = f"""{BOXES}, {_CAMS}, b0 AS (SELECT frame_id, det_idx, class_name, x, y, z, dx, dy, dz, yaw, y AS id FROM box),
b1 AS (SELECT *, list_transform({_HALVES}, lambda p: {{'x': x + p.i * dx * cos(yaw) - p.j * dy * sin(yaw), 'y': y + p.i * dx * sin(yaw) + p.j * dy * cos(yaw), 'z': z + p.k * dz}}) AS c FROM b0, cam),
b2 AS (SELECT *, list_transform(c, lambda p: {{{_MOVED}}}) AS a, t[9] * x + t[10] * y + t[11] * z + t[12] AS depth FROM b1),
b3 AS (SELECT *, list_transform(a, lambda p: {{'p': p, 'r': sqrt(p.x * p.x + p.y * p.y), 't': atan2(sqrt(p.x * p.x + p.y * p.y), p.z)}}) AS g FROM b2 WHERE len(list_filter(a, lambda p: p.z <= 0.1)) = 0),
b4 AS (SELECT *, list_transform(g, lambda q: {{'p': q.p, 's': CASE WHEN q.r > 1e-9 THEN q.t * (1 + q.t * q.t * (d[1] + q.t * q.t * (d[2] + q.t * q.t * (d[3] + q.t * q.t * d[4])))) / q.r ELSE 1 / q.p.z END}}) AS g2 FROM b3),
b5 AS (SELECT *, list_distinct(list_transform(g2, lambda q: {{'u': trunc((k[1] * q.p.x * q.s + k[2])::FLOAT)::BIGINT, 'v': trunc((k[3] * q.p.y * q.s + k[4])::FLOAT)::BIGINT}})) AS pts FROM b4),
b6 AS (SELECT *, {_EDGES.format(p='pts')} AS edges FROM b5), b7 AS (SELECT *, list_distinct(list_transform(CASE WHEN len(edges) > 0 THEN list_transform(edges, lambda e: {{'u': e.pu, 'v': e.pv}}) ELSE pts END, lambda p: {{'u': least(greatest(p.u, 0), width - 1)::BIGINT, 'v': least(greatest(p.v, 0), height - 1)::BIGINT}})) AS inn FROM b6),
h AS (SELECT frame_id, id, camera, place, depth, width, height, pts, edges, inn, {_EDGES.format(p='inn')} AS inner_edges FROM b7),
s0 AS (SELECT * FROM ({_SPANS.format(p='pts', e='edges', at=_AT, step=STEP)}) WHERE low <= high), s1 AS (SELECT * FROM ({_SPANS.format(p='inn', e='inner_edges', at=_AT, step=STEP)}) WHERE low <= high),
tot AS (SELECT frame_id, id, camera, sum(high - low + 1) AS total FROM s0 GROUP BY ALL),
z AS (SELECT frame_id, camera, u, v, min(depth) AS near FROM (SELECT *, unnest(range(greatest(low, 0), least(high, (width - 1) // {STEP}) + 1)) AS u FROM s0 WHERE v >= 0 AND v * {STEP} < height) GROUP BY ALL),
o AS (SELECT frame_id, id, camera, depth, v, unnest(range(low, high + 1)) AS u FROM s1),
c AS (SELECT frame_id, id, camera, count(*) AS n, count(*) FILTER (near <= depth - 0.3) AS hid FROM o LEFT JOIN z USING (frame_id, camera, u, v) GROUP BY ALL),
e AS (SELECT h.frame_id, h.id, h.camera, h.place, coalesce((coalesce(n, 0) - coalesce(hid, 0)) / total, 0.0) AS ratio, coalesce(coalesce(hid, 0) / total, 0.0) AS occluded, coalesce((total - coalesce(n, 0)) / total, 1.0) AS truncated FROM h LEFT JOIN tot USING (frame_id, id, camera) LEFT JOIN c USING (frame_id, id, camera)),
best AS (SELECT frame_id, id, arg_max({{'ratio': ratio, 'occluded': occluded, 'truncated': truncated, 'cam': camera}}, {{'r': ratio, 'p': -place}}) AS b FROM e GROUP BY ALL)"""


def _boxes(spark, sf):
    return boxes(spark, sf).withColumn("clip", F.lit(0)).withColumn("id", F.col("y"))


def _cameras(spark):
    return spark.createDataFrame([(0, n, p, list(t), list(k), list(d), w, h) for n, p, t, k, d, w, h in CAMERAS], "clip int, camera string, place int, t array<double>, k array<double>, d array<double>, width int, height int")


def _id():
    """The id to three places, halves of the product away from zero as in the SQL (Spark rounds the shortest decimal)."""
    return (F.signum("id") * F.floor(F.abs(F.col("id") * 1000) + 0.5) / 1000).alias("id")


@query("camera_shares", f"WITH {_SHARES} SELECT frame_id, {r('id', 3)}, camera, {r('ratio')}, {r('occluded')}, {r('truncated')} FROM e")
def camera_shares(spark, sf):
    e = visibility.in_cameras(_boxes(spark, sf), _cameras(spark), ("clip",), ("frame_id", "id"), STEP)
    return rounded(e.select("frame_id", _id(), "camera", *(visibility.halved_up(c, 4).alias(c) for c in ("ratio", "occluded", "truncated"))))


_POINTS = "pt AS (SELECT frame_id, x + k * 0.7 AS px, y + k * 0.4 AS py, z + k * 0.45 AS pz FROM box, (VALUES (-1), (0), (1)) AS ks(k))"


@query("camera_visible", f"""WITH {_SHARES}, {_POINTS}, sp AS (SELECT b0.frame_id, id, greatest(0, least(1, (max(pz) - min(pz)) / any_value(dz))) AS span FROM b0 JOIN pt ON pt.frame_id = b0.frame_id AND abs((px - x) * cos(yaw) + (py - y) * sin(yaw)) <= dx / 2 AND abs((py - y) * cos(yaw) - (px - x) * sin(yaw)) <= dy / 2 AND abs(pz - z) <= dz / 2 GROUP BY 1, 2),
g AS (SELECT b0.frame_id, b0.id, b.ratio, b.occluded, b.truncated, b.cam, 1 - coalesce(span, 0) AS gap FROM b0 LEFT JOIN best USING (frame_id, id) LEFT JOIN sp USING (frame_id, id)),
q AS (SELECT *, CASE WHEN occluded <= 0.01 THEN CASE WHEN 1 - gap > 0.9 THEN 0.0 ELSE greatest(occluded, gap) END ELSE occluded END AS gone, occluded <= 0.01 AS asked FROM g),
w AS (SELECT *, CASE WHEN asked THEN greatest(0.0, 1 - truncated - gone) ELSE ratio END AS share FROM q)
SELECT frame_id, {r('id', 3)}, CASE WHEN share >= 0.5 THEN 1 ELSE 2 END AS tag, {r('coalesce(share, 0.0)', 4, 'ratio')}, {r('coalesce(gone, 0.0)', 4, 'occluded')}, {r('coalesce(truncated, 1.0)', 4, 'truncated')}, cam AS best_cam FROM w WHERE round(coalesce(share, 0.0), 4) > 0.05""")
def camera_visible(spark, sf):
    points = cloud(spark, sf).withColumn("clip", F.lit(0))
    d = visibility.finally_visible(_boxes(spark, sf), _cameras(spark), ("clip",), ("frame_id", "id"), 0.05, points=points, step=STEP)
    return rounded(d.select("frame_id", _id(), "tag", "ratio", "occluded", "truncated", "best_cam"))
