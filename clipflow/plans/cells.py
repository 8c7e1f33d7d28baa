"""Queries on regions of cells, merged chains and the contracts of stages, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.functions import boxes as box_functions
from clipflow.operators import cells, contracts, sorting
from clipflow.plans.catalog import query, r, rounded
from clipflow.sources.tables import OBSERVATIONS, TRACKED, observations, tracked

_CELLS = """{n}b AS (SELECT *, sqrt(dx * dx + dy * dy) / 2 + {m} AS reach FROM {src}), {n}x AS (SELECT *, unnest(range(floor((x - reach) / 1.0)::BIGINT, floor((x + reach) / 1.0)::BIGINT + 1)) AS cx FROM {n}b),
{n}y AS (SELECT *, unnest(range(floor((y - reach) / 1.0)::BIGINT, floor((y + reach) / 1.0)::BIGINT + 1)) AS cy FROM {n}x), {n}l AS (SELECT cx, cy, dx, dy, cx + 0.5 - x AS mx, cy + 0.5 - y AS my, yaw FROM {n}y),
{n} AS (SELECT DISTINCT cx, cy FROM {n}l WHERE abs(mx * cos(yaw) + my * sin(yaw)) <= dx / 2 + {m} + 1e-9 AND abs(my * cos(yaw) - mx * sin(yaw)) <= dy / 2 + {m} + 1e-9)"""
#: Few boxes, so that cells have gaps: the dear ones on the far side.
_FEW = "few AS (SELECT * FROM trk WHERE y > 55 AND class_name = 'Car')"
_SWEPT = f"{TRACKED}, {_FEW}, {_CELLS.format(n='c', m='0.013', src='few')}"


def _few(spark, sf):
    return cells.swept(tracked(spark, sf).where("y > 55 AND class_name = 'Car'"), 1.0, 0.013)


@query("region_bounds", f"WITH {TRACKED}, b AS (SELECT min(x) - 2 AS x0, min(y) - 2 AS y0, max(x) + 2 AS x1, max(y) + 2 AS y1 FROM trk) SELECT {r('x0')}, {r('y0')}, (ceil((x1 - x0) / 0.7) + 1)::BIGINT AS nx, (ceil((y1 - y0) / 0.7) + 1)::BIGINT AS ny FROM b")
def region_bounds(spark, sf):
    return rounded(cells.bounds(tracked(spark, sf), 2.0, 0.7))


@query("region_swept_cells", f"WITH {_SWEPT} SELECT cx, cy FROM c")
def region_swept_cells(spark, sf):
    return _few(spark, sf)


_DISC = ", ".join(f"({i}, {j})" for i, j in cells.disc(2))
_DILATED = f"k(i, j) AS (VALUES {_DISC}), d AS (SELECT DISTINCT cx + i AS cx, cy + j AS cy FROM c, k)"


@query("region_dilated", f"WITH {_SWEPT}, {_DILATED} SELECT cx, cy FROM d")
def region_dilated(spark, sf):
    return cells.dilated(_few(spark, sf), 2)


@query("region_closed", f"WITH {_SWEPT}, {_DILATED}, e AS (SELECT cx + i AS cx, cy + j AS cy, count(*) AS n FROM d, k GROUP BY 1, 2) SELECT cx, cy FROM e SEMI JOIN d USING (cx, cy) WHERE n = {len(cells.disc(2))}")
def region_closed(spark, sf):
    return cells.closed(_few(spark, sf), 2)


@query("region_components", f"""WITH RECURSIVE {_SWEPT}, n AS (SELECT p.cx * 1000 + p.cy AS a, q.cx * 1000 + q.cy AS b FROM c p JOIN c q ON abs(p.cx - q.cx) <= 1 AND abs(p.cy - q.cy) <= 1),
u AS (SELECT a, b FROM n UNION SELECT u.a, n.b FROM u JOIN n ON u.b = n.a), g AS (SELECT a, min(b) AS root FROM u GROUP BY 1), s AS (SELECT root, count(*) AS size FROM g GROUP BY 1) SELECT size, count(*) AS n FROM s WHERE size >= 12 GROUP BY 1""")
def region_components(spark, sf):
    return cells.components(_few(spark, sf), 12).groupBy("root").agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("n"))


@query("region_contains", f"WITH {_SWEPT} SELECT event_id, c.cx IS NOT NULL AS inside FROM trk LEFT JOIN c ON floor(x) = c.cx AND floor(y) = c.cy")
def region_contains(spark, sf):
    return cells.contained(tracked(spark, sf), _few(spark, sf), 1.0).select("event_id", "inside")


@query("region_share_near", f"""WITH {TRACKED}, s AS (SELECT DISTINCT x, y FROM trk WHERE class_name = 'Truck' AND dx > 10.5), h AS (SELECT DISTINCT event_id FROM trk JOIN s ON sqrt((trk.x - s.x) ** 2 + (trk.y - s.y) ** 2) <= 1.5)
SELECT track_id, {r("avg(CASE WHEN h.event_id IS NULL THEN 0 ELSE 1 END)", 4, "share")} FROM trk LEFT JOIN h USING (event_id) GROUP BY 1""")
def region_share_near(spark, sf):
    d = tracked(spark, sf)
    return rounded(cells.share_near(d, d.where("class_name = 'Truck' AND dx > 10.5"), 1.5))


@query("region_polygons", f"""WITH {OBSERVATIONS} SELECT event_id, abs((x - 500) + 0.5 * (y - 50)) <= 200.0000001 AND abs((y - 50) - 0.5 * (x - 500)) <= 150.0000001 AS inside, 96000.0::DOUBLE AS area FROM obs WHERE x IS NOT NULL AND y IS NOT NULL""")
def region_polygons(spark, sf):
    # the parallelogram |u| <= 200, |v| <= 150 with u = dx + dy / 2, v = dy - dx / 2
    at = lambda u, v: F.struct(F.lit(500 + (u - v / 2) / 1.25).alias("x"), F.lit(50 + (v + u / 2) / 1.25).alias("y"))
    polygon = F.array(at(200, 150), at(-200, 150), at(-200, -150), at(200, -150))
    o = observations(spark, sf).where("x IS NOT NULL AND y IS NOT NULL")
    return rounded(o.select("event_id", cells.in_polygon(polygon, F.col("x"), F.col("y")).alias("inside"), box_functions.area(polygon).alias("area")))


@query("region_extended", f"""WITH {TRACKED}, w AS (SELECT track_id, arg_min(x, event_id) AS x0, arg_min(y, event_id) AS y0, arg_max(x, event_id) AS x1, arg_max(y, event_id) AS y1 FROM trk GROUP BY 1), h AS (SELECT *, atan2(y1 - y0, x1 - x0) AS h FROM w)
SELECT track_id, {r("x1 + k * cos(h)", 3, "x")}, {r("y1 + k * sin(h)", 3, "y")} FROM h, range(1, 31) t(k) UNION ALL SELECT track_id, {r("x0 - k * cos(h)", 3, "x")}, {r("y0 - k * sin(h)", 3, "y")} FROM h, range(1, 31) t(k)""")
def region_extended(spark, sf):
    d = tracked(spark, sf)
    ends = d.groupBy("track_id").agg(*(f(c, "event_id").alias(c + n) for n, f in (("0", F.min_by), ("1", F.max_by)) for c in ("x", "y")))
    h = F.atan2(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))
    return rounded(cells.extended(d, ends.withColumns({"h0": h, "h1": h}), 30.0, 1.0), 3)


@query("sort_ids_around_used", f"""WITH {TRACKED}, u AS (SELECT DISTINCT track_id * 3 AS new_id FROM trk WHERE track_id % 2 = 0), k AS (SELECT frame_id, row_number() OVER (ORDER BY frame_id) AS i FROM (SELECT DISTINCT frame_id FROM trk)),
f AS (SELECT v AS new_id, row_number() OVER (ORDER BY v) AS i FROM range(5, (SELECT max(frame_id) * 2 + 100000 FROM trk)) t(v) ANTI JOIN u ON u.new_id = t.v) SELECT frame_id, new_id FROM k JOIN f USING (i)""")
def sort_ids_around_used(spark, sf):
    d = tracked(spark, sf)
    return sorting.dense_ids(d, "frame_id", 5, d.where("track_id % 2 = 0").select((F.col("track_id") * 3).alias("new_id")))


@query("merge_chains", f"""WITH {TRACKED}, l AS (SELECT frame_id, CASE class_name WHEN 'Car' THEN 0 WHEN 'Truck' THEN 1 ELSE 2 END AS chain, event_id AS place, CASE WHEN det_idx = 3 THEN 900001 ELSE det_idx % 3 END::BIGINT AS obj_id FROM trk),
a AS (SELECT *, row_number() OVER (PARTITION BY frame_id, obj_id ORDER BY chain, place) > 1 AS again FROM l), k AS (SELECT *, CASE WHEN again THEN row_number() OVER (PARTITION BY frame_id, again ORDER BY chain, place, obj_id) END AS k FROM a),
f AS (SELECT frame_id, v, row_number() OVER (PARTITION BY frame_id ORDER BY v) AS k FROM (SELECT DISTINCT frame_id FROM l) q, range(900000, 900032) t(v) WHERE NOT EXISTS (SELECT 1 FROM l u WHERE u.frame_id = q.frame_id AND u.obj_id = v))
SELECT k.frame_id, chain, place, obj_id, CASE WHEN again THEN f.v ELSE obj_id END AS new_id FROM k LEFT JOIN f ON f.frame_id = k.frame_id AND f.k = k.k""")
def merge_chains(spark, sf):
    chain = F.when(F.col("class_name") == "Car", 0).when(F.col("class_name") == "Truck", 1).otherwise(2).alias("chain")
    own = F.when(F.col("det_idx") == 3, 900_001).otherwise(F.col("det_idx") % 3).cast("long").alias("obj_id")
    return sorting.chains_merged(tracked(spark, sf).select("frame_id", chain, F.col("event_id").alias("place"), own), 900_000)


@query("contract_identity_only", f"WITH {TRACKED}, b AS (SELECT event_id, frame_id, x FROM trk), a AS (SELECT event_id, frame_id, CASE WHEN det_idx = 7 THEN x + 1 ELSE x END AS x FROM trk) SELECT *, 'before' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) UNION ALL SELECT *, 'after' FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)")
def contract_identity_only(spark, sf):
    before = tracked(spark, sf).select("event_id", "frame_id", "track_id", "x", "det_idx")
    after = before.withColumn("track_id", F.col("track_id") + 1).withColumn("x", F.when(F.col("det_idx") == 7, F.col("x") + 1).otherwise(F.col("x")))
    return contracts.changed_besides(before.drop("det_idx"), after.drop("det_idx"), ("track_id",))


@query("contract_frozen", f"WITH {TRACKED} SELECT event_id FROM trk WHERE class_name = 'Truck' AND (det_idx = 6 OR track_id % 50 = 0)")
def contract_frozen(spark, sf):
    before = tracked(spark, sf).select("event_id", "class_name", "x", "track_id", "det_idx")
    after = before.where("track_id % 50 <> 0").withColumn("x", F.when(F.col("det_idx") == 6, F.col("x") - 1).otherwise(F.col("x")))
    return contracts.frozen_broken(before, after, ("event_id",), F.col("class_name") == "Truck")


@query("contract_repeated_keys", f"WITH {TRACKED} SELECT frame_id, track_id, count(*) AS n FROM trk GROUP BY 1, 2 HAVING count(*) > 1")
def contract_repeated_keys(spark, sf):
    return contracts.repeated_keys(tracked(spark, sf), "frame_id", "track_id")


@query("contract_class_changes", f"WITH {TRACKED} SELECT event_id, class_name, CASE WHEN class_name = 'Car' THEN 'yaw' WHEN class_name = 'Truck' THEN 'dz' ELSE 'dz,yaw' END AS changed FROM trk WHERE det_idx = 3")
def contract_class_changes(spark, sf):
    before = tracked(spark, sf).select("event_id", "class_name", "dz", "yaw", "det_idx")
    after = before.withColumns({k: F.when(F.col("det_idx") == 3, F.col(k) + 1).otherwise(F.col(k)) for k in ("dz", "yaw")})
    return contracts.forbidden_changes(before.drop("det_idx"), after.drop("det_idx"), "event_id", {"Car": ("dz",), "Truck": ("yaw",)})
