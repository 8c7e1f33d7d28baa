"""Queries on boxes and fragments that take each other's place, on labels and on a camera's view, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.operators import alignment, filters, matching, points, stitching
from clipflow.operators.visibility import halved_up
from clipflow.plans.catalog import HOUR, query, r, rounded
from clipflow.plans.shapes import _AX
from clipflow.plans.signals import _PARTS, _STATES, _parts, _states
from clipflow.plans.world import _INSIDE
from clipflow.sources.tables import OBSERVATIONS, TRACKED, cloud, observations, tracked

_NEAR = _INSIDE.replace("/ 2", "/ 2 + 1e-6")
_T = "(PARTITION BY track_id ORDER BY t_us, event_id"


@query("filter_against_motion", f"""WITH {TRACKED}, u AS (SELECT *, atan2(y - lag(y) OVER w, x - lag(x) OVER w) AS u FROM trk WINDOW w AS {_T})),
s AS (SELECT event_id, yaw, coalesce(sum(cos(u)) OVER a, 0) + coalesce(sum(cos(u)) OVER b, 0) AS c, coalesce(sum(sin(u)) OVER a, 0) + coalesce(sum(sin(u)) OVER b, 0) AS s FROM u WINDOW a AS {_T} ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING), b AS {_T} ROWS BETWEEN 2 FOLLOWING AND 2 FOLLOWING))
SELECT event_id FROM s WHERE sqrt(c * c + s * s) <= 1e-6 OR {_AX.format(a="yaw", b="atan2(s, c)")} <= 1.05""")
def filter_against_motion(spark, sf):
    return matching.against_motion_dropped(tracked(spark, sf), 2, 1.05).select("event_id")


@query("join_restored_geometry", f"""WITH RECURSIVE {TRACKED}, d AS (SELECT frame_id, event_id AS place, class_name, x, y, dx FROM trk), raw AS (SELECT frame_id, event_id AS place, class_name, x + 1 AS x, y - 1 AS y, dx * 2 AS dx FROM trk),
n AS (SELECT d.frame_id, d.place, raw.place AS other, round(sqrt((d.x - raw.x) ** 2 + (d.y - raw.y) ** 2), 6) AS away FROM d JOIN raw USING (frame_id, class_name)), w AS (SELECT frame_id, place, list(other ORDER BY away, other) AS os FROM n WHERE away <= 6 GROUP BY 1, 2), o AS (SELECT *, row_number() OVER (PARTITION BY frame_id ORDER BY place) AS i FROM w),
g AS (SELECT frame_id, 0 AS i, NULL::BIGINT AS place, NULL::BIGINT AS other, []::BIGINT[] AS used FROM (SELECT DISTINCT frame_id FROM o) UNION ALL SELECT o.frame_id, o.i, o.place, list_filter(o.os, lambda v: NOT list_contains(used, v))[1], CASE WHEN list_filter(o.os, lambda v: NOT list_contains(used, v))[1] IS NULL THEN used ELSE list_append(used, list_filter(o.os, lambda v: NOT list_contains(used, v))[1]) END FROM g JOIN o ON o.frame_id = g.frame_id AND o.i = g.i + 1)
SELECT d.frame_id, d.place, {r("coalesce(raw.dx, d.dx)", 4, "dx")} FROM d LEFT JOIN (SELECT * FROM g WHERE other IS NOT NULL) m ON m.frame_id = d.frame_id AND m.place = d.place LEFT JOIN raw ON raw.frame_id = m.frame_id AND raw.place = m.other""")
def join_restored_geometry(spark, sf):
    d = tracked(spark, sf).select("frame_id", F.col("event_id").alias("place"), "class_name", "x", "y", "dx")
    raw = d.withColumns({"x": F.col("x") + 1, "y": F.col("y") - 1, "dx": F.col("dx") * 2})
    return rounded(matching.restored(d, raw, 6.0, ("dx",)).select("frame_id", "place", "dx"))


@query("join_anchors", f"""WITH {_PARTS}, e AS (SELECT track_id AS id, min(t_us) AS t0, max(t_us) AS t1, arg_min(x, (t_us, event_id)) AS x0, arg_min(y, (t_us, event_id)) AS y0, arg_max(x, (t_us, event_id)) AS x1, arg_max(y, (t_us, event_id)) AS y1 FROM pt GROUP BY 1),
p AS (SELECT a.id AS a, b.id AS b, round((a.t0 - b.t1) / 1e6 + sqrt((a.x0 - b.x1) ** 2 + (a.y0 - b.y1) ** 2), 6) AS score FROM e a JOIN e b ON a.id <> b.id AND a.t0 >= b.t1 AND a.t0 - b.t1 <= {3 * HOUR} AND sqrt((a.x0 - b.x1) ** 2 + (a.y0 - b.y1) ** 2) <= 60)
SELECT a, arg_min(b, (score, b)) AS b, {r("min(score)", 3, "score")} FROM p GROUP BY 1""")
def join_anchors(spark, sf):
    at = F.struct("t_us", "event_id")
    e = _parts(spark, sf).groupBy(F.col("track_id").alias("id")).agg(F.min("t_us").alias("t0"), F.max("t_us").alias("t1"), *(f(c, at).alias(c + n) for n, f in (("0", F.min_by), ("1", F.max_by)) for c in ("x", "y")))
    return rounded(matching.anchors(e, e, 3 * HOUR, 60.0).withColumn("score", halved_up("score", 3)), 3)


@query("export_label_ids", f"""WITH {TRACKED}, f AS (SELECT frame_id, event_id AS place, CASE WHEN det_idx = 2 THEN 't' || track_id ELSE track_id::VARCHAR END AS track FROM trk WHERE class_name = 'Truck'), l AS (SELECT frame_id, list(CASE WHEN try_cast(track AS BIGINT) IS NULL THEN 'x' || track ELSE (track::BIGINT + 1000)::VARCHAR END ORDER BY place) AS ids FROM f GROUP BY 1)
SELECT frame_id, coalesce(array_to_string(ids, ','), '') AS obj_ids FROM (SELECT DISTINCT frame_id FROM trk) LEFT JOIN l USING (frame_id)""")
def export_label_ids(spark, sf):
    d = tracked(spark, sf)
    track = F.when(F.col("det_idx") == 2, F.concat(F.lit("t"), F.col("track_id").cast("string"))).otherwise(F.col("track_id").cast("string"))
    rows = d.where("class_name = 'Truck'").select("frame_id", F.col("event_id").alias("place"), track.alias("track"))
    return matching.labels_of(d, rows, 1000).select("frame_id", F.array_join("obj_ids", ",").alias("obj_ids"))


@query("sink_upserted", f"WITH {TRACKED}, n AS (SELECT track_id, event_id, 1 AS part FROM trk WHERE class_name = 'Truck' AND dx > 10.9) SELECT track_id, event_id, 0 AS part FROM trk ANTI JOIN n USING (track_id) UNION ALL SELECT * FROM n")
def sink_upserted(spark, sf):
    d = tracked(spark, sf).select("track_id", "event_id", F.lit(0).alias("part"), "class_name", "dx")
    new = d.where("class_name = 'Truck' AND dx > 10.9").withColumn("part", F.lit(1))
    return matching.upserted(d.drop("class_name", "dx"), new.drop("class_name", "dx"), "track_id")


@query("signal_carried", f"WITH {_STATES} SELECT track_id, bin, last_value(state IGNORE NULLS) OVER (PARTITION BY track_id ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM st")
def signal_carried(spark, sf):
    return matching.carried(_states(spark, sf).withColumnRenamed("state", "seen"), "track_id", "seen").select("track_id", "bin", F.col("state").alias("carried"))


@query("camera_fisheye", f"""WITH {TRACKED}, t AS (SELECT event_id, x, z, y, sqrt(x * x + z * z) AS rr, atan2(sqrt(x * x + z * z), y) AS t FROM trk), b AS (SELECT *, t * (1 + t * t * (0.1 + t * t * (-0.02 + t * t * (0.003 - t * t * 0.0004)))) AS bent FROM t)
SELECT event_id, {r("CASE WHEN y > 0.1 THEN 100 * x * CASE WHEN rr > 1e-9 THEN bent / rr ELSE 1 / y END + 50 END", 3, "u")}, {r("CASE WHEN y > 0.1 THEN 90 * z * CASE WHEN rr > 1e-9 THEN bent / rr ELSE 1 / y END + 40 END", 3, "v")} FROM b""")
def camera_fisheye(spark, sf):
    u, v = matching.fisheye(F.col("x"), F.col("z"), F.col("y"), (100.0, 50.0, 90.0, 40.0), (0.1, -0.02, 0.003, -0.0004))
    return rounded(tracked(spark, sf).select("event_id", u.alias("u"), v.alias("v")), 3)


@query("join_seeds", f"""WITH {TRACKED}, n AS (SELECT a.event_id, count(DISTINCT b.frame_id) AS n_frames, max(b.t_us) - min(b.t_us) AS span_us FROM trk a JOIN trk b ON a.class_name = b.class_name AND abs(a.x - b.x) <= 0.8 AND abs(a.y - b.y) <= 0.8 AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 0.8 AND {_AX.format(a="a.yaw", b="b.yaw")} <= pi() / 6 GROUP BY 1)
SELECT event_id, n_frames, span_us FROM n WHERE n_frames >= 4 AND span_us >= 1200000""")
def join_seeds(spark, sf):
    return matching.seeds(tracked(spark, sf), 0.8, 4, 1_200_000)


@query("filter_unmoved_dropped", f"""WITH {OBSERVATIONS}, o AS (SELECT *, median(x) OVER (PARTITION BY track_id) AS mx, median(y) OVER (PARTITION BY track_id) AS my, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS s FROM obs WHERE class_name = 'click' WINDOW w AS {_T})),
t AS (SELECT track_id, count(*) AS n, sqrt((arg_max(x, (t_us, event_id)) - arg_min(x, (t_us, event_id))) ** 2 + (arg_max(y, (t_us, event_id)) - arg_min(y, (t_us, event_id))) ** 2) AS net, quantile_cont(sqrt((x - mx) ** 2 + (y - my) ** 2), 0.9) AS p90, max(s) AS step FROM o GROUP BY 1),
g AS (SELECT track_id FROM t WHERE NOT coalesce(n >= 12 AND (net >= 60 OR p90 >= 120 OR step >= 200), false)) SELECT event_id FROM obs WHERE class_name <> 'error' AND NOT (class_name = 'click' AND track_id IN (SELECT track_id FROM g))""")
def filter_unmoved_dropped(spark, sf):
    o = observations(spark, sf)
    return filters.low_confidence_dropped(o, ("error",), filters.unmoved_tracks(o, "click", 12, 60, 120, 200), "click").select("event_id")


@query("fill_holes_with_points", f"""WITH {TRACKED}, o AS (SELECT track_id, frame_id // 40 AS frame, {', '.join(f'avg({c}) AS {c}' for c in ('x', 'y', 'z', 'dx', 'dy', 'dz'))} FROM trk GROUP BY 1, 2), g AS (SELECT *, lead(frame) OVER w - frame AS gap, {', '.join(f'lead({c}) OVER w AS {c}1' for c in ('x', 'y', 'z', 'dx', 'dy', 'dz'))} FROM o WINDOW w AS (PARTITION BY track_id ORDER BY frame)), h AS (SELECT *, unnest(range(1, gap)) AS k FROM g WHERE gap > 1 AND gap <= 3),
f AS (SELECT track_id, frame + k AS frame, {', '.join(f'{c} + ({c}1 - {c}) * k / gap AS {c}' for c in ('x', 'y', 'z', 'dx', 'dy', 'dz'))}, 0.0::DOUBLE AS yaw FROM h), pts AS (SELECT frame_id // 40 AS frame, x + (k - 1) * 0.7::DOUBLE AS px, y + (k - 1) * 0.4::DOUBLE AS py, z + (k - 1) * 0.45::DOUBLE AS pz FROM trk, range(3) t(k))
SELECT track_id, f.frame, count(*) AS n_points FROM f JOIN pts p ON f.frame = p.frame AND {_NEAR} GROUP BY 1, 2 HAVING count(*) >= 2""")
def fill_holes_with_points(spark, sf):
    frame = F.floor(F.col("frame_id") / 40)
    d = tracked(spark, sf).withColumn("frame", frame)
    filled = stitching.holes_filled(d, "frame", 2, ("x", "y", "z", "dx", "dy", "dz")).withColumn("yaw", F.lit(0.0))
    counted = points.counted(filled, cloud(spark, sf).withColumn("frame", frame), ("frame", "track_id"), 1e-6)
    return counted.where("n_points >= 2").select("track_id", "frame", "n_points")


#: Tracks by their median place and the frames that they are in, as candidates and members.
@query("join_suppressed", f"""WITH RECURSIVE {TRACKED}, c AS (SELECT track_id AS id, median(x) AS x, median(y) AS y, row_number() OVER (ORDER BY count(*) DESC, track_id) AS place FROM trk GROUP BY 1), m AS (SELECT DISTINCT track_id AS id, frame_id % 3000 AS member FROM trk), z AS (SELECT id, count(*) AS n FROM m GROUP BY 1),
s AS (SELECT a.id AS a, b.id AS b, count(*) AS k FROM m a JOIN m b ON a.member = b.member AND a.id <> b.id GROUP BY 1, 2), o AS (SELECT a.id AS a, b.id AS b FROM c a JOIN c b ON a.id <> b.id WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 0.8 UNION SELECT s.a, s.b FROM s JOIN z p ON p.id = s.a JOIN z q ON q.id = s.b WHERE k >= 0.25 * least(p.n, q.n)),
g AS (SELECT b AS id, list(a) AS by_ FROM o GROUP BY 1), w AS (SELECT c.id, place, coalesce(by_, []) AS by_ FROM c LEFT JOIN g USING (id)),
t AS (SELECT 0::BIGINT AS place, []::BIGINT[] AS kept, 0::BIGINT AS id, 0::BIGINT AS leader UNION ALL SELECT w.place, CASE WHEN len(f) > 0 THEN kept ELSE list_append(kept, w.id) END, w.id, CASE WHEN len(f) > 0 THEN f[1] ELSE w.id END FROM (SELECT w.*, kept, list_filter(kept, lambda e: list_contains(w.by_, e)) AS f FROM t JOIN w ON w.place = t.place + 1) w)
SELECT id, leader FROM t WHERE place > 0""")
def join_suppressed(spark, sf):
    d = tracked(spark, sf)
    c = d.groupBy(F.col("track_id").alias("id")).agg(F.median("x").alias("x"), F.median("y").alias("y"), F.struct(-F.count("*"), F.col("track_id")).alias("place"))
    return matching.suppressed(c, d.select(F.col("track_id").alias("id"), (F.col("frame_id") % 3000).alias("member")), 0.8, 0.25)


_SLOTS = "sl AS (SELECT k AS slot, 4 * k - 20.0::DOUBLE AS pos FROM range(12) t(k))"


@query("row_matches", f"""WITH RECURSIVE {TRACKED}, {_SLOTS}, o AS (SELECT frame_id, y, row_number() OVER (PARTITION BY frame_id ORDER BY y, event_id) AS i FROM trk),
c AS (SELECT o.frame_id, o.i, list(CASE WHEN abs(y - pos) <= 5 THEN 1000 - round(abs(y - pos), 5) ELSE -1e9 END ORDER BY slot) AS w FROM o, sl GROUP BY ALL), z AS (SELECT frame_id, max(i) AS n FROM o GROUP BY 1),
d AS (SELECT DISTINCT frame_id, 0::BIGINT AS i, list_transform(range(13), lambda k: 0.0::DOUBLE) AS v FROM o UNION ALL
  SELECT frame_id, i, list_transform(range(13), lambda k: list_max(e[1:k + 1])) FROM (SELECT c.frame_id, c.i, list_transform(range(13), lambda k: CASE WHEN k = 0 THEN 0.0 ELSE greatest(v[k + 1], v[k] + w[k]) END) AS e FROM d JOIN c ON c.frame_id = d.frame_id AND c.i = d.i + 1))
SELECT frame_id, ceil(v[13] / 1000)::BIGINT AS n, {r('ceil(v[13] / 1000) * 1000 - v[13]', 5, 'cost')} FROM d JOIN z USING (frame_id) WHERE d.i = z.n AND v[13] > 0""")
def row_matches(spark, sf):
    slots = F.explode(F.filter(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda k: F.struct(k.cast("long").alias("slot"), (k * 4 - 20.0).alias("at"))), lambda s: F.abs(F.col("y") - s["at"]) <= 5))
    d = tracked(spark, sf).select("frame_id", F.struct("y", "event_id").alias("seen_at"), F.col("event_id").alias("seen"), "y", slots.alias("s"))
    pairs = d.select("frame_id", "seen", "seen_at", F.col("s.slot").alias("slot"), F.col("s.at").alias("slot_at"), F.round(F.abs(F.col("y") - F.col("s.at")), 5).alias("cost"))
    return rounded(alignment.row_matches(pairs, ("frame_id",)).groupBy("frame_id").agg(F.count("*").alias("n"), F.sum("cost").alias("cost")), 5)
