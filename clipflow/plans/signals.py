"""Queries on states over time and on fragments of tracks, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.operators import signals, stitching
from clipflow.operators.visibility import halved_up
from clipflow.plans.catalog import HOUR, query, r, rounded
from clipflow.sources.tables import OBSERVATIONS, TRACKED, observations, tracked

_BIN = 6 * HOUR
_W = "WINDOW w AS (PARTITION BY track_id ORDER BY t_us, event_id)"
#: The state of a track in six hours: the first event's name, unknown for views.
_STATES = f"{OBSERVATIONS}, st AS (SELECT track_id, floor(t_us / {_BIN})::BIGINT AS bin, CASE WHEN min(class_name) = 'view' THEN NULL ELSE min(class_name) END AS state FROM obs GROUP BY 1, 2)"


def _states(spark, sf):
    o = observations(spark, sf).groupBy("track_id", F.floor(F.col("t_us") / _BIN).alias("bin")).agg(F.min("class_name").alias("state"))
    return o.withColumn("state", F.when(F.col("state") != "view", F.col("state")))


@query("signal_projected", f"""WITH {OBSERVATIONS}, p AS (SELECT *, x * cos(0.5) + y * sin(0.5) AS ahead, y * cos(0.5) - x * sin(0.5) AS aside, (t_us - lag(t_us) OVER w) / 1e6 AS dt, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2) AS step FROM obs {_W}),
v AS (SELECT *, CASE WHEN dt > 0 THEN step / dt END AS v FROM p) SELECT event_id, floor(t_us / {HOUR})::BIGINT AS bin, {r("ahead")}, {r("aside")}, {r("coalesce(v, CASE WHEN dt IS NULL THEN lead(v) OVER w END)", 6, "speed")} FROM v {_W}""")
def signal_projected(spark, sf):
    d = signals.projected(observations(spark, sf), 0.5, HOUR)
    return d.select("event_id", "bin", *((F.round(c, n) + 0.0).alias(c) for c, n in (("ahead", 4), ("aside", 4), ("speed", 6))))


@query("signal_majority", f"""WITH {_STATES}, k AS (SELECT track_id, state, bin AS src, unnest(range(bin - 2, bin + 3)) AS bin FROM st WHERE state IS NOT NULL), v AS (SELECT track_id, bin, state, count(*) AS n, min(src) AS f FROM k GROUP BY 1, 2, 3),
b AS (SELECT track_id, bin, arg_max(state, (n, -f)) AS major FROM v GROUP BY 1, 2) SELECT track_id, bin, state, major FROM st LEFT JOIN b USING (track_id, bin)""")
def signal_majority(spark, sf):
    return signals.majority(_states(spark, sf), "track_id", 2).select("track_id", "bin", "state", "major")


@query("signal_hysteresis", f"""WITH RECURSIVE {_STATES}, o AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY bin) AS i FROM st),
h AS (SELECT track_id, bin, state, i, state AS steady, 1 AS n FROM o WHERE i = 1 UNION ALL SELECT o.track_id, o.bin, o.state, o.i, CASE WHEN (CASE WHEN o.state IS NOT DISTINCT FROM h.state THEN h.n + 1 ELSE 1 END) >= 2 THEN o.state ELSE h.steady END, CASE WHEN o.state IS NOT DISTINCT FROM h.state THEN h.n + 1 ELSE 1 END FROM h JOIN o ON o.track_id = h.track_id AND o.i = h.i + 1)
SELECT track_id, bin, state, steady FROM h""")
def signal_hysteresis(spark, sf):
    return signals.hysteresis(_states(spark, sf), "track_id", 2).select("track_id", "bin", "state", "steady")


@query("signal_intervals", f"""WITH {_STATES}, c AS (SELECT *, CASE WHEN row_number() OVER w > 1 AND lag(state) OVER w IS NOT DISTINCT FROM state THEN 0 ELSE 1 END AS new FROM st WINDOW w AS (PARTITION BY track_id ORDER BY bin)), g AS (SELECT *, sum(new) OVER (PARTITION BY track_id ORDER BY bin) AS run FROM c)
SELECT track_id, any_value(state) AS state, min(bin) AS first_bin, max(bin) AS last_bin, count(*) AS n FROM g GROUP BY track_id, run""")
def signal_intervals(spark, sf):
    return signals.intervals(_states(spark, sf), "track_id", "state")


@query("signal_crossings", f"""WITH RECURSIVE {OBSERVATIONS}, o AS (SELECT track_id, event_id, t_us, round(x, 2) AS ahead, row_number() OVER w AS i FROM obs WHERE x IS NOT NULL {_W}),
f AS (SELECT track_id, i, event_id, t_us, ahead AS anchor, false AS hit FROM o WHERE i = 1
 UNION ALL SELECT track_id, i, event_id, t_us, CASE WHEN fresh OR passed THEN ahead ELSE anchor END, passed FROM (SELECT *, NOT fresh AND ahead >= 60 AND ahead - anchor >= 25 AS passed FROM (SELECT o.*, f.anchor, o.t_us - f.t_us > {24 * HOUR} OR o.ahead <= 40 AS fresh FROM f JOIN o ON o.track_id = f.track_id AND o.i = f.i + 1)))
SELECT track_id, event_id FROM f WHERE hit""")
def signal_crossings(spark, sf):
    o = observations(spark, sf).where("x IS NOT NULL").withColumn("ahead", F.round("x", 2))
    return signals.crossings(o, 25.0, 24 * HOUR, 60.0, 20.0)


_FEATURES = f"""{OBSERVATIONS}, s AS (SELECT *, x - lag(x) OVER w AS sx, y - lag(y) OVER w AS sy FROM obs {_W}), h AS (SELECT *, atan2(sy, sx) AS h FROM s WHERE sqrt(sx * sx + sy * sy) >= 30),
t AS (SELECT *, fmod(fmod(h - lag(h) OVER w + pi(), 2 * pi()) + 2 * pi(), 2 * pi()) - pi() AS turn FROM h {_W}), z AS (SELECT *, last_value(CASE WHEN turn <> 0 THEN sign(turn) END IGNORE NULLS) OVER (PARTITION BY track_id ORDER BY t_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM t),
ft AS (SELECT track_id, arg_min(h, (t_us, event_id)) AS h0, arg_max(h, (t_us, event_id)) AS h1, coalesce(sum(turn), 0) AS cumulative, count(*) FILTER (sign(turn) * was < 0) AS changes, arg_min(x - sx, (t_us, event_id)) AS x0, arg_min(y - sy, (t_us, event_id)) AS y0, arg_max(x, (t_us, event_id)) AS x1, arg_max(y, (t_us, event_id)) AS y1 FROM z GROUP BY 1),
fe AS (SELECT track_id, fmod(fmod(h1 - h0 + pi(), 2 * pi()) + 2 * pi(), 2 * pi()) - pi() AS net_turn, cumulative, (y1 - y0) * cos(h0) - (x1 - x0) * sin(h0) AS offset_, changes FROM ft)"""


@query("track_turn_features", f"WITH {_FEATURES} SELECT track_id, {r('net_turn', 3)}, {r('cumulative', 3)}, {r('offset_', 3, 'aside')}, changes FROM fe")
def track_turn_features(spark, sf):
    return rounded(signals.turn_features(observations(spark, sf), 30.0).withColumnRenamed("offset", "aside"), 3)


@query("track_movements", f"""WITH {_FEATURES}, g AS (SELECT track_id, net_turn AS t, cumulative AS c, offset_ AS o FROM fe),
m AS (SELECT track_id, CASE WHEN t >= 1 THEN 2.0 WHEN t >= 0.3 THEN 1.0 ELSE 0 END + CASE WHEN c >= 1 THEN 1 ELSE 0 END + CASE WHEN o >= 40 THEN 0.5 ELSE 0 END AS l, CASE WHEN t <= -1 THEN 2.0 WHEN t <= -0.3 THEN 1.0 ELSE 0 END + CASE WHEN c <= -1 THEN 1 ELSE 0 END + CASE WHEN o <= -40 THEN 0.5 ELSE 0 END AS rt,
 CASE WHEN abs(t) < 0.3 THEN 2.0 ELSE 0 END + CASE WHEN abs(c) < 0.3 THEN 1 ELSE 0 END + CASE WHEN abs(o) < 40 THEN 0.5 ELSE 0 END AS s FROM g)
SELECT track_id, {r("l::DOUBLE", 1, "to_left")}, {r("rt::DOUBLE", 1, "to_right")}, {r("s::DOUBLE", 1, "straight")}, CASE WHEN s >= l AND s >= rt THEN 'straight' WHEN l >= rt THEN 'left' ELSE 'right' END AS movement FROM m""")
def track_movements(spark, sf):
    d = signals.movements(signals.turn_features(observations(spark, sf), 30.0), 1.0, 0.3, 40.0)
    return rounded(d.select("track_id", F.col("left").alias("to_left"), F.col("right").alias("to_right"), "straight", "movement"), 1)


@query("signal_axis_pairs", f"""WITH RECURSIVE {_FEATURES}, d AS (SELECT track_id AS id, round(net_turn, 6) AS h FROM fe), p AS (SELECT a.id AS a, b.id AS b, round(abs(fmod(fmod(a.h - b.h - pi() + pi(), 2 * pi()) + 2 * pi(), 2 * pi()) - pi()), 6) AS apart FROM d a JOIN d b ON a.id < b.id),
k AS (SELECT *, row_number() OVER (ORDER BY apart, a, b) AS i FROM p WHERE apart <= 0.4),
gt AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS used, 0::BIGINT AS a, 0::BIGINT AS b, 0.0::DOUBLE AS apart, false AS took UNION ALL SELECT k.i, CASE WHEN free THEN list_concat(used, [k.a, k.b]) ELSE used END, k.a, k.b, k.apart, free FROM (SELECT k.*, used, NOT list_contains(used, k.a) AND NOT list_contains(used, k.b) AS free FROM gt JOIN k ON k.i = gt.i + 1) k)
SELECT a, b, {r("apart", 4)} FROM gt WHERE took""")
def signal_axis_pairs(spark, sf):
    d = signals.turn_features(observations(spark, sf), 30.0).select(F.col("track_id").alias("id"), F.round("net_turn", 6).alias("heading"))
    return rounded(signals.axis_pairs(d, 0.4))


_WAYS = f"""{OBSERVATIONS}, wy AS (SELECT track_id AS id, track_id AS place, track_id % 2 AS clip, ['left', 'straight', 'u_turn', 'right'][track_id % 4 + 1] AS movement, round(atan2(arg_max(coalesce(y, 0), (t_us, event_id)) - arg_min(coalesce(y, 0), (t_us, event_id)), arg_max(x, (t_us, event_id)) - arg_min(x, (t_us, event_id))), 6) AS h, avg(x) AS x, avg(coalesce(y, 0)) AS y FROM obs WHERE x IS NOT NULL GROUP BY ALL),
wo AS (SELECT *, row_number() OVER (PARTITION BY clip ORDER BY place) AS i FROM wy),
ld AS (SELECT clip, i, [{{'id': id, 'h': h, 'x': x, 'y': y}}] AS l, id AS lead FROM wo WHERE i = 1 UNION ALL SELECT clip, i, CASE WHEN len(c) > 0 THEN l ELSE list_append(l, {{'id': id, 'h': h, 'x': x, 'y': y}}) END, CASE WHEN len(c) > 0 THEN c[1].id ELSE id END
 FROM (SELECT o.*, l, list_filter(l, lambda e: abs(fmod(fmod(o.h - e.h + pi(), 2 * pi()) + 2 * pi(), 2 * pi()) - pi()) <= 0.6 AND abs((o.x - e.x) * sin(e.h) - (o.y - e.y) * cos(e.h)) <= 30) AS c FROM ld JOIN wo o ON o.clip = ld.clip AND o.i = ld.i + 1)),
ways AS (SELECT wo.*, ld.lead FROM wo JOIN ld ON ld.clip = wo.clip AND ld.i = wo.i)"""


def _ways(spark, sf):
    o = observations(spark, sf).where("x IS NOT NULL").withColumn("y", F.coalesce("y", F.lit(0.0)))
    at = F.struct("t_us", "event_id")
    end = lambda f, c: f(c, at)
    name = F.element_at(F.array(*map(F.lit, ("left", "straight", "u_turn", "right"))), (F.col("id") % 4 + 1).cast("int"))
    h = F.round(F.atan2(end(F.max_by, "y") - end(F.min_by, "y"), end(F.max_by, "x") - end(F.min_by, "x")), 6)
    t = o.groupBy(F.col("track_id").alias("id")).agg(h.alias("heading"), F.avg("x").alias("x"), F.avg("y").alias("y"))
    return t.withColumns({"place": F.col("id"), "clip": F.col("id") % 2, "movement": name})


@query("signal_directions", f"WITH RECURSIVE {_WAYS} SELECT id, lead AS leader FROM ways")
def signal_directions(spark, sf):
    return signals.directions(_ways(spark, sf), ("clip",), 0.6, 30.0)


@query("signal_lanes", f"""WITH RECURSIVE {_WAYS}, dr AS (SELECT lead, atan2(sum(sin(h)), sum(cos(h))) AS hd, median(x) AS mx, median(y) AS my FROM ways GROUP BY 1 HAVING count(*) >= 2),
la AS (SELECT lead, CASE WHEN movement IN ('left', 'right') THEN movement ELSE 'straight' END AS movement, hd, (x - mx) * sin(hd) - (y - my) * cos(hd) AS aside FROM ways JOIN dr USING (lead)),
lb AS (SELECT lead, movement, any_value(hd) AS heading, median(aside) AS c, greatest(3.75, quantile_cont(aside, 0.98) - quantile_cont(aside, 0.02) + 1.875) AS width, count(*) AS n FROM la GROUP BY 1, 2),
lc AS (SELECT *, coalesce(max(c) FILTER (movement = 'straight') OVER (PARTITION BY lead), CASE WHEN count(*) OVER (PARTITION BY lead) > 1 THEN median(c) OVER (PARTITION BY lead) END) AS st FROM lb)
SELECT lead AS direction, movement, {r('heading', 3)}, {r('CASE WHEN st IS NULL THEN c WHEN movement = $$left$$ THEN least(c, st - 3.75) WHEN movement = $$right$$ THEN greatest(c, st + 3.75) ELSE c END', 3, 'centre')}, {r('width', 3)}, n FROM lc""")
def signal_lanes(spark, sf):
    t = _ways(spark, sf)
    named = t.join(signals.directions(t, ("clip",), 0.6, 30.0).withColumnRenamed("leader", "direction"), "id")
    return rounded(signals.lanes(named, 2, 3.75), 3)


@query("signal_phases", f"""WITH RECURSIVE {OBSERVATIONS}, sc AS (SELECT track_id, floor(t_us / {_BIN})::BIGINT AS bin, floor(avg(x) / 25)::DOUBLE AS s0, (5 - floor(avg(x) / 25))::DOUBLE AS s1, count(*)::DOUBLE AS s2 FROM obs GROUP BY 1, 2), o AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY bin) AS i FROM sc),
f AS (SELECT track_id, bin, i, s0 AS c0, s1 AS c1, s2 AS c2, 0 AS b0, 1 AS b1, 2 AS b2 FROM o WHERE i = 1
 UNION ALL SELECT track_id, bin, i, CASE WHEN c0 >= m - 2 THEN c0 ELSE m - 2 END + s0, CASE WHEN c1 >= m - 2 THEN c1 ELSE m - 2 END + s1, CASE WHEN c2 >= m - 2 THEN c2 ELSE m - 2 END + s2, CASE WHEN c0 >= m - 2 THEN 0 ELSE k END, CASE WHEN c1 >= m - 2 THEN 1 ELSE k END, CASE WHEN c2 >= m - 2 THEN 2 ELSE k END
 FROM (SELECT o.*, c0, c1, c2, greatest(c0, c1, c2) AS m, CASE WHEN c0 >= c1 AND c0 >= c2 THEN 0 WHEN c1 >= c2 THEN 1 ELSE 2 END AS k FROM f JOIN o ON o.track_id = f.track_id AND o.i = f.i + 1)),
z AS (SELECT track_id, max(i) AS n FROM o GROUP BY 1),
g AS (SELECT f.track_id, f.bin, f.i, CASE WHEN c0 >= c1 AND c0 >= c2 THEN 0 WHEN c1 >= c2 THEN 1 ELSE 2 END AS p FROM f JOIN z ON z.track_id = f.track_id AND z.n = f.i
 UNION ALL SELECT track_id, bin, i, p FROM (SELECT f.track_id, f.bin, f.i, CASE g.p WHEN 0 THEN t.b0 WHEN 1 THEN t.b1 ELSE t.b2 END AS p FROM g JOIN f ON f.track_id = g.track_id AND f.i = g.i - 1 JOIN f t ON t.track_id = g.track_id AND t.i = g.i))
SELECT track_id, bin, CASE p WHEN 0 THEN 'go' WHEN 1 THEN 'wait' ELSE 'turn' END AS phase FROM g""")
def signal_phases(spark, sf):
    level = F.floor(F.avg("x") / 25).cast("double")
    s = observations(spark, sf).groupBy("track_id", F.floor(F.col("t_us") / _BIN).alias("bin")).agg(level.alias("go"), (5 - level).alias("wait"), F.count("*").cast("double").alias("turn"))
    return signals.phases(s, "track_id", ("go", "wait", "turn"), 2.0)


_DAYS = 4 * 24 * HOUR
_PARTS = f"{OBSERVATIONS}, pt AS (SELECT event_id, track_id * 1000 + floor(t_us / {_DAYS})::BIGINT % 1000 AS track_id, t_us, x, y FROM obs WHERE x IS NOT NULL AND y IS NOT NULL)"
_CANDIDATES = f"""{_PARTS}, q AS (SELECT *, (t_us - min(t_us) OVER (PARTITION BY track_id)) / 1e6 AS t, row_number() OVER (PARTITION BY track_id ORDER BY t_us, event_id) AS i, row_number() OVER (PARTITION BY track_id ORDER BY t_us DESC, event_id DESC) AS j FROM pt),
e AS (SELECT track_id, min(t_us) AS t0, max(t_us) AS t1, arg_min(x, (t_us, event_id)) AS x0, arg_min(y, (t_us, event_id)) AS y0, arg_max(x, (t_us, event_id)) AS x1, arg_max(y, (t_us, event_id)) AS y1,
 CASE WHEN isfinite(regr_slope(x, t) FILTER (i <= 4)) THEN regr_slope(x, t) FILTER (i <= 4) ELSE 0 END AS vx0, CASE WHEN isfinite(regr_slope(y, t) FILTER (i <= 4)) THEN regr_slope(y, t) FILTER (i <= 4) ELSE 0 END AS vy0, CASE WHEN isfinite(regr_slope(x, t) FILTER (j <= 4)) THEN regr_slope(x, t) FILTER (j <= 4) ELSE 0 END AS vx1, CASE WHEN isfinite(regr_slope(y, t) FILTER (j <= 4)) THEN regr_slope(y, t) FILTER (j <= 4) ELSE 0 END AS vy1 FROM q GROUP BY 1),
p AS (SELECT a.track_id AS a, b.track_id AS b, (b.t0 - a.t1) / 1e6 AS gap, a.x1, a.y1, a.vx1, a.vy1, b.x0, b.y0, b.vx0, b.vy0 FROM e a JOIN e b ON a.track_id <> b.track_id AND b.t0 > a.t1 AND b.t0 - a.t1 <= {3 * HOUR}),
s AS (SELECT a, b, gap, sqrt((x1 + vx1 * gap - x0) ** 2 + (y1 + vy1 * gap - y0) ** 2) AS f, sqrt((x0 - vx0 * gap - x1) ** 2 + (y0 - vy0 * gap - y1) ** 2) AS k, 30 + 0.001 * gap + 0.12 * gap * sqrt(vx1 ** 2 + vy1 ** 2) AS gate FROM p),
cd AS (SELECT a, b, gap, round(f + k, 6) AS score FROM s WHERE f <= gate AND k <= gate)"""


def _parts(spark, sf):
    o = observations(spark, sf).where("x IS NOT NULL AND y IS NOT NULL")
    return o.withColumn("track_id", F.col("track_id") * 1000 + F.floor(F.col("t_us") / _DAYS) % 1000)


def _halved_up(d):
    """d with its gaps and scores to three places as in the SQL."""
    return rounded(d.withColumns({c: halved_up(c, 3) for c in ("gap", "score") if c in d.columns}), 3)


_GATE = stitching.Gate(3 * HOUR, 30.0, 0.001, 0.12)


def _pairs(spark, sf):
    return stitching.candidates(_parts(spark, sf), 3 * HOUR, 30.0, 0.001, 0.12)


@query("stitch_candidates", f"WITH {_CANDIDATES} SELECT a, b, {r('gap', 3)}, {r('score', 3)} FROM cd")
def stitch_candidates(spark, sf):
    return _halved_up(_pairs(spark, sf))


@query("stitch_mutual_best", f"""WITH {_CANDIDATES}, n AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score, b) AS i, row_number() OVER (PARTITION BY b ORDER BY score, a) AS j, lead(score) OVER (PARTITION BY a ORDER BY score, b) AS la, lead(score) OVER (PARTITION BY b ORDER BY score, a) AS lb FROM cd)
SELECT a, b, {r("score", 3)} FROM n WHERE i = 1 AND j = 1 AND (la IS NULL OR la - score >= 0.18) AND (lb IS NULL OR lb - score >= 0.18)""")
def stitch_mutual_best(spark, sf):
    return _halved_up(stitching.mutual_candidates(_parts(spark, sf), _GATE, 0.18))


@query("stitch_greedy", f"""WITH RECURSIVE {_CANDIDATES}, n AS (SELECT a, b, score, row_number() OVER (ORDER BY score, a, b) AS i FROM cd),
g AS (SELECT 0 AS i, []::BIGINT[] AS ua, []::BIGINT[] AS ub, false AS ok UNION ALL SELECT n.i, CASE WHEN list_contains(ua, a) OR list_contains(ub, b) THEN ua ELSE list_append(ua, a) END, CASE WHEN list_contains(ua, a) OR list_contains(ub, b) THEN ub ELSE list_append(ub, b) END, NOT (list_contains(ua, a) OR list_contains(ub, b)) FROM g JOIN n ON n.i = g.i + 1)
SELECT a, b, {r("score", 3)} FROM n JOIN g USING (i) WHERE ok""")
def stitch_greedy(spark, sf):
    return _halved_up(stitching.greedy_candidates(_parts(spark, sf), _GATE))


@query("fill_holes", f"""WITH {TRACKED}, o AS (SELECT track_id, frame_id // 40 AS frame, avg(x) AS x, avg(y) AS y FROM trk GROUP BY 1, 2), g AS (SELECT *, lead(frame) OVER w - frame AS gap, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM o WINDOW w AS (PARTITION BY track_id ORDER BY frame)), h AS (SELECT *, unnest(range(1, gap)) AS k FROM g WHERE gap > 1 AND gap <= 5)
SELECT track_id, frame + k AS frame, {r("x + (x1 - x) * k / gap + 1e-7", 3, "x")}, {r("y + (y1 - y) * k / gap + 1e-7", 3, "y")} FROM h""")
def fill_holes(spark, sf):
    d = tracked(spark, sf).withColumn("frame", F.floor(F.col("frame_id") / 40))
    filled = stitching.holes_filled(d, "frame", 4, ("x", "y"))
    return rounded(filled.select("track_id", "frame", (F.col("x") + 1e-7).alias("x"), (F.col("y") + 1e-7).alias("y")), 3)


@query("track_lateral_offsets", f"""WITH {OBSERVATIONS}, s AS (SELECT *, x - lag(x) OVER w AS sx, y - lag(y) OVER w AS sy FROM obs {_W}), a AS (SELECT *, coalesce(lag(sx) OVER w, lead(sx) OVER w) AS ax, coalesce(lag(sy) OVER w, lead(sy) OVER w) AS ay FROM s WHERE sx IS NOT NULL {_W})
SELECT track_id, {r("max(CASE WHEN sqrt(ax * ax + ay * ay) > 1e-9 THEN abs(sy * ax - sx * ay) / sqrt(ax * ax + ay * ay) ELSE 0 END)", 3, "worst")}, coalesce(max(CASE WHEN sqrt(ax * ax + ay * ay) > 1e-9 THEN abs(sy * ax - sx * ay) / sqrt(ax * ax + ay * ay) ELSE 0 END) <= 200, true) AS fits FROM a GROUP BY 1""")
def track_lateral_offsets(spark, sf):
    return rounded(stitching.lateral_offsets(observations(spark, sf), 200.0), 3)


@query("tracks_never_together", f"""WITH {OBSERVATIONS}, f AS (SELECT DISTINCT track_id, floor(t_us / {HOUR // 6})::BIGINT AS frame_id FROM obs), m AS (SELECT track_id, median(x) AS x, median(y) AS y FROM obs GROUP BY 1), p AS (SELECT a.track_id AS a, b.track_id AS b, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS apart FROM m a JOIN m b ON a.track_id < b.track_id AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 25)
SELECT a, b, {r("apart", 3)} FROM p ANTI JOIN (SELECT u.track_id AS a, v.track_id AS b FROM f u JOIN f v USING (frame_id)) USING (a, b)""")
def tracks_never_together(spark, sf):
    o = observations(spark, sf).withColumn("frame_id", F.floor(F.col("t_us") / (HOUR // 6)))
    return rounded(stitching.never_together(o, 25.0), 3)
