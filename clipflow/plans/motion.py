"""Queries on motion within windows and sessions of a track, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.operators import windows
from clipflow.plans.catalog import HOUR, query, r, rounded
from clipflow.sources.tables import OBSERVATIONS, observations

_W = "WINDOW w AS (PARTITION BY track_id ORDER BY t_us, event_id)"
_XY = f"{OBSERVATIONS}, ob AS (SELECT * FROM obs WHERE x IS NOT NULL AND y IS NOT NULL)"
_SESSIONS = f"{_XY}, lt AS (SELECT *, CASE WHEN t_us - lag(t_us) OVER w > {12 * HOUR} THEN 1 ELSE 0 END AS late FROM ob {_W}), ss AS (SELECT *, sum(late) OVER w AS session FROM lt {_W})"


def _obs(spark, sf):
    return observations(spark, sf).where("x IS NOT NULL AND y IS NOT NULL")


@query("window_steady", f"""WITH {_XY}, n AS (SELECT *, row_number() OVER w AS i, x - lag(x) OVER w AS sx, y - lag(y) OVER w AS sy, (t_us - lag(t_us) OVER w) AS dt FROM ob {_W}), q AS (SELECT a.track_id, a.event_id, a.t_us, sum(sqrt(b.sx ** 2 + b.sy ** 2)) AS path, count(*) AS k, max(b.dt) AS gap, arg_max(b.x, b.i) - any_value(a.x) AS dx, arg_max(b.y, b.i) - any_value(a.y) AS dy, (max(b.t_us) - a.t_us) / 1e6 AS time, list({{'x': b.sx, 'y': b.sy}}) AS st
 FROM (SELECT track_id, event_id, t_us, x, y, i FROM n) a JOIN n b ON a.track_id = b.track_id AND b.i BETWEEN a.i + 1 AND a.i + 5 GROUP BY a.track_id, a.event_id, a.t_us),
ok AS (SELECT *, sqrt(dx * dx + dy * dy) AS net FROM q WHERE k = 5 AND path >= 100 AND gap <= {24 * HOUR} AND sqrt(dx * dx + dy * dy) >= 0.3 * path AND sqrt(dx * dx + dy * dy) >= 0.0001 * time AND len(list_filter(st, lambda s: s.x * dx + s.y * dy > 0)) >= 3)
SELECT track_id, arg_min(event_id, (t_us, event_id)) AS event_id, {r("arg_min(path, (t_us, event_id))", 3, "path")}, {r("arg_min(net, (t_us, event_id))", 3, "net")} FROM ok GROUP BY 1""")
def window_steady(spark, sf):
    return rounded(windows.steady_windows(_obs(spark, sf), 6, 100.0, 0.0001, 0.3, 3, 24 * HOUR), 3)


@query("window_sessions", f"WITH {_SESSIONS} SELECT event_id, session::BIGINT AS session FROM ss")
def window_sessions(spark, sf):
    return windows.sessions(_obs(spark, sf), 12 * HOUR).select("event_id", "session")


@query("window_session_headings", f"""WITH {_SESSIONS}, t AS (SELECT *, (t_us - min(t_us) OVER (PARTITION BY track_id, session)) / 1e6 AS t FROM ss),
v AS (SELECT event_id, regr_slope(x, t) OVER n AS vx, regr_slope(y, t) OVER n AS vy, sqrt((last_value(x) OVER n - first_value(x) OVER n) ** 2 + (last_value(y) OVER n - first_value(y) OVER n) ** 2) AS way FROM t WINDOW n AS (PARTITION BY track_id, session ORDER BY t_us, event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
SELECT event_id, {r("CASE WHEN isfinite(vx) AND sqrt(vx * vx + vy * vy) >= 0.0005 AND way >= 20 THEN cos(atan2(vy, vx)) END", 3, "c")} FROM v""")
def window_session_headings(spark, sf):
    d = windows.session_headings(_obs(spark, sf), 12 * HOUR, 3, 0.0005, 20.0)
    return rounded(d.select("event_id", F.cos("heading").alias("c")), 3)


@query("window_neighbour_headings", f"""WITH {_XY}, u AS (SELECT *, atan2(y - lag(y) OVER w, x - lag(x) OVER w) AS u FROM ob {_W}),
s AS (SELECT event_id, coalesce(sum(cos(u)) OVER a, 0) + coalesce(sum(cos(u)) OVER b, 0) AS c, coalesce(sum(sin(u)) OVER a, 0) + coalesce(sum(sin(u)) OVER b, 0) AS s FROM u WINDOW a AS (PARTITION BY track_id ORDER BY t_us, event_id ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING), b AS (PARTITION BY track_id ORDER BY t_us, event_id ROWS BETWEEN 2 FOLLOWING AND 2 FOLLOWING))
SELECT event_id, {r("CASE WHEN sqrt(c * c + s * s) > 1e-6 THEN cos(atan2(s, c)) END", 3, "c")} FROM s""")
def window_neighbour_headings(spark, sf):
    return rounded(windows.neighbour_headings(_obs(spark, sf), 2).select("event_id", F.cos("heading").alias("c")), 3)


_WLS = "sum(exp(-0.5 * ((b.t_us - a.t_us) / 1e6 / 43200) ** 2) * {})"
_DT = "((b.t_us - a.t_us) / 1e6)"
_FIT = lambda c: f"CASE WHEN n * tt - t * t > 1e-9 THEN ({c} * tt - t * t{c}) / (n * tt - t * t) ELSE {c} / n END"


@query("window_smoothed_places", f"""WITH {_SESSIONS}, k AS (SELECT *, row_number() OVER (PARTITION BY track_id, session ORDER BY t_us, event_id) AS i FROM ss),
m AS (SELECT a.event_id, any_value(a.x) AS x0, any_value(a.y) AS y0, {_WLS.format(1)} AS n, {_WLS.format(_DT)} AS t, {_WLS.format(f"{_DT} * {_DT}")} AS tt, {_WLS.format("b.x")} AS x, {_WLS.format(f"{_DT} * b.x")} AS tx, {_WLS.format("b.y")} AS y, {_WLS.format(f"{_DT} * b.y")} AS ty
 FROM k a JOIN k b ON a.track_id = b.track_id AND a.session = b.session AND b.i BETWEEN a.i - 3 AND a.i + 3 GROUP BY a.event_id)
SELECT event_id, {r(f"x0 + greatest(-40, least(40, ({_FIT('x')} - x0) * 0.65))", 3, "sx")}, {r(f"y0 + greatest(-40, least(40, ({_FIT('y')} - y0) * 0.65))", 3, "sy")} FROM m""")
def window_smoothed_places(spark, sf):
    return rounded(windows.smoothed_places(_obs(spark, sf), 12 * HOUR, 3, 0.65, 40.0).select("event_id", "sx", "sy"), 3)


@query("window_repaired_levels", f"""WITH {_XY}, g AS (SELECT *, x - lag(x) OVER (PARTITION BY track_id ORDER BY x, event_id) AS gap FROM ob), c AS (SELECT track_id, arg_max(x, (gap, x)) FILTER (gap >= 20) AS cut FROM g GROUP BY 1),
n AS (SELECT ob.*, cut, count(*) FILTER (x < cut) OVER (PARTITION BY track_id) AS low, count(*) FILTER (x >= cut) OVER (PARTITION BY track_id) AS high FROM ob JOIN c USING (track_id)),
a AS (SELECT *, last_value(CASE WHEN x < cut THEN {{'t': t_us, 'v': x}} END IGNORE NULLS) OVER (PARTITION BY track_id ORDER BY t_us, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS a, first_value(CASE WHEN x < cut THEN {{'t': t_us, 'v': x}} END IGNORE NULLS) OVER (PARTITION BY track_id ORDER BY t_us, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b FROM n)
SELECT event_id, {r("CASE WHEN coalesce(low >= 3 AND high >= 3 AND low >= high AND NOT x < cut, false) THEN CASE WHEN a IS NULL THEN b.v WHEN b IS NULL OR a.t = b.t THEN a.v ELSE a.v + (b.v - a.v) * (t_us - a.t) / (b.t - a.t) END ELSE x END", 3, "level")} FROM a""")
def window_repaired_levels(spark, sf):
    return rounded(windows.repaired_levels(_obs(spark, sf), "x", 3, 20.0).select("event_id", "level"), 3)
