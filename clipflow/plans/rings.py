"""Queries on the borders of cell sets, with their SQL."""

from __future__ import annotations

from clipflow.operators import cells, rings
from clipflow.plans.catalog import query, r, rounded
from clipflow.plans.cells import _CELLS
from clipflow.sources.tables import TRACKED, tracked

#: Trucks of a stretch, by the parity of their frame, as two sets of cells: `side` keeps them apart.
_WHERE = "y > 57 AND class_name = 'Truck'"
_SIDES = " UNION ALL ".join(f"SELECT {i}::BIGINT AS side, cx, cy FROM s{i}" for i in (0, 1))
_SETS = f"{TRACKED}, t0 AS (SELECT * FROM trk WHERE {_WHERE} AND frame_id % 2 = 0), t1 AS (SELECT * FROM trk WHERE {_WHERE} AND frame_id % 2 = 1), {_CELLS.format(n='s0', m='0.013', src='t0')}, {_CELLS.format(n='s1', m='0.013', src='t1')}, c AS ({_SIDES})"
_RINGS = f"""{_SETS},
e AS (SELECT c.*, d, (c.cx + 1048576) * 2097152 + c.cy + 1048576 AS k, c.cx + [0, 1, 1, 0][d + 1] AS x, c.cy + [0, 0, 1, 1][d + 1] AS y FROM c, range(4) t(d) ANTI JOIN c o ON o.side = c.side AND o.cx = c.cx + [0, 1, 0, -1][d + 1] AND o.cy = c.cy + [-1, 0, 1, 0][d + 1]),
x AS (SELECT p.side, p.k * 4 + p.d AS edge, arg_min(q.k * 4 + q.d, CASE WHEN (q.d - p.d + 4) % 4 = 3 THEN 0 ELSE 1 END) AS next FROM e p JOIN e q ON p.side = q.side AND q.x = p.x + [1, 0, -1, 0][p.d + 1] AND q.y = p.y + [0, 1, 0, -1][p.d + 1] GROUP BY 1, 2),
w AS (SELECT side, edge AS ring, edge AS at, next AS e, 0 AS place FROM x UNION ALL SELECT w.side, ring, w.e, x.next, place + 1 FROM w JOIN x ON x.side = w.side AND x.edge = w.e WHERE w.e > ring),
n AS (SELECT w.side, w.ring, w.place, w.at, w.e FROM w SEMI JOIN (SELECT side, ring FROM w WHERE e = ring) g ON g.side = w.side AND g.ring = w.ring),
f AS (SELECT n.*, p.x, p.y, p.d, p.cx, p.cy, q.x AS x1, q.y AS y1, q.d AS d1, q.cx AS cx1, q.cy AS cy1 FROM n JOIN e p ON p.side = n.side AND p.k * 4 + p.d = n.at JOIN e q ON q.side = n.side AND q.k * 4 + q.d = n.e),
m AS (SELECT side, ring, count(*) AS edges, count(*) FILTER (d <> d1) AS corners, sum(x * y1 - x1 * y) / 2 AS area, sum(cx * cy1 - cx1 * cy) / 2 AS outline_area FROM f GROUP BY 1, 2)"""
_OUTLINES = f"""{_RINGS}, o AS (SELECT q.side, q.ring, q.place, q.cx + 0.5 AS x, q.cy + 0.5 AS y FROM f q JOIN m USING (side, ring) JOIN f p ON p.side = q.side AND p.e = q.at WHERE m.area > 0 AND abs(outline_area) >= 8 AND (q.cx <> p.cx OR q.cy <> p.cy))"""
_BIG = 1 << 40
_FAR = "max({{'d': sqrt((o.x - {p}.x) ** 2 + (o.y - {p}.y) ** 2), 'n': -o.place, 'x': o.x, 'y': o.y}})"


def _sets(spark, sf):
    d = tracked(spark, sf).where(_WHERE)
    side = lambda i: cells.swept(d.where(f"frame_id % 2 = {i}"), 1.0, 0.013).selectExpr(f"{i}L AS side", "cx", "cy")
    return side(0).union(side(1))


def _ranked(spark, sf):
    return rings.ranked(rings.border_edges(_sets(spark, sf), ("side",)), ("side",))


@query("region_rings", f"WITH RECURSIVE {_RINGS} SELECT side, ring, edges, corners::BIGINT AS corners, {r('area', 1)}, {r('outline_area', 1)} FROM m")
def region_rings(spark, sf):
    return rounded(rings.measured(_ranked(spark, sf), ("side",)), 1)


@query("region_simplified", f"""WITH RECURSIVE {_OUTLINES},
p AS (SELECT side, ring, arg_min({{'x': x, 'y': y}}, place) AS p FROM o GROUP BY 1, 2), a AS (SELECT o.side, o.ring, {_FAR.format(p='p.p')} AS p FROM o JOIN p USING (side, ring) GROUP BY 1, 2),
b AS (SELECT o.side, o.ring, {_FAR.format(p='a.p')} AS p FROM o JOIN a USING (side, ring) GROUP BY 1, 2),
z AS (SELECT side, ring, least(-a.p.n, -b.p.n) AS l, greatest(-a.p.n, -b.p.n) AS h FROM a JOIN b USING (side, ring)),
v AS (SELECT side, ring, place::BIGINT AS o, x, y FROM o UNION ALL SELECT side, ring, place + {_BIG}, x, y FROM o),
s AS (SELECT side, ring, l::BIGINT AS l, h::BIGINT AS h FROM z UNION ALL SELECT side, ring, h, l + {_BIG} FROM z UNION ALL
  SELECT side, ring, CASE WHEN k = 0 THEN l ELSE -g.n END, CASE WHEN k = 0 THEN -g.n ELSE h END FROM (SELECT s.side, s.ring, s.l, s.h, max({{'d': CASE WHEN i.x = j.x AND i.y = j.y THEN sqrt((v.x - i.x) ** 2 + (v.y - i.y) ** 2) ELSE abs((v.x - i.x) * (j.y - i.y) - (v.y - i.y) * (j.x - i.x)) / sqrt((j.x - i.x) ** 2 + (j.y - i.y) ** 2) END, 'n': -v.o}}) AS g
    FROM s JOIN v ON v.side = s.side AND v.ring = s.ring AND v.o > s.l AND v.o < s.h JOIN v i ON i.side = s.side AND i.ring = s.ring AND i.o = s.l JOIN v j ON j.side = s.side AND j.ring = s.ring AND j.o = s.h GROUP BY 1, 2, 3, 4), range(2) t(k) WHERE g.d > 1.5),
u AS (SELECT DISTINCT side, ring, l % {_BIG} AS place FROM s), q AS (SELECT side, ring, row_number() OVER (PARTITION BY side, ring ORDER BY place) - 1 AS corner, x, y, count(*) OVER (PARTITION BY side, ring) AS c FROM u JOIN o USING (side, ring, place))
SELECT side, ring, corner::INT AS corner, {r('x')}, {r('y')} FROM q WHERE c >= 3""")
def region_simplified(spark, sf):
    e = _ranked(spark, sf)
    o = rings.outlines(e, rings.measured(e, ("side",)), ("side",), 8.0)
    return rounded(rings.polygons(rings.simplified(o, 1.5, ("side",)), 1.0, ("side",)))
