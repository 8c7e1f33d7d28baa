"""Queries on grounds, roofs and sides of boxes over a dense cloud, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.operators import fits
from clipflow.plans.catalog import query, r, rounded

#: All boxes of 375 orders as the points of a frame, a rolling ground with bumps, and the last box of large orders as boxes on it.
_DENSE = """pt AS (SELECT l_orderkey // 375 AS frame, (l_quantity::DOUBLE - 25) / 5 + l_extendedprice::DOUBLE / 700001 AS px, (l_extendedprice::DOUBLE / 1000 - 30) / 5 AS py, 0.03 * ((l_quantity::DOUBLE - 25) / 5 + l_extendedprice::DOUBLE / 700001) - 0.02 * ((l_extendedprice::DOUBLE / 1000 - 30) / 5) + l_discount::DOUBLE + CASE WHEN l_returnflag = 'R' THEN l_tax::DOUBLE * 20 ELSE 0 END AS pz FROM lineitem),
bx AS (SELECT l_orderkey // 375 AS frame, l_orderkey * 1000000000 + round(l_extendedprice * 100)::BIGINT AS id, (l_quantity::DOUBLE - 25) / 5 + l_extendedprice::DOUBLE / 700001 AS x, (l_extendedprice::DOUBLE / 1000 - 30) / 5 AS y, 0.03 * ((l_quantity::DOUBLE - 25) / 5 + l_extendedprice::DOUBLE / 700001) - 0.02 * ((l_extendedprice::DOUBLE / 1000 - 30) / 5) + 0.75 AS z, 3 + l_discount::DOUBLE * 20 AS dx, 2.0::DOUBLE AS dy, 1.5::DOUBLE AS dz, l_tax::DOUBLE * 30 + 0.0123 AS yaw FROM lineitem WHERE l_linenumber = 7),
near AS (SELECT bx.*, px, py, pz, (px - x) * cos(yaw) + (py - y) * sin(yaw) AS al, (py - y) * cos(yaw) - (px - x) * sin(yaw) AS ac FROM bx JOIN pt USING (frame))"""
_W = "WINDOW w AS (PARTITION BY id)"
_GROUND = f"""{_DENSE}, g0 AS (SELECT * FROM near WHERE abs(al) <= dx / 2 + 1.2 AND abs(ac) <= dy / 2 + 1.2 AND NOT (abs(al) <= dx / 2 + 0.18 AND abs(ac) <= dy / 2 + 0.18) AND pz BETWEEN z - dz / 2 - 0.75 AND z - dz / 2 + 0.45),
g1 AS (SELECT *, count(*) OVER w AS n, min(pz) OVER w AS low, quantile_cont(pz, 0.7) OVER w AS high FROM g0 {_W} QUALIFY n >= 18), g2 AS (SELECT *, CASE WHEN pz <= high THEN floor((pz - low) / 0.06)::BIGINT END AS bin FROM g1),
g3 AS (SELECT id, arg_max(bin, {{'c': c, 'b': -bin}}) AS bin FROM (SELECT id, bin, count(*) AS c FROM g2 WHERE bin IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
g4 AS (SELECT g2.* FROM g2 JOIN g3 USING (id) WHERE high - low < 0.04 OR abs(pz - (low + (g3.bin + 0.5) * 0.06)) <= 0.12), k0 AS (SELECT id, x, y, z, dz, px - x AS u, py - y AS v, pz - z AS q, true AS keep, NULL::DOUBLE AS a, NULL::DOUBLE AS b, NULL::DOUBLE AS c FROM (SELECT *, count(*) OVER w AS n4 FROM g4 {_W}) WHERE n4 >= 10)"""
for _i in range(fits.ROUNDS):
    _GROUND += f""", m{_i} AS (SELECT id, count(*) AS n, sum(u) AS su, sum(v) AS sv, sum(q) AS sq, sum(u * u) - sum(u) ** 2 / count(*) AS uu, sum(u * v) - sum(u) * sum(v) / count(*) AS uv, sum(v * v) - sum(v) ** 2 / count(*) AS vv, sum(u * q) - sum(u) * sum(q) / count(*) AS uq, sum(v * q) - sum(v) * sum(q) / count(*) AS vq FROM k{_i} WHERE keep GROUP BY 1),
f{_i} AS (SELECT *, CASE WHEN ok THEN (uq * vv - vq * uv) / det END AS fa, CASE WHEN ok THEN (vq * uu - uq * uv) / det END AS fb FROM (SELECT *, uu * vv - uv * uv AS det, n >= 8 AND uu * vv - uv * uv > 1e-9 * uu * vv AS ok FROM m{_i})),
o{_i} AS (SELECT k.id, x, y, z, dz, u, v, q, keep, n >= 8 AS more, CASE WHEN n >= 8 THEN fa ELSE a END AS a, CASE WHEN n >= 8 THEN fb ELSE b END AS b, CASE WHEN n >= 8 THEN (sq - fa * su - fb * sv) / n ELSE c END AS c FROM k{_i} k JOIN f{_i} USING (id)),
p{_i} AS (SELECT *, q - a * u - b * v - c AS off FROM o{_i}), r{_i} AS (SELECT *, median(off) FILTER (keep) OVER w AS mid FROM p{_i} {_W}), s{_i} AS (SELECT *, median(abs(off - mid)) FILTER (keep) OVER w AS mad FROM r{_i} {_W}),
k{_i + 1} AS (SELECT id, x, y, z, dz, u, v, q, CASE WHEN more THEN coalesce(abs(off - mid) <= greatest(0.07, 3 * 1.4826 * mad), false) ELSE keep END AS keep, a, b, c FROM s{_i})"""
_GROUND += f", gr AS (SELECT id, CASE WHEN n >= 8 AND sqrt(a * a + b * b) <= 0.35 AND abs(c + dz / 2) <= 0.75 THEN z + c END AS ground, n AS n_ground FROM (SELECT id, any_value(z) AS z, any_value(dz) AS dz, any_value(a) AS a, any_value(b) AS b, any_value(c) AS c, count(*) FILTER (keep) AS n FROM k{fits.ROUNDS} GROUP BY 1))"


def dense(spark, sf):
    """Points (frame, px, py, pz) and boxes (frame, id, box)."""
    level = 0.03 * F.col("px") - 0.02 * F.col("py")
    d = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.floor(F.col("l_orderkey") / 375).alias("frame"), (F.col("l_orderkey") * 1_000_000_000 + F.round(F.col("l_extendedprice") * 100).cast("long")).alias("id"), "l_linenumber", ((F.col("l_quantity").cast("double") - 25) / 5 + F.col("l_extendedprice").cast("double") / 700_001).alias("px"), ((F.col("l_extendedprice").cast("double") / 1000 - 30) / 5).alias("py"), F.col("l_discount").cast("double").alias("disc"), F.col("l_tax").cast("double").alias("tax"), F.col("l_returnflag").alias("flag"))
    points = d.select("frame", "px", "py", (level + F.col("disc") + F.when(F.col("flag") == "R", F.col("tax") * 20).otherwise(0.0)).alias("pz"))
    on = d.where("l_linenumber = 7").select("frame", "id", F.col("px").alias("x"), F.col("py").alias("y"), (level + 0.75).alias("z"), (3 + F.col("disc") * 20).alias("dx"), F.lit(2.0).alias("dy"), F.lit(1.5).alias("dz"), (F.col("tax") * 30 + 0.0123).alias("yaw"))
    return points, on


KEYS = ("frame", "id")


@query("fit_ground", f"WITH {_GROUND} SELECT bx.id, {r('ground', 3)}, n_ground FROM bx LEFT JOIN gr USING (id)")
def fit_ground(spark, sf):
    points, on = dense(spark, sf)
    return rounded(fits.grounds(on, points, KEYS).select("id", "ground", "n_ground"), 3)


_BOTTOM = "bg AS (SELECT bx.*, CASE WHEN id % 2 = 0 THEN z - dz / 2 + 0.05 END AS ground FROM bx), nb AS (SELECT near.*, bg.ground FROM near JOIN bg USING (id))"
_ROOF = f"""{_DENSE}, {_BOTTOM}, c0 AS (SELECT *, coalesce(ground, z - dz / 2) AS bottom, greatest(z + dz / 2, coalesce(ground, z - dz / 2) + dz) + 0.35 AS top, dx / 2 - 0.05 AS hx, dy / 2 - 0.05 AS hy FROM nb),
c1 AS (SELECT *, greatest(1, floor((top - bottom - 0.1) / 0.05)::BIGINT + 1) AS nw, count(*) OVER w AS crop FROM c0 WHERE abs(al) <= hx AND abs(ac) <= hy AND pz BETWEEN bottom AND top {_W} QUALIFY crop >= 6),
c2 AS (SELECT *, unnest(range(greatest(0, floor((pz - bottom) / 0.05)::BIGINT - 3), least(nw, floor((pz - bottom) / 0.05)::BIGINT + 2))) AS win FROM c1),
c3 AS (SELECT *, least(greatest(floor((al + hx) / (2 * hx) * 6), 0), 5)::INT AS ci, least(greatest(floor((ac + hy) / (2 * hy) * 4), 0), 3)::INT AS cj FROM c2 WHERE pz >= bottom + win * 0.05::DOUBLE AND pz < bottom + win * 0.05::DOUBLE + 0.1),
c4 AS (SELECT id, win, any_value(nw) AS nw, count(*) AS support, quantile_cont(pz, 0.95) AS top, count(DISTINCT ci * 4 + cj) AS cells FROM c3 GROUP BY 1, 2
  HAVING support >= 6 AND quantile_cont(al, 0.95) - quantile_cont(al, 0.05) >= greatest(0.6, 0.14 * 2 * any_value(hx)) AND quantile_cont(ac, 0.95) - quantile_cont(ac, 0.05) >= greatest(0.25, 0.12 * 2 * any_value(hy))
  AND count(*) FILTER (abs(al) <= hx * 0.4 AND abs(ac) <= hy * 0.4) >= 2 AND abs(median(al)) <= any_value(hx) * 0.35 AND abs(median(ac)) <= any_value(hy) * 0.35 AND cells >= 3),
c5 AS (SELECT DISTINCT id, win, ci, cj FROM c3 SEMI JOIN c4 USING (id, win)), c6 AS (SELECT id, win, ci, cj, ci AS i, cj AS j FROM c5 UNION SELECT c6.id, c6.win, c6.ci, c6.cj, c5.ci, c5.cj FROM c6 JOIN c5 ON c5.id = c6.id AND c5.win = c6.win AND abs(c5.ci - c6.i) <= 1 AND abs(c5.cj - c6.j) <= 1),
c7 AS (SELECT id, win FROM (SELECT id, win, ci, cj, count(*) AS size FROM c6 GROUP BY ALL) GROUP BY 1, 2 HAVING max(size) >= 3), c8 AS (SELECT c4.*, win - row_number() OVER (PARTITION BY id ORDER BY win) AS run FROM c4 SEMI JOIN c7 USING (id, win)),
c9 AS (SELECT *, count(*) OVER (PARTITION BY id, run) AS size, lead(win) OVER (PARTITION BY id ORDER BY win) AS nxt FROM c8)"""


def _with_ground(on):
    return on.withColumn("ground", F.when(F.col("id") % 2 == 0, F.col("z") - F.col("dz") / 2 + 0.05))


@query("fit_roof", f"WITH RECURSIVE {_ROOF}, rf AS (SELECT id, arg_max(top, win) AS roof, arg_max(support, win) AS n_roof FROM c9 WHERE size >= 2 AND (nxt IS NULL OR nxt > win + 1) AND win + 1 < nw GROUP BY 1) SELECT bx.id, {r('roof')}, n_roof FROM bx LEFT JOIN rf USING (id)")
def fit_roof(spark, sf):
    points, on = dense(spark, sf)
    return rounded(fits.roofs(_with_ground(on), points, KEYS).select("id", "roof", "n_roof"))


_FACE = """coalesce({n} >= 8 AND {n} >= n * 0.1 AND {n} / {b} >= 1.6 * (n / greatest(hi{a} - lo{a}, 1e-6)), false)"""
_SHRUNK = f"""{_DENSE}, {_BOTTOM}, h0 AS (SELECT *, quantile_cont(al, 0.02) OVER w AS lox, quantile_cont(al, 0.98) OVER w AS hix, quantile_cont(ac, 0.02) OVER w AS loy, quantile_cont(ac, 0.98) OVER w AS hiy, least(greatest(dx * 0.12, 0.18), 0.6) AS bx_, least(greatest(dy * 0.12, 0.18), 0.6) AS by_
  FROM nb WHERE abs(al) <= dx / 2 + 0.22 AND abs(ac) <= dy / 2 + 0.22 AND pz BETWEEN coalesce(ground, z - dz / 2 - 0.2) + 0.12 AND greatest(z + dz / 2, coalesce(ground, z - dz / 2 - 0.2) + dz) + 0.55 {_W}),
h1 AS (SELECT id, count(*) AS n, any_value(lox) AS lox, any_value(hix) AS hix, any_value(loy) AS loy, any_value(hiy) AS hiy, count(*) FILTER (al <= lox + bx_) AS ux, count(*) FILTER (al >= hix - bx_) AS vx, count(*) FILTER (ac <= loy + by_) AS uy, count(*) FILTER (ac >= hiy - by_) AS vy FROM h0 GROUP BY 1 HAVING n >= 10),
h2 AS (SELECT bg.*, n, lox, hix, loy, hiy, {_FACE.format(n='ux', b='least(greatest(dx * 0.12, 0.18), 0.6)', a='x')} AS sx, {_FACE.format(n='vx', b='least(greatest(dx * 0.12, 0.18), 0.6)', a='x')} AS tx, {_FACE.format(n='uy', b='least(greatest(dy * 0.12, 0.18), 0.6)', a='y')} AS sy, {_FACE.format(n='vy', b='least(greatest(dy * 0.12, 0.18), 0.6)', a='y')} AS ty, dx >= dy AS longx, dy > dx AS longy FROM bg LEFT JOIN h1 USING (id)),
h3 AS (SELECT *, {', '.join(f"CASE WHEN s{a} THEN greatest(-d{a} / 2, lo{a} - CASE WHEN long{a} THEN 0.15 ELSE 0.1 END) ELSE -d{a} / 2 END AS l{a}, CASE WHEN t{a} THEN least(d{a} / 2, hi{a} + CASE WHEN long{a} THEN 0.15 ELSE 0.1 END) ELSE d{a} / 2 END AS h{a}, least(CASE WHEN long{a} THEN 3.2 ELSE 1.45 END, d{a}) AS m{a}" for a in 'xy')} FROM h2),
h4 AS (SELECT *, {', '.join(f"h{a} - l{a} < m{a} AS slim{a}, greatest(-d{a} / 2, (l{a} + h{a}) / 2 - m{a} / 2) AS wl{a}, least(d{a} / 2, (l{a} + h{a}) / 2 + m{a} / 2) AS wh{a}" for a in 'xy')} FROM h3),
h5 AS (SELECT *, {', '.join(f"slim{a} AND s{a} AND t{a} AND wh{a} - wl{a} < m{a} AS cut{a}" for a in 'xy')} FROM h4),
h6 AS (SELECT *, {', '.join(f"CASE WHEN NOT slim{a} THEN l{a} WHEN cut{a} THEN -d{a} / 2 WHEN s{a} AND t{a} THEN wl{a} WHEN s{a} THEN h{a} - m{a} ELSE l{a} END AS f{a}, CASE WHEN NOT slim{a} THEN h{a} WHEN cut{a} THEN d{a} / 2 WHEN s{a} AND t{a} THEN wh{a} WHEN s{a} THEN h{a} ELSE l{a} + m{a} END AS g{a}, CASE WHEN cut{a} THEN 'none' WHEN s{a} AND t{a} THEN 'both' WHEN s{a} THEN 'low' WHEN t{a} THEN 'high' ELSE 'none' END AS mode_{a}" for a in 'xy')} FROM h5)"""


@query("fit_sides", f"WITH {_SHRUNK} SELECT id, {r('x + (fx + gx) / 2 * cos(yaw) - (fy + gy) / 2 * sin(yaw)', 5, 'x')}, {r('y + (fx + gx) / 2 * sin(yaw) + (fy + gy) / 2 * cos(yaw)', 5, 'y')}, {r('greatest(gx - fx, 1e-6)', 5, 'dx')}, {r('greatest(gy - fy, 1e-6)', 5, 'dy')}, mode_x, mode_y FROM h6")
def fit_sides(spark, sf):
    points, on = dense(spark, sf)
    return rounded(fits.shrunk(_with_ground(on), points, KEYS).select("id", "x", "y", "dx", "dy", "mode_x", "mode_y"), 5)
