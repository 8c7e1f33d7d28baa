"""Queries on clouds of several sensors, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from clipflow.operators import clouds
from clipflow.plans.catalog import query, r, rounded

#: Three sensors by the flag of a line item; the others' times lag behind the reference's, and some lie too far off.
_BASES = {"top": (1.0, 0.0, 0.0, 0.5, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 2.0), "front": (0.0, -1.0, 0.0, 2.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0), "rear": (-1.0, 0.0, 0.0, -1.5, 0.0, -1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0)}
_M = lambda v: "[" + ", ".join(f"{x}::DOUBLE" for x in v) + "]"
_CELL = lambda m, i, j: ("1.0" if i == j else "0.0") if i == 3 else f"{m}[{4 * i + j + 1}]"
_TIMES = lambda a, b: "[" + ", ".join(" + ".join(f"{_CELL(a, i, k)} * {_CELL(b, k, j)}" for k in range(3)) + (f" + {a}[{4 * i + 4}]" if j == 3 else " + 0.0") for i in range(3) for j in range(4)) + "]"
_BACK = lambda m: "[" + ", ".join(f"-({m}[{i + 1}] * {m}[4] + {m}[{i + 5}] * {m}[8] + {m}[{i + 9}] * {m}[12])" if j == 3 else f"{m}[{4 * j + i + 1}]" for i in range(3) for j in range(4)) + "]"
_CLOUD = """cl AS (SELECT l_orderkey % 4 AS clip, CASE l_returnflag WHEN 'A' THEN 'top' WHEN 'N' THEN 'front' ELSE 'rear' END AS sensor, (l_orderkey // 40) * 100000 + CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 13000 ELSE 48000 + l_orderkey // 40 % 5 * 1000 END AS t_us, l_quantity::DOUBLE AS px, l_extendedprice::DOUBLE / 1000 AS py, l_tax::DOUBLE * 10 AS pz, l_orderkey * 10 + l_linenumber AS item FROM lineitem)"""
_POSE = "po AS (SELECT o_orderkey // 25 % 4 AS clip, o_orderkey // 100 * 250000 + 30000 AS t_us, o_orderkey / 50.0::DOUBLE AS px, (o_orderkey % 700) / 100.0::DOUBLE AS py, (o_orderkey % 63) / 20.0::DOUBLE AS half FROM orders WHERE o_orderkey % 25 = 3 AND o_orderkey // 25 % 4 < 3)"


def _clouds(spark, sf):
    flag, key = F.col("l_returnflag"), F.col("l_orderkey")
    turn = F.floor(key / 40)
    lag = F.when(flag == "A", 0).when(flag == "N", 13_000).otherwise(48_000 + turn % 5 * 1000)
    name = F.when(flag == "A", "top").when(flag == "N", "front").otherwise("rear")
    d = lambda c: F.col(c).cast("double")
    return spark.read.parquet(f"{sf}/lineitem.parquet").select((key % 4).alias("clip"), name.alias("sensor"), (turn * 100_000 + lag).alias("t_us"), d("l_quantity").alias("px"), (d("l_extendedprice") / 1000).alias("py"), (d("l_tax") * 10).alias("pz"), (key * 10 + F.col("l_linenumber")).alias("item"))


def _poses(spark, sf):
    key = F.col("o_orderkey")
    o = spark.read.parquet(f"{sf}/orders.parquet").where("o_orderkey % 25 = 3 AND floor(o_orderkey / 25) % 4 < 3")
    half = (key % 63) / F.lit(20.0)
    return o.select((F.floor(key / 25) % 4).alias("clip"), (F.floor(key / 100) * 250_000 + 30_000).alias("t_us"), (key / 50.0).alias("px"), ((key % 700) / 100.0).alias("py"), F.lit(0.0).alias("pz"), F.lit(0.0).alias("qx"), F.lit(0.0).alias("qy"), F.sin(half).alias("qz"), F.cos(half).alias("qw"))


@query("clouds_fused", f"""WITH {_CLOUD}, {_POSE}, ex AS ({' UNION ALL '.join(f"SELECT '{k}' AS sensor, {_M(v)} AS base" for k, v in _BASES.items())}), st AS (SELECT DISTINCT clip, sensor, t_us FROM cl), rf AS (SELECT clip, t_us, o.sensor FROM st, (VALUES ('front'), ('rear')) o(sensor) WHERE st.sensor = 'top'),
ne AS (SELECT rf.clip, rf.sensor, rf.t_us, arg_min(o.t_us, {{'d': abs(o.t_us - rf.t_us), 't': o.t_us}}) AS stamp FROM rf JOIN st o ON o.clip = rf.clip AND o.sensor = rf.sensor AND abs(o.t_us - rf.t_us) <= 50000 GROUP BY ALL),
pa AS (SELECT s.clip, s.t_us, a.t_us IS NOT NULL AS has_a, b.t_us IS NOT NULL AS has_b, coalesce(a.t_us, b.t_us) AS ta, coalesce(b.t_us, a.t_us) AS tb, coalesce(a.px, b.px) AS ax, coalesce(b.px, a.px) AS bx, coalesce(a.py, b.py) AS ay, coalesce(b.py, a.py) AS by_, coalesce(a.half, b.half) AS ah, coalesce(b.half, a.half) AS bh FROM (SELECT DISTINCT clip, t_us FROM st) s ASOF LEFT JOIN po a ON a.clip = s.clip AND s.t_us >= a.t_us ASOF LEFT JOIN po b ON b.clip = s.clip AND s.t_us <= b.t_us),
al AS (SELECT *, CASE WHEN tb - ta <= 0 THEN 0 WHEN tb - ta > 600000 THEN CASE WHEN 2 * (t_us - ta) <= tb - ta THEN 0 ELSE 1 END ELSE (t_us - ta) / (tb - ta)::DOUBLE END AS k, cos(ah) * cos(bh) + sin(ah) * sin(bh) AS dot FROM pa WHERE has_a OR has_b),
sl AS (SELECT *, acos(least(abs(dot), 1)) AS g, CASE WHEN dot < 0 THEN -1 ELSE 1 END AS sg, abs(dot) > 0.9995 AS close FROM al), fa AS (SELECT *, CASE WHEN close THEN 1 - k ELSE sin((1 - k) * g) / sin(g) END AS f1, sg * CASE WHEN close THEN k ELSE sin(k * g) / sin(g) END AS f2 FROM sl),
qu AS (SELECT *, f1 * sin(ah) + f2 * sin(bh) AS rz, f1 * cos(ah) + f2 * cos(bh) AS rw FROM fa), qn AS (SELECT *, rz / sqrt(rz * rz + rw * rw) AS qz, rw / sqrt(rz * rz + rw * rw) AS qw FROM qu),
wo AS (SELECT clip, t_us, [1 - 2 * qz * qz, -2 * qz * qw, 0, ax * (1 - k) + bx * k, 2 * qz * qw, 1 - 2 * qz * qz, 0, ay * (1 - k) + by_ * k, 0, 0, 1, 0]::DOUBLE[] AS w FROM qn),
s1 AS (SELECT ne.*, {_BACK('h.base')} AS hi, e.base AS b, u.w AS here, v.w AS there FROM ne JOIN ex e ON e.sensor = ne.sensor JOIN ex h ON h.sensor = 'top' LEFT JOIN wo u ON u.clip = ne.clip AND u.t_us = ne.t_us LEFT JOIN wo v ON v.clip = ne.clip AND v.t_us = ne.stamp),
s2 AS (SELECT *, {_TIMES('hi', 'b')} AS still, {_BACK('here')} AS hb FROM s1), s3 AS (SELECT *, {_TIMES('hb', 'there')} AS went FROM s2), s4 AS (SELECT *, CASE WHEN here IS NOT NULL AND there IS NOT NULL THEN {_TIMES('went', 'still')} ELSE still END AS way FROM s3)
SELECT clip, t_us, sensor, item, {r('px', 5)}, {r('py', 5)}, {r('pz', 5)} FROM cl WHERE sensor = 'top' UNION ALL
SELECT s4.clip, s4.t_us, s4.sensor, item, {', '.join(r(f'way[{4 * i + 1}] * px + way[{4 * i + 2}] * py + way[{4 * i + 3}] * pz + way[{4 * i + 4}]', 5, k) for i, k in enumerate(('px', 'py', 'pz')))} FROM cl JOIN s4 ON s4.clip = cl.clip AND s4.sensor = cl.sensor AND s4.stamp = cl.t_us""")
def clouds_fused(spark, sf):
    extrinsics = spark.createDataFrame([(c, k, list(v)) for c in range(4) for k, v in _BASES.items()], "clip long, sensor string, base array<double>")
    d = clouds.fused(_clouds(spark, sf), extrinsics, _poses(spark, sf), "clip", "top", 50_000, 600_000)
    return rounded(d.select("clip", "t_us", "sensor", "item", "px", "py", "pz"), 5)
