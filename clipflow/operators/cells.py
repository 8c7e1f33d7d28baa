"""Regions as sets of grid cells: made from boxes, grown, closed, joined up, and looked up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipflow.operators.groups import linked_groups

_SIDE = 1 << 21


def key(cx: Column, cy: Column) -> Column:
    """One number for a cell within a million cells of the origin."""
    return (cx + _SIDE // 2) * _SIDE + cy + _SIDE // 2


def cell(v: Column, size: float) -> Column:
    return F.floor(v / size).cast("long")


def bounds(d: DataFrame, margin: float, size: float) -> DataFrame:
    """(x0, y0, nx, ny): the padded corner of all places and the cells that cover them."""
    b = d.agg((F.min("x") - margin).alias("x0"), (F.min("y") - margin).alias("y0"), (F.max("x") + margin).alias("x1"), (F.max("y") + margin).alias("y1"))
    return b.select("x0", "y0", (F.ceil((F.col("x1") - F.col("x0")) / size) + 1).alias("nx"), (F.ceil((F.col("y1") - F.col("y0")) / size) + 1).alias("ny"))


def swept(d: DataFrame, size: float, margin: float = 0.0) -> DataFrame:
    """(cx, cy): cells whose middle lies in a box (x, y, dx, dy, yaw) enlarged by the margin."""
    reach = F.hypot("dx", "dy") / 2 + margin
    span = lambda c: F.sequence(cell(F.col(c) - reach, size), cell(F.col(c) + reach, size))
    e = d.withColumn("cx", F.explode(span("x"))).withColumn("cy", F.explode(span("y")))
    mx, my = (F.col("cx") + 0.5) * size - F.col("x"), (F.col("cy") + 0.5) * size - F.col("y")
    u, v = mx * F.cos("yaw") + my * F.sin("yaw"), my * F.cos("yaw") - mx * F.sin("yaw")
    return e.where((F.abs(u) <= F.col("dx") / 2 + margin) & (F.abs(v) <= F.col("dy") / 2 + margin)).select("cx", "cy").distinct()


def disc(radius: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if i * i + j * j <= radius * radius]


def _around(cells: DataFrame, radius: int) -> DataFrame:
    steps = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in disc(radius)))
    return cells.withColumn("_s", F.explode(steps)).select((F.col("cx") + F.col("_s.i")).alias("cx"), (F.col("cy") + F.col("_s.j")).alias("cy"))


def dilated(cells: DataFrame, radius: int) -> DataFrame:
    """The cells within a disc of a cell; a radius of 0 or less changes nothing."""
    return _around(cells, radius).distinct() if radius > 0 else cells


def eroded(cells: DataFrame, radius: int) -> DataFrame:
    """The cells whose whole disc is there."""
    if radius <= 0:
        return cells
    seen = _around(cells, radius).groupBy("cx", "cy").agg(F.count("*").alias("_n")).where(F.col("_n") == len(disc(radius))).select("cx", "cy")
    return seen.join(cells, ["cx", "cy"], "left_semi")


def closed(cells: DataFrame, radius: int) -> DataFrame:
    """Gaps narrower than the disc filled."""
    return eroded(dilated(cells, radius), radius)


def components(cells: DataFrame, least: int) -> DataFrame:
    """(cx, cy, root): cells of the groups of `least` cells or more that touch, corners included."""
    own = cells.select("cx", "cy", key(F.col("cx"), F.col("cy")).alias("_k"))
    steps = F.array(*(F.lit(i * _SIDE + j) for i, j in ((0, 1), (1, -1), (1, 0), (1, 1))))
    ahead = own.select(F.col("_k").alias("a"), F.explode(steps).alias("_s")).select("a", (F.col("a") + F.col("_s")).alias("b"))
    links = ahead.join(own.select(F.col("_k").alias("b")), "b", "left_semi").select("a", "b")
    roots = linked_groups(links)
    placed = own.join(roots, own["_k"] == roots["node"], "left").select("cx", "cy", F.coalesce("root", "_k").alias("root"))
    large = placed.groupBy("root").agg(F.count("*").alias("_n")).where(F.col("_n") >= least).select("root")
    return placed.join(large, "root", "left_semi").select("cx", "cy", "root")


def contained(d: DataFrame, cells: DataFrame, size: float) -> DataFrame:
    """d with inside: whether the cell of (x, y) is one of the cells."""
    marks = cells.select("cx", "cy").distinct().withColumn("_in", F.lit(True))
    e = d.withColumn("cx", cell(F.col("x"), size)).withColumn("cy", cell(F.col("y"), size)).join(marks, ["cx", "cy"], "left")
    return e.withColumn("inside", F.coalesce("_in", F.lit(False))).drop("cx", "cy", "_in")


def share_near(d: DataFrame, places: DataFrame, radius: float) -> DataFrame:
    """(track_id, share): the part of a track's rows within the radius of any place (x, y).

    Places are copied to the cells about their own.  A row looks at them, up to
    the first one near, only if the bounds of some cell's places are near it.
    """
    p = places.select(F.col("x").alias("_px"), F.col("y").alias("_py")).distinct()
    p = p.withColumn("_cx", cell(F.col("_px"), radius)).withColumn("_cy", cell(F.col("_py"), radius))
    near = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    copied = lambda q: q.withColumn("_s", F.explode(F.array(*near))).withColumns({"_cx": F.col("_cx") + F.col("_s.i"), "_cy": F.col("_cy") + F.col("_s.j")}).drop("_s")
    bounds_of = p.groupBy("_cx", "_cy").agg(F.struct(*(f(c).alias(f"{c}{n}") for c in ("_px", "_py") for n, f in (("0", F.min), ("1", F.max)))).alias("_b"))
    about = copied(bounds_of).groupBy("_cx", "_cy").agg(F.collect_list("_b").alias("_bs"))
    off = lambda b, k: F.greatest(b[f"_p{k}0"] - F.col(k), F.col(k) - b[f"_p{k}1"], F.lit(0.0))
    rows = d.select("track_id", "event_id", "x", "y")
    asked = rows.withColumns({"_cx": cell(F.col("x"), radius), "_cy": cell(F.col("y"), radius)}).join(about, ["_cx", "_cy"])
    asked = asked.where(F.exists("_bs", lambda b: (off(b, "x") <= radius) & (off(b, "y") <= radius))).select("event_id", "x", "y", "_cx", "_cy").alias("r")
    q = copied(p).alias("q")
    x, y = F.col("r.x") - F.col("q._px"), F.col("r.y") - F.col("q._py")
    meet = (F.col("r._cx") == F.col("q._cx")) & (F.col("r._cy") == F.col("q._cy")) & (F.sqrt(x * x + y * y) <= radius)
    hit = asked.join(q.hint("merge"), meet, "left_semi").select("event_id").distinct().withColumn("_hit", F.lit(1))
    return rows.join(hit, "event_id", "left").groupBy("track_id").agg(F.avg(F.coalesce("_hit", F.lit(0))).alias("share"))


def in_polygon(polygon: Column, x: Column, y: Column) -> Column:
    """Whether a place lies in a polygon (an array of x, y), its border included."""
    after = F.concat(F.slice(polygon, 2, F.size(polygon) - 1), F.slice(polygon, 1, 1))
    side = lambda p, q: (q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"])
    on = F.zip_with(polygon, after, lambda p, q: (F.abs(side(p, q)) <= 1e-9) & x.between(F.least(p["x"], q["x"]), F.greatest(p["x"], q["x"])) & y.between(F.least(p["y"], q["y"]), F.greatest(p["y"], q["y"])))
    crossed = F.zip_with(polygon, after, lambda p, q: ((p["y"] > y) != (q["y"] > y)) & (x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"]))
    return F.exists(on, lambda v: v) | (F.size(F.filter(crossed, lambda v: v)) % 2 == 1)


def extended(d: DataFrame, ways: DataFrame, length: float, step: float) -> DataFrame:
    """(track_id, x, y): straight continuations, `length` beyond both ends of each track.

    ways has a track's ends and headings (x0, y0, h0, x1, y1, h1).
    """
    k = F.sequence(F.lit(1), F.lit(int(length / step)))
    ahead = ways.select("track_id", "x1", "y1", "h1", F.explode(k).alias("k")).select("track_id", (F.col("x1") + F.col("k") * step * F.cos("h1")).alias("x"), (F.col("y1") + F.col("k") * step * F.sin("h1")).alias("y"))
    back = ways.select("track_id", "x0", "y0", "h0", F.explode(k).alias("k")).select("track_id", (F.col("x0") - F.col("k") * step * F.cos("h0")).alias("x"), (F.col("y0") - F.col("k") * step * F.sin("h0")).alias("y"))
    return ahead.unionByName(back).join(d.select("track_id").distinct(), "track_id", "left_semi")
