"""Parking regions: slots that stand close together, split into compact rectangles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipflow.functions.angles import axis_turn
from clipflow.operators.aggregates import heading_of
from clipflow.operators.groups import durable, linked_groups

Columns = tuple[str, ...]


@dataclass(frozen=True)
class Parking:
    extra: float = 0.3
    gap: float = 1.0
    turn: float = 0.8
    size: float = 0.6
    least: int = 4
    most_slots: int = 30
    most_extent: float = 30.0
    split_gap: float = 4.5
    margin: float = 0.5
    cell: float = 6.0


def reach(heading: Column, dx: Column, dy: Column, way: Column, extra: float) -> Column:
    """How far an oriented box, larger by `extra` on all sides, reaches from its centre towards a heading."""
    return F.abs(F.cos(way - heading)) * (dx / 2 + extra) + F.abs(F.sin(way - heading)) * (dy / 2 + extra)


def close_slots(slots: DataFrame, by: Columns = (), config: Parking = Parking()) -> DataFrame:
    """(a, b): slots (*by, id, x, y, dx, dy, yaw) with little room between them and of about one axis and size.

    Slots meet in the cells that they and half the room reach, and nowhere else.
    """
    c = config
    far = F.hypot(F.col("dx") / 2 + c.extra, F.col("dy") / 2 + c.extra) + c.gap / 2
    span = lambda k: F.explode(F.sequence(F.floor((F.col(k) - far) / c.cell), F.floor((F.col(k) + far) / c.cell)))
    placed = slots.select(*by, "id", "x", "y", "dx", "dy", "yaw").withColumn("_cx", span("x")).withColumn("_cy", span("y"))
    a, b = placed.alias("a"), placed.alias("b")
    met = (F.col("a._cx") == F.col("b._cx")) & (F.col("a._cy") == F.col("b._cy")) & (F.col("a.id") < F.col("b.id"))
    for k in by:
        met = met & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    v = lambda s, k: F.col(f"{s}.{k}")
    apart = F.hypot(v("b", "x") - v("a", "x"), v("b", "y") - v("a", "y"))
    way = F.atan2(v("b", "y") - v("a", "y"), v("b", "x") - v("a", "x"))
    room = apart - sum(reach(v(s, "yaw"), v(s, "dx"), v(s, "dy"), way, c.extra) for s in "ab")
    sizes = [F.hypot(v(s, "dx"), v(s, "dy")) for s in "ab"]
    alike = (axis_turn(v("a", "yaw"), v("b", "yaw")) <= c.turn) & (F.hypot(v("a", "dx") - v("b", "dx"), v("a", "dy") - v("b", "dy")) / F.greatest(*sizes, F.lit(1.0)) <= c.size)
    return a.join(b, met & ((apart <= 1e-6) | ((room <= c.gap) & alike))).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()


def _extents(d: DataFrame) -> DataFrame:
    """d with each slot's place along its group's heading (h) and across it (r)."""
    axes = heading_of(d, "region", F.col("yaw")).withColumnRenamed("axis", "_axis")
    cos, sin = F.cos("_axis"), F.sin("_axis")
    return d.join(axes, "region").withColumns({"h": F.col("x") * cos + F.col("y") * sin, "r": F.col("y") * cos - F.col("x") * sin})


def regions(slots: DataFrame, by: Columns = (), config: Parking = Parking()) -> DataFrame:
    """(id, region): the region of each slot; slots of one region hang together, and large ones are split.

    Level by level, a region of more slots or of a larger extent than allowed is
    cut at its widest gap along either axis that leaves enough slots on both
    sides, else beside the middle slot of its longer axis; until no region can
    be cut.  A level is a window over the open regions' slots in order and a
    table of one cut for each.
    """
    c = config
    roots = linked_groups(close_slots(slots, by, c)).withColumnRenamed("node", "id")
    own = slots.select("id", "x", "y", "yaw").join(roots, "id", "left")
    left = durable(own.select("id", "x", "y", "yaw", F.coalesce("root", "id").cast("string").alias("region")))
    done = []
    while True:
        each = W.partitionBy("region")
        e = _extents(left).withColumns({"_n": F.count("*").over(each), "_eh": F.max("h").over(each) - F.min("h").over(each), "_er": F.max("r").over(each) - F.min("r").over(each)})
        large = (F.col("_n") >= 2 * c.least) & ((F.col("_n") > c.most_slots) | (F.greatest("_eh", "_er") > c.most_extent))
        e = durable(e.withColumn("_large", large))
        done.append(e.where("NOT _large").select("id", "region"))
        e = e.where("_large")
        if e.isEmpty():
            break
        both = e.select("region", "id", "_n", "_eh", "_er", F.explode(F.array(F.struct(F.lit(1).alias("row"), F.col("r").alias("at")), F.struct(F.lit(0).alias("row"), F.col("h").alias("at")))).alias("_a")).select("region", "id", "_n", (F.col("_er") >= F.col("_eh")).alias("_rows_longer"), "_a.row", "_a.at")
        order = W.partitionBy("region", "row").orderBy("at", "id")
        g = both.withColumns({"_i": F.row_number().over(order), "_next": F.lead("at").over(order)}).where("_next IS NOT NULL").withColumn("_gap", F.col("_next") - F.col("at"))
        natural = (F.col("_gap") >= c.split_gap) & (F.col("_i") >= c.least) & (F.col("_n") - F.col("_i") >= c.least)
        middle = F.least(F.greatest(F.floor(F.col("_n") / 2), F.lit(c.least)), F.col("_n") - c.least)
        beside = (F.col("row") == F.col("_rows_longer").cast("int")) & (F.col("_i") == middle)
        cut = F.struct("row", ((F.col("at") + F.col("_next")) / 2).alias("at"))
        cuts = g.where(natural | beside).groupBy("region").agg(F.max_by(cut, F.struct(natural.cast("int").alias("k"), F.when(natural, F.col("_gap")).otherwise(0.0).alias("g"), "row", (-F.col("_i")).alias("i"))).alias("_cut"))
        split = e.join(cuts, "region").withColumn("_side", F.when(F.when(F.col("_cut.row") == 1, F.col("r")).otherwise(F.col("h")) <= F.col("_cut.at"), "0").otherwise("1"))
        sides = split.withColumn("_less", F.count(F.when(F.col("_side") == "0", 1)).over(each))
        stays = (F.col("_less") < c.least) | (F.col("_n") - F.col("_less") < c.least)
        sides = durable(sides.select("id", "x", "y", "yaw", "region", "_side", stays.alias("_stays")))
        done.append(sides.where("_stays").select("id", "region"))
        left = durable(sides.where("NOT _stays").select("id", "x", "y", "yaw", F.concat("region", F.lit("/"), "_side").alias("region")))
        if left.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def rectangles(slots: DataFrame, placed: DataFrame, config: Parking = Parking()) -> DataFrame:
    """(region, n, x, y, along, across, heading): a rectangle about each region of enough slots, along its own axis and with a margin."""
    c = config
    e = _extents(slots.join(placed, "id"))
    far = {"h": reach(F.col("yaw"), F.col("dx"), F.col("dy"), F.col("_axis"), c.extra), "r": reach(F.col("yaw"), F.col("dx"), F.col("dy"), F.col("_axis") + F.lit(1.5707963267948966), c.extra)}
    g = e.groupBy("region").agg(F.count("*").alias("n"), F.first("_axis").alias("heading"), *(f(s * far[k] + F.col(k)).alias(f"_{k}{n}") for k in "hr" for f, s, n in ((F.min, -1, "0"), (F.max, 1, "1")))).where(F.col("n") >= c.least)
    mid = {k: (F.col(f"_{k}0") + F.col(f"_{k}1")) / 2 for k in "hr"}
    cos, sin = F.cos("heading"), F.sin("heading")
    return g.select("region", "n", (mid["h"] * cos - mid["r"] * sin).alias("x"), (mid["h"] * sin + mid["r"] * cos).alias("y"), (F.col("_h1") - F.col("_h0") + 2 * c.margin).alias("along"), (F.col("_r1") - F.col("_r0") + 2 * c.margin).alias("across"), "heading")
