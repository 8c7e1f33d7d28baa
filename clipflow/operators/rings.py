"""Borders of cell sets as rings: chained by list ranking, measured, and simplified.

A side of a cell whose neighbour isn't in the set is a directed border edge with
the set on its left.  Where two cells touch by a corner only, the border goes on
along the other cell, so that a ring goes around cells that touch in any way.
Each operator takes `by` columns first (a clip, a region): sets of different
values never meet.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipflow.operators.cells import key
from clipflow.operators.groups import durable

#: Directions of edges: right along the bottom, up on the right, left along the top, down on the left.
_STEPS = ((1, 0), (0, 1), (-1, 0), (0, -1))
#: From a cell's lower left corner to the start of its edge of a direction, and to the neighbour behind the edge.
_STARTS = ((0, 0), (1, 0), (1, 1), (0, 1))
_BEHIND = ((0, -1), (1, 0), (0, 1), (-1, 0))
Columns = tuple[str, ...]


def _chosen(options: tuple[tuple[int, int], ...], axis: int, direction: Column) -> Column:
    return F.element_at(F.array(*(F.lit(o[axis]) for o in options)), direction + 1)


def border_edges(cells: DataFrame, by: Columns = ()) -> DataFrame:
    """(*by, cx, cy, dir, x, y, edge, next): the border's edges, each with its cell, start, number, and the number of the one that follows."""
    cells = cells.select(*by, "cx", "cy").distinct()
    sides = F.array(*(F.struct(F.lit(d).alias("dir"), F.lit(i).alias("i"), F.lit(j).alias("j")) for d, (i, j) in enumerate(_BEHIND)))
    e = cells.select(*by, "cx", "cy", F.explode(sides).alias("_s")).select(*by, "cx", "cy", F.col("_s.dir").alias("dir"), (F.col("cx") + F.col("_s.i")).alias("_nx"), (F.col("cy") + F.col("_s.j")).alias("_ny"))
    inside = cells.withColumnsRenamed({"cx": "_nx", "cy": "_ny"})
    open_sides = e.join(inside, [*by, "_nx", "_ny"], "left_anti").select(*by, "cx", "cy", "dir")
    d = F.col("dir")
    placed = open_sides.withColumns({"x": F.col("cx") + _chosen(_STARTS, 0, d), "y": F.col("cy") + _chosen(_STARTS, 1, d), "edge": key(F.col("cx"), F.col("cy")) * 4 + d})
    placed = durable(placed)
    ends = placed.withColumns({"x": F.col("x") + _chosen(_STEPS, 0, d), "y": F.col("y") + _chosen(_STEPS, 1, d)}).select(*by, "x", "y", "dir", F.col("edge").alias("_from"))
    onward = placed.select(*by, "x", "y", F.col("dir").alias("_dir"), F.col("edge").alias("next"))
    # of two ways on, the right turn: it leads around the cell across the corner
    turn = F.pmod(F.col("_dir") - F.col("dir"), F.lit(4))
    followed = ends.join(onward, [*by, "x", "y"]).groupBy(*by, F.col("_from").alias("edge")).agg(F.min_by("next", F.when(turn == 3, 0).otherwise(1)).alias("next"))
    return placed.join(followed, [*by, "edge"])


def ranked(edges: DataFrame, by: Columns = ()) -> DataFrame:
    """edges (*by, edge, next, ...) with ring, the least edge of their cycle, and place, their steps from it.

    Pointers double: after k rounds an edge knows the least of the 2**k edges
    from it on.  Rounds end when no least changes.  Then, with the way cut
    before the least edge, distances to it double likewise.
    """
    state = edges.select(*by, "edge", F.col("next").alias("to"), F.least("edge", "next").alias("ring"))
    state = durable(state)
    while True:
        there = state.select(*by, F.col("edge").alias("to"), F.col("to").alias("_to"), F.col("ring").alias("_ring"))
        moved = durable(state.join(there, [*by, "to"]).select(*by, "edge", F.col("_to").alias("to"), F.least("ring", "_ring").alias("ring"), (F.col("_ring") < F.col("ring")).alias("_moved")))
        state = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            break
    rings = state.select(*by, "edge", "ring")
    # steps to the cycle's least edge, which stays where it is
    way = durable(edges.select(*by, "edge", "next").join(rings, [*by, "edge"]).select(*by, "edge", "ring", F.when(F.col("edge") == F.col("ring"), F.col("edge")).otherwise(F.col("next")).alias("to"), F.when(F.col("edge") == F.col("ring"), 0).otherwise(1).cast("long").alias("left")))
    while not way.where("to <> ring").isEmpty():
        there = way.select(*by, F.col("edge").alias("to"), F.col("to").alias("_to"), F.col("left").alias("_left"))
        way = durable(way.join(there, [*by, "to"]).select(*by, "edge", "ring", F.col("_to").alias("to"), (F.col("left") + F.col("_left")).alias("left")))
    sizes = way.groupBy(*by, "ring").agg(F.count("*").alias("_n"))
    place = F.pmod(F.col("_n") - F.col("left"), F.col("_n")).alias("place")
    return edges.join(way.join(sizes, [*by, "ring"]).select(*by, "edge", "ring", place), [*by, "edge"])


def _cross(x: str, y: str, x1: str, y1: str) -> Column:
    return F.sum(F.col(x) * F.col(y1) - F.col(x1) * F.col(y)) / 2


def measured(ranked_edges: DataFrame, by: Columns = ()) -> DataFrame:
    """(*by, ring, edges, corners, area, outline_area) of each ring, in cells.

    The area is that of the cells inside, negative for the ring of a hole; the
    outline's is that of the polygon through the middles of the border's cells.
    """
    after = ranked_edges.select(*by, F.col("edge").alias("next"), F.col("x").alias("_x"), F.col("y").alias("_y"), F.col("dir").alias("_dir"), F.col("cx").alias("_cx"), F.col("cy").alias("_cy"))
    figures = [F.count("*").alias("edges"), F.sum((F.col("dir") != F.col("_dir")).cast("long")).alias("corners"), _cross("x", "y", "_x", "_y").alias("area"), _cross("cx", "cy", "_cx", "_cy").alias("outline_area")]
    return ranked_edges.join(after, [*by, "next"]).groupBy(*by, "ring").agg(*figures)


def outlines(ranked_edges: DataFrame, figures: DataFrame, by: Columns = (), least_area: float = 0.0) -> DataFrame:
    """(*by, ring, place, x, y): the middles of the cells along each outer ring whose outline has the area, in cells, or more.

    A cell stands once for the edges that it gives in a row; `place` has gaps.
    """
    outer = figures.where((F.col("area") > 0) & (F.abs("outline_area") >= least_area)).select(*by, "ring", "edges")
    e = ranked_edges.join(outer, [*by, "ring"])
    before = e.select(*by, F.col("next").alias("edge"), F.col("cx").alias("_cx"), F.col("cy").alias("_cy"))
    new = (F.col("cx") != F.col("_cx")) | (F.col("cy") != F.col("_cy")) | ((F.col("place") == 0) & (F.col("edges") == 4))
    return e.join(before, [*by, "edge"]).where(new).select(*by, "ring", "place", (F.col("cx") + 0.5).alias("x"), (F.col("cy") + 0.5).alias("y"))


def _off_line() -> Column:
    """Distance of (x, y) from the line through (lx, ly) and (hx, hy), or from the one place if they are the same."""
    dx, dy = F.col("hx") - F.col("lx"), F.col("hy") - F.col("ly")
    rx, ry = F.col("x") - F.col("lx"), F.col("y") - F.col("ly")
    return F.when((dx == 0) & (dy == 0), F.hypot(rx, ry)).otherwise(F.abs(rx * dy - ry * dx) / F.hypot(dx, dy))


def simplified(points: DataFrame, tolerance: float, by: Columns = ()) -> DataFrame:
    """(*by, ring, place, x, y): the corners that a polygon of each ring of points keeps within the tolerance.

    Two places far from each other are kept first: the farthest from the first
    one, and the farthest from that.  In rounds every open stretch then keeps
    the place farthest from the line through its ends, if it is beyond the
    tolerance, and is split there; of equally far places the first.
    """
    ring = [*by, "ring"]
    at = lambda p: F.hypot(F.col("x") - F.col(f"{p}x"), F.col("y") - F.col(f"{p}y"))
    spot = lambda order, p: F.max_by(F.struct("place", "x", "y"), order).alias(p)
    named = lambda d, p: d.select(*ring, *(F.col(f"_p.{k}").alias(f"{p}{n}") for k, n in (("place", ""), ("x", "x"), ("y", "y"))))
    points = durable(points.select(*ring, "place", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")))
    first = named(points.groupBy(*ring).agg(spot(-F.col("place"), "_p")), "a")
    for _ in range(2):
        last, first = first, None
        far = points.join(last.withColumnsRenamed({"a": "o", "ax": "ox", "ay": "oy"}), ring)
        first = named(far.groupBy(*ring).agg(spot(F.struct(at("o"), -F.col("place")), "_p")), "a")
    ends = durable(last.withColumnsRenamed({"a": "b", "ax": "bx", "ay": "by"}).join(first, ring))
    kept = [ends.select(*ring, F.col(p).alias("place"), F.col(f"{p}x").alias("x"), F.col(f"{p}y").alias("y")) for p in ("a", "b")]
    low = (F.col("a") < F.col("b"))
    pick = lambda x, y: F.when(low, F.col(x)).otherwise(F.col(y))
    least = ends.select(*ring, *(pick(f"a{n}", f"b{n}").alias(f"l{n}") for n in ("", "x", "y")), *(pick(f"b{n}", f"a{n}").alias(f"h{n}") for n in ("", "x", "y")))
    both = points.join(least, ring).where((F.col("place") != F.col("l")) & (F.col("place") != F.col("h")))
    within = F.col("place").between(F.col("l"), F.col("h"))
    turned = lambda p, q: F.when(within, F.col(p)).otherwise(F.col(q))
    # the stretch that goes over the ring's start is the one from the higher end to the lower
    stretch = both.withColumns({f"{p}{n}": turned(f"{p}{n}", f"{q}{n}") for p, q in (("l", "h"), ("h", "l")) for n in ("", "x", "y")})
    open_points = durable(stretch.withColumn("order", F.when(within | (F.col("place") > F.col("l")), F.col("place")).otherwise(F.col("place") + F.lit(1 << 40))))
    while True:
        span = [*ring, "l", "h"]
        farthest = open_points.groupBy(*span).agg(F.max(F.struct(_off_line().alias("d"), (-F.col("order")).alias("o"), "place", "x", "y")).alias("_f")).where(F.col("_f.d") > tolerance)
        farthest = durable(farthest.select(*span, F.col("_f.place").alias("m"), (-F.col("_f.o")).alias("mo"), F.col("_f.x").alias("mx"), F.col("_f.y").alias("my")))
        if farthest.isEmpty():
            break
        kept.append(farthest.select(*ring, F.col("m").alias("place"), F.col("mx").alias("x"), F.col("my").alias("y")))
        left = open_points.join(farthest, span).where(F.col("place") != F.col("m"))
        lower = F.col("order") < F.col("mo")
        side = lambda mine, other: {f"{mine}{n}": F.when(lower if mine == "h" else ~lower, F.col(f"m{n}")).otherwise(F.col(f"{mine}{n}")) for n in ("", "x", "y")}
        open_points = durable(left.withColumns(side("h", "m") | side("l", "m")).drop("m", "mo", "mx", "my"))
    return reduce(DataFrame.union, kept).distinct()


def polygons(corners: DataFrame, size: float, by: Columns = (), x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """(*by, ring, corner, x, y) of the rings with three corners or more, numbered from 0, in the units of cells of that size from (x0, y0)."""
    listed = corners.groupBy(*by, "ring").agg(F.sort_array(F.collect_list(F.struct("place", "x", "y"))).alias("_c")).where(F.size("_c") >= 3)
    spread = listed.select(*by, "ring", F.posexplode("_c").alias("corner", "_p"))
    return spread.select(*by, "ring", "corner", F.round(F.col("_p.x") * size + x0, 4).alias("x"), F.round(F.col("_p.y") * size + y0, 4).alias("y"))
