"""States over time: bins, votes, holds, switches, crossings and intervals."""

from __future__ import annotations

import math
from functools import reduce
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clipflow.operators.aggregates import along
from clipflow.operators.groups import durable, leaders
from clipflow.operators.stitching import once_each

#: How many undecided tracks look for leaders among themselves at first.
HEAD = 512


def projected(obs: DataFrame, heading: float, width_us: int) -> DataFrame:
    """obs with bin, ahead, aside and speed: place and speed along a heading; a track's first speed is its second one."""
    c, s = F.cos(F.lit(heading)), F.sin(F.lit(heading))
    o = obs.withColumn("ahead", F.col("x") * c + F.col("y") * s).withColumn("aside", F.col("y") * c - F.col("x") * s).withColumn("bin", F.floor(F.col("t_us") / width_us))
    dt = (F.col("t_us") - F.lag("t_us").over(along())) / 1e6
    own = F.when(dt > 0, F.hypot(F.col("x") - F.lag("x").over(along()), F.col("y") - F.lag("y").over(along())) / dt)
    o = o.withColumn("_v", own)
    return o.withColumn("speed", F.coalesce("_v", F.when(F.lag("t_us").over(along()).isNull(), F.lead("_v").over(along())))).drop("_v")


def majority(states: DataFrame, by: str, half: int) -> DataFrame:
    """states (by, bin, state) with major: the state most often known within `half` bins, the one known first of as frequent ones; null if none is."""
    known = states.where("state IS NOT NULL").select(by, "state", F.col("bin").alias("_from"), F.explode(F.sequence(F.col("bin") - half, F.col("bin") + half)).alias("bin"))
    votes = known.groupBy(by, "bin", "state").agg(F.count("*").alias("_n"), F.min("_from").alias("_first"))
    best = votes.groupBy(by, "bin").agg(F.max_by("state", F.struct(F.col("_n"), -F.col("_first"))).alias("major"))
    return states.join(best, [by, "bin"], "left")


def runs(states: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """states with run, a number of the stretch of equal values that a row is in, and nth, its place there."""
    w = W.partitionBy(by).orderBy(order)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & F.lag(order).over(w).isNotNull(), 0).otherwise(1)
    r = states.withColumn("_new", new).withColumn("run", F.sum("_new").over(w))
    return r.withColumn("nth", F.row_number().over(W.partitionBy(by, "run").orderBy(order))).drop("_new")


def hysteresis(states: DataFrame, by: str, least: int) -> DataFrame:
    """states with steady: the state switches only once another has stood for `least` bins in a row, and so lags behind; the first stands from the start."""
    r = runs(states, by, "bin", "state")
    so_far = W.partitionBy(by).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    firm = F.last(F.when(F.col("nth") >= least, F.struct("state")), True).over(so_far)
    first = F.first(F.struct("state")).over(so_far)
    return r.withColumn("steady", F.coalesce(firm, first)["state"]).drop("run", "nth")


def intervals(states: DataFrame, by: str, value: str) -> DataFrame:
    """(by, value, first_bin, last_bin, n): the stretches of equal values."""
    return runs(states, by, "bin", value).groupBy(by, "run", value).agg(F.min("bin").alias("first_bin"), F.max("bin").alias("last_bin"), F.count("*").alias("n")).drop("run")


def crossings(places: DataFrame, step: float, most_gap_us: int, line: float, tolerance: float) -> DataFrame:
    """(track_id, event_id): rows at which a track has passed the line for good.

    Progress counts from the last place clearly before the line, so slow
    creeping adds up; once it reaches `step` beyond, the row is told and counting
    starts anew there, as it does after a long gap.  Rows stream past in the
    order of their track and time, two numbers being all that is held of a
    track; rows without time or place are left out.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        track, last, anchor = None, None, None
        for batch in batches:
            told = []
            for i, (k, t, ahead) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("track_id", "t_us", "ahead")), strict=True)):
                fresh = anchor is None or k != track or t - last > most_gap_us or ahead <= line - tolerance
                passed = not fresh and ahead >= line and ahead - anchor >= step
                if passed:
                    told.append(i)
                if fresh or passed:
                    anchor = ahead
                track, last = k, t
            yield batch.select(["track_id", "event_id"]).take(pa.array(told, pa.int64()))

    rows = places.select("track_id", "event_id", "t_us", "ahead").where("t_us IS NOT NULL AND ahead IS NOT NULL")
    ordered = rows.repartition("track_id").sortWithinPartitions("track_id", "t_us", "event_id")
    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("track_id", "event_id")}
    return ordered.mapInArrow(scan, f"track_id {kinds['track_id']}, event_id {kinds['event_id']}")


def movements(features: DataFrame, strong: float, weak: float, lateral: float) -> DataFrame:
    """features (net_turn, cumulative, offset) with left, right, straight and movement: added scores, and the best; straight where as good."""
    t, c, o = F.col("net_turn"), F.col("cumulative"), F.col("offset")
    add = lambda *rules: sum((F.when(cond, v).otherwise(0.0) for cond, v in rules[1:]), F.when(rules[0][0], rules[0][1]).otherwise(0.0))
    left = add((t >= strong, 2.0), ((t >= weak) & (t < strong), 1.0), (c >= strong, 1.0), (o >= lateral, 0.5))
    right = add((t <= -strong, 2.0), ((t <= -weak) & (t > -strong), 1.0), (c <= -strong, 1.0), (o <= -lateral, 0.5))
    straight = add((F.abs(t) < weak, 2.0), (F.abs(c) < weak, 1.0), (F.abs(o) < lateral, 0.5))
    d = features.withColumns({"left": left, "right": right, "straight": straight})
    best = F.when((F.col("straight") >= F.col("left")) & (F.col("straight") >= F.col("right")), "straight").when(F.col("left") >= F.col("right"), "left").otherwise("right")
    return d.withColumn("movement", best)


def turn_features(obs: DataFrame, least_step: float) -> DataFrame:
    """(track_id, net_turn, cumulative, offset, changes): how a track turns, from the headings of its steps of `least_step` or more.

    net_turn is from the first heading to the last, cumulative the sum of the
    turns between steps, changes how often their sign changes, and offset the
    last place aside of the first heading.
    """
    from clipflow.functions.angles import wrap

    way = lambda c: F.col(c) - F.lag(c).over(along())
    s = obs.withColumn("_sx", way("x")).withColumn("_sy", way("y")).where(F.hypot("_sx", "_sy") >= least_step).withColumn("_h", F.atan2("_sy", "_sx"))
    s = s.withColumn("_turn", wrap(F.col("_h") - F.lag("_h").over(along())))
    s = s.withColumn("_was", F.last(F.when(F.col("_turn") != 0, F.signum("_turn")), True).over(along().rowsBetween(W.unboundedPreceding, -1)))
    at = F.struct("t_us", "event_id")
    f = s.groupBy("track_id").agg(
        F.min_by("_h", at).alias("_h0"), F.max_by("_h", at).alias("_h1"), F.coalesce(F.sum("_turn"), F.lit(0.0)).alias("cumulative"), F.count_if(F.signum("_turn") * F.col("_was") < 0).alias("changes"),
        F.min_by(F.struct((F.col("x") - F.col("_sx")).alias("x"), (F.col("y") - F.col("_sy")).alias("y")), at).alias("_p0"), F.max_by(F.struct("x", "y"), at).alias("_p1"),
    )
    dx, dy = F.col("_p1.x") - F.col("_p0.x"), F.col("_p1.y") - F.col("_p0.y")
    return f.select("track_id", wrap(F.col("_h1") - F.col("_h0")).alias("net_turn"), "cumulative", (dy * F.cos("_h0") - dx * F.sin("_h0")).alias("offset"), "changes")


#: Pairs that a direction may have in the first, narrowest round of tolerances; each further round is so many times wider.
FEW, WIDER = 8, 8


def axis_pairs(directions: DataFrame, tolerance: float) -> DataFrame:
    """(a, b, apart): directions (id, heading) and their opposites within the tolerance, each in one pair: from the best pair on, of as good ones the lesser ids.

    The narrowest pairs come first: those of a tolerance that gives each
    direction a few are made and chosen, and only what they leave meets in a
    wider one, since pairs further apart can't come before.
    """
    left = durable(directions.select("id", "heading").where("heading IS NOT NULL"))
    within, out = min(tolerance, FEW * math.pi / max(left.count(), 1)), []
    while True:
        best = durable(once_each(_opposite(left, within)))
        out.append(best)
        if within >= tolerance:
            return reduce(DataFrame.union, out).withColumnRenamed("score", "apart")
        gone = best.select(F.explode(F.array("a", "b")).alias("id"))
        left, within = durable(left.join(gone, "id", "left_anti")), min(tolerance, WIDER * within)


def _opposite(directions: DataFrame, tolerance: float) -> DataFrame:
    """(a, b, score): each two directions whose headings are opposite within the tolerance, a < b, and how much they are off, to six places."""
    from clipflow.functions.angles import turn, wrap

    # a direction meets those whose heading, turned about, lies in its own or a neighbouring sector; sectors are wide enough for rounding
    sectors = max(1, int(2 * math.pi / max(tolerance + 1e-6, 1e-5)))
    width = 2 * math.pi / sectors
    sector = lambda h: F.pmod(F.floor(F.pmod(h, F.lit(2 * math.pi)) / width), F.lit(sectors))
    around = F.array_distinct(F.array(*(F.pmod(sector(F.col("heading")) + k, F.lit(sectors)) for k in (-1, 0, 1))))
    p = directions.select(F.col("id").alias("a"), F.col("heading").alias("_ha"), F.explode(around).alias("_s"))
    q = directions.select(F.col("id").alias("b"), F.col("heading").alias("_hb"), sector(wrap(F.col("heading") + math.pi)).alias("_s"))
    pairs = p.join(q, "_s").where("a < b").withColumn("score", F.round(turn(F.col("_ha"), F.col("_hb") + math.pi), 6)).where(F.col("score") <= tolerance)
    return pairs.select("a", "b", "score").distinct()


def directions(tracks: DataFrame, by: tuple[str, ...], tolerance: float, gate: float) -> DataFrame:
    """(id, leader): the direction of travel of each track (*by, id, place, heading, x, y), named by the track that leads it.

    Tracks go by their place; one that no leader before it has within the
    tolerance of its heading and the gate aside of its line leads.  The first
    undecided tracks of each `by` find the leaders among themselves, which then
    decide all tracks that they cover, and so on with more of them at a time; so
    tracks meet leaders, in sectors of heading, rather than each other.
    """
    from clipflow.functions.angles import turn

    sectors = max(1, int(2 * math.pi / tolerance))
    sector = F.pmod(F.floor(F.pmod("heading", F.lit(2 * math.pi)) / (2 * math.pi / sectors)), F.lit(sectors))

    def met(ahead: DataFrame, behind: DataFrame, how: str = "inner") -> DataFrame:
        a = ahead.withColumn("_s", F.explode(F.array_distinct(F.array(*(F.pmod(sector + k, F.lit(sectors)) for k in (-1, 0, 1)))))).alias("a")
        b = behind.withColumn("_s", sector).alias("b")
        on = (F.col("a._s") == F.col("b._s")) & (F.col("a.place") < F.col("b.place"))
        for k in by:
            on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
        aside = (F.col("b.x") - F.col("a.x")) * F.sin("a.heading") - (F.col("b.y") - F.col("a.y")) * F.cos("a.heading")
        on = on & (turn(F.col("a.heading"), F.col("b.heading")) <= tolerance) & (F.abs(aside) <= gate)
        return b.join(a, on, "left_anti").drop("_s") if how == "left_anti" else a.join(b, on, how)

    tracks = durable(tracks.select(*by, "id", "place", "heading", "x", "y"))
    left, size, found = tracks, HEAD, []
    while not left.isEmpty():
        nth = F.row_number().over(W.partitionBy(*by).orderBy("place", "id"))
        head = durable(left.withColumn("_nth", nth).where(F.col("_nth") <= size).drop("_nth"))
        own = leaders(head.select("id", "place"), met(head, head).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"))).where("id = leader").select("id")
        lead = durable(head.join(own, "id", "left_semi").select(head.columns))
        found.append(lead)
        rest = left.join(head.select("id"), "id", "left_anti").select(left.columns)
        left, size = durable(met(lead, rest, "left_anti")), 2 * size
    lead = tracks.where("false")
    for part in found:
        lead = lead.union(part)
    follow = met(lead, tracks.join(lead.select("id"), "id", "left_anti").select(tracks.columns)).groupBy(F.col("b.id").alias("id")).agg(F.min_by("a.id", F.struct("a.place", "a.id")).alias("leader"))
    return lead.select("id", F.col("id").alias("leader")).union(follow)


def lanes(tracks: DataFrame, least: int, width: float) -> DataFrame:
    """(direction, movement, heading, centre, width, n): a lane for each movement of a direction of `least` tracks or more.

    tracks (direction, id, movement, heading, x, y); centres are medians aside
    of the direction's median place, to the right, left lanes at least a width
    left of the straight one (or of the median of centres) and right ones right
    of it; a lane is as wide as its tracks spread, and half a width.
    """
    d = tracks.groupBy("direction").agg(F.atan2(F.sum(F.sin("heading")), F.sum(F.cos("heading"))).alias("_h"), F.median("x").alias("_x"), F.median("y").alias("_y"), F.count("*").alias("_n")).where(F.col("_n") >= least)
    named = F.when(F.col("movement").isin("left", "right"), F.col("movement")).otherwise("straight")
    t = tracks.withColumn("movement", named).join(d, "direction").withColumn("_aside", (F.col("x") - F.col("_x")) * F.sin("_h") - (F.col("y") - F.col("_y")) * F.cos("_h"))
    spread = F.percentile("_aside", F.lit(0.98)) - F.percentile("_aside", F.lit(0.02))
    one = t.groupBy("direction", "movement").agg(F.first("_h").alias("heading"), F.median("_aside").alias("_c"), F.greatest(F.lit(width), spread + 0.5 * width).alias("width"), F.count("*").alias("n"))
    all_of = W.partitionBy("direction")
    middle = F.when(F.count("*").over(all_of) > 1, F.median("_c").over(all_of))
    straight = F.coalesce(F.max(F.when(F.col("movement") == "straight", F.col("_c"))).over(all_of), middle)
    centre = F.when(straight.isNull(), F.col("_c")).when(F.col("movement") == "left", F.least("_c", straight - width)).when(F.col("movement") == "right", F.greatest("_c", straight + width)).otherwise(F.col("_c"))
    return one.withColumn("centre", centre).select("direction", "movement", "heading", "centre", "width", "n")


def phases(scores: DataFrame, by: str, names: tuple[str, ...], switch: float) -> DataFrame:
    """(by, bin, phase): the likeliest course of phases, where each bin's score of its phase counts and a switch costs.

    Bins stream past in the order of their `by`; the best course into each phase
    goes on from bin to bin, one small number for each phase and bin tells where
    it came from, and the best course is read back at the end of a `by`.  Of as
    good ones the phase named first; missing scores count nothing.
    """
    n = len(names)

    def course(bins: list, scores: list[list[float]]) -> list[str]:
        cost, back = [0.0] * n, bytearray()
        for s in scores:
            best = max(cost)
            first = cost.index(best)
            stays = [c >= best - switch for c in cost]
            cost = [round((c if stay else best - switch) + v, 6) for c, stay, v in zip(cost, stays, s, strict=True)]
            back += bytes(k if stay else first for k, stay in enumerate(stays))
        k, out = cost.index(max(cost)), []
        for i in range(len(bins) - 1, -1, -1):
            out.append(names[k])
            k = back[i * n + k]
        return out[::-1]

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, key, bins, held = None, None, [], []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([key] * len(bins), kind.field(0).type), pa.array(bins, kind.field(1).type), pa.array(course(bins, held), pa.string())], [by, "bin", "phase"])

        for batch in batches:
            kind, ready = batch.schema, []
            for k, b, *s in zip(*(batch.column(i).to_pylist() for i in range(n + 2)), strict=True):
                if bins and k != key:
                    ready.append(done())
                    bins, held = [], []
                key = k
                bins.append(b)
                held.append(s)
            if ready:
                yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
        if bins:
            yield done()

    rows = scores.select(by, "bin", *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_s{k}") for k, c in enumerate(names)))
    ordered = rows.repartition(by).sortWithinPartitions(by, "bin", *(f"_s{k}" for k in range(n)))
    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (by, "bin"))
    return ordered.mapInArrow(follow, f"{fields}, phase string")
