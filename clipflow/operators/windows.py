"""Ordered computations along a track."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clipflow.operators.aggregates import along, stepped


def track():
    return W.partitionBy("track_id")


def islands(d: DataFrame, flag: Column) -> DataFrame:
    """d with island, a number that grows along the track wherever the flag changes."""
    was = F.lag(flag).over(along())
    return d.withColumn("island", F.sum(F.when(was.isNull() | (was != flag), 1).otherwise(0)).over(along()))


def regression_heading(obs: DataFrame, half: int, least_speed: float) -> DataFrame:
    """obs with heading: of the least-squares velocity of +-half rows where that is fast enough, else the nearest known before, then after."""
    near = along().rowsBetween(-half, half)
    t = F.col("t_us") / 1e6
    o = obs.withColumn("_t", t - F.min(t).over(track()))
    slope = lambda k: F.regr_slope(F.col(k), F.col("_t")).over(near)
    o = o.withColumn("_vx", slope("x")).withColumn("_vy", slope("y"))
    own = F.when(F.hypot("_vx", "_vy") >= least_speed, F.atan2("_vy", "_vx"))
    o = o.withColumn("_own", own)
    before = F.last("_own", True).over(along().rowsBetween(W.unboundedPreceding, 0))
    after = F.first("_own", True).over(along().rowsBetween(0, W.unboundedFollowing))
    return o.withColumn("heading", F.coalesce(before, after)).drop("_t", "_vx", "_vy", "_own")


def stationary_runs(obs: DataFrame, speed: float, least: int) -> DataFrame:
    """(track_id, first_us, last_us, n): runs of `least` rows or more that are slow from or to a neighbour."""
    s = stepped(obs)
    slow = F.coalesce(F.least(F.col("speed"), F.lead("speed").over(along())) <= speed, F.lit(False))
    s = islands(s.withColumn("_slow", slow), F.col("_slow"))
    return s.where("_slow").groupBy("track_id", "island").agg(F.min("t_us").alias("first_us"), F.max("t_us").alias("last_us"), F.count("*").alias("n")).where(F.col("n") >= least).drop("island")


def stop_intervals(obs: DataFrame, speed: float, least_us: int) -> DataFrame:
    """(track_id, start_us, end_us, mx, my): intervals of slow steps that last, with the middle of their places."""
    before = lambda c: F.lag(c).over(along())
    s = stepped(obs).withColumn("_from", before("t_us")).withColumn("_fx", before("x")).withColumn("_fy", before("y")).where("speed IS NOT NULL")
    s = islands(s.withColumn("_slow", F.col("speed") <= speed), F.col("_slow"))
    at = F.struct("t_us", "event_id")
    runs = s.where("_slow").groupBy("track_id", "island").agg(F.min("_from").alias("start_us"), F.max("t_us").alias("end_us"), ((F.min_by("_fx", at) + F.max_by("x", at)) / 2).alias("mx"), ((F.min_by("_fy", at) + F.max_by("y", at)) / 2).alias("my"))
    return runs.where(F.col("end_us") - F.col("start_us") >= least_us).drop("island")


def explicit_stop(obs: DataFrame, step: float, least_us: int) -> DataFrame:
    """(track_id, start_us, end_us, cx, cy): the longest run of short steps that lasts, the earliest of as long ones, and its mean place."""
    s = stepped(obs).withColumn("_from", F.lag("t_us").over(along())).where("step IS NOT NULL")
    s = islands(s.withColumn("_short", F.col("step") < step), F.col("_short"))
    runs = s.where("_short").groupBy("track_id", "island").agg(F.min("_from").alias("start_us"), F.max("t_us").alias("end_us"), F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    long = runs.where(F.col("end_us") - F.col("start_us") >= least_us)
    rank = W.partitionBy("track_id").orderBy(F.desc(F.col("end_us") - F.col("start_us")), "start_us")
    return long.withColumn("_n", F.row_number().over(rank)).where("_n = 1").select("track_id", "start_us", "end_us", "cx", "cy")


def endpoint_velocity(obs: DataFrame, rows: int) -> DataFrame:
    """(track_id, vx0, vy0, vx1, vy1): least-squares velocities of a track's first and last rows."""
    back = track().orderBy(F.desc("t_us"), F.desc("event_id"))
    o = obs.withColumn("_t", (F.col("t_us") - F.min("t_us").over(track())) / 1e6).withColumn("_i", F.row_number().over(along())).withColumn("_j", F.row_number().over(back))
    slope = lambda k, i: F.regr_slope(F.when(F.col(i) <= rows, F.col(k)), F.when(F.col(i) <= rows, F.col("_t")))
    return o.groupBy("track_id").agg(slope("x", "_i").alias("vx0"), slope("y", "_i").alias("vy0"), slope("x", "_j").alias("vx1"), slope("y", "_j").alias("vy1"))


def isolated_last(obs: DataFrame, gap_us: int) -> DataFrame:
    """(track_id, event_id): last observations that follow a long gap."""
    back = track().orderBy(F.desc("t_us"), F.desc("event_id"))
    o = obs.withColumn("_gap", F.col("t_us") - F.lag("t_us").over(along())).withColumn("_n", F.row_number().over(back))
    return o.where((F.col("_n") == 1) & (F.col("_gap") >= gap_us)).select("track_id", "event_id")


def smoothed(counts: DataFrame, by: str, value: str, window: int) -> DataFrame:
    """counts with smooth: a box filter of `window` bins, zero beyond the edges, as ordered by bin."""
    left = window // 2
    near = W.partitionBy(by).orderBy("bin").rowsBetween(-left, window - 1 - left)
    return counts.withColumn("smooth", F.sum(value).over(near) / window)


def filled(states: DataFrame, hold_us: int, gap_us: int) -> DataFrame:
    """states with held: a known state is held over unknown rows for a while, and across short gaps between equal states."""
    known = F.when(F.col("state").isNotNull(), F.struct("t_us", "state"))
    before = F.last(known, True).over(along().rowsBetween(W.unboundedPreceding, 0))
    after = F.first(known, True).over(along().rowsBetween(0, W.unboundedFollowing))
    s = states.withColumn("_b", before).withColumn("_a", after)
    held = F.when(F.col("t_us") - F.col("_b.t_us") <= hold_us, F.col("_b.state"))
    across = F.when((F.col("_b.state") == F.col("_a.state")) & (F.col("_a.t_us") - F.col("_b.t_us") <= gap_us), F.col("_b.state"))
    return s.withColumn("held", F.coalesce("state", held, across)).drop("_a", "_b")


def hole_runs(d: DataFrame) -> DataFrame:
    """(track_id, first_missing, last_missing, before, after): runs of frames in which a track isn't seen between its first and last."""
    seen = d.select("track_id", "frame").distinct()
    nxt = F.lead("frame").over(W.partitionBy("track_id").orderBy("frame"))
    g = seen.withColumn("after", nxt).where(F.col("after") > F.col("frame") + 1)
    return g.select("track_id", (F.col("frame") + 1).alias("first_missing"), (F.col("after") - 1).alias("last_missing"), F.col("frame").alias("before"), "after")


def first_break(obs: DataFrame, acceleration: float) -> DataFrame:
    """(track_id, break_at): the number of the first row where the track turns back or speeds up beyond the limit."""
    vx = (F.col("x") - F.lag("x").over(along())) / F.col("dt")
    vy = (F.col("y") - F.lag("y").over(along())) / F.col("dt")
    s = stepped(obs).withColumn("_i", F.row_number().over(along()))
    s = s.withColumn("_vx", F.when(F.col("dt") > 0, vx)).withColumn("_vy", F.when(F.col("dt") > 0, vy))
    px, py = F.lag("_vx").over(along()), F.lag("_vy").over(along())
    s = s.withColumn("_dot", F.col("_vx") * px + F.col("_vy") * py).withColumn("_acc", F.hypot(F.col("_vx") - px, F.col("_vy") - py) / F.col("dt"))
    return s.where((F.col("_dot") < 0) | (F.col("_acc") > acceleration)).groupBy("track_id").agg(F.min("_i").alias("break_at"))


def interval_speeds(obs: DataFrame, intervals: DataFrame, margin_us: int, bin_us: int = 21_600_000_000) -> DataFrame:
    """(track_id, start_us, n, mean_speed, max_speed) of each interval widened by the margin on either side.

    Rows meet the intervals of their track and time bin only.
    """
    low, high = F.col("start_us") - margin_us, F.col("end_us") + margin_us
    i = intervals.select("track_id", "start_us", low.alias("_low"), high.alias("_high")).distinct()
    bins = F.sequence(F.floor(F.col("_low") / bin_us), F.floor(F.col("_high") / bin_us))
    s = stepped(obs).select("track_id", "t_us", "speed", F.floor(F.col("t_us") / bin_us).alias("_bin"))
    met = i.withColumn("_bin", F.explode(bins)).join(s, ["track_id", "_bin"]).where("t_us BETWEEN _low AND _high")
    own = met.groupBy("track_id", "start_us").agg(F.count("speed").alias("n"), F.avg("speed").alias("mean_speed"), F.max("speed").alias("max_speed"))
    return i.select("track_id", "start_us").join(own, ["track_id", "start_us"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def radial_departures(obs: DataFrame, near: float, far: float, step: float, rows: int, least: int, total: float) -> DataFrame:
    """(track_id, confirmed_us): tracks that leave their first place outwards, and when they are first beyond `near` plus a step."""
    first = track().orderBy("t_us", "event_id")
    o = obs.withColumn("_i", F.row_number().over(first)).withColumn("_r", F.hypot(F.col("x") - F.first("x").over(first), F.col("y") - F.first("y").over(first)))
    o = o.withColumn("_up", F.col("_r") - F.lag("_r").over(first))
    rise = (F.col("_i") <= rows) & (F.col("_up") > step)
    t = o.groupBy("track_id").agg(F.max("_r").alias("m"), F.count_if(rise).alias("n"), F.sum(F.when(rise, F.col("_up"))).alias("s"), F.min(F.when(F.col("_r") >= near, F.col("t_us"))).alias("confirmed_us"))
    return t.where((F.col("m") >= far) & (F.col("n") >= least) & (F.col("s") >= total)).select("track_id", "confirmed_us")


def principal_axis(obs: DataFrame) -> DataFrame:
    """(track_id, axis, span): direction of the largest spread (closed form of the 2x2 eigenvector), and the way along it."""
    by = track()
    cov = lambda a, b: F.covar_pop(F.col(a), F.col(b)).over(by)
    o = obs.withColumn("axis", F.atan2(2 * cov("x", "y"), cov("x", "x") - cov("y", "y")) / 2)
    along = F.col("x") * F.cos("axis") + F.col("y") * F.sin("axis")
    return o.groupBy("track_id").agg(F.first("axis").alias("axis"), (F.max(along) - F.min(along)).alias("span"))


def steady_windows(obs: DataFrame, rows: int, path: float, speed: float, concentration: float, forward: int, most_gap_us: int) -> DataFrame:
    """(track_id, event_id, path, net): each track's first window of `rows` rows in which it clearly moves on.

    It goes `path` at least, straight by `concentration`, at a net `speed`, with
    `forward` steps along the way from first to last, and without a long gap.
    """
    near = along().rowsBetween(0, rows - 1)
    s = stepped(obs).withColumn("_sx", F.col("x") - F.lag("x").over(along())).withColumn("_sy", F.col("y") - F.lag("y").over(along()))
    steps = F.slice(F.collect_list(F.struct("_sx", "_sy", "step", "dt")).over(near), 2, rows)  # the first row's step leads to it
    e = s.withColumn("_steps", steps).withColumn("_dx", F.last("x").over(near) - F.col("x")).withColumn("_dy", F.last("y").over(near) - F.col("y")).withColumn("_time", (F.last("t_us").over(near) - F.col("t_us")) / 1e6)
    e = e.where(F.size("_steps") == rows - 1)
    total = F.aggregate("_steps", F.lit(0.0), lambda a, v: a + v["step"])
    ahead = F.size(F.filter("_steps", lambda v: v["_sx"] * F.col("_dx") + v["_sy"] * F.col("_dy") > 0))
    e = e.withColumn("path", total).withColumn("net", F.hypot("_dx", "_dy"))
    ok = (F.col("path") >= path) & (F.col("net") >= concentration * F.col("path")) & (F.col("net") >= speed * F.col("_time")) & (ahead >= forward) & F.forall("_steps", lambda v: v["dt"] * 1e6 <= most_gap_us)
    return e.where(ok).groupBy("track_id").agg(F.min_by(F.struct("event_id", "path", "net"), F.struct("t_us", "event_id")).alias("w")).select("track_id", "w.*")


def sessions(obs: DataFrame, gap_us: int) -> DataFrame:
    """obs with session: a number that grows along the track at each gap longer than gap_us."""
    late = F.col("t_us") - F.lag("t_us").over(along()) > gap_us
    return obs.withColumn("_late", F.coalesce(late, F.lit(False)).cast("int")).withColumn("session", F.sum("_late").over(along())).drop("_late")


def session_headings(obs: DataFrame, gap_us: int, half: int, least_speed: float, least_way: float) -> DataFrame:
    """obs with session and heading: of the least-squares velocity of +-half rows of the session, null where that is slow or short."""
    s = sessions(obs, gap_us)
    order = W.partitionBy("track_id", "session").orderBy("t_us", "event_id")
    near = order.rowsBetween(-half, half)
    s = s.withColumn("_t", (F.col("t_us") - F.min("t_us").over(W.partitionBy("track_id", "session"))) / 1e6)
    slope = lambda k: F.regr_slope(F.col(k), F.col("_t")).over(near)
    s = s.withColumn("_vx", slope("x")).withColumn("_vy", slope("y"))
    way = F.hypot(F.last("x").over(near) - F.first("x").over(near), F.last("y").over(near) - F.first("y").over(near))
    s = s.withColumn("_way", way)
    return s.withColumn("heading", F.when((F.hypot("_vx", "_vy") >= least_speed) & (F.col("_way") >= least_way), F.atan2("_vy", "_vx"))).drop("_t", "_vx", "_vy", "_way")


def neighbour_headings(obs: DataFrame, half: int) -> DataFrame:
    """obs with heading: the mean direction of the steps among +-half neighbours that leave the row itself out; null without any."""
    s = obs.withColumn("_px", F.lag("x").over(along())).withColumn("_py", F.lag("y").over(along()))
    s = s.withColumn("_u", F.atan2(F.col("y") - F.col("_py"), F.col("x") - F.col("_px")))
    # the steps that end before the row, and those that begin after it
    behind, ahead = along().rowsBetween(1 - half, -1), along().rowsBetween(2, half)
    part = lambda f: F.coalesce(F.sum(f("_u")).over(behind), F.lit(0.0)) + F.coalesce(F.sum(f("_u")).over(ahead), F.lit(0.0))
    s = s.withColumn("_c", part(F.cos)).withColumn("_s", part(F.sin))
    return s.withColumn("heading", F.when(F.hypot("_c", "_s") > 1e-6, F.atan2("_s", "_c"))).drop("_px", "_py", "_u", "_c", "_s")


def smoothed_places(obs: DataFrame, gap_us: int, half: int, blend: float, most: float) -> DataFrame:
    """obs with sx, sy: places drawn by `blend` to the weighted line of +-half rows of their session, `most` at most.

    Weights fall with the rows' distance in time; the line is the solution of
    the normal equations, which are sums over the rows.
    """
    s = sessions(obs, gap_us)
    order = W.partitionBy("track_id", "session").orderBy("t_us", "event_id").rowsBetween(-half, half)
    s = s.withColumn("_near", F.collect_list(F.struct("t_us", "x", "y")).over(order))
    width = gap_us / 1e6

    def drawn(c: str) -> Column:
        dt = lambda v: (v["t_us"] - F.col("t_us")) / 1e6
        w = lambda v: F.exp(-0.5 * F.pow(dt(v) / width, 2))
        total = lambda f: F.aggregate("_near", F.lit(0.0), lambda a, v: a + w(v) * f(v))
        n, t, tt, y, ty = total(lambda v: F.lit(1.0)), total(dt), total(lambda v: dt(v) * dt(v)), total(lambda v: v[c]), total(lambda v: dt(v) * v[c])
        det = n * tt - t * t
        fit = F.when(det > 1e-9, (y * tt - t * ty) / det).otherwise(y / n)
        return F.col(c) + F.greatest(F.lit(-most), F.least(F.lit(most), (fit - F.col(c)) * blend))

    return s.withColumn("sx", drawn("x")).withColumn("sy", drawn("y")).drop("_near")


def repaired_levels(obs: DataFrame, value: str, least: int, jump: float) -> DataFrame:
    """obs with level: where a track's values lie in two sets apart, the upper ones are drawn on the line between the lower ones about them.

    The sets are those on either side of the largest gap between values, with
    `least` rows each, no fewer below than above, and a gap of `jump` or more.
    """
    by = W.partitionBy("track_id")
    v = obs.withColumn("_gap", F.col(value) - F.lag(value).over(by.orderBy(value, "event_id")))
    v = v.withColumn("_cut", F.max(F.when(F.col("_gap") >= jump, F.struct("_gap", F.col(value).alias("at")))).over(by)["at"])
    low = F.col(value) < F.col("_cut")
    v = v.withColumn("_low", F.count_if(low).over(by)).withColumn("_high", F.count_if(~low).over(by))
    fixes = (F.col("_low") >= least) & (F.col("_high") >= least) & (F.col("_low") >= F.col("_high"))
    anchor = F.when(low, F.struct("t_us", F.col(value).alias("v")))
    v = v.withColumn("_a", F.last(anchor, True).over(along().rowsBetween(W.unboundedPreceding, 0))).withColumn("_b", F.first(anchor, True).over(along().rowsBetween(0, W.unboundedFollowing)))
    between = F.when(F.col("_a").isNull(), F.col("_b.v")).when(F.col("_b").isNull() | (F.col("_b.t_us") == F.col("_a.t_us")), F.col("_a.v")).otherwise(F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * (F.col("t_us") - F.col("_a.t_us")) / (F.col("_b.t_us") - F.col("_a.t_us")))
    return v.withColumn("level", F.when(F.coalesce(fixes & ~low, F.lit(False)), between).otherwise(F.col(value))).drop("_gap", "_cut", "_low", "_high", "_a", "_b")
