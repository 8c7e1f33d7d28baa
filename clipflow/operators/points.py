"""Points in boxes, and the filters and fits that look at them.

To count them, boxes and points are dealt by frame once, and all that follows
stays where it is: no copies of boxes are dealt, nor what is counted.  Fits that
need the points themselves meet them by frame and cell of a few metres.  Clouds
are never gathered in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clipflow.operators.filters import REASONS, HardFilter, hard_filtered


def local(px: Column, py: Column, x: Column, y: Column, yaw: Column) -> tuple[Column, Column]:
    """A place in the frame of a box: along it and across it."""
    c, s = F.cos(yaw), F.sin(yaw)
    return (px - x) * c + (py - y) * s, (py - y) * c - (px - x) * s


def inside(margin: float = 0.0) -> Column:
    """Whether point (px, py, pz) lies in the box (x, y, z, dx, dy, dz, yaw), its sides included."""
    along, across = local(F.col("px"), F.col("py"), F.col("x"), F.col("y"), F.col("yaw"))
    return (F.abs(along) <= F.col("dx") / 2 + margin) & (F.abs(across) <= F.col("dy") / 2 + margin) & (F.abs(F.col("pz") - F.col("z")) <= F.col("dz") / 2 + margin)


#: Side of the cells in which points and boxes meet, and width of the stripes by which far points of a frame are told at once.
CELL, WIDE = 4.0, 32.0


def reached(own: DataFrame, reach: Column, cell: float) -> DataFrame:
    """own (x, y) once for each cell (_px, _py) within `reach` of it along both axes."""
    across = lambda c: F.explode(F.sequence(F.floor((F.col(c) - reach) / cell), F.floor((F.col(c) + reach) / cell)))
    return own.withColumn("_px", across("x")).withColumn("_py", across("y"))


def near_points(own: DataFrame, points: DataFrame, frame: list[str], reach: Column, cell: float = CELL) -> DataFrame:
    """Rows of own (frame..., x, y) each with the points (frame..., px, py, ...) of its frame in the cells within `reach` of it, along both axes.

    A point is in one cell, a box in each cell that it reaches, so a large frame
    is many keys, and a point meets only boxes that are near.
    """
    placed = points.withColumns({k: F.floor(F.col(c) / cell) for k, c in (("_px", "px"), ("_py", "py"))})
    return reached(own, reach, cell).join(placed, [*frame, "_px", "_py"]).drop("_px", "_py")


def counted(d: DataFrame, points: DataFrame, keys: tuple[str, ...] = ("frame_id", "det_idx"), margin: float = 0.0, shared: int = 1) -> DataFrame:
    """d with n_points, low and high: the number of points in each box, and the least and greatest of their heights.

    keys name a box; the first `shared` of them (its frame, and its clip if
    there is one) are the points' too.  Boxes are taken larger by the margin on
    all sides; those of the same keys count as one.  A box looks at all points
    of its frame, at the stripe of each first.
    """
    frame, found = keys[:shared], ("n_points", "low", "high")
    columns = [*keys, *(c for c in d.columns if c not in keys)]
    reach = F.hypot("dx", "dy") / 2 + abs(margin) * 2
    # what is known of a row alone is added after it is dealt
    own = d.select(*columns).repartition(*frame).select("*", F.floor((F.col("y") - reach) / WIDE).alias("_from"), F.floor((F.col("y") + reach) / WIDE).alias("_to"), F.monotonically_increasing_id().alias("_row"))
    cloud = points.select(*(F.col(c).alias(f"_{c}") for c in frame), "px", "py", "pz").repartition(*(f"_{c}" for c in frame)).withColumn("_stripe", F.floor(F.col("py") / WIDE))
    near = F.col("_stripe").between(F.col("_from"), F.col("_to")) & inside(margin)
    for c in frame:
        near = (F.col(c) == F.col(f"_{c}")) & near
    for c in keys[shared:]:
        near = near & F.col(c).isNotNull()
    met = own.join(cloud, near, "left").groupBy("_row", *keys).agg(*(F.first(c).alias(c) for c in columns if c not in keys), F.count("pz").alias("n_points"), F.min("pz").alias("low"), F.max("pz").alias("high"))
    same = W.partitionBy(*keys)
    return met.select(*columns, *(f(c).over(same).alias(c) for c, f in zip(found, (F.sum, F.min, F.max), strict=True)))


def sparse_filtered(d: DataFrame, config: HardFilter, most: int) -> DataFrame:
    """`hard_filtered` with the reason sparse_points for boxes of `most` points or fewer (n_points is a column of d)."""
    f = hard_filtered(d, config)
    sparse = (F.col("n_points") <= most) & ~F.array_contains("reasons", "invalid_box")
    reasons = F.when(F.coalesce(sparse, F.lit(False)), F.array_append("reasons", F.lit(REASONS[-1]))).otherwise(F.col("reasons"))
    return f.withColumn("reasons", reasons).withColumn("primary", F.get("reasons", 0)).withColumn("kept", F.size("reasons") == 0)


def finally_filtered(d: DataFrame, most_points: int, most_frames: int, class_name: str) -> DataFrame:
    """d without boxes of few points, then of tracks that are then left in few frames, then of other classes; the order counts."""
    # one shuffle by track, so that what d is made from is made once
    track = W.partitionBy("track_id")
    new = F.col("frame_id").isNotNull() & ~F.col("frame_id").eqNullSafe(F.lag("frame_id").over(track.orderBy("frame_id")))
    dense = d.where((F.col("n_points") > most_points) & F.col("track_id").isNotNull()).withColumn("_new", new.cast("long"))
    long = dense.withColumn("_n", F.sum("_new").over(track)).where(F.col("_n") > most_frames)
    return long.where(F.col("class_name") == class_name).select(*d.columns)


def bottom_fitted(d: DataFrame, class_name: str, prior: float, tolerance: float, least: float, pad: float) -> DataFrame:
    """d with boxes of the prior's height resting on their lowest point: the top stays, the bottom moves up, but never below the least height."""
    top, bottom = F.col("z") + F.col("dz") / 2, F.col("z") - F.col("dz") / 2
    gap = F.col("low") - bottom
    height = top - F.greatest(F.col("low") - pad, bottom)
    fits = (F.col("class_name") == class_name) & (F.abs(F.col("dz") - prior) <= tolerance) & (gap > 1e-6) & (height >= least)
    fits = F.coalesce(fits, F.lit(False))
    return d.withColumn("_h", F.when(fits, height).otherwise(F.col("dz"))).withColumn("z", F.when(fits, top - F.col("_h") / 2).otherwise(F.col("z"))).withColumn("dz", F.col("_h")).drop("_h")


def top_fitted(d: DataFrame, class_name: str, least_points: int, height: float, trim: float, gap: float) -> DataFrame:
    """d with a class's boxes at least `height` tall and topped by their highest point; a bottom that hangs below the lowest point by more than `gap` rises, `trim` at most."""
    tall = F.greatest(F.col("dz"), F.lit(height))
    bottom = F.col("high") - tall
    raised = F.when(F.col("low") - bottom > gap, F.least(F.col("low") - bottom, F.lit(trim))).otherwise(0.0)
    fits = F.coalesce((F.col("class_name") == class_name) & (F.col("n_points") >= least_points), F.lit(False))
    new = d.withColumn("_h", F.when(fits, tall - raised).otherwise(F.col("dz")))
    return new.withColumn("z", F.when(fits, F.col("high") - F.col("_h") / 2).otherwise(F.col("z"))).withColumn("dz", F.col("_h")).drop("_h")


def occlusion(d: DataFrame) -> DataFrame:
    """d with occluded: the share of a box's height that its points don't span; 1 without points."""
    return d.withColumn("occluded", F.when(F.col("n_points") == 0, 1.0).otherwise(1 - F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("high") - F.col("low")) / F.col("dz")))))


def track_heights(d: DataFrame, low: float, high: float, otherwise: float) -> DataFrame:
    """(track_id, height): the median of the heights that points span within the bounds, else of the boxes' own, else the general one."""
    span = F.col("high") - F.col("low")
    return d.groupBy("track_id").agg(F.coalesce(F.median(F.when(span.between(low, high), span)), F.median("dz"), F.lit(otherwise)).alias("height"))


def z_fitted(d: DataFrame, height: float, tolerance: float) -> DataFrame:
    """d with mode and z: which of the ground and the roof a box of that height stands on or hangs from.

    Both where they are about the height apart, then the ground, the roof, and
    else the box as it is; moves of up to 0.03 are left out.
    """
    both = F.abs(F.col("high") - F.col("low") - height) <= tolerance
    mode = F.when(F.col("low").isNull() & F.col("high").isNull(), "raw").when(both, "both").when(F.abs(F.col("low") - (F.col("z") - F.col("dz") / 2)) <= tolerance, "ground").when(F.abs(F.col("high") - (F.col("z") + F.col("dz") / 2)) <= tolerance, "roof").otherwise("raw")
    new = F.when(mode == "both", (F.col("low") + F.col("high")) / 2).when(mode == "ground", F.col("low") + height / 2).when(mode == "roof", F.col("high") - height / 2).otherwise(F.col("z"))
    return d.withColumn("mode", mode).withColumn("z", F.when(F.abs(new - F.col("z")) <= 0.03, F.col("z")).otherwise(new))
