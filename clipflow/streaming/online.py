"""Online forms of the filters, bins and gap sessions, for streams of observations with an event-time column `ts`."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filtered(stream: DataFrame, least_score: float) -> DataFrame:
    """Stateless: observations that score enough."""
    return stream.where(F.col("score") >= least_score)


def binned(stream: DataFrame, width: str, late: str) -> DataFrame:
    """Counts by class and window; observations later than `late` are left out."""
    w = stream.withWatermark("ts", late).groupBy(F.window("ts", width), "class_name")
    return w.agg(F.count("*").alias("samples"), F.approx_count_distinct("track_id").alias("active")).select("class_name", F.col("window.start").alias("start"), "samples", "active")


def segments(stream: DataFrame, gap: str, late: str) -> DataFrame:
    """One row for each stretch of a track without a gap longer than `gap`."""
    s = stream.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "track_id")
    return s.agg(F.count("*").alias("n")).select("track_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def smoothed(stream: DataFrame, size: str, slide: str, late: str) -> DataFrame:
    """Counts by class in windows of `size` that begin every `slide`: an extension of the row-based filter, as gaps count as empty time."""
    w = stream.withWatermark("ts", late).groupBy(F.window("ts", size, slide), "class_name")
    return w.agg(F.count("*").alias("samples")).select("class_name", F.col("window.start").alias("start"), "samples")


def once(stream: DataFrame, keys: tuple[str, ...], late: str) -> DataFrame:
    """Rows of which an equal key came within `late` before are left out; the first stays, where a batch keeps the last."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(list(keys))


def followed(stream: DataFrame, gap_s: float, late: str) -> DataFrame:
    """(track_id, ts, started, n, late): each row with the start of its track's stretch without a longer gap, and its number there.

    A stretch is state of its track, in the order of time; it expires once the
    watermark is a gap beyond its last row.  Rows before the last one seen are
    marked late and change nothing.
    """

    def step(key, parts, state):
        if state.hasTimedOut:
            state.remove()
            return
        started, last, n = state.get if state.exists else (None, None, 0)
        rows = pd.concat(list(parts)).sort_values("ts")
        times = rows["ts"].astype("datetime64[us]").astype("int64").tolist()
        out = []
        for t in times:
            if last is not None and t < last:
                out.append((started, n, True))
                continue
            if last is None or t - last > gap_s * 1e6:
                started, n = t, 0
            last, n = t, n + 1
            out.append((started, n, False))
        state.update((started, last, n))
        # a watermark that has passed this already can't be set again
        state.setTimeoutTimestamp(max(int(last / 1000 + gap_s * 1000) + 1, state.getCurrentWatermarkMs() + 1))
        first, number, is_late = zip(*out, strict=True)
        yield pd.DataFrame({"track_id": key[0], "ts": rows["ts"].to_numpy(), "started": pd.to_datetime(list(first), unit="us"), "n": number, "late": is_late})

    grouped = stream.select("track_id", "ts").withWatermark("ts", late).groupBy("track_id")
    return grouped.applyInPandasWithState(step, "track_id long, ts timestamp, started timestamp, n long, late boolean", "started long, last long, n long", "append", "EventTimeTimeout")
