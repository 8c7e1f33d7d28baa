"""A clip's boxes tied to tracks as its frames come in: state by clip, in lists and timers.

The state store must be RocksDB (`spark.sql.streaming.stateStore.providerClass`).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

OUT = "clip long, ts timestamp, det long, track long, late boolean"
_TRACK = "track long, t long, x double, y double, vx double, vy double"


def tied(tracks: list[tuple], seen: list[tuple], t: int, first_new: int, gate: float, per_second: float) -> tuple[list[tuple], dict[int, int], int]:
    """Open tracks, the track of each det, and the next free number, after the boxes (det, x, y) of one frame.

    From the nearest pair on, a box goes to the track whose way on comes within
    the gate, which widens with the time that it wasn't seen; of as near ones
    the lesser track, then det.  Other boxes begin tracks, in their order.
    """
    pairs = []
    for k, _, x, y, vx, vy, dt in ((*tr, (t - tr[1]) / 1e6) for tr in tracks):
        for det, u, v in seen:
            off = ((x + vx * dt - u) ** 2 + (y + vy * dt - v) ** 2) ** 0.5
            if off <= gate + per_second * dt:
                pairs.append((off, k, det))
    of, taken = {}, set()
    for _, k, det in sorted(pairs):
        if k not in taken and det not in of:
            of[det] = k
            taken.add(k)
    known, now = {tr[0]: tr for tr in tracks}, [tr for tr in tracks if tr[0] not in taken]
    for det, u, v in seen:
        if det not in of:
            of[det], first_new = first_new, first_new + 1
            now.append((of[det], t, u, v, 0.0, 0.0))
            continue
        k, before, x, y, *_ = known[of[det]]
        dt = (t - before) / 1e6
        now.append((k, t, u, v, (u - x) / dt if dt > 0 else 0.0, (v - y) / dt if dt > 0 else 0.0))
    return sorted(now), of, first_new


def frames_of(rows: pd.DataFrame) -> Iterator[tuple[int, list[tuple]]]:
    """The boxes (det, x, y) of each time, in order."""
    at = rows["ts"].astype("datetime64[us]").astype("int64")
    for t, part in rows.assign(_t=at).sort_values(["_t", "det"]).groupby("_t", sort=True):
        yield int(t), list(part[["det", "x", "y"]].itertuples(index=False, name=None))


class FollowClip(StatefulProcessor):
    """A clip's open tracks, the number of the next one, and a timer that ends what isn't seen any more."""

    def __init__(self, gap_us: int, gate: float, per_second: float) -> None:
        self.gap_us, self.gate, self.per_second = gap_us, gate, per_second

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tracks = handle.getListState("tracks", _TRACK)
        self.clock = handle.getValueState("clock", "next long, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        tracks = [tuple(t) for t in self.tracks.get()]
        first_new, last = tuple(self.clock.get()) if self.clock.exists() else (1, None)
        out = []
        for t, seen in frames_of(pd.concat(list(rows))):
            if last is not None and t <= last:  # an earlier frame changes nothing
                out += [(key[0], t, det, None, True) for det, *_ in seen]
                continue
            tracks = [tr for tr in tracks if t - tr[1] <= self.gap_us]
            tracks, of, first_new = tied(tracks, seen, t, first_new, self.gate, self.per_second)
            out += [(key[0], t, det, of[det], False) for det, *_ in seen]
            last = t
        self.tracks.put(tracks)
        self.clock.update((first_new, last))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(max(last // 1000 + self.gap_us // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))
        d = pd.DataFrame(out, columns=["clip", "ts", "det", "track", "late"])
        yield d.assign(ts=pd.to_datetime(d["ts"], unit="us"), track=d["track"].astype("Int64"))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.tracks.clear()  # numbers go on where they were
        return iter(())

    def close(self) -> None:
        pass


def followed(stream: DataFrame, gap_s: float, gate: float, per_second: float, late: str) -> DataFrame:
    """(clip, ts, det, track, late) of a stream of boxes (clip, ts, det, x, y), one row out for each row in.

    Frames of a clip are taken in the order of time; one that comes after a
    later one was seen is marked late, has no track and changes nothing.
    """
    d = stream.select("clip", "ts", "det", "x", "y").withWatermark("ts", late)
    return d.groupBy("clip").transformWithStateInPandas(FollowClip(int(gap_s * 1e6), gate, per_second), OUT, "append", "EventTime")


def followed_batch(boxes: DataFrame, gap_s: float, gate: float, per_second: float) -> DataFrame:
    """The same for a table: a clip's frames in one group, which is the unit that its tracks are about."""

    def follow(rows: pd.DataFrame) -> pd.DataFrame:
        tracks, first_new, out = [], 1, []
        for t, seen in frames_of(rows):
            tracks = [tr for tr in tracks if t - tr[1] <= gap_s * 1e6]
            tracks, of, first_new = tied(tracks, seen, t, first_new, gate, per_second)
            out += [(rows["clip"].iloc[0], t, det, of[det], False) for det, *_ in seen]
        d = pd.DataFrame(out, columns=["clip", "ts", "det", "track", "late"])
        return d.assign(ts=pd.to_datetime(d["ts"], unit="us"))

    return boxes.select("clip", "ts", "det", "x", "y").groupBy("clip").applyInPandas(follow, OUT)
