"""Fragments of one vehicle that waits and moves on in a queue, stitched together.

Fragments of a direction that lie side by side make a lane, and neighbours along
a lane a queue.  Of two fragments of a queue the later one may go on where the
earlier one ended, if no third one stood between them meanwhile; such links are
merged in the queue's order as long as no two members are there at once.

Fragments are dealt by queue once; kernels of arrays take whole queues, so that
pairs of fragments never are rows, but for the links.  A task holds the
fragments of a queue, and a bounded number of its pairs at a time.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipflow.operators import arrow

Columns = tuple[str, ...]


@dataclass(frozen=True)
class Queue:
    lane: float = 3.5
    gap: float = 20.0
    back: float = 1.5
    aside: float = 2.5
    lane_change: float = 5.0
    around: float = 2.0


def fragments(obs: DataFrame, by: Columns = ()) -> DataFrame:
    """(*by, direction, id, movement, u, v, n, dynamic, alone, began, ended): observations (*by, direction, way, id, movement, t_us, x, y, inside, dynamic, isolated) by fragment.

    u and v are the median place along the direction's heading `way` and to the
    right of it; began and ended are structs (t_us, u, inside) of the first and
    last row.  Isolated rows count for nothing but `alone`, which tells that
    there are some; a fragment without a direction, or without other rows, is none.
    """
    d = obs.where("direction IS NOT NULL AND way IS NOT NULL AND t_us IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL")
    own = ~F.coalesce("isolated", F.lit(False))
    kept = lambda c: F.when(own, F.col(c))
    at = F.when(own, F.struct("t_us", "x", "y", F.coalesce("inside", F.lit(False)).alias("inside")))
    # lanes and queues are found by clip and direction, so rows are dealt once
    g = d.repartition(*by, "direction").groupBy(*by, "direction", "id").agg(
        F.min("movement").alias("movement"), F.first("way").alias("way"), F.median(kept("x")).alias("_x"), F.median(kept("y")).alias("_y"), F.count(kept("t_us")).alias("n"),
        F.coalesce(F.bool_or(own & F.col("dynamic")), F.lit(False)).alias("dynamic"), F.bool_or(~own).alias("alone"), F.min(at).alias("_first"), F.max(at).alias("_last"),
    )
    along = lambda x, y: F.col(x) * F.cos("way") + F.col(y) * F.sin("way")
    end = lambda s: F.struct(F.col(f"{s}.t_us").alias("t_us"), along(f"{s}.x", f"{s}.y").alias("u"), F.col(f"{s}.inside").alias("inside"))
    across = F.col("_x") * F.sin("way") - F.col("_y") * F.cos("way")
    return g.where("n > 0").select(*by, "direction", "id", "movement", along("_x", "_y").alias("u"), across.alias("v"), "n", "dynamic", "alone", end("_first").alias("began"), end("_last").alias("ended"))


def queued(parts: DataFrame, by: Columns = (), config: Queue = Queue()) -> DataFrame:
    """Fragments with their lane and queue, numbered within a direction and a lane, and their position in the queue."""

    def islands(d: DataFrame, keys: Columns, order: Columns, apart: float, name: str) -> DataFrame:
        w = W.partitionBy(*keys).orderBy(*order)
        new = F.coalesce((F.col(order[0]) - F.lag(order[0]).over(w) > apart).cast("int"), F.lit(0))
        return d.withColumn("_new", new).withColumn(name, F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")

    lanes = islands(parts, (*by, "direction"), ("v", "id"), config.lane, "lane")
    queues = islands(lanes, (*by, "direction", "lane"), ("u", "v", "id"), config.gap, "queue")
    return queues.withColumn("position", F.row_number().over(W.partitionBy(*by, "direction", "lane", "queue").orderBy("u", "v", "id")))


#: Numbers of the movements that rules name; others get numbers of their own.
NONE, LEFT, STRAIGHT, RIGHT = range(4)
#: Thirds that each link looks at first, one after the other, before the rest of its stretch is looked through at once.
FIRST = 32


def compatible(a: np.ndarray, b: np.ndarray, v_a: np.ndarray, v_b: np.ndarray, most: float) -> np.ndarray:
    """Whether fragments of these movements may be of one vehicle: left of straight is left, right of it right, and no lane change is wide."""
    near = np.abs(v_a - v_b) <= most
    same = (a == NONE) | (b == NONE) | (a == b)
    pair = lambda m, n: ((a == m) & (b == n)) | ((a == n) & (b == m))
    of = lambda m: np.where(a == m, v_a, v_b)
    return np.select(
        [same, pair(LEFT, STRAIGHT), pair(RIGHT, STRAIGHT)],
        [~((a == RIGHT) | (b == RIGHT)) | near, near & (of(LEFT) <= of(STRAIGHT)), near & (of(RIGHT) >= of(STRAIGHT))],
        ~pair(LEFT, RIGHT),
    )


def _behind(q: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, config: Queue) -> np.ndarray:
    """Whether nothing of the queue stands between fragments a and b, from where and when a ended to where and when b began."""
    order = np.argsort(q["u"], kind="stable")
    u, begun, ended = q["u"][order], q["t0"][order], q["t1"][order]
    after, before = q["t1"][a], q["t0"][b]
    # as in SQL, nan is greatest
    low, high = np.fmin(q["u1"][a], q["u0"][b]) - config.around, np.maximum(q["u1"][a], q["u0"][b]) + config.around
    first, last = np.searchsorted(u, low, "left"), np.searchsorted(u, high, "right")
    free, left = np.ones(len(a), bool), np.flatnonzero(first < last)
    for k in range(FIRST):
        if not len(left):
            break
        third = first[left] + k
        hit = (begun[third] > after[left]) & (ended[third] < before[left])
        free[left[hit]] = False
        left = left[~hit & (third + 1 < last[left])]
    for part in arrow.parts((last - first)[left]):
        some = left[part]
        link, third = arrow.ranges(first[some], (last - first)[some])
        hit = (begun[third] > after[some][link]) & (ended[third] < before[some][link])
        free[some[link[hit]]] = False
    return free


def _linked(q: dict[str, np.ndarray], config: Queue) -> tuple[np.ndarray, np.ndarray]:
    """The fragments a and b of a queue where b may go on where a ended."""
    c, numbers = config, {"": NONE, "left": LEFT, "straight": STRAIGHT, "right": RIGHT}
    move = np.array([numbers.setdefault(m, len(numbers)) for m in q["movement"]])
    order = np.argsort(q["v"], kind="stable")
    v = q["v"][order]
    first, last = np.searchsorted(v, v - c.aside - 1e-6, "left"), np.searchsorted(v, v + c.aside + 1e-6, "right")
    size, found = np.where(np.isnan(v), 0, last - first), []
    for part in arrow.parts(size):
        a, b = arrow.ranges(first[part], size[part])
        a, b = order[a + part.start], order[b]
        some = (q["t1"][a] < q["t0"][b]) & (np.abs(q["v"][a] - q["v"][b]) <= c.aside) & ((q["u0"][b] + c.back >= q["u1"][a]) | np.isnan(q["u0"][b])) & (q["in1"][a] | q["in0"][b])
        a, b = a[some], b[some]
        some = compatible(move[a], move[b], q["v"][a], q["v"][b], c.lane_change)
        a, b = a[some], b[some]
        some = _behind(q, a, b, c)
        found.append((a[some], b[some]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _by_queue(parts: DataFrame, by: Columns, kernel: Callable, schema: T.StructType, more: Columns = ()) -> DataFrame:
    """The tables that kernel(rows, queue) makes of each queue's fragments, which are in the order of their positions: an Arrow table, and its columns as arrays."""
    keys = [*by, "direction", "lane", "queue"]
    ends = [F.col(f"{s}.{k}").alias(n + d) for s, d in (("began", "0"), ("ended", "1")) for k, n in (("t_us", "t"), ("u", "u"), ("inside", "in"))]
    # fragments of no clip link with none
    d = parts.dropna(how="any", subset=list(by)) if by else parts
    d = d.select(*keys, "id", "position", F.coalesce("movement", F.lit("")).alias("movement"), "u", "v", *ends, *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in arrow.whole(batches, keys):
            cuts = [*np.flatnonzero(arrow.starts(t, keys)), len(t)]
            whole = {c: t.column(c).to_numpy() for c in t.column_names if c not in (*keys, "id")}
            for i, j in zip(cuts, cuts[1:], strict=False):
                if j - i > 1:
                    yield from kernel(t.slice(i, j - i), {c: x[i:j] for c, x in whole.items()})

    return d.repartition(*keys).sortWithinPartitions(*keys, "position").mapInArrow(run, schema)


def _fields(d: DataFrame, names: list[str]) -> list[T.StructField]:
    return [T.StructField(n, d.schema[n].dataType) for n in names]


def links(parts: DataFrame, by: Columns = (), config: Queue = Queue()) -> DataFrame:
    """(*by, direction, lane, queue, a, b, first, second): fragments as `queued` gives them where b may go on where a ended; first and second are their lower and higher position."""
    keys = [*by, "direction", "lane", "queue"]
    id_ = parts.schema["id"].dataType
    schema = T.StructType([*_fields(parts, keys), T.StructField("a", id_), T.StructField("b", id_), T.StructField("first", T.IntegerType()), T.StructField("second", T.IntegerType())])

    def kernel(t: pa.Table, q: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        a, b = _linked(q, config)
        if len(a):
            at = q["position"].astype(np.int32)
            columns = [*(t.column(k).take(pa.array(a)) for k in keys), t.column("id").take(pa.array(a)), t.column("id").take(pa.array(b)), pa.array(np.minimum(at[a], at[b])), pa.array(np.maximum(at[a], at[b]))]
            yield from pa.table(columns, names=schema.names).combine_chunks().to_batches()

    return _by_queue(parts, by, kernel, schema)


def _merged(first: np.ndarray, second: np.ndarray, begun: list[int], ended: list[int]) -> list[int]:
    """The group of each fragment, named by one of its members: links (in their order) count if no member of one side is there while one of the other is."""
    root = list(range(len(begun)))
    #: the spans of each group, which are apart, in order
    spans = {}

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def meets(small: list[tuple[int, int]], large: list[tuple[int, int]]) -> bool:
        for f, t in small:
            k = bisect_left(large, (f,))
            if (k and large[k - 1][1] >= f) or (k < len(large) and large[k][0] <= t):
                return True
        return False

    for a, b in zip(first.tolist(), second.tolist(), strict=True):
        a, b = top(a), top(b)
        if a == b:
            continue
        s, l = (spans.get(k) or [(begun[k], ended[k])] for k in (a, b))
        if len(s) > len(l):
            a, b, s, l = b, a, l, s
        if not meets(s, l):
            for span in s:
                insort(l, span)
            spans[b] = l
            spans.pop(a, None)
            root[a] = b
    return [top(i) for i in range(len(root))]


def stitched(parts: DataFrame, by: Columns = (), config: Queue = Queue()) -> DataFrame:
    """(*by, id, target): fragments (as `fragments` gives them) of merged links, and the id that they all get.

    Links count in the order of their queue's positions; one is taken if no
    member of either side is there while one of the other is.  The target has
    the most rows (then the least id) of those without isolated rows; where none
    is or nothing is dynamic, nothing is merged.
    """
    keys, own = [*by, "direction", "lane", "queue"], ["id", "n", "dynamic", "alone"]
    found = queued(parts, by, config)
    schema = T.StructType([*_fields(found, [*keys, *own]), T.StructField("root", T.IntegerType())])

    def kernel(t: pa.Table, q: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        a, b = _linked(q, config)
        if len(a):
            # rows are in the order of positions
            first, second = np.minimum(a, b), np.maximum(a, b)
            order = np.lexsort((second, first))
            root = _merged(first[order], second[order], q["t0"].tolist(), q["t1"].tolist())
            some = np.bincount(root, minlength=len(t))[root] > 1
            yield from t.select([*keys, *own]).append_column("root", pa.array(np.array(root, np.int32))).filter(pa.array(some)).combine_chunks().to_batches()

    whole = _by_queue(found, by, kernel, schema, ("n", "dynamic", "alone"))
    w = W.partitionBy(*keys, "root")
    best = F.min(F.when(~F.col("alone"), F.struct(-F.col("n"), "id"))).over(w).getField("id")
    return whole.withColumn("target", best).withColumn("_moves", F.bool_or("dynamic").over(w)).where("_moves AND target IS NOT NULL").select(*by, "id", "target")
