"""Hard-negative mining by inner products, with LEMP-style coordinate pruning.

1. Rows are laid out by label and falling length in shards of one label each;
   a shard's runs of `BUCKET` rows are its length buckets.  A task that holds a
   shard keeps, for each bucket and coordinate, the list of rows by value.
2. An ask is an anchor with ranges of scores, and a number of rows wanted from
   each.  A bucket with the greatest length L can't reach a score t where
   |q| L < t.  Otherwise the angle between q and any row that reaches it is
   arccos(t / (|q| L)) at most, so the row's value on a focus coordinate (one of
   the anchor's largest) lies in a range; the rows of these ranges are found by
   bisection in the sorted lists, the sets of several coordinates intersected,
   and what is left is scored exactly.  Each score found raises t.
3. Positives: every anchor asks its own shard first, which gives it a least
   score, and then the other shards of its label that can reach it.  Negatives:
   likewise one shard of another label, drawn by hash, and then all that can
   reach the least score of any of its ranges.  Anchors are the stated set of
   queries; they stream past the shard in blocks, in bounded memory.  A shard's
   answer is the best few for each range, so what meets for one anchor is a few
   rows of each shard that reaches its threshold.

Recall is exact: a range bounds every row that can reach the score, and nothing
is capped.

Defined results: rows without vec_id, label or vector, or with a null or
non-finite component, take no part; shorter vectors count as zeros beyond their
end; an empty vector scores zero with everything; equal scores go by vec_id;
rows that repeat an id are rows of their own, and an anchor is only never its
own positive; a negative positive score has no negatives; an empty table gives
an empty result; other columns are ignored.  A score that no long holds is an
error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from llm.sparkkit import small, stored

#: Rows of a shard and of a length bucket at most; focus coordinates of an anchor.
SHARD, BUCKET, FOCUS = 1 << 16, 4096, 6
#: Shards that meet the anchors under one key of their join.
FAN = 100_000
ANY = 1 << 62
#: Products summed below this are exact in doubles.
EXACT = float(1 << 53)


def quantised(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(row, vec_id, label, v, norm2): the rows that take part, components scaled and floored."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    d = some.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", v.alias("v"))
    return d.withColumn("norm2", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def sharded(rows: DataFrame) -> DataFrame:
    """rows with `shard`: runs of at most SHARD rows of one label by falling length."""
    order = [F.col("label"), F.desc("norm2"), F.col("vec_id"), F.col("row")]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn("shard", F.concat_ws("-", part, F.floor(place / SHARD), "label")).drop("_at")


def vectors(column: pa.Array, width: int) -> np.ndarray:
    """The lists of a column as rows of a matrix, zeros beyond their ends."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    width = max(width, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), width), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def exact_scores(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of v with q."""
    n = min(v.shape[1], len(q))
    v, q = v[:, :n], q[:n]
    if np.abs(v).max(initial=0).astype(float) * np.abs(q).max(initial=0).astype(float) * n < EXACT:
        return np.rint(v.astype(np.float64, copy=False) @ q.astype(np.float64)).astype(np.int64)
    return np.array([int(x) for x in v.astype(np.int64).astype(object) @ q.astype(np.int64).astype(object)], np.int64)


class Bucket:
    """Rows of about one length, and for each coordinate their places by value."""

    def __init__(self, v: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        self.ids, self.rows = ids, rows
        self.length = math.sqrt(float((v.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
        self.v = v.astype(np.float64) if np.abs(v).max(initial=0) < EXACT else v
        self.order = np.argsort(v, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.v, self.order, axis=0)

    def feasible(self, q: np.ndarray, length: float, focus: np.ndarray, least: int) -> np.ndarray | None:
        """Places that may score `least` or more; None for all."""
        if least <= 0 or length == 0 or self.length == 0:
            return None
        beta = math.acos(min(1.0, least / (length * self.length)))
        alpha = np.arccos(np.clip(q[focus] / length, -1, 1))
        slack = 1e-6 * self.length + 1e-6
        low = self.length * np.cos(np.minimum(math.pi, alpha + beta)) - slack
        high = self.length * np.cos(np.maximum(0.0, alpha - beta)) + slack
        spans = []
        for f, a, b in zip(focus.tolist(), low, high, strict=True):
            column = self.sorted[:, f]
            spans.append((np.searchsorted(column, a, "left"), np.searchsorted(column, b, "right"), f))
        spans.sort(key=lambda s: s[1] - s[0])
        if 2 * (spans[0][1] - spans[0][0]) > len(self.ids):
            return None
        seen = np.zeros(len(self.ids), np.uint8)
        for first, last, f in spans:
            seen[self.order[first:last, f]] += 1
        return np.flatnonzero(seen == len(spans))


def best(q: np.ndarray, me: int, lows: list[int], highs: list[int], wanted: int, buckets: list[Bucket]) -> Iterator[tuple[int, int, int]]:
    """(range, score, vec_id) of the `wanted` highest scores of each range, equal ones by id."""
    length = math.sqrt(float((q.astype(np.float64) ** 2).sum()))
    focus = np.argsort(-np.abs(q), kind="stable")[:FOCUS]
    some = [j for j in range(len(lows)) if lows[j] <= highs[j]]
    have = {j: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for j in some}
    least = {j: lows[j] for j in some}
    for b in buckets:  # by falling length
        t = min(least.values(), default=ANY)
        if t > 0 and t > length * b.length * (1 + 1e-9) + 1e-6:
            break
        inside = focus[focus < b.v.shape[1]]
        at = b.feasible(q, length, inside, t) if len(inside) else None
        v, ids, rows = (b.v, b.ids, b.rows) if at is None else (b.v[at], b.ids[at], b.rows[at])
        scores = exact_scores(v, q)
        for j in some:
            ok = (scores >= least[j]) & (scores <= highs[j]) & (rows != me)
            s, i = np.concatenate([have[j][0], scores[ok]]), np.concatenate([have[j][1], ids[ok]])
            first = np.lexsort((i, -s))[:wanted]
            have[j] = s[first], i[first]
            if len(first) == wanted:
                least[j] = max(least[j], int(s[first[-1]]))
    for j in some:
        yield from ((j, int(s), int(i)) for s, i in zip(*have[j], strict=True))


def answered(index: DataFrame, asks: DataFrame, wanted: int) -> DataFrame:
    """(anchor, j, score, vec_id): for asks (shard, anchor, v, lows, highs) the best rows of each range in the shard."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, buckets = None, [], []
        for batch in batches:
            names, at = batch.column("shard").to_pylist(), 0
            kinds = batch.column("ask").to_numpy(zero_copy_only=False)
            edges = [i for i in range(1, len(names)) if names[i] != names[i - 1] or kinds[i] != kinds[i - 1]] + [len(names)]
            for end in edges if names else []:
                part, at = batch.slice(at, end - at), end
                if names[end - 1] != shard:
                    shard, held, buckets = names[end - 1], [], []
                if not kinds[end - 1]:
                    held.append(part)
                    continue
                if held:
                    whole = pa.Table.from_batches(held).combine_chunks()
                    v, ids, rows = vectors(whole.column("v"), 0), whole.column("vec_id").to_numpy(), whole.column("row").to_numpy()
                    buckets, held = [Bucket(v[i : i + BUCKET], ids[i : i + BUCKET], rows[i : i + BUCKET]) for i in range(0, len(v), BUCKET)], []
                q, found = vectors(part.column("v"), 0), []
                for i, (me, lows, highs) in enumerate(zip(part.column("row").to_pylist(), part.column("lows").to_pylist(), part.column("highs").to_pylist(), strict=True)):
                    found += [(me, *x) for x in best(q[i], me, lows, highs, wanted, buckets)]
                columns = list(zip(*found, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], ["anchor", "j", "score", "vec_id"])

    none = F.lit(None).cast("array<long>")
    # bucket rows come before the asks of their shard, longest first
    rows = index.select("shard", F.lit(False).alias("ask"), F.col("vec_id").cast("long"), "row", "v", none.alias("lows"), none.alias("highs"), (-F.col("norm2")).alias("_by"))
    every = rows.union(asks.select("shard", F.lit(True), F.lit(None).cast("long"), "anchor", "v", "lows", "highs", F.lit(0.0)))
    dealt = every.repartition("shard").sortWithinPartitions("shard", "ask", "_by", "vec_id", "row").drop("_by")
    return dealt.mapInArrow(search, "anchor long, j int, score long, vec_id long")


def foremost(found: DataFrame, wanted: int) -> DataFrame:
    """found with `rank`, for the `wanted` first of each anchor's range."""
    rank = F.row_number().over(W.partitionBy("anchor", "j").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= wanted)


def searched(index: DataFrame, shards: DataFrame, anchors: DataFrame, may: Column, seed: Column, wanted: int, name: str) -> DataFrame:
    """(anchor, j, score, vec_id, rank) for anchors (anchor, label, home, v, norm2, lows, highs).

    `may` tells of an anchor a and a shard s whether one can hold an answer for
    the other, `seed` orders an anchor's shards: the first is asked before the
    others, which need only what beats its answer.
    """
    n = shards.count()
    groups = max(1, -(-n // FAN))
    s = small(shards.withColumn("fan", F.pmod(F.xxhash64("shard"), F.lit(groups))), n).alias("s")
    fanned = anchors.withColumn("fan", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).alias("a")
    reach = F.sqrt(F.col("a.norm2")) * F.sqrt(F.col("s.longest")) * (1 + 1e-9) + 1e-6

    def asks(a: DataFrame) -> DataFrame:
        can = (F.col("a.fan") == F.col("s.fan")) & may & (reach >= F.array_min("a.lows"))
        return a.join(s, can).select("s.shard", "a.anchor", "a.v", "a.lows", "a.highs", seed.alias("seed"))

    first = stored(asks(fanned).groupBy("anchor").agg(F.min_by(F.struct("shard", "v", "lows", "highs"), "seed").alias("x")).select("anchor", "x.*"), f"{name}-first")
    opened = stored(answered(index, first, wanted), f"{name}-opened")
    worst = opened.groupBy("anchor", "j").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= wanted)
    bounds = worst.groupBy("anchor").agg(F.map_from_entries(F.collect_list(F.struct("j", "least"))).alias("bounds"))
    raised = fanned.join(bounds, "anchor", "left").withColumn("lows", F.transform("lows", lambda x, j: F.greatest(x, F.coalesce(F.try_element_at("bounds", j), x)))).alias("a")
    others = asks(raised).join(first.select("anchor", "shard"), ["anchor", "shard"], "left_anti")
    return foremost(opened.union(answered(index, others, wanted)), wanted)


def mined(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (vec_id, label, embedding) where `anchor` holds.

    Negatives score between low and high percent of the positive.
    """
    index = stored(sharded(stored(quantised(rows, scale), "negatives-rows")), "negatives-index")
    shards = stored(index.groupBy("shard", "label").agg(F.max("norm2").alias("longest")), "negatives-shards")
    anchors = index.where(anchor).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", F.col("shard").alias("home"), "v", "norm2")
    same = F.col("a.label") == F.col("s.label")
    anything = anchors.withColumn("lows", F.array(F.lit(-ANY))).withColumn("highs", F.array(F.lit(ANY)))
    found = searched(index, shards, anything, same, F.when(F.col("a.home") == F.col("s.shard"), F.lit(-(1 << 63))).otherwise(F.xxhash64("s.shard", "a.anchor")), positives, "negatives-positives")
    pairs = stored(found.select("anchor", (F.col("rank") - 1).alias("j"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-pairs")
    p = F.col("positive_score")
    ranges = pairs.where("positive_score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("j", _div(p * low + 99).alias("low"), _div(p * high).alias("high")))).alias("r"))
    asking = anchors.join(ranges, "anchor").select("anchor", "label", "home", "v", "norm2", F.transform("r", lambda x: x["low"]).alias("lows"), F.transform("r", lambda x: x["high"]).alias("highs"))
    hard = searched(index, shards, stored(asking, "negatives-asking"), ~same, F.xxhash64("s.shard", "a.anchor"), negatives, "negatives-hard")
    named = hard.select("anchor", "j", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(pairs, ["anchor", "j"]).join(anchors.select("anchor", "anchor_id"), "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _div(x: Column) -> Column:
    """x / 100 without its fraction, exact, for x of 0 or more."""
    return ((x - x % 100) / 100).cast("long")


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    relabelled = e.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mined(relabelled, F.col("vec_id") % 50 == 0)


OP12_SQL = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT p.anchor_id, p.other AS positive_id, s.other AS negative_id, p.score AS positive_score, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY s.score DESC, s.other)::INT AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
