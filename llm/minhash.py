"""MinHash near-dedup by bottom-k sketches of one hash function.

1. A document's set is its distinct word shingles, as 64-bit hashes; its sketch
   is the `SKETCH` least.  Documents with equal sets form a class, and only
   classes go on.
2. Inverted lists of the retained values give candidates.  Two sets similar
   enough keep at least `least_shared` values in common but for a chance of one
   in a million; so, with a class's values ordered from the rarest, two such
   classes share one of the first SKETCH - least_shared + 1, and only those are
   listed.  Values of passages that very many documents share are the last in
   that order and drop out without loss.  Sets of fewer values are their own
   sketches, and for them nothing is left to chance: what larger partners hold
   beyond their sketches is allowed for.
3. Short lists give all their pairs; long ones link each member with two
   central ones, not with each other.  Pairs pass a bound by sizes and an estimate
   from the union of both sketches, and are then verified on full sets.
4. Members of long lists that are still in more than one component take their
   full sets, ordered from the rarest shingle: similar ones share one of the
   first few, near enough to the front in both for the rest to make the
   similarity.  What a template gives all its copies is frequent and comes last,
   so such lists give few pairs, and lose none.  They are verified likewise.
5. Verified links make components.

Defined results: null and empty texts, and texts without words, have an empty
set and stay alone; texts of fewer words than a shingle are one shingle; rows
with equal text are one class wherever they are; a row without doc_id is linked
like others, is never the one that stays, and alone has no component and is
kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.components import components
from llm.sparkkit import WORD, small, stored, unused
from llm.textkit import LOWER, buffers, shingles, slices, word_hashes, words

WIDTH = 5
PERCENT = 85
#: Values of a sketch, and the chance that two linked sets share too few of them.
SKETCH, CHANCE = 64, 1e-6
#: Members of a list that gives all its pairs.
SHORT = 32


@cache
def least_shared(percent: int) -> int:
    """How many values of the union's sketch two sets of that similarity share but for CHANCE."""
    j, below = percent / 100, 0.0
    for t in range(SKETCH + 1):
        below += math.comb(SKETCH, t) * j**t * (1 - j) ** (SKETCH - t)
        if below > CHANCE:
            return t
    return SKETCH


@cache
def least_visible(n: int, percent: int) -> int:
    """How many values of a set of n < SKETCH values are at least in the sketch of any set similar enough."""
    sizes = range(-(-n * percent // 100), n * 100 // percent + 1)
    # of m values m - SKETCH don't show
    return max(1, min((-(-percent * (n + m) // (100 + percent)) - max(0, m - SKETCH) for m in sizes), default=1))


def shingle_sets(part: pa.RecordBatch, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of the batch."""
    data, offsets = buffers(part.column("text"))
    low = LOWER[data]
    start, end, bounds = words(low, offsets)
    hashes, at = shingles(word_hashes(low, start, end), bounds, width)
    for i in range(len(at) - 1):
        yield np.unique(hashes[at[i] : at[i + 1]])


def set_hash(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def digests(docs: DataFrame, width: int = WIDTH, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, `more`, n_shingles, set_hash and sketch of each document."""
    keep = ["doc_id", *more]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, key, sketch = [], [], []
                for values in shingle_sets(part, width):
                    n.append(len(values))
                    key.append(set_hash(values) if len(values) else None)
                    sketch.append(values[:SKETCH].tobytes())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sketch, pa.binary())], [*keep, "n_shingles", "set_hash", "sketch"])

    d = docs.select(*keep, "text")
    fields = ", ".join(f"`{k}` {d.schema[k].dataType.simpleString()}" for k in keep)
    return d.mapInArrow(digest, f"{fields}, n_shingles long, set_hash binary, sketch binary")


def values_of(sketches: DataFrame) -> DataFrame:
    """(node, n, value) for each retained value of (node, n, sketch)."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            each = [np.frombuffer(x, np.int64) for x in batch.column("sketch").to_pylist()]
            rows = np.repeat(np.arange(len(each)), [len(x) for x in each])
            out = batch.select(["node", "n"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.concatenate([*each, np.zeros(0, np.int64)]))], ["node", "n", "value"])

    return sketches.mapInArrow(spread, "node long, n long, value long")


def listed(sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(value, node, n, central): the inverted lists of at least two members."""
    values = values_of(sketches)
    often = values.groupBy("value").agg(F.count("*").alias("often")).where("often > 1")
    shared = values.join(often, "value").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("often", "value"))).alias("shared"))
    kept = F.least(F.col("n"), F.lit(SKETCH))
    least = F.when(F.col("n") >= SKETCH, F.lit(least_shared(percent))).otherwise(F.get(F.array(*(F.lit(least_visible(n, percent)) for n in range(SKETCH))), F.col("n").cast("int")))
    listed = F.greatest(F.lit(0), F.size("shared") - least + 1)  # the kept - size(shared) rarest stand in no other sketch
    each = shared.withColumn("central", F.aggregate("shared", F.lit(0).cast("long"), lambda a, x: a + x["often"])).where(kept >= least)
    rows = each.select("node", "n", "central", F.explode(F.slice("shared", F.lit(1), listed.cast("int"))).alias("s")).select(F.col("s.value").alias("value"), "node", "n", "central")
    return rows


def sized(n: Column, m: Column, percent: int = PERCENT) -> Column:
    """Whether sets of n and m values can be similar enough."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * percent


def estimated(pairs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose sketches' union doesn't speak against them."""
    shared = least_shared(percent)

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(a) < SKETCH or len(b) < SKETCH:  # a whole set: the exact check is as cheap
                    ok.append(True)
                    continue
                both = np.sort(np.concatenate([a, b]))
                twice = both[1:] == both[:-1]
                distinct = np.ones(len(both), bool)
                distinct[1:] = ~twice
                last = both[distinct][SKETCH - 1]
                ok.append(np.count_nonzero(twice & (both[1:] <= last)) >= shared)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    s = sketches.select("node", "sketch")
    both = pairs.join(s.withColumnsRenamed({"node": "a", "sketch": "x"}), "a").join(s.withColumnsRenamed({"node": "b", "sketch": "y"}), "b")
    return both.select("a", "b", "x", "y").mapInArrow(likely, "a long, b long")


def shared_counts(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b, shared): the exact intersections of full sets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                out.append((len(a), len(b), len(a) + len(b) - len(np.union1d(a, b))))
            figures = np.array(out, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), *(pa.array(figures[:, k]) for k in range(3))], ["a", "b", "n_a", "n_b", "shared"])

    both = pairs.join(sets.withColumnsRenamed({"node": "a", "set": "x"}), "a").join(sets.withColumnsRenamed({"node": "b", "set": "y"}), "b")
    return both.select("a", "b", "x", "y").mapInArrow(count, "a long, b long, n_a long, n_b long, shared long")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int = WIDTH) -> DataFrame:
    """(node, set) of the wanted (doc_id, node, set_hash) classes, made anew from the text of one document each."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                keys, sets = [], []
                for node, want, values in zip(part.column("node").to_pylist(), part.column("set_hash").to_pylist(), shingle_sets(part, width), strict=True):
                    if set_hash(values) == want:  # another row may have the same doc_id
                        keys.append(node)
                        sets.append(values.tobytes())
                yield pa.RecordBatch.from_pydict({"node": pa.array(keys, pa.int64()), "set": pa.array(sets, pa.binary())})

    got = docs.select("doc_id", "text").join(small(wanted, wanted.count()), "doc_id")
    return got.select("node", "set_hash", "text").mapInArrow(make, "node long, set binary").groupBy("node").agg(F.first("set").alias("set"))


def links(docs: DataFrame, classes: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """(a, b): verified links that connect whatever is similar enough; classes are (node, set_hash, n, doc_id, sketch)."""
    lists = stored(listed(classes.select("node", "n", "sketch"), percent), "minhash-lists")
    side = F.xxhash64("node", F.lit(9)) % 2 == 0
    best = lambda c: F.max_by("node", c)
    order = F.struct("central", "node")
    pivots = stored(lists.groupBy("value").agg(F.count("*").alias("members"), best(order).alias("p1"), best(F.when(side, order)).alias("p2"), best(F.when(~side, order)).alias("p3")).where("members > 1"), "minhash-pivots")
    members = stored(lists.join(pivots.select("value", "members"), "value"), "minhash-members")
    # short lists give all their pairs, long ones a star for each of two central members
    few, many = members.where(F.col("members") <= SHORT), members.where(F.col("members") > SHORT)
    x, y = few.alias("x"), few.alias("y")
    near = x.join(y, (F.col("x.value") == F.col("y.value")) & (F.col("x.node") < F.col("y.node")) & sized(F.col("x.n"), F.col("y.n"), percent)).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    star = many.join(pivots.drop("members"), "value").select("node", F.explode(F.array("p1", F.when(F.col("p2") == F.col("p1"), F.col("p3")).otherwise(F.col("p2")))).alias("pivot")).where("pivot IS NOT NULL AND pivot <> node").distinct()
    nodes = stored(members.select("node").distinct().join(classes, "node"), "minhash-nodes")
    sizes = nodes.select("node", "n")
    far = star.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    far = far.join(sizes.toDF("a", "n"), "a").join(sizes.toDF("b", "m"), "b").where(sized(F.col("n"), F.col("m"), percent)).select("a", "b")
    pairs = stored(estimated(near.union(far).distinct(), nodes, percent), "minhash-candidates")
    sets = stored(full_sets(docs, nodes.select("doc_id", "node", "set_hash"), width), "minhash-sets")
    linked = lambda c: c.where(F.col("shared") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("shared")) * percent)
    first = stored(shared_counts(pairs, sets), "minhash-verified")
    roots = stored(components(linked(first).select("a", "b")), "minhash-roots")
    rest = stored(estimated(across(many, nodes, sets, first, roots, percent), nodes, percent), "minhash-rest")
    second = stored(linked(shared_counts(rest, sets)).select("a", "b"), "minhash-second")
    return linked(first).select("a", "b").union(second)


def ranked(open_sets: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, place): the first shingles of each set, the rarest of all these sets first, that any set similar enough may share with it.

    Two such sets share one of their first `n - least + 1`, with `least` the
    values that they have in common at least.  Shingles of one set only keep
    their places but are no rows.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, data in zip(batch.column("node").to_pylist(), batch.column("set"), strict=True):
                values = np.frombuffer(data.as_buffer(), np.int64)
                size = np.full(len(values), len(values))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), node)), pa.array(size), pa.array(values)], ["node", "n", "token"])

    tokens = stored(open_sets.mapInArrow(spread, "node long, n long, token long"), "minhash-tokens")
    often = tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    own = tokens.join(often, "token").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("often", "token"))).alias("shared"))
    alone = (F.col("n") - F.size("shared")).alias("alone")
    most = F.floor(F.col("n") * (100 - percent) / 100) + 1
    first = own.select("node", "n", alone, F.slice("shared", F.lit(1), F.greatest(most - (F.col("n") - F.size("shared")), F.lit(0)).cast("int")).alias("first"))
    return first.select("node", "n", "alone", F.posexplode("first").alias("k", "s")).select(F.col("s.token").alias("token"), "node", "n", (F.col("alone") + F.col("k")).alias("place"))


def across(many: DataFrame, nodes: DataFrame, sets: DataFrame, known: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of members of long lists that are in different components and may be similar enough."""
    placed = many.join(roots, "node", "left").select("value", "node", F.coalesce("root", "node").alias("root"))
    open_lists = placed.groupBy("value").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("value")
    left = stored(placed.join(open_lists, "value", "left_semi").select("node", "root").distinct(), "minhash-open")
    if left.isEmpty():
        return known.select("a", "b").where("false")
    first = stored(ranked(sets.join(left.select("node"), "node", "left_semi"), percent).join(left, "node"), "minhash-ranked")
    # each pair across components has one side at least outside the component with most of the shingle's sets
    each = first.groupBy("token", "root").agg(F.count("*").alias("own"))
    main = each.groupBy("token").agg(F.max_by("root", F.struct("own", "root")).alias("main"), F.count("*").alias("roots")).where("roots > 1").select("token", "main")
    rows = stored(first.join(main, "token"), "minhash-across")
    x, y = rows.where("root <> main").alias("x"), rows.alias("y")
    least = F.ceil((F.col("x.n") + F.col("y.n")) * percent / (100 + percent))
    possible = (F.col("x.n") - F.col("x.place") >= least) & (F.col("y.n") - F.col("y.place") >= least)
    once = (F.col("y.root") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    pairs = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root")) & once & sized(F.col("x.n"), F.col("y.n"), percent) & possible)
    pairs = pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    return pairs.join(known.select("a", "b"), ["a", "b"], "left_anti")


def grouped(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, more: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, `more`, n_shingles, component_id and kept of each document."""
    d = stored(digests(docs, width, more), "minhash-digests")
    some = d.where("n_shingles > 0")
    each = some.groupBy("set_hash").agg(F.first("n_shingles").alias("n"), F.min("doc_id").alias("doc_id"), F.first("sketch").alias("sketch"))
    classes = stored(each.withColumn("node", F.monotonically_increasing_id()), "minhash-classes")  # numbered once: the table stays as written
    found = stored(components(links(docs, classes.where("doc_id IS NOT NULL"), percent, width)), "minhash-components")
    placed = classes.select("node", "set_hash", "doc_id").join(found, "node", "left").select("set_hash", "doc_id", F.coalesce("root", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("least"))
    ids = placed.join(least, "root").select("set_hash", "least")
    out = d.drop("sketch").join(ids, "set_hash", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", *more, "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def deduplicated(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH) -> DataFrame:
    """The documents, with all their columns, that stay: the one with the least id of each component.

    Rows that repeat both id and text are one document.
    """
    mine, gone_id, gone_text = (unused(docs, k) for k in ("text_key", "gone_id", "gone_text"))
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    gone = grouped(docs.select("doc_id", "text", key.alias(mine)), percent, width, (mine,)).where("NOT kept")
    gone = stored(gone.select(F.col("doc_id").alias(gone_id), F.col(mine).alias(gone_text)).distinct(), "minhash-gone")
    return docs.join(small(gone, gone.count()), F.col("doc_id").eqNullSafe(F.col(gone_id)) & (key == F.col(gone_text)), "left_anti")


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    return grouped(spark.read.parquet(f"{sf_dir}/documents.parquet"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP9_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {WIDTH - 1}], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {WIDTH - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= {PERCENT} * (a.n + b.n - k)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.c = e.x)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id, min(r.c) = d.doc_id AS kept
FROM d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY d.doc_id
"""
