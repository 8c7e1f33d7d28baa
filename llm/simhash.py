"""SimHash near-dedup with pivot distance tables.

1. A fingerprint has a bit for each of 64: whether more than half of the text's
   shingle hashes (XXH64, seed 42, repeats included) have it.  Documents with
   one fingerprint are one class, and only classes go on.
2. Two fingerprints that differ in at most `MOST` bits agree wholly in
   `pieces - MOST` of any `pieces` pieces, so lists by such agreeing pieces hold
   every pair.  More pieces give more, but shorter lists; their number follows
   from the count of classes (`pieces_for`), and no pair depends on it.
3. Each fingerprint has its Hamming distances to `PIVOTS` reference
   fingerprints.  Two fingerprints within MOST bits differ by at most MOST in
   each distance, so pairs of a list with a larger coordinate difference are
   discarded, and the others verified.
4. Lists of more than `SHORT` members don't give all their pairs: some members
   serve as pivots of the list, and their distances link whatever is within MOST
   bits of one; up to `ROUNDS` rounds of them, until at most `PAIRS` pairs of
   members are left outside the lists' largest components.  Then what is left is
   finished exactly: each such member asks, through the pivot tables again,
   whether anything in the largest component is near (a semi join, salted by
   members), and what is near nothing there is paired with the other components.
5. Verified links make components.

Defined results: null and empty texts and texts without words have fingerprint
zero and are linked like others; texts of fewer words than a shingle are one
shingle; repeated rows have one class; a row without doc_id is linked like
others and never names a component, which is null if it has no other row; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.components import components
from llm.sparkkit import small, stored
from llm.textkit import LOWER, buffers, slices, words

WIDTH = 4
#: Differing bits of two linked fingerprints at most.
MOST = 4
HASH_SEED = 42
#: Reference fingerprints of the distance tables.
PIVOTS = tuple(int(x) for x in np.random.default_rng(1311).integers(-(1 << 63), (1 << 63) - 1, 16))
#: Members of a list that gives all its pairs, and rounds of pivots for longer ones.
SHORT, ROUNDS = 64, 3
#: Members that one task of the exact comparison holds against the others, about.
SALT_ROWS = 2048
#: Pairs of members outside their lists' largest components that are compared at once, before the last round.
PAIRS = 1e8


def spaced(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words one after the other with a space behind each, and where each starts (one more than words)."""
    length = end - start + 1
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=at[1:])
    out = np.concatenate([data, data[:1]])[np.repeat(start - at[:-1], length) + np.arange(at[-1])]
    out[at[1:] - 1] = 32
    return out, at


def bit_sums(hashes: np.ndarray, bounds: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """For each row, how many of its hashes [bounds[i], bounds[i+1]) have each of the 64 bits."""
    out = np.zeros((len(bounds) - 1, 64), np.int64)
    for first in range(0, len(hashes), block):
        part = hashes[first : first + block]
        bits = np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        rows = np.arange(np.searchsorted(bounds, first, side="right") - 1, np.searchsorted(bounds, first + len(part)))
        rows = rows[bounds[rows + 1] > np.maximum(bounds[rows], first)]  # rows without hashes have no place
        out[rows] += np.add.reduceat(bits, np.maximum(bounds[rows] - first, 0), axis=0, dtype=np.int64)
    return out


def fingerprints_of(part: pa.RecordBatch, width: int = WIDTH) -> np.ndarray:
    """The fingerprint of each text of the batch."""
    data, offsets = buffers(part.column("text"))
    low = LOWER[data]
    start, end, bounds = words(low, offsets)
    text, at = spaced(low, start, end)
    count = np.diff(bounds)
    runs = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    runs_at = np.zeros(len(runs) + 1, np.int64)
    np.cumsum(runs, out=runs_at[1:])
    first = np.arange(runs_at[-1]) - np.repeat(runs_at[:-1] - bounds[:-1], runs)
    last = first + np.repeat(np.minimum(count, width), runs)
    text, digest = text.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(text[s:e], HASH_SEED) for s, e in zip(at[first].tolist(), (at[last] - 1).tolist(), strict=True)), np.uint64, len(first))
    more = bit_sums(hashes, runs_at) * 2 > runs[:, None]
    return np.packbits(more, axis=1, bitorder="little").view(np.int64).ravel()


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, fp) of each document."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fingerprints_of(part, width))], ["doc_id", "fp"])

    d = docs.select("doc_id", "text")
    return d.mapInArrow(make, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, fp long")


def pieces_for(n: int, most: int = MOST) -> int:
    """Pieces whose lists have about eight members by chance at most, for n fingerprints."""
    pieces = most + 2
    while pieces < 16 and n >> (64 * (pieces - most) // pieces) > 8:
        pieces += 1
    return pieces


def masks(pieces: int, most: int = MOST) -> list[int]:
    """Masks, as signed longs, of each choice of pieces that two near fingerprints can agree in."""
    edges = [64 * i // pieces for i in range(pieces + 1)]
    piece = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(pieces)]
    whole = (sum(piece[i] for i in chosen) for chosen in combinations(range(pieces), pieces - most))
    return [m - (1 << 64) if m >> 63 else m for m in whole]


def apart(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y))


def with_distances(d: DataFrame) -> DataFrame:
    """d with the distance of its `fp` to each pivot, the coordinates d0, d1, ..."""
    return d.withColumns({f"d{i}": F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("byte") for i, p in enumerate(PIVOTS)})


def survives(most: int = MOST) -> Column:
    """Whether no coordinate of x and y differs by more than `most`, and then whether the fingerprints don't."""
    coordinates = [F.abs(F.col(f"x.d{i}") - F.col(f"y.d{i}")) <= most for i in range(len(PIVOTS))]
    return reduce(lambda a, b: a & b, coordinates) & (apart(F.col("x.fp"), F.col("y.fp")) <= most)


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def starred(rows: DataFrame, choices: DataFrame, seed: int, most: int) -> DataFrame:
    """(a, b): the members of rows (c, k, fp) near one of the few pivots that each list takes from choices (c, k, fp)."""
    order, other = F.xxhash64("fp", F.lit(seed)), F.xxhash64("fp", F.lit(seed + 1))
    chosen = choices.groupBy("c", "k").agg(F.array_distinct(F.array(F.min_by("fp", order), F.max_by("fp", order), F.min_by("fp", other), F.max_by("fp", other))).alias("pivots"))
    each = rows.join(chosen, ["c", "k"]).select("fp", F.explode("pivots").alias("pivot"))
    return each.where((F.col("fp") != F.col("pivot")) & (apart(F.col("fp"), F.col("pivot")) <= most)).select(*_pair("fp", "pivot")).distinct()


def placed(many: DataFrame, roots: DataFrame) -> DataFrame:
    """(c, k, fp, root, main, n, outside): the members of lists in more than one component, each list's component with most members, and how many are outside it."""
    rows = many.select("c", "k", "fp").join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    each = rows.groupBy("c", "k", "root").agg(F.count("*").alias("own"))
    lists = each.groupBy("c", "k").agg(F.max_by("root", F.struct("own", "root")).alias("main"), F.count("*").alias("roots"), F.sum("own").alias("n"), (F.sum("own") - F.max("own")).alias("outside")).where("roots > 1").drop("roots")
    return stored(rows.join(lists, ["c", "k"]), "simhash-open")


def finished(open_rows: DataFrame, most: int) -> DataFrame:
    """(a, b): links of lists' members in different components, at least one for each two components that have any."""
    parts = F.ceil(F.col("n") / SALT_ROWS).cast("int")
    salted = open_rows.withColumn("salt", F.pmod(F.xxhash64("fp"), parts).cast("int"))
    rest = stored(with_distances(salted.where("root <> main")), "simhash-rest")
    every = with_distances(open_rows.withColumn("salt", F.explode(F.sequence(F.lit(0), parts - 1))))
    here = (F.col("x.c") == F.col("y.c")) & (F.col("x.k") == F.col("y.k")) & (F.col("x.salt") == F.col("y.salt"))
    x, main = rest.alias("x"), every.where("root = main").alias("y")
    joined = stored(x.join(main, here & survives(most), "left_semi").select("c", "k", "fp", "main"), "simhash-joined")
    left = rest.join(joined.select("c", "k", "fp"), ["c", "k", "fp"], "left_anti").alias("x")
    others = every.where("root <> main").alias("y")
    pairs = left.join(others, here & (F.col("x.root") != F.col("y.root")) & survives(most)).select(*_pair("x.fp", "y.fp"))
    return joined.select(*_pair("fp", "main")).union(pairs).distinct()


def roots_of(nodes: DataFrame, most: int = MOST) -> DataFrame:
    """(node, root) of fingerprints of nodes (fp), all different, that hang together within `most` bits; lone ones may be missing."""
    choices = masks(pieces_for(nodes.count(), most), most)
    rows = nodes.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in choices))).alias("c", "k"))
    lists = rows.groupBy("c", "k").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(rows.join(lists, ["c", "k"]), "simhash-members")
    few, many = with_distances(members.where(F.col("n") <= SHORT)), members.where(F.col("n") > SHORT)
    x, y = few.alias("x"), few.alias("y")
    near = x.join(y, (F.col("x.c") == F.col("y.c")) & (F.col("x.k") == F.col("y.k")) & (F.col("x.fp") < F.col("y.fp")) & survives(most)).select(*_pair("x.fp", "y.fp"))
    roots = components(near.union(starred(many, many, 0, most)), "simhash-roots")
    for turn in range(ROUNDS):
        open_rows = placed(many, roots)
        figures = open_rows.groupBy("c", "k").agg(F.max("outside").alias("outside")).agg(F.count("*").alias("lists"), F.sum(F.pow("outside", F.lit(2))).alias("pairs")).first()
        if not figures.lists:
            break
        exact = turn == ROUNDS - 1 or figures.pairs <= PAIRS
        new = finished(open_rows, most) if exact else starred(open_rows, open_rows.where("root <> main"), 2 * turn + 2, most)
        # components that the new links join
        at = roots.withColumnsRenamed({"node": "a", "root": "x"}), roots.withColumnsRenamed({"node": "b", "root": "y"})
        joined = new.join(at[0], "a", "left").join(at[1], "b", "left").select(F.coalesce("x", "a").alias("a"), F.coalesce("y", "b").alias("b")).where("a <> b")
        above = components(joined, "simhash-roots").toDF("root", "above")
        known = roots.select("node").union(new.select("a")).union(new.select("b")).distinct().join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        roots = stored(known.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root")), "simhash-roots")
        if exact:
            break
    return roots


def grouped(docs: DataFrame, most: int = MOST, width: int = WIDTH) -> DataFrame:
    """doc_id, fp and component_id of each document."""
    d = stored(fingerprints(docs, width), "simhash-fingerprints")
    classes = stored(d.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = roots_of(classes.select("fp"), most).withColumnRenamed("node", "fp")
    own = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = own.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(own.select("fp", "root").join(ids, "root").select("fp", "component_id"), "simhash-named")
    return d.join(small(named, named.count(), 32), "fp").select("doc_id", "fp", "component_id")


def op11_simhash_pivots(spark, sf_dir: str) -> DataFrame:
    found = grouped(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
