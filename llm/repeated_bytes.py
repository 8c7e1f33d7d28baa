"""Exact removal of byte strings that repeat, over all documents.

A byte is removed if it lies in a string of `LENGTH` bytes that starts earlier
too: in a document of a smaller id, or earlier in the same one.

Every string of LENGTH bytes is assigned to its minimiser, the GRAM bytes within it
of the least hash (the leftmost of equals); equal strings have equal minimisers
at the same offset.  So:

1. Texts give their minimisers (about one for 35 bytes), which are ordered by
   hash; those that occur once can't be part of a repeated string and go.
2. The others fetch from their text the stretch of bytes whose strings they
   stand for, and are ordered by hash and place again.  A stretch equal to an
   earlier one repeats whole; where one hash has several different stretches,
   as at the edges of passages, their strings are compared one by one.
3. The repeated strings' bytes are cut from the texts.

Orders are streamed through the tasks: what a task holds of a minimiser is its
different stretches, not its occurrences, and equal stretches of one chunk of
texts are settled before the shuffle.

Defined results: a null text has no bytes; texts of fewer bytes than LENGTH keep
all; rows that repeat both id and text are one document and get equal results;
rows that repeat an id with other texts are ordered by their text's hash; rows
without id come last; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.sparkkit import small, stored
from llm.textkit import buffers, byte_sums, mix, sliding_min, slices, span_hash

LENGTH, GRAM = 100, 32
_SLICE = 2 << 20
_PLACE = np.uint64((1 << 22) - 1)
_STRETCH = "h long, doc long, place long, g long, first long, n int, bytes binary"
_RANGE = "doc long, row int, start long, end long"


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """doc, row and text: the order of the documents (row tells texts of one id apart).

    Documents without id come after ids below 2**62, by 62 bits of a hash of
    text and length, so that doc and row together tell any such texts apart.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    nameless = F.shiftrightunsigned(F.xxhash64(text, F.length(text)), 2) + F.lit(1 << 62)
    doc = F.coalesce(F.col("doc_id").cast("long"), nameless)
    return docs.select(doc.alias("doc"), F.pmod(F.xxhash64(text), F.lit(1 << 31)).cast("int").alias("row"), text.alias("text"), *more)


def minimisers(sums: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts given by their `byte_sums`: hash and place of each minimiser, and the first and the number of the strings it stands for."""
    size = int(offsets[-1])
    if size > int(_PLACE):  # one very long text, in parts that overlap by a string less a byte
        parts, step = [], int(_PLACE) - LENGTH
        for at in range(0, size - LENGTH + 1, step):
            end = min(at + step + LENGTH - 1, size)
            h, place, first, n = minimisers(_shifted(sums, at, end), np.array([0, end - at]))
            parts.append((h, place + at, first + at, n))
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))
    if size < LENGTH:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    at = np.arange(size - GRAM + 1)
    h = mix(span_hash(sums, at, at + GRAM))
    least = sliding_min(h & ~_PLACE | at.astype(np.uint64), LENGTH - GRAM + 1)
    starts = np.arange(len(least))
    ok = np.ones(len(least), bool)
    for end in offsets[1:-1]:  # strings that would run from one text into the next
        ok[max(end - LENGTH + 1, 0) : end] = False
    starts, least = starts[ok], least[ok]
    if not len(starts):
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    fresh = np.append(True, (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1))
    runs = np.flatnonzero(fresh)
    place = (least[runs] & _PLACE).astype(np.int64)
    return h[place], place, starts[runs], np.diff(np.append(runs, len(starts)))


def _shifted(sums: np.ndarray, at: int, end: int) -> np.ndarray:
    """The prefix sums of the bytes [at, end) as those of a text of its own."""
    from llm.textkit import powers

    return (sums[at : end + 1] - sums[at]) * powers(at + 1, -1)[at]


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, doc, place) of all minimisers; the place's upper half is the row."""
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            data, offsets = buffers(part.column("text"))
            h, place, _, _ = minimisers(byte_sums(data), offsets)
            own = np.searchsorted(offsets, place, side="right") - 1
            doc, row = part.column("doc").to_numpy(), part.column("row").to_numpy().astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.int64)), pa.array(doc[own]), pa.array(row[own] << 32 | place - offsets[own])], ["h", "doc", "place"])


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows ordered by h, doc and place, those whose h has another place; equal rows count once."""
    held = np.zeros((0, 3), np.int64)  # the last row, once or with the one before it
    for batch in batches:
        rows = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns], axis=1)])
        if not len(rows):
            continue
        rows = rows[np.append(True, (rows[1:] != rows[:-1]).any(axis=1))]
        same = rows[1:, 0] == rows[:-1, 0]
        keep = np.append(False, same) | np.append(same, False)
        keep[: max(len(held) - 1, 0)] = False  # given out already
        keep[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(rows[keep, 1]), pa.array(rows[keep, 2])], ["doc", "place"])
        held = rows[-2:] if len(rows) > 1 and same[-1] else rows[-1:]
    if len(held) > 1:
        yield pa.RecordBatch.from_arrays([pa.array(held[-1:, 1]), pa.array(held[-1:, 2])], ["doc", "place"])


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of the texts' repeated minimisers; equal ones of a chunk after the first have no bytes."""
    for batch in batches:
        for part in slices(batch, "text", _SLICE):
            data, offsets = buffers(part.column("text"))
            sums = byte_sums(data)
            h, place, first, n = minimisers(sums, offsets)
            own = np.searchsorted(offsets, place, side="right") - 1
            lists = part.column("places")
            wanted = np.asarray(lists.flatten()) & 0xFFFFFFFF
            wanted += np.repeat(offsets[:-1], np.diff(np.asarray(lists.offsets)))
            ok = np.isin(place, wanted)
            h, place, first, n, own = h[ok].astype(np.int64), place[ok], first[ok], n[ok], own[ok]
            g = mix(span_hash(sums, first, first + n + LENGTH - 1) + n.astype(np.uint64)).astype(np.int64)
            doc, row = part.column("doc").to_numpy()[own], part.column("row").to_numpy().astype(np.int64)[own] << 32
            at, start = row | place - offsets[own], first - offsets[own]
            order = np.lexsort((start, at, doc, g, h))
            new = np.ones(len(order), bool)
            new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
            same_row = np.zeros(len(order), bool)  # a copy of its row: nothing that starts earlier
            lead = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))] if len(order) else order
            same_row[order] = (doc[order] == doc[lead]) & (at[order] == at[lead]) & (start[order] == start[lead])
            is_first = np.zeros(len(order), bool)
            is_first[order] = new
            raw = data.tobytes()
            text = [raw[a : a + k + LENGTH - 1] if f or s else None for a, k, f, s in zip(first.tolist(), n.tolist(), is_first.tolist(), same_row.tolist(), strict=True)]
            # settled ones need no company: they are dealt out by their place
            key = np.where(is_first | same_row, h, mix((doc + at).astype(np.uint64), 3).astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(doc), pa.array(at), pa.array(g), pa.array(start), pa.array(n.astype(np.int32)), pa.array(text, pa.binary())], ["h", "doc", "place", "g", "first", "n", "bytes"])


def _ranges(doc: np.ndarray, place: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(doc), pa.array((place >> 32).astype(np.int32)), pa.array(start), pa.array(end)], ["doc", "row", "start", "end"])


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ranges of bytes of repeated strings, from stretches ordered by h, doc, place and first."""
    held: pa.Table | None = None
    for batch in batches:
        settled = batch.column("bytes").is_null()
        done = batch.filter(settled)
        if done.num_rows:
            doc, place, first, n = (done.column(k).to_numpy() for k in ("doc", "place", "first", "n"))
            yield _ranges(doc, place, first, first + n + LENGTH - 1)
        rest = pa.Table.from_batches([batch.filter(pa.compute.invert(settled))])
        if not rest.num_rows:
            continue
        old = held.num_rows if held is not None else 0
        table = pa.concat_tables([held, rest]).combine_chunks() if old else rest
        h, doc, place, g, first, n = (table.column(k).to_numpy() for k in ("h", "doc", "place", "g", "first", "n"))
        index = np.arange(len(h))
        group = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1
        order = np.lexsort((index, g, group))
        new = np.append(True, (group[order][1:] != group[order][:-1]) | (g[order][1:] != g[order][:-1]))
        lead = np.zeros(len(h), np.int64)
        lead[order] = order[np.maximum.accumulate(np.where(new, index, 0))]
        copy = (doc == doc[lead]) & (place == place[lead]) & (first == first[lead])
        again = ~copy & (index >= old)
        if again.any():
            yield _ranges(doc[again], place[again], first[again], (first + n)[again] + LENGTH - 1)
        # one row for each different stretch; groups with several are compared string by string
        firsts = np.flatnonzero(lead == index)
        several = np.bincount(group[firsts], minlength=group[-1] + 1)[group[firsts]] > 1
        picked = firsts[several]
        if len(picked):
            yield from _compare(table, picked, group, doc, place, first, n, old)
        held = table.take(pa.array(firsts[group[firsts] == group[-1]]))


def _compare(table: pa.Table, picked: np.ndarray, group: np.ndarray, doc: np.ndarray, place: np.ndarray, first: np.ndarray, n: np.ndarray, old: int) -> Iterator[pa.RecordBatch]:
    """Ranges of the strings of the picked stretches that an earlier stretch of their group has too."""
    cuts = np.flatnonzero(np.append(True, group[picked][1:] != group[picked][:-1]))
    begin = 0
    limits = [*cuts[1:][np.diff(np.cumsum(n[picked])[cuts[1:] - 1] // 500_000, prepend=0) > 0], len(picked)]
    for stop in limits:  # whole groups, about half a million strings at a time
        some = picked[begin:stop]
        begin = stop
        if not len(some):
            continue
        data = np.frombuffer(b"".join(table.column("bytes").take(pa.array(some)).to_pylist()), np.uint8)
        sizes = n[some].astype(np.int64) + LENGTH - 1
        base = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(some)), n[some])
        inner = np.arange(len(row)) - np.repeat(np.cumsum(n[some]) - n[some], n[some])
        sums = byte_sums(data)
        at = base[row] + inner
        key = mix(span_hash(sums, at, at + LENGTH)) ^ mix(group[some][row].astype(np.uint64), 7)
        order = np.argsort(key, kind="stable")
        same = np.append(False, key[order][1:] == key[order][:-1])
        repeated = np.zeros(len(key), bool)
        repeated[order] = same
        repeated &= (some >= old)[row]
        if repeated.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[0], repeated.view(np.int8), [0]])))
            opens = np.flatnonzero(repeated & ~np.append(False, repeated[:-1] & (row[1:] == row[:-1])))
            closes = np.flatnonzero(repeated & ~np.append(repeated[1:] & (row[1:] == row[:-1]), False))
            assert len(opens) == len(closes) and len(edge)
            where = some[row[opens]]
            yield _ranges(doc[where], place[where], first[where] + inner[opens], first[where] + inner[closes] + LENGTH)


_MERGED = "doc long, row int, ranges array<struct<start:long,end:long>>"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's ranges with those that touch made one, in order."""
    for batch in batches:
        lists = batch.column("ranges")
        each = lists.flatten()
        owner = np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
        start, end = (each.field(k).to_numpy(zero_copy_only=False) for k in ("start", "end"))
        order = np.lexsort((start, owner))
        owner, start, end = owner[order], start[order], end[order]
        width = int(end.max(initial=0)) + 2  # keeps the ends of one document below the starts of the next
        far = np.maximum.accumulate(owner * width + end)
        fresh = np.append(True, far[:-1] < (owner * width + start)[1:])[: len(owner)]
        at = np.flatnonzero(fresh)
        stop = np.maximum.reduceat(end, at) if len(at) else end
        merged = pa.StructArray.from_arrays([pa.array(start[at]), pa.array(stop)], ["start", "end"])
        offsets = np.searchsorted(owner[at], np.arange(len(lists) + 1))
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("row"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), merged)], ["doc", "row", "ranges"])


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc, row, ranges): the ranges [start, end) of bytes to remove of each document, apart and in order."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = keyed(docs)
    marks = texts.mapInArrow(_mark, "h long, doc long, place long")
    marks = marks.repartition(n, "h").sortWithinPartitions("h", "doc", "place")
    again = marks.mapInArrow(_repeated, "doc long, place long").withColumn("row", F.shiftright("place", 32).cast("int"))
    again = stored(again.groupBy("doc", "row").agg(F.collect_list("place").alias("places")), "repeated-places")
    stretches = texts.join(again, ["doc", "row"]).mapInArrow(_fetch, _STRETCH)
    ordered = stretches.repartition(n, "h").sortWithinPartitions("h", "doc", "place", "first")
    found = ordered.mapInArrow(_judge, _RANGE)
    lists = found.groupBy("doc", "row").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    return stored(lists.mapInArrow(_merge, _MERGED), "repeated-ranges")


def cut_texts(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep`, n_bytes, n_removed, n_spans and the remaining bytes `kept_bytes` of each document."""
    return _cut(docs, keep, False)


def _cut(docs: DataFrame, keep: tuple[str, ...], digest: bool) -> DataFrame:
    ranges = repeated_ranges(docs)
    last = "kept_sha256" if digest else "kept_bytes"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                data, offsets = buffers(part.column("text"))
                gone = np.zeros(len(data) + 1, np.int64)
                lists = part.column("ranges").to_pylist()
                for at, ranges in zip(offsets[:-1].tolist(), lists, strict=True):
                    for r in ranges or ():
                        gone[at + r["start"]] += 1
                        gone[at + r["end"]] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                out = []
                for a, b, ranges in zip(offsets[:-1].tolist(), offsets[1:].tolist(), lists, strict=True):
                    own = gone[a:b]
                    left = data[a:b][~own].tobytes() if ranges else data[a:b].tobytes()
                    spans = np.count_nonzero(own[1:] & ~own[:-1]) + int(b > a and own[0]) if ranges else 0
                    out.append((b - a, b - a - len(left), int(spans), hashlib.sha256(left).hexdigest() if digest else left))
                columns = list(zip(*out, strict=True)) or [[]] * 4
                types = (pa.int64(), pa.int64(), pa.int64(), pa.string() if digest else pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], [*keep, "n_bytes", "n_removed", "n_spans", last])

    numbers = ranges.agg(F.coalesce(F.sum(F.size("ranges") + 3), F.lit(0))).first()[0]
    texts = keyed(docs, *keep).join(small(ranges, numbers, 16), ["doc", "row"], "left").select(*keep, "text", "ranges")
    fields = ", ".join(f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keep)
    return texts.mapInArrow(cut, f"{fields}, n_bytes long, n_removed long, n_spans long, {last} {'string' if digest else 'binary'}")


def op4_repeated_bytes(spark, sf_dir: str) -> DataFrame:
    return _cut(spark.read.parquet(f"{sf_dir}/documents.parquet"), ("doc_id",), True)


OP4_SQL = f"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT doc_id, hex(b) AS x, octet_length(b) AS n FROM d),
w AS (SELECT doc_id, p, md5_number(substr(x, 2 * p + 1, {2 * LENGTH})) AS s FROM (SELECT doc_id, x, unnest(range(0, n - {LENGTH - 1})) AS p FROM h WHERE n >= {LENGTH})),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY s ORDER BY doc_id, p) AS k FROM w) WHERE k > 1),
g AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM r),
i AS (SELECT doc_id, min(p) AS a, max(p) + {LENGTH} AS z FROM (SELECT *, sum(CASE WHEN gap IS NULL OR gap > {LENGTH} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS k FROM g) GROUP BY doc_id, k),
k AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM i),
t AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, max(z) AS z FROM k JOIN h USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(z, 0) + 1))) AS kept_sha256 FROM h LEFT JOIN t USING (doc_id)
"""
