"""WARC archives with a two-level capture index.

Archives are written by Spark's text writer: a record is its headers and body,
and the writer's line separator is the empty line that ends a WARC record, so
the files are plain WARC on any store that Spark writes to.  Equal payloads of
`REVISIT_BYTES` or more are stored once, in the record of the largest page_id;
the others are revisit records that refer to it.

The index has two levels.  Captures are sorted by their reversed-host URL key
and packed into compressed blocks; the first key of each block goes into a
sparse directory of `DIRECTORY_KEYS` entries at most (blocks grow beyond that),
which is what tasks hold.  A lookup searches the directory by bisection, then
the block by bisection, and then reads the record's bytes and no others.

Defined results: a null html is an empty payload, a null url is kept as the
empty key, a null page_id stands in a record as an empty one, is looked up like
others, and its payload's record is the response only if no row with an id
shares it (then all of them are); rows that repeat are records that repeat;
an empty table gives an archive without records.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.sparkkit import shared_dir, small, stored

REVISIT_BYTES = 1000
#: Records of one archive file at most, captures of an index block at least, keys of the directory at most.
FILE_RECORDS, BLOCK_CAPTURES, DIRECTORY_KEYS = 500, 512, 20_000
#: Bytes of one archive file at most, but for a single record; records beyond a share of it go to files of their own.
FILE_BYTES = 128 << 20
_CAPTURE = "key string, page_id long, path string, offset long, length long"
_END = b"\r\n\r\n"


def header_url(url: Column) -> Column:
    """The url as a header may hold it: bytes up to 0x20 and 0x7F are percent-encoded or dropped."""
    u = F.coalesce(url, F.lit(""))
    for char, code in ((" ", "%20"), ("\r", "%0D"), ("\n", "%0A"), ("\t", "%09")):
        u = F.replace(u, F.lit(char), F.lit(code))
    return F.regexp_replace(u, r"[\x00-\x1F\x7F]", "")


def records(pages: DataFrame) -> DataFrame:
    """(value): the text of each page's record without its ending."""
    html = F.coalesce(F.col("html"), F.lit(""))
    p = pages.select("page_id", header_url(F.col("url")).alias("url"), html.alias("html"), F.octet_length(html).alias("n"), F.sha1(html.cast("binary")).alias("digest"))
    same = p.where(F.col("n") >= REVISIT_BYTES).groupBy("digest").agg(F.max("page_id").alias("original"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    same = stored(same, "warc-payloads")
    p = p.join(small(same, same.count()), "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.coalesce(F.col("original") == F.col("page_id"), F.lit(False)) & (F.col("n") >= REVISIT_BYTES)
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), F.lit("\r\n\r\n"))
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), urn(F.col("original")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return p.select(F.concat(head, body).alias("value"))


def write_archives(pages: DataFrame, path: str, most: int = FILE_BYTES) -> None:
    """Writes the records of all pages to files below path, of FILE_RECORDS and about `most` bytes at most."""
    every = records(pages)
    size = F.octet_length("value")
    share = most // FILE_RECORDS
    # a record is longer than its page: by its headers, and the url in them
    largest = pages.agg(F.max(F.coalesce(F.octet_length("html"), F.lit(0)) + 3 * F.coalesce(F.octet_length("url"), F.lit(0)))).first()[0] or 0
    largest += 1500

    def write(some: DataFrame, n: int) -> None:
        some.write.mode("append").option("lineSep", _END.decode()).option("maxRecordsPerFile", n).text(path)

    if largest <= share:
        write(every, FILE_RECORDS)
    else:
        write(every.where(size <= share), FILE_RECORDS)
        write(every.where(size > share), min(FILE_RECORDS, max(1, most // largest)))


def url_key(url: str) -> str:
    """The host's labels from the last to the first, and what follows the host."""
    rest = url.partition("://")[2] if "://" in url else url
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    return f"{','.join(reversed(rest[:cut].lower().split('.')))}){rest[cut:]}" if url else ""


def parse_head(data: bytes, at: int) -> tuple[dict[str, str], int]:
    """The header fields of the record at `at`, and where its block begins."""
    end = data.index(_END, at)
    lines = data[at:end].decode().split("\r\n")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}, end + len(_END)


def _page(urn: str) -> int | None:
    number = urn.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def captures(spark: SparkSession, path: str) -> DataFrame:
    """key, page_id, path, offset and length of each record of the archives below path."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data, at, out = content.as_py(), 0, []
                while at < len(data):
                    head, block = parse_head(data, at)
                    end = block + int(head["content-length"])
                    out.append((url_key(head["warc-target-uri"]), _page(head["warc-record-id"]), name, at, end - at))
                    at = end + len(_END)
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["key", "page_id", "path", "offset", "length"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(scan, _CAPTURE)


def _order(key: str, page_id: int | None) -> tuple:
    return key, page_id is not None, page_id or 0


def build_index(found: DataFrame) -> tuple[DataFrame, list[tuple[tuple, int]]]:
    """The stored blocks (block, n, first_key, first_id, data), and the directory [(first, block)] in order."""
    found = stored(found, "warc-captures")
    total = found.count()
    per_block = max(BLOCK_CAPTURES, -(-total // (DIRECTORY_KEYS // 2)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows = TaskContext.get().partitionId() << 32, []

        def block() -> pa.RecordBatch:
            nonlocal number
            number += 1
            data = zlib.compress("\n".join(map(json.dumps, rows)).encode())
            return pa.RecordBatch.from_pydict({"block": pa.array([number], pa.int64()), "n": pa.array([len(rows)], pa.int64()), "first_key": pa.array([rows[0][0]]), "first_id": pa.array([rows[0][1]], pa.int64()), "data": pa.array([data], pa.binary())})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows.append(row)
                if len(rows) == per_block:
                    yield block()
                    rows = []
        if rows:
            yield block()

    parts = max(1, min(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), DIRECTORY_KEYS // 2, -(-total // per_block)))
    by = [F.col("key").asc(), F.col("page_id").asc_nulls_first(), F.col("path"), F.col("offset")]
    ordered = found.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    blocks = stored(ordered.mapInArrow(pack, "block long, n long, first_key string, first_id long, data binary"), "warc-index")
    directory = [(_order(r["first_key"], r["first_id"]), r["block"]) for r in blocks.select("block", "first_key", "first_id").collect()]  # DIRECTORY_KEYS at most
    return blocks, sorted(directory)


def lookup(wanted: DataFrame, blocks: DataFrame, directory: list[tuple[tuple, int]]) -> DataFrame:
    """The captures of each distinct wanted (url, page_id), as in `captures`; url as `header_url` gives it."""
    shared = wanted.sparkSession.sparkContext.broadcast(([k for k, _ in directory], [b for _, b in directory]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, numbers = shared.value
        for batch in batches:
            out = []
            for url, page_id in zip(batch.column("url").to_pylist(), batch.column("page_id").to_pylist(), strict=True):
                key = url_key(url)
                want = _order(key, page_id)
                # captures that repeat a key and id may go on from the block before
                low, high = max(0, bisect.bisect_left(firsts, want) - 1), bisect.bisect_right(firsts, want)
                out += [(numbers[i], key, page_id) for i in range(low, high)]
            columns = list(zip(*out, strict=True)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64()), strict=True)], ["block", "key", "page_id"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for wants, data in zip(batch.column("wants").to_pylist(), batch.column("data").to_pylist(), strict=True):
                rows = [json.loads(x) for x in zlib.decompress(data).decode().split("\n")]
                orders = [_order(r[0], r[1]) for r in rows]
                out = []
                for w in wants:
                    want = _order(w["key"], w["page_id"])
                    out += rows[bisect.bisect_left(orders, want) : bisect.bisect_right(orders, want)]
                columns = list(zip(*out, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()), strict=True)], ["key", "page_id", "path", "offset", "length"])

    placed = wanted.select("url", "page_id").distinct().mapInArrow(place, "block long, key string, page_id long").distinct()
    groups = placed.groupBy("block", F.pmod(F.xxhash64("key", "page_id"), F.lit(8)).alias("part")).agg(F.collect_list(F.struct("key", "page_id")).alias("wants"))
    return groups.join(blocks.select("block", "data"), "block").select("wants", "data").mapInArrow(search, _CAPTURE)


_READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, key string"
#: Schemes of Hadoop's connectors and those by which the same stores are opened for range reads.
RANGE_SCHEMES = {"file": "file", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _read(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
    """What (key, record) pairs say."""
    out = []
    for key, data in rows:
        head, at = parse_head(data, 0)
        http, body = parse_head(data, at)
        payload = data[body:]
        kind = head["warc-type"]
        whole = kind == "response"
        digest = hashlib.sha1(payload).hexdigest() if whole else head["warc-payload-digest"].rpartition(":")[2]
        out.append((_page(head["warc-record-id"]), len(payload) if whole else int(http["content-length"]), digest, kind, None if whole else _page(head["warc-refers-to"]), key))
    columns = list(zip(*out, strict=True)) or [[]] * 6
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "key"])


def read_ranges(found: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and key of each capture, read from its bytes.

    Stores of RANGE_SCHEMES are read range by range; from others, which only
    Spark opens, come whole archive files, whose size is bounded.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        name, file = None, None
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, 64):
                    rows = []
                    for key, path, offset, length in zip(*(batch.slice(at, 64).column(k).to_pylist() for k in ("key", "path", "offset", "length")), strict=True):
                        if path != name:
                            if file:
                                file.close()
                            scheme, _, rest = path.partition(":")
                            store, inner = fs.FileSystem.from_uri(f"{RANGE_SCHEMES[scheme]}:{rest}")
                            name, file = path, store.open_input_file(inner)
                        rows.append((key, file.read_at(length, offset)))
                    yield _read(rows)
        finally:
            if file:
                file.close()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, ranges in zip(batch.column("content"), batch.column("ranges").to_pylist(), strict=True):
                data = content.as_buffer()
                for at in range(0, len(ranges), 64):
                    yield _read([(r["key"], data[r["offset"] : r["offset"] + r["length"]].to_pybytes()) for r in ranges[at : at + 64]])

    found = stored(found, "warc-ranges")
    schemes = {r[0] for r in found.select(F.split("path", ":")[0]).distinct().collect()}
    if schemes <= set(RANGE_SCHEMES):
        near = found.repartition("path").sortWithinPartitions("path", "offset").select("key", "path", "offset", "length")
        return near.mapInArrow(read, _READ)
    folders = [r[0] for r in found.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]
    ranges = found.groupBy("path").agg(F.collect_list(F.struct("key", "offset", "length")).alias("ranges"))
    files = found.sparkSession.read.format("binaryFile").load(folders).select("path", "content")
    return files.join(ranges, "path").select("content", "ranges").mapInArrow(cut, _READ)


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """Every page, written to archives and read back through the index."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    path = shared_dir(spark, "warc")
    write_archives(pages, path)
    blocks, directory = build_index(captures(spark, path))
    found = lookup(pages.select(header_url(F.col("url")).alias("url"), "page_id"), blocks, directory)
    return read_ranges(found).drop("key")


OP6_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT payload_digest, max(page_id) AS original FROM p WHERE payload_bytes >= {REVISIT_BYTES} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN original <> page_id THEN original END AS refers_to
FROM p LEFT JOIN o USING (payload_digest)
"""
