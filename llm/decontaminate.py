"""Benchmark decontamination by a distributed positional inverted index, on DataFrame functions alone.

Benchmark items are cut into windows of consecutive words, whose terms are the
index's vocabulary.  One pass over the documents stores the postings (term, row,
position) of those terms and the number of words of each row; everything after
reads the index, never the texts:

1. The postings tell how often each term occurs, which orders a window's terms
   from the rarest.
2. The list of the rarest, less its offset in the window, gives starts where the
   window may occur; it is intersected with the list of the next, adjusted
   likewise.
3. What is left asks for its other terms at their places, in the postings of the
   rows that have such starts; starts with all of them are the exact matches.

The vocabulary and the windows' terms are broadcast while their counted number
is small, and joined by a shuffle beyond.  A phrase found in very many documents
is very many short rows spread by document; nothing groups the rows of a term,
window or item in one task.

Defined results: a null text has no words and no hits; an item without words
has no windows; a row's matches depend on its text alone, so rows that repeat
an id are judged each on its own, by id and text hash; items that repeat an item_id count once; an
empty table on either side gives no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.sparkkit import small, stored

#: Words: runs of digits, letters and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Stands after the last word of a document, so that one pass gives postings and lengths; no word holds it.
END, END_ID = "\x00end", -1
WINDOW = 10
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z to a-z and nothing else, by the fast function where the text is ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def terms(text: Column) -> Column:
    return F.regexp_extract_all(lowered(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def row_hash(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return F.xxhash64(text, F.length(text))


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, phrase, n): the distinct windows of each item, n words each."""
    i = items.select("item_id", terms(F.col("text")).alias("words")).where(F.size("words") > 0)
    start = F.explode(F.sequence(F.lit(1), F.greatest(F.size("words") - width + 1, F.lit(1))))
    return i.select("item_id", "words", start.alias("_at")).select("item_id", F.slice("words", F.col("_at"), F.lit(width)).alias("phrase")).distinct().withColumn("n", F.size("phrase"))


def postings_of(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Stored (term_id, doc_id, row_hash, at): every place of a term of the stored vocabulary (term, term_id), and one row more a document.

    That one has END_ID as term and the number of words as place.
    """
    known = vocabulary.union(docs.sparkSession.range(1).select(F.lit(END), F.lit(END_ID).cast("long")))
    words = docs.select("doc_id", row_hash(F.col("text")).alias("row_hash"), terms(F.col("text")).alias("words"))
    # only functions that Spark compiles stand here, else each place would copy the document's words
    each = words.select("doc_id", "row_hash", F.posexplode(F.array_append("words", END)).alias("at", "term"))
    return stored(each.join(small(known, vocabulary.count()), "term").select("term_id", "doc_id", "row_hash", "at"), "decontaminate-postings")


def ordered_terms(phrases: DataFrame, vocabulary: DataFrame, postings: DataFrame) -> DataFrame:
    """Stored (phrase_id, n, rank, term_id, offset): each phrase's terms, rank 0 the rarest in the postings; terms without any are left out."""
    counts = postings.groupBy("term_id").agg(F.count("*").alias("often"))
    each = phrases.select("phrase_id", "n", F.posexplode("phrase").alias("offset", "term")).join(vocabulary.join(counts, "term_id"), "term")
    ranked = each.groupBy("phrase_id", "n").agg(F.sort_array(F.collect_list(F.struct("often", "term_id", "offset"))).alias("r"))
    return stored(ranked.select("phrase_id", "n", F.posexplode("r").alias("rank", "x")).select("phrase_id", "n", "rank", "x.term_id", "x.offset"), "decontaminate-order")


def starts_of(postings: DataFrame, order: DataFrame) -> DataFrame:
    """(phrase_id, n, doc_id, row_hash, start): the postings' lists of these phrase terms, less their offsets."""
    found = postings.join(small(order, order.count()), "term_id")
    return found.select("phrase_id", "n", "doc_id", "row_hash", (F.col("at") - F.col("offset")).alias("start")).where("start >= 0")


def same_row(x: str, y: str) -> Column:
    return F.col(f"{x}.doc_id").eqNullSafe(F.col(f"{y}.doc_id")) & (F.col(f"{x}.row_hash") == F.col(f"{y}.row_hash"))


def phrase_starts(postings: DataFrame, order: DataFrame) -> DataFrame:
    """(doc_id, row_hash, phrase_id, start, n): every exact occurrence of a phrase, start counted from 0."""
    row, key = ["doc_id", "row_hash"], ["phrase_id", "n", "doc_id", "row_hash", "start"]
    whole = order.groupBy("phrase_id").agg(F.count("*").alias("known"), F.first("n").alias("n")).where("known = n").select("phrase_id")
    order = order.join(whole, "phrase_id", "left_semi")  # a phrase with a term that no document has doesn't occur
    one = starts_of(postings, order.where("rank = 0"))
    two = starts_of(postings, order.where("rank = 1")).alias("y")
    x = one.where("n > 1").alias("x")
    both = x.join(two, (F.col("x.phrase_id") == F.col("y.phrase_id")) & same_row("x", "y") & (F.col("x.start") == F.col("y.start")), "left_semi")
    found = stored(both.union(one.where("n = 1")).distinct(), "decontaminate-starts")
    rest = order.where("rank > 1").select("phrase_id", "term_id", "offset")
    asked = found.where("n > 2").join(small(rest, rest.count()), "phrase_id").withColumn("at", F.col("start") + F.col("offset")).alias("x")
    rows = stored(found.where("n > 2").select(*row).distinct(), "decontaminate-rows")
    places = postings.alias("p").join(small(rows, rows.count()).alias("r"), same_row("p", "r"), "left_semi").where(F.col("term_id") != END_ID).distinct().alias("y")
    there = asked.join(places, same_row("x", "y") & (F.col("x.at") == F.col("y.at")) & (F.col("x.term_id") == F.col("y.term_id")))
    full = there.groupBy(*(F.col(f"x.{k}").alias(k) for k in key)).agg(F.count("*").alias("more")).where(F.col("more") == F.col("n") - 2)
    return full.select(*row, "phrase_id", "start", "n").union(found.where("n <= 2").select(*row, "phrase_id", "start", "n"))


def phrases_of(items: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Stored (phrase_id, phrase, n) of the distinct phrases, and (item_id, phrase_id)."""
    w = windows(items, width).withColumn("phrase_id", F.md5(F.array_join("phrase", " ").cast("binary")))
    w = stored(w, "decontaminate-windows")
    return w.select("phrase_id", "phrase", "n").dropDuplicates(["phrase_id"]), w.select("item_id", "phrase_id")


def index(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored postings of the items' terms, the ordered terms of their windows, and (item_id, phrase_id)."""
    phrases, of = phrases_of(items, width)
    vocabulary = phrases.select(F.explode("phrase").alias("term")).distinct()
    vocabulary = stored(vocabulary.withColumn("term_id", F.monotonically_increasing_id()), "decontaminate-terms")
    postings = postings_of(docs, vocabulary)
    return postings, ordered_terms(phrases, vocabulary, postings), of


def matches(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored (doc_id, row_hash, phrase_id, start, n); (doc_id, row_hash, n_words) of all documents; (item_id, phrase_id)."""
    postings, order, of = index(docs, items, width)
    found = stored(phrase_starts(postings, order), "decontaminate-matches")
    return found, postings.where(F.col("term_id") == END_ID).select("doc_id", "row_hash", F.col("at").cast("long").alias("n_words")), of


def covered(spans: Column) -> Column:
    """Words covered by an ordered array of (start, n)."""
    step = lambda a, s: F.struct(F.greatest(a["end"], s["start"] + s["n"]).alias("end"), (a["n"] + F.greatest(s["start"] + s["n"] - F.greatest(a["end"], s["start"]), F.lit(0))).alias("n"))
    return F.aggregate(spans, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step, lambda a: a["n"])


def hits(found: DataFrame, of: DataFrame) -> DataFrame:
    """(doc_id, row_hash, spans, n_hit, item_ids) of the documents with matches; spans are ordered (start, n)."""
    row = ["doc_id", "row_hash"]
    spans = found.groupBy(*row).agg(F.sort_array(F.collect_set(F.struct("start", "n"))).alias("spans"))
    pairs = found.select(*row, "phrase_id").distinct().join(of, "phrase_id").select(*row, "item_id").distinct()
    ids = pairs.groupBy(*row).agg(F.sort_array(F.collect_list(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("item_ids"))
    a, b = spans.alias("a"), ids.alias("b")
    return a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.row_hash") == F.col("b.row_hash"))).select("a.*", covered(F.col("spans")).cast("long").alias("n_hit"), "item_ids")


def judged(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and the spans of each document."""
    found, lengths, of = matches(docs, items, width)
    d = lengths.alias("d")
    h = hits(found, of).alias("h")
    ids = F.coalesce(F.col("h.item_ids"), F.array().cast("array<string>"))
    n_hit = F.coalesce(F.col("h.n_hit"), F.lit(0)).cast("long")
    return d.join(h, F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("d.row_hash") == F.col("h.row_hash")), "left").select(
        "d.doc_id", "d.n_words", n_hit.alias("n_hit"), F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "h.spans"
    )


def clean(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """docs, with all its columns, without the rows that have a hit."""
    found, _, _ = matches(docs, items, width)
    bad = stored(found.select("doc_id", "row_hash").distinct(), "decontaminate-bad")
    bad = small(bad, bad.count()).alias("b")
    return docs.join(bad, docs["doc_id"].eqNullSafe(F.col("b.doc_id")) & (row_hash(docs["text"]) == F.col("b.row_hash")), "left_anti")


def proximity_matches(docs: DataFrame, items: DataFrame, slop: int = 3, width: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, start, gap): windows whose two rarest terms stand near each other as in the window.

    Terms that no document has are passed over.  The distance between both terms
    may differ from that in the window by `slop` words; gap is the difference, 0
    where they stand exactly as in the window.
    """
    postings, order, of = index(docs, items, width)
    one, two = (starts_of(postings, order.where(F.col("rank") == k)) for k in (0, 1))
    cell = F.floor(F.col("start") / (slop + 1))
    x = one.withColumn("cell", cell).alias("x")
    y = two.withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1))).alias("y")  # starts at most slop apart lie in neighbouring cells
    gap = F.col("y.start") - F.col("x.start")
    near = x.join(y, (F.col("x.phrase_id") == F.col("y.phrase_id")) & same_row("x", "y") & (F.col("x.cell") == F.col("y.cell")) & (F.abs(gap) <= slop))
    return near.select("x.phrase_id", "x.doc_id", "x.start", gap.alias("gap")).join(of, "phrase_id").select("doc_id", "item_id", "start", "gap").distinct()


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    j = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return j.drop("spans")


OP7_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}') AS ws FROM benchmark),
w AS (SELECT DISTINCT item_id, ws[i:i + {WINDOW - 1}] AS p FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - {WINDOW - 2}, 2))) AS i FROM b WHERE len(ws) > 0)),
n AS (SELECT DISTINCT len(p) AS n FROM w),
g AS (SELECT r, i, n, ws[i:i + n - 1] AS p FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, n WHERE len(ws) >= n)),
m AS (SELECT r, i, n, item_id FROM g JOIN w USING (p)),
c AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS x FROM (SELECT DISTINCT r, i, n FROM m)) GROUP BY r),
k AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT r, coalesce(item_id::VARCHAR, '') AS s FROM m) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN k USING (r)
"""
