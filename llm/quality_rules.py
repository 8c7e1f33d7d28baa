"""Quality rules with adaptive thresholds, on DataFrame functions alone.

Base measures of each text are computed inside its row.  Four ratios then go
into a mergeable quantile sketch for every language and source: counts by
logarithmic bucket with a fixed relative error, which merge by addition, so
partial sums before the shuffle serve hot sources and any order of merging
gives the same thresholds.  A ratio fails beyond the far-out fence of its group
(a quartile plus a multiple of the interquartile range, and a least distance so
that groups of equal values keep ordinary texts).  Thresholds are joined to the
documents; Spark broadcasts them when they are small and shuffles the measures,
never the texts, when they are not.

Defined results: a null text has no words and fails the base rule, as an empty
one does; null languages or sources are groups of their own; repeated rows are
judged each on its own; an empty table gives an empty result; groups of fewer
than `LEAST_GROUP` passing documents take the language's thresholds, and those
of smaller languages the thresholds of all documents.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from llm.sparkkit import NOT_SPACE, WORD, stored

SYMBOLS = r"[#*$%&|<>]+"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Buckets of the sketch: a value lies within 2 % of its bucket's middle.
GAMMA = 1.04
LEAST_VALUE = 1e-4
#: Fence: quartile plus FENCE times the interquartile range.
FENCE = 4.0
LEAST_GROUP = 100
#: Measure: whether low values fail, whether high ones do, and the least distance from the quartile.
RATIOS = {
    "symbol_ratio": (False, True, 0.75),
    "word_length": (True, True, 2.0),
    "dup_line_ratio": (False, True, 0.3),
    "repeat_ratio": (False, True, 0.25),
}


def measured(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """`keep` and the base measures n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Equal 3-word windows of a text are found by sorting the windows' 64-bit
    hashes with their positions; texts whose hashes all differ skip that.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    d = docs.select(
        *keep,
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
        F.length(F.regexp_replace(text, NOT_SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
    )
    d = d.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.slice(F.transform("_words", lambda x, i: F.xxhash64(x, F.get("_words", i + 1), F.get("_words", i + 2))), F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))).alias("_windows"),
    )
    base = [*keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    ordered = F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))))
    d = d.select(*base, ordered.alias("_ordered"))
    same = lambda e, k: (F.get("_ordered", k - 1)["x"] == e["x"]) | (F.get("_ordered", k + 1)["x"] == e["x"])
    starts = F.sort_array(F.transform(F.filter("_ordered", lambda e, k: F.coalesce(same(e, k), F.lit(False))), lambda e: e["i"]))
    d = d.select(*base, starts.alias("_starts"))
    covered = F.aggregate("_starts", F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda a, i: F.struct((i + 3).alias("end"), (a["n"] + i + 3 - F.greatest(a["end"], i)).alias("n")), lambda a: a["n"])
    return d.select(*base, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def ratios(d: DataFrame) -> DataFrame:
    by = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return (
        d.withColumn("symbol_ratio", by("n_symbols", "n_words"))
        .withColumn("word_length", by("word_chars", "n_words"))
        .withColumn("dup_line_ratio", by("n_dup_lines", "n_lines"))
        .withColumn("repeat_ratio", by("n_repeat_words", "n_words"))
    )


def bucket(value: Column) -> Column:
    """The sketch's bucket of a value: 0 for values up to LEAST_VALUE."""
    return F.when(value <= LEAST_VALUE, 0).otherwise(F.ceil(F.round(F.log(value / LEAST_VALUE) / math.log(GAMMA), 6))).cast("int")


def middle(bucket: Column) -> Column:
    return F.when(bucket == 0, 0.0).otherwise(F.pow(F.lit(GAMMA), bucket - 0.5) * LEAST_VALUE)


def sketches(d: DataFrame, by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """(*by, measure, bucket, n): the mergeable sketches; sum n to merge them."""
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in RATIOS)))
    return d.select(*by, pairs.alias("_p")).groupBy(*by, "_p.measure", "_p.bucket").agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, by: tuple[str, ...]) -> DataFrame:
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, by: tuple[str, ...], fence: float = FENCE) -> DataFrame:
    """(*by, n_group, low_<ratio>, high_<ratio>) from merged sketches."""
    group = W.partitionBy(*by, "measure")
    run = F.sum("n").over(group.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
    s = sketch.withColumn("_run", run).withColumn("_all", F.sum("n").over(group))
    at = lambda m, q: middle(F.min(F.when((F.col("measure") == m) & (F.col("_run") >= F.col("_all") * q), F.col("bucket"))))
    out = [F.max("_all").alias("n_group")]
    for m, (low, high, least) in RATIOS.items():
        q1, q3 = at(m, 0.25), at(m, 0.75)
        reach = F.greatest((q3 - q1) * fence, F.lit(least))
        out += [(q1 - reach).alias(f"low_{m}")] * low + [(q3 + reach).alias(f"high_{m}")] * high
    return s.groupBy(*by).agg(*out)


def judged(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "lang", "source")) -> DataFrame:
    """`keep`, the base measures, base_failed and kept for each document; lang and source are in `keep`."""
    d = ratios(stored(measured(docs, keep), "quality-measures"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    d = d.withColumn("base_failed", failed)
    fine = stored(sketches(d.where(~F.col("base_failed"))), "quality-sketches")
    names = [f"{s}_{m}" for m, (low, high, _) in RATIOS.items() for s, on in (("low", low), ("high", high)) if on]
    own = fences(fine, ("lang", "source")).alias("g")
    lang = fences(merged(fine, ("lang",)), ("lang",)).alias("l")
    every = fences(merged(fine, ()), ()).alias("e")
    pick = lambda n: F.when(F.col("g.n_group") >= LEAST_GROUP, F.col(f"g.{n}")).when(F.col("l.n_group") >= LEAST_GROUP, F.col(f"l.{n}")).otherwise(F.col(f"e.{n}")).alias(n)
    table = own.join(lang, F.col("g.lang").eqNullSafe(F.col("l.lang"))).join(F.broadcast(every), F.lit(True)).select("g.lang", "g.source", *map(pick, names)).alias("t")
    verdict = F.lit(True)
    for m, (low, high, _) in RATIOS.items():
        if low:
            verdict &= F.col(f"d.{m}") >= F.col(f"t.low_{m}")
        if high:
            verdict &= F.col(f"d.{m}") <= F.col(f"t.high_{m}")
    joined = d.alias("d").join(table, F.col("d.lang").eqNullSafe(F.col("t.lang")) & F.col("d.source").eqNullSafe(F.col("t.source")), "left")
    return joined.select("d.*", (~F.col("d.base_failed") & F.coalesce(verdict, F.lit(False))).alias("kept"))


def kept(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns: the fences joined back to the rows by id and text hash."""
    key = F.xxhash64("text")
    d = judged(docs.withColumn("_quality_key", key), ("doc_id", "lang", "source", "_quality_key")).where("kept").select(F.col("doc_id").alias("_id"), F.col("_quality_key").alias("_key")).distinct()
    return docs.join(d, docs["doc_id"].eqNullSafe(d["_id"]) & (F.xxhash64(docs["text"]) == d["_key"]), "left_semi")


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    d = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _sql() -> str:
    g = repr(math.log(GAMMA))
    at = lambda m, q: f"CASE WHEN min(bucket) FILTER (measure = '{m}' AND run >= al * {q}) = 0 THEN 0.0 ELSE pow({GAMMA}, min(bucket) FILTER (measure = '{m}' AND run >= al * {q}) - 0.5) * {LEAST_VALUE} END"
    cols, names, tests = [], [], []
    for m, (low, high, least) in RATIOS.items():
        q1, q3 = f"({at(m, 0.25)})", f"({at(m, 0.75)})"
        reach = f"greatest(({q3} - {q1}) * {FENCE}, {least})"
        for on, s, value, sign in ((low, "low", f"{q1} - {reach}", ">="), (high, "high", f"{q3} + {reach}", "<=")):
            if on:
                cols.append(f"{value} AS {s}_{m}")
                names.append(f"{s}_{m}")
                tests.append(f"d.{m} {sign} t.{s}_{m}")
    level = lambda by: f"SELECT {by}max(al) AS n_group, {', '.join(cols)} FROM (SELECT *, sum(n) OVER (PARTITION BY {by}measure ORDER BY bucket) AS run, sum(n) OVER (PARTITION BY {by}measure) AS al FROM (SELECT {by}measure, bucket, sum(n) AS n FROM sk GROUP BY ALL)) {'GROUP BY ' + by.rstrip(', ') if by else ''}"
    parts = " UNION ALL ".join(f"SELECT lang, source, '{m}' AS measure, CASE WHEN {m} <= {LEAST_VALUE} THEN 0 ELSE ceil(round(ln({m} / {LEAST_VALUE}) / {g}, 6)) END::INT AS bucket FROM d WHERE NOT base_failed" for m in RATIOS)
    picks = ", ".join(f"CASE WHEN g.n_group >= {LEAST_GROUP} THEN g.{n} WHEN l.n_group >= {LEAST_GROUP} THEN l.{n} ELSE e.{n} END AS {n}" for n in names)
    return rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM documents),
n AS (SELECT row_number() OVER () AS rowid_, * FROM w),
win2 AS (SELECT n.rowid_, i, n.ws[i] || ' ' || n.ws[i + 1] || ' ' || n.ws[i + 2] AS g FROM (SELECT rowid_, ws, unnest(range(1, len(ws) - 1)) AS i FROM n) n),
rep AS (SELECT rowid_, i FROM (SELECT *, count(*) OVER (PARTITION BY rowid_, g) AS c FROM win2) WHERE c >= 2),
cov AS (SELECT rowid_, count(DISTINCT p) AS c FROM (SELECT rowid_, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rowid_),
b AS (SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
      (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
      (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(c, 0)::BIGINT AS n_repeat_words FROM n LEFT JOIN cov USING (rowid_)),
d AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed,
      CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS symbol_ratio, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS word_length,
      CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_line_ratio, CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS repeat_ratio FROM b),
sk AS (SELECT lang, source, measure, bucket, count(*) AS n FROM ({parts}) GROUP BY ALL),
g AS ({level('lang, source, ')}), l AS ({level('lang, ')}), e AS ({level('')}),
t AS (SELECT g.lang, g.source, {picks} FROM g JOIN l ON g.lang IS NOT DISTINCT FROM l.lang, e)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce({' AND '.join(tests)}, false) AS kept
FROM d LEFT JOIN t ON d.lang IS NOT DISTINCT FROM t.lang AND d.source IS NOT DISTINCT FROM t.source
"""


OP10_SQL = _sql()
