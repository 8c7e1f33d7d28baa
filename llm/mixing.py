"""Mixing sources to target weights.

Words are counted per document and summed per source; every source gets a
target by weighted water-filling; a document is emitted floor(rate) times, and
once more by a hash-seeded Bernoulli draw of the remaining fraction, where the
rate is its source's target over its source's size.

Defined results: a null text has size 0; a null source is a source of its own,
ordered last; a source without words has target 0 and rate 0; an empty table
gives an empty mix; rows of one id or without id have draws of their own, by
their texts (rows that repeat both share one); other columns, of any name, pass
through `mix` untouched, but for a column copy_no in any case, which is replaced.

The only rows that meet in one task are the per-source totals (one row for each
source); documents are never grouped whole, so a source with a third of all
rows is a map-side sum and a join of its few totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from llm.sparkkit import WORD, stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source's words are taken this many times at most.
MOST = 3
SEED = "mix-1"


def words_of(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends only on the id, the text and the seed."""
    key = F.concat_ws(":", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null")), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size).

    Sources share all words by weight, none above `most` times its own size;
    what a source can't take goes to the others by weight.  In order of
    most * size / weight the sources that stop at their limit come first, so
    running sums find them without iterating.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    limit = F.col("source_size").cast("double") * most
    before = W.orderBy("_fill", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    every = W.partitionBy()
    left = (F.sum(F.col("source_size").cast("double")).over(every) - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))) / (F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
    level = F.when(F.col("_fill") > F.col("_level"), F.col("_level"))
    return (
        total.withColumn("_weight", weight)
        .withColumn("_limit", limit)
        .withColumn("_fill", F.col("_limit") / F.col("_weight"))
        .withColumn("_level", left)
        .withColumn("_least", F.min(F.struct(F.when(level.isNotNull(), F.col("_fill")).alias("fill"), level.alias("level"))).over(W.partitionBy(level.isNotNull())))
        .withColumn("_least", F.max(F.when(level.isNotNull(), F.col("_least.level"))).over(every))
        .select("source", "source_size", F.when(level.isNull(), F.col("_limit")).otherwise(F.col("_weight") * F.col("_least")).alias("target"))
    )


def copies_of(rate: Column, drawn: Column) -> Column:
    return F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies), a row for each document."""
    sizes = stored(docs.select("doc_id", "source", words_of(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text"), seed).alias("drawn")), "mix-sizes")
    targets = source_targets(sizes, weights, most)
    d, t = sizes.alias("d"), targets.alias("t")
    rate = F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(0.0)
    return d.join(t, F.col("d.source").eqNullSafe(F.col("t.source"))).select("d.doc_id", "d.source", "d.size", "t.source_size", "t.target", copies_of(rate, F.col("d.drawn")).cast("long").alias("copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mixture itself: every column of docs, and copy_no from 1 up for each emitted copy.

    The rates join the documents by source; texts are neither shuffled nor
    grouped.  A document travels as one struct, so that no column's name can
    clash with one of this function's.
    """
    sizes = docs.select("source", words_of(F.col("text")).alias("size"))
    rates = source_targets(sizes, weights, most).select(F.col("source").alias("of"), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))
    whole = docs.select(F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in docs.columns)).alias("doc"))
    of = lambda c: F.col("doc").getField(c)
    joined = whole.join(rates, of("source").eqNullSafe(F.col("of")))
    made = joined.select("doc", copies_of(F.col("rate"), draw(of("doc_id"), of("text"), seed)).cast("int").alias("copies")).where("copies > 0")
    each = made.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"))
    return each.select(*(of(c).alias(c) for c in docs.columns if c.lower() != "copy_no"), "copy_no")


def op8_mix(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents as figures: one row for each document, with the words that the mix takes."""
    p = plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return p.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(text, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w, source_size::DOUBLE * 3 AS lim FROM s),
f AS (SELECT *, lim / w AS fill FROM r),
l AS (SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(lim) OVER p, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER p, 0)) AS level FROM f
      WINDOW p AS (ORDER BY fill, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN fill > level THEN w * (SELECT arg_min(level, fill) FROM l WHERE fill > level) ELSE lim END AS target FROM l),
j AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
      ('0x' || substr(md5('mix-1:' || coalesce(d.doc_id::VARCHAR, 'null') || ':' || d.key), 1, 12))::BIGINT::DOUBLE / 281474976710656.0 AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM j
"""
