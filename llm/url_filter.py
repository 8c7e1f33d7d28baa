"""URL filters: rules first, then a character language-model ratio, on DataFrame functions alone.

URLs that a rule allows or blocks train two smoothed variable-order Markov
models of characters (interpolated Witten-Bell, orders 0 to ORDER-1).  The score
of a URL is the mean over its characters of the difference of log-likelihoods;
it is allowed if the score reaches a threshold calibrated on rule-decided URLs
that were held out of the training.

Every character of a distinct URL becomes one gram of ORDER characters; lower
orders are sums over the grams counted once.  Frequent grams ('https', 'examp')
are keys that every URL has, so the grams' scores reach the URLs by a join that
Spark may broadcast or split, and scores are whole millionths so that sums
agree in any order.

Defined results: a null URL, or one without '://', has an empty host and path,
fits no rule and is scored by what text it has (null: as an empty one, which scores 0);
URLs that repeat get the same verdict; an empty table gives an empty result;
without rule-decided URLs of both kinds every score is 0 and the threshold is 0,
so that the filter allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from llm.sparkkit import stored

#: (verdict, rule), a rule being a host and the start of a path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
ORDER = 5
#: One in this many rule-decided URLs calibrates instead of training.
CALIBRATION_FOLDS = 5
#: Characters that a URL may have, for the uniform model below order 0.
ALPHABET = 128
#: Copies of the one row that every gram looks up.
SALTS = 64
#: Bins of the calibration: scores in steps of 1/BINS between -LIMIT and LIMIT.
BINS, LIMIT = 100, 8


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null.  The rules are a fixed short list."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def grams(urls: DataFrame) -> DataFrame:
    """The rows of urls with gram: for each character of `url` the ORDER characters that end with it, padded at the start."""
    padded = urls.where(F.length("url") > 0).withColumn("_padded", F.concat(F.lit("^" * (ORDER - 1)), F.col("url")))
    ends = F.transform(F.sequence(F.lit(1), F.length("url")), lambda i: F.substring(F.col("_padded"), i, F.lit(ORDER)))
    return padded.withColumn("gram", F.explode(ends)).drop("_padded")


def gram_scores(counts: DataFrame) -> DataFrame:
    """(gram, score): millionths of the log-likelihood difference, from (gram, yes, no) training counts."""
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.lit(ORDER)), lambda k: F.struct(k.alias("k"), F.substring(F.col("gram"), F.lit(ORDER + 1) - k, k).alias("part"))))
    seen = counts.where("yes + no > 0").select("yes", "no", suffix.alias("_s")).groupBy("_s.k", "_s.part").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    context = seen.groupBy("k", F.expr("substring(part, 1, k - 1)").alias("context")).agg(
        F.sum("yes").alias("all_yes"), F.sum("no").alias("all_no"), F.sum(F.when(F.col("yes") > 0, 1).otherwise(0)).alias("kinds_yes"), F.sum(F.when(F.col("no") > 0, 1).otherwise(0)).alias("kinds_no")
    )
    # every gram has the empty context: its one row is given out SALTS times
    salt = F.when(F.col("k") == 1, F.pmod(F.xxhash64("gram"), F.lit(SALTS))).otherwise(0).cast("int")
    context = context.withColumn("salt", F.explode(F.when(F.col("k") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    want = counts.select("gram", suffix.alias("_s")).select("gram", "_s.k", "_s.part", F.expr("substring(_s.part, 1, _s.k - 1)").alias("context")).withColumn("salt", salt)
    parts = want.join(seen, ["k", "part"], "left").join(context, ["k", "context", "salt"], "left").na.fill(0, ["yes", "no", "all_yes", "all_no", "kinds_yes", "kinds_no"])
    orders = parts.groupBy("gram").agg(F.sort_array(F.collect_list(F.struct("k", "yes", "no", "all_yes", "all_no", "kinds_yes", "kinds_no"))).alias("orders"))

    def smooth(side: str) -> Column:
        step = lambda p, o: F.when(o[f"all_{side}"] > 0, (o[side] + o[f"kinds_{side}"] * p) / (o[f"all_{side}"] + o[f"kinds_{side}"])).otherwise(p)
        return F.aggregate("orders", F.lit(1.0 / ALPHABET), step)

    return orders.select("gram", F.round((F.log(smooth("yes")) - F.log(smooth("no"))) * 1_000_000).cast("long").alias("score"))


def threshold(scored: DataFrame) -> DataFrame:
    """One row (threshold): where (score, verdict) have the least mean of both error rates, the lowest such place if tied.

    Between two bins the threshold is in the middle of the gap.
    """
    b = F.greatest(F.lit(-LIMIT * BINS), F.least(F.lit(LIMIT * BINS), F.floor(F.col("score") * BINS))).cast("int")
    bins = scored.groupBy(b.alias("bin")).agg(F.sum(F.when(F.col("verdict") == "allow", 1).otherwise(0)).alias("yes"), F.sum(F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("no"))
    order, every = W.orderBy("bin"), W.partitionBy()
    before = order.rowsBetween(W.unboundedPreceding, -1)
    lost = F.coalesce(F.sum("yes").over(before), F.lit(0)) / F.sum("yes").over(every)
    passed = 1 - F.coalesce(F.sum("no").over(before), F.lit(0)) / F.sum("no").over(every)
    # whole billionths, so that equal errors tie in every engine
    error = F.round((lost + passed) * 1e9).cast("long")
    middle = (F.col("bin") + F.coalesce(F.lag("bin").over(order) + 1, F.col("bin"))) / (2 * BINS)
    ranked = bins.select("bin", middle.alias("middle"), F.when((F.sum("yes").over(every) > 0) & (F.sum("no").over(every) > 0), error).alias("error"))
    return ranked.agg(F.coalesce(F.min_by("middle", F.when(F.col("error").isNotNull(), F.struct("error", "bin"))), F.lit(0.0)).alias("threshold"))


def judged(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and score of each row of pages."""
    d = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url")).select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    d = d.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules)).select("page_id", "url", "host", "path", "_rule.rule", F.col("_rule.verdict").alias("ruled"))
    urls = d.select("url", "ruled").distinct().select("url", "ruled", F.conv(F.substring(F.md5(F.col("url").cast("binary")), 1, 15), 16, 10).cast("long").alias("key"))
    learns = F.col("key") % CALIBRATION_FOLDS != 0
    each = grams(urls.select("url", F.unhex(F.md5(F.col("url").cast("binary"))).alias("key"), F.when(learns & (F.col("ruled") == "allow"), 1).otherwise(0).alias("yes"), F.when(learns & (F.col("ruled") == "block"), 1).otherwise(0).alias("no"))).select("key", "gram", "yes", "no")
    counts = stored(each.groupBy("gram").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")), "url-grams")
    both = counts.agg((F.sum("yes") > 0).alias("y"), (F.sum("no") > 0).alias("n")).first()
    points = gram_scores(counts) if both["y"] and both["n"] else counts.select("gram", F.lit(0).cast("long").alias("score"))
    totals = each.select("key", "gram").join(points, "gram").groupBy("key").agg((F.sum("score") / F.count("*") / 1e6).alias("score"))
    scored = stored(urls.select("url", "ruled", learns.alias("learns"), F.unhex(F.md5(F.col("url").cast("binary"))).alias("key")).join(totals, "key", "left").select("url", "ruled", "learns", F.coalesce("score", F.lit(0.0)).alias("score")), "url-scores")
    edge = threshold(scored.where("NOT learns AND ruled IS NOT NULL").select("score", F.col("ruled").alias("verdict")))
    method = scored.select("url", "score").join(F.broadcast(edge), F.lit(True)).select("url", "score", F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block").alias("_method"))
    return d.join(method, "url").select("page_id", "host", "path", "rule", F.coalesce("ruled", "_method").alias("verdict"), "score")


def op1_url_filter(spark, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _sql() -> str:
    fits = lambda r: f"((host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) AND starts_with(path, '/{r.partition('/')[2]}'))"
    ordered = sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    pick = lambda k: "CASE " + " ".join(f"WHEN {fits(r[1])} THEN '{r[k]}'" for r in ordered) + " END"

    steps, prior = [], f"SELECT gram, (1.0::DOUBLE / {ALPHABET}) AS py, (1.0::DOUBLE / {ALPHABET}) AS pn FROM counts"
    for k in range(1, ORDER + 1):
        step = lambda s, p: f"CASE WHEN coalesce(c.all_{s}, 0) > 0 THEN (coalesce(m.{s}, 0) + c.kinds_{s} * {p}) / (c.all_{s} + c.kinds_{s}) ELSE {p} END"
        steps.append(f"o{k} AS (SELECT o.gram, {step('yes', 'o.py')} AS py, {step('no', 'o.pn')} AS pn FROM ({prior}) o LEFT JOIN seen m ON m.k = {k} AND m.part = right(o.gram, {k}) LEFT JOIN context c ON c.k = {k} AND c.context = left(right(o.gram, {k}), {k - 1}))")
        prior = f"SELECT * FROM o{k}"
    return rf"""
WITH p AS (SELECT page_id, coalesce(url, '') AS url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
d AS (SELECT *, {pick(1)} AS rule, {pick(0)} AS ruled FROM p),
urls AS (SELECT DISTINCT url, ruled, ('0x' || substr(md5(url), 1, 15))::BIGINT % {CALIBRATION_FOLDS} <> 0 AS learns FROM d),
each AS (SELECT url, substr('{"^" * (ORDER - 1)}' || url, i, {ORDER}) AS gram, (learns AND ruled = 'allow')::INT AS yes, (learns AND ruled = 'block')::INT AS no FROM (SELECT *, unnest(range(1, length(url) + 1)) AS i FROM urls)),
counts AS (SELECT gram, sum(coalesce(yes, 0)) AS yes, sum(coalesce(no, 0)) AS no FROM each GROUP BY gram),
seen AS (SELECT k, right(gram, k) AS part, sum(yes) AS yes, sum(no) AS no FROM counts, (SELECT unnest(range(1, {ORDER + 1})) AS k) WHERE yes + no > 0 GROUP BY 1, 2),
context AS (SELECT k, left(part, k - 1) AS context, sum(yes) AS all_yes, sum(no) AS all_no, count(*) FILTER (yes > 0) AS kinds_yes, count(*) FILTER (no > 0) AS kinds_no FROM seen GROUP BY 1, 2),
{', '.join(steps)},
points AS (SELECT gram, CASE WHEN (SELECT min(x) FROM (SELECT sum(yes) AS x FROM counts UNION ALL SELECT sum(no) FROM counts)) > 0 THEN round((ln(py) - ln(pn)) * 1000000)::BIGINT ELSE 0 END AS score FROM o{ORDER}),
totals AS (SELECT url, sum(score) / count(*) / 1e6 AS score FROM each JOIN points USING (gram) GROUP BY url),
scored AS (SELECT urls.*, coalesce(score, 0.0) AS score FROM urls LEFT JOIN totals USING (url)),
bins AS (SELECT greatest({-LIMIT * BINS}, least({LIMIT * BINS}, floor(score * {BINS})))::INT AS bin, count(*) FILTER (ruled = 'allow') AS yes, count(*) FILTER (ruled = 'block') AS no FROM scored WHERE NOT learns AND ruled IS NOT NULL GROUP BY 1),
errors AS (SELECT bin, (bin + coalesce(lag(bin) OVER (ORDER BY bin) + 1, bin)) / {2 * BINS}.0::DOUBLE AS middle, sum(yes) OVER () AS y, sum(no) OVER () AS n, coalesce(sum(yes) OVER b, 0) / sum(yes) OVER () + 1 - coalesce(sum(no) OVER b, 0) / sum(no) OVER () AS e FROM bins WINDOW b AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
edge AS (SELECT coalesce((SELECT middle FROM errors WHERE y > 0 AND n > 0 ORDER BY round(e * 1e9)::BIGINT, bin LIMIT 1), 0.0) AS t)
SELECT page_id, host, path, rule, coalesce(d.ruled, CASE WHEN score >= t THEN 'allow' ELSE 'block' END) AS verdict, score FROM d JOIN scored USING (url), edge
"""


OP1_SQL = _sql()
