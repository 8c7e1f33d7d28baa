"""The pipeline's stages on the smallest tables, each against a brute-force version on its own input."""

import math
from collections import Counter

import pytest

import corpus_pipeline
from llm import mixing, quality_classifier
from tests.llm.test_operators import TERM, WORD, brute_components, brute_hits

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, docs := spark.read.parquet(path)))
    return out


def rows(d):
    return [(r.doc_id, r.text) for r in d.select("doc_id", "text").collect()]


def test_all_but_the_last_return_the_columns_of_documents(results):
    assert all(after.columns == before.columns for before, after in results[:-1])
    assert results[-1][1].columns == [*results[-1][0].columns, "copy_no"]


def test_quality_keeps_what_scores_enough(spark, results):
    before, after = results[0]
    want = {r.doc_id for r in quality_classifier.scored(before, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.score >= 0.3}
    assert {r.doc_id for r in after.collect()} == want


def test_near_dedup_keeps_one_of_each_group(results):
    before, after = results[1]
    assert sorted(r[0] for r in rows(after)) == sorted(i for i, _, c in brute_components(rows(before), 80) if i == c)


def test_passages_are_cut_from_later_documents_only(results):
    before, after = (dict(rows(x)) for x in results[2])
    assert before.keys() == after.keys()
    seen = set()
    for doc in sorted(before):
        w = WORD.findall((after[doc] or "").lower())
        own = {tuple(w[i : i + 60]) for i in range(len(w) - 59)}
        assert not own & seen, doc
        seen |= own
    changed = [d for d in before if before[d] != after[d]]
    assert all(len(WORD.findall(after[d])) <= len(WORD.findall(before[d])) - 45 for d in changed)


def test_decontamination_drops_the_documents_with_hits(spark, results):
    before, after = results[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert sorted(r[0] for r in rows(after)) == sorted(h[0] for h in brute_hits(rows(before), items) if not h[-1])
    assert TERM.findall("a b")


def test_mixture_emits_floor_or_ceiling_of_the_rate(results):
    before, after = results[4]
    plan = {r.doc_id: r for r in mixing.plan(before).collect()}
    copies = Counter(r[0] for r in rows(after))
    for doc, r in plan.items():
        rate = r.target / r.source_size if r.source_size else 0
        assert copies[doc] == r.copies and math.floor(rate) <= r.copies <= math.ceil(rate)


def test_run_gives_the_last_stage(spark, results):
    assert Counter(rows(corpus_pipeline.run(spark, SF))) == Counter(rows(results[-1][1]))


def test_stages_take_odd_tables(spark):
    """Null ids and texts, repeated ids, empty and long texts, extra columns with the names of inner ones, and no rows at all."""
    names = "doc_id long, text string, lang string, source string, n_chars long, row string, spans string, hash string, odd_id string, score string, root string, value string, y string"
    passage = " ".join(f"p{i}" for i in range(80))
    texts = [None, "", "one two", passage + " tail", "head " + passage, "x " * 30_000, passage.upper() + " other end"]
    table = [(k % 5 if k else None, t, None if k % 2 else "en", None if k % 3 else "a", 1, *["own"] * 8) for k, t in enumerate(texts * 2)]
    docs = spark.createDataFrame(table, names)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.columns[: len(docs.columns)] == docs.columns, name
        kept = out.collect()
        assert all(r.row == r.spans == r.value == "own" for r in kept) and len(kept) <= 3 * len(table), name
        assert stage(spark, docs.where("false"), SF).count() == 0, name
