"""Queries with SQL against it, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from smoothway.llm import decontam, jaccard, queries, store
from tests.compare import assert_same


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_oracle(spark, duck, sf_dir, name):
    assert_same(queries.QUERIES[name](spark, sf_dir), duck, queries.ORACLES[name])


def test_all_operators_are_registered():
    import __spark_entry__ as entry

    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


def test_each_stage_has_its_effect(spark, sf_dir):
    docs = store.written(spark.read.parquet(f"{sf_dir}/documents.parquet"), "documents")
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        kept = store.written(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert kept.columns == docs.columns
            assert kept.count() <= docs.count()
        docs = after[name] = kept
    near = jaccard.near_duplicates(after["near_duplicates"])
    assert near.filter("doc_id <> component_id").isEmpty()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert decontam.contamination(after["decontamination"], items).filter("contaminated").isEmpty()
    assert after["pii"].count() == after["decontamination"].count()
    assert after["packing"].filter("piece = 0").count() == after["pii"].count()


def test_spans_can_go_instead_of_documents(spark):
    docs = spark.createDataFrame([(1, "before ONE two three after", 26), (2, "clean text", 10), (3, None, None)], "doc_id long, text string, n_chars long")
    items = spark.createDataFrame([(7, "one two three")], "item_id long, text string")
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in decontam.decontaminate(docs, items, remove="spans").collect()}
    assert kept == {1: ("before  after", 13), 2: ("clean text", 10), 3: (None, None)}
