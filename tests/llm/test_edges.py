"""Every operator on odd tables: nulls in any column, empty and very long texts, ties, repeated rows,
no rows at all, and extra columns with clashing names."""

import public_tokenizers
import pytest

from smoothway.llm import decontam, html, jaccard, langid, lm, packing, pii, sharding, simhash, store, toxicity

LONG = "alpha beta gamma delta epsilon zeta eta theta " * 4000
ODD = [
    (1, "one two three four five six", "en", "a", 27, 9, 1),
    (1, "one two three four five six", "en", "a", 27, 9, 1),
    (2, None, None, None, None, None, None),
    (3, "", "en", "b", 0, 3, 2),
    (4, LONG, "de", "b", len(LONG), 3, 3),
    (None, "lost words of a row without an id", "de", None, 33, None, None),
    (5, "?!", "en", "c", 2, 1, 1),
    (6, "Äpfel und Öl 😀 writes a@b.co", "de", "c", 29, 1, 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score long, shard long"
PATHS = [public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken")]


def _labels(docs):
    return docs.sparkSession.createDataFrame([(1, 1), (3, 0), (4, 0), (6, 1), (None, 1), (77, 0)], "doc_id long, toxic int")


def _items(docs):
    return docs.sparkSession.createDataFrame([(1, "two three four"), (2, None), (None, "five six"), (3, "")], "item_id long, text string")


RUNS = {
    "simhash": lambda d: simhash.edited_fingerprints(d),
    "langid": lambda d: langid.languages(d),
    "toxicity": lambda d: toxicity.toxicity(d, _labels(d)),
    "sharding": lambda d: sharding.shard(d),
    "decontam": lambda d: decontam.contamination(d, _items(d)),
    "jaccard": lambda d: jaccard.near_duplicates(d),
    "html": lambda d: html.extract(d, "doc_id", "lang", "text"),
    "pii": lambda d: pii.pii_report(d),
    "lm": lambda d: lm.backoff_scores(d),
}


@pytest.mark.parametrize("name", RUNS)
@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "none"])
def test_one_row_per_document(spark, name, rows):
    docs = store.written(spark.createDataFrame(rows, SCHEMA).repartition(3), "odd")
    found = RUNS[name](docs)
    assert found.count() == len(rows)
    assert len(set(found.columns)) == len(found.columns)


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "none"])
def test_packing_loses_nothing(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = packing.packed(docs, *PATHS).collect()
    assert sum(r["piece"] == 0 for r in found) == len(rows)


@pytest.mark.parametrize("rows", [ODD, []], ids=["odd", "none"])
def test_filters_keep_the_columns(spark, rows):
    docs = store.written(spark.createDataFrame(rows, SCHEMA), "odd")
    for kept in (toxicity.keep_clean(docs, _labels(docs)), jaccard.keep_one(docs), decontam.decontaminate(docs, _items(docs)), pii.redact(docs)):
        assert kept.columns == docs.columns
        assert kept.count() <= len(rows)
