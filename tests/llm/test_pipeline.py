"""The pipeline's stages on small tables, and the registered queries."""

import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from featurelens.llm import queries


def test_all_queries_are_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.queries()) | {"pipeline"} <= names and set(queries.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_runs(spark, sf_tiny, name):
    assert E.queries()[name](spark, sf_tiny).count() >= 0


def test_stages_keep_columns_and_chain(spark, sf_tiny):
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    seen = docs.count()
    for k, (_, fn) in enumerate(C.STAGES):
        out = fn(spark, docs, sf_tiny)
        if k < len(C.STAGES) - 1:
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        assert docs.count() <= seen
        seen = docs.count()
    assert seen > 0


def test_stages_take_odd_rows(spark, sf_tiny):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "a b c", "en", "s", 5), (2, "", "en", "s", 0),
                                 (2, "", "en", "s", 0), (3, "word " * 30_000, "en", "s", 1)], schema)
    for _, fn in C.STAGES:
        fn(spark, odd, sf_tiny).collect()
        assert fn(spark, odd.limit(0), sf_tiny).count() == 0


def test_near_duplicates_leave_one(spark, sf_tiny):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(5, text, "en", "s", 1), (7, text + " more", "en", "s", 1), (9, "other words " * 20, "en", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id for r in C.join_ngrams(spark, df, sf_tiny).collect()} == {5, 9}
