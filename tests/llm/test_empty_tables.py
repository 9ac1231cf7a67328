"""Every query of this folder over tables without rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from revenue_lens.llm.queries import QUERIES

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality bigint, toxic bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for name, schema in SCHEMAS.items():
        spark.createDataFrame([], schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, empty_dir, name):
    rows = QUERIES[name](spark, empty_dir).collect()
    # One conversation is the query's own.
    assert [r["conv_id"] for r in rows] == [-1] if name.startswith("op3_") else rows == []


def test_pipeline(spark, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).select(F.count("*")).first()[0] == 0
