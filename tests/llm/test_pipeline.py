"""Stages of the pipeline on a small folder of tables."""

import random

import pytest
from llm_helpers import components, make_docs  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline as pipeline

WORDS = [f"w{i}" for i in range(500)]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture()
def folder(spark, make_docs, tmp_path):
    item, passage = prose(9000, 40), "\n".join(prose(9100 + k, 20) for k in range(3))
    rows = [(i, prose(i, 60) + (" vileword" if i % 5 == 0 else ""), "en", f"s{i % 3}") for i in range(200)]
    rows += [(300, prose(1, 60), "en", "s0"), (301, prose(2, 59), "en", "s0"), (302, f"{prose(7, 30)} {item}", "en", "s1")]
    rows += [(310, f"{passage}\n{prose(50, 40)}", "en", "s1"), (311, f"{passage}\n{prose(51, 40)}", "en", "s1"), (312, passage, "en", None), (320, None), (321, "")]
    make_docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(150)], "doc_id bigint, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in pipeline.STAGES:
        before = docs
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()} if name != "source_mix" else None
        if name != "source_mix":
            assert docs.columns == columns
        if name == "near_duplicates":
            want = components([(r["doc_id"], r["text"]) for r in before.collect()])
            assert set(kept[name]) == {i for i, (_, root) in want.items() if root == i}
    toxic = {i for i in range(200) if i % 5 == 0}
    assert not toxic & set(kept["toxicity"]) and len(kept["toxicity"]) == 208 - len(toxic)
    assert 312 not in kept["line_dedup"] and kept["line_dedup"][311] == prose(51, 40) and kept["line_dedup"][320] is None
    assert {300, 301} & set(kept["near_duplicates"]) == set()
    assert set(kept["near_duplicates"]) - set(kept["decontamination"]) == {302}
    assert docs.groupBy("doc_id", "copy", "block").count().where(F.col("count") > 1).count() == 0


def test_unlike_texts_of_one_doc_id_are_judged_by_themselves(spark, make_docs):
    rows = [(1, prose(1, 60)), (5, prose(1, 59)), (5, prose(2, 60)), (7, prose(2, 59)), (7, prose(3, 60)), (7, prose(3, 60)), (8, None), (8, ""), (9, prose(4, 60), "en", "z"), (9, prose(4, 60), "en", "b"), (None, prose(1, 60))]
    left = pipeline.drop_near_duplicates(spark, make_docs(rows), "")
    want = [(1, rows[0][1], "a"), (5, rows[2][1], "a"), (7, rows[4][1], "a"), (8, None, "a"), (8, "", "a"), (9, rows[8][1], "b"), (None, rows[0][1], "a")]
    assert sorted(map(repr, ((r["doc_id"], r["text"], r["source"]) for r in left.collect()))) == sorted(map(repr, want))
