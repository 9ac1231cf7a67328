"""From raw documents to a training mix: toxicity, repeated lines, near duplicates, benchmark leaks, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it and hands it to the next.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_lens.llm.benchmark_match import with_matches
from revenue_lens.llm.catalog import table
from revenue_lens.llm.line_windows import emptied, remove_repeated_windows
from revenue_lens.llm.minhash import near_duplicates
from revenue_lens.llm.source_mix import mixed_texts
from revenue_lens.llm.toxicity import THRESHOLD, fit, score_of
from revenue_lens.operators.storage import materialize, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on all labelled ones, does not reject."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(score_of(spark, model, F.col("text")) < THRESHOLD)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of three-line passages; documents that were nothing else go.
    ``n_chars`` follows the text."""
    left = remove_repeated_windows(docs).where(~F.coalesce(emptied(F.col("text"), F.col("n_removed")), F.lit(False)))
    changed = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("row.n_chars"))}
    return left.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One text of each component of near duplicates: that with the smallest doc_id, and of several of that doc_id
    the one with the smallest digest. Of rows that repeat doc_id and text the smallest stays. Rows without a
    doc_id stay."""
    digest = F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit(""))
    ids = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min(digest).alias("low"), F.max(digest).alias("high"))
    again = materialize(ids.where("n > 1").select("doc_id", (F.col("low") != F.col("high")).alias("unlike")))
    if not again.where("unlike").take(1):
        gone = near_duplicates(docs).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
        left = docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")
    else:
        # A number for each doc_id and text, in their order, judged as a document of its own.
        texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("of_doc"), digest.alias("digest")).distinct()
        numbers = materialize(texts.orderBy("of_doc", "digest").withColumn("number", F.monotonically_increasing_id()))
        same = (F.col("doc_id") == F.col("of_doc")) & (digest == F.col("digest"))
        named = docs.join(numbers, same).select(F.col("number").alias("doc_id"), "text")
        gone = near_duplicates(named).where("NOT kept").select(F.col("doc_id").alias("number")).distinct()
        left = docs.join(numbers.join(gone, "number"), same, "left_anti")
    repeats = again.select(F.col("doc_id").alias("again"))
    once = left.join(repeats, F.col("doc_id") == F.col("again"), "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    least = left.join(repeats, F.col("doc_id") == F.col("again"), "left_semi").groupBy("doc_id", digest.alias("digest")).agg(F.min(row).alias("row"))
    return once.unionByName(least.select("row.*"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return with_matches(docs, table(spark, sf_dir, "benchmark")).where(F.size("matches") == 0).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per drawn block of words, shard by shard in its order."""
    return mixed_texts(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("source_mix", mix_sources),
]

#: Classifiers and hashes of other engines cannot be written in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
