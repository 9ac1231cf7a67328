"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Texts become sets of hashed character n-grams (lower case, runs of white space as one space, a
space at both ends). The classifier is fitted on a bounded sample of labelled rows: per n-gram
the log ratio of its smoothed frequencies in toxic and other texts, then logistic regression on
these ratios. Scoring adds up one number per distinct n-gram of the whole text.

Nulls and empties: a null text counts as empty; an empty text gets the score of no n-grams at all.
Rows without a doc_id are scored and never learnt from. A document labelled more than once is
toxic if any label says so; null labels teach nothing. Without labels of both kinds every
score is the share of toxic labels (0 without labels). Repeated rows are scored alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revenue_lens.llm.catalog import id_remainder, query, table
from revenue_lens.operators.storage import materialize

#: Rows of each class (0, 1) to learn from, those with the smallest hashes of doc_id.
SAMPLE_PER_CLASS = (4000, 2000)
THRESHOLD = 0.3
SIZES = (4, 5)
BITS = 20
#: Added to every count of rows; a ratio counts from so many standard deviations.
SMOOTHING, DEVIATIONS = 1.0, 3.0


@dataclass
class ToxicityModel:
    weights: np.ndarray  # of each n-gram, already times its log-count ratio
    intercept: float


def _ngrams(text: str | None) -> np.ndarray:
    """Distinct hashed n-grams of a text."""
    codes = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    parts = []
    for n in SIZES:
        count = len(codes) - n + 1
        if count > 0:
            h = np.full(count, n, np.uint32)
            for i in range(n):
                h = (h ^ codes[i : i + count]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA6B)
            parts.append(h >> np.uint32(32 - BITS))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


def _feature_batches(batches):
    for batch in batches:
        found = [np.unique(_ngrams(t)).tobytes() for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array(found, pa.binary())], ["toxic", "features"])


def _count_batches(batches):
    """(id, toxic, other): how many rows of each kind hold an n-gram, over the rows of one task."""
    counts = np.zeros((2, 2**BITS), np.int32)
    for batch in batches:
        for toxic, features in zip(batch["toxic"].to_pylist(), batch["features"].to_pylist()):
            counts[toxic, np.frombuffer(features, np.uint32)] += 1  # no id twice in a text
    ids = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (ids, counts[1, ids], counts[0, ids])], ["id", "toxic", "other"])


def fit(docs: DataFrame, labels: DataFrame, sample_per_class: tuple[int, int] = SAMPLE_PER_CLASS) -> ToxicityModel:
    """Learn from rows of ``docs`` that ``labels(doc_id, toxic)`` covers, at most ``sample_per_class`` of each
    class. Equal texts in the sample count once. The log-count ratios are computed where the rows are; only
    the n-grams whose ratio differs from 0 by more than chance come to the driver."""
    marked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    marked = marked.join(docs.select("doc_id").where("doc_id IS NOT NULL").distinct(), "doc_id", "left_semi")
    totals = {r["toxic"]: r["n"] for r in marked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    if len(totals) < 2:
        return ToxicityModel(np.zeros(2**BITS, np.float32), _logit(prior))
    picked = None
    for k in (0, 1):
        some = marked.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_per_class[k])
        picked = some if picked is None else picked.unionByName(some)
    # The sample's ids are at most sum(sample_per_class) rows.
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id").groupBy(F.xxhash64("text")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    features = materialize(sample.select("toxic", "text").mapInArrow(_feature_batches, "toxic int, features binary"))
    sizes = {r["toxic"]: r["n"] for r in features.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return ToxicityModel(np.zeros(2**BITS, np.float32), _logit(prior))
    counts = features.mapInArrow(_count_batches, "id bigint, toxic bigint, other bigint").groupBy("id").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    share = lambda c, n: (F.col(c) + SMOOTHING) / (n + 2 * SMOOTHING)
    ratio = F.log(share("toxic", sizes[1])) - F.log(share("other", sizes[0]))
    # A ratio within chance of 0 is noise, of which long texts have a lot.
    chance = DEVIATIONS * F.sqrt(1 / (F.col("toxic") + SMOOTHING) + 1 / (F.col("other") + SMOOTHING))
    kept = counts.select("id", ratio.alias("ratio"), chance.alias("chance")).where("abs(ratio) >= chance").collect()  # at most 2^20 numbers
    ratios = np.zeros(2**BITS)
    ratios[[r["id"] for r in kept]] = [r["ratio"] for r in kept]
    used = docs.sparkSession.sparkContext.broadcast(ratios != 0)

    def telling(batches):
        for batch in batches:
            left = [np.frombuffer(f, np.uint32) for f in batch["features"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["toxic"], pa.array([ids[used.value[ids]].tobytes() for ids in left], pa.binary())], ["toxic", "features"])

    rows = features.mapInArrow(telling, "toxic int, features binary").collect()
    rows = sorted((r["toxic"], bytes(r["features"])) for r in rows)
    return _fit_sample([np.frombuffer(f, np.uint32) for _, f in rows], np.array([toxic for toxic, _ in rows], np.float64), ratios, prior)


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return float(np.log(p / (1 - p)))


def _fit_sample(features: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, prior: float, passes: int = 100, ridge: float = 1.0) -> ToxicityModel:
    size = 2**BITS
    rows = np.repeat(np.arange(len(y)), [len(ids) for ids in features])
    ids = np.concatenate(features)
    columns, at = np.unique(ids, return_inverse=True)
    x = ratio[columns][at]
    counts = len(y)
    w, b = np.zeros(len(columns)), 0.0
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for step in range(1, passes + 1):  # Adam on the whole sample
        z = np.bincount(rows, weights=x * w[at], minlength=counts) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / counts
        gw = np.bincount(at, weights=x * error[rows], minlength=len(columns)) + ridge * w / counts
        gb = error.sum()
        mw, vw, mb, vb = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        rate, c1, c2 = 0.03, 1 - 0.9**step, 1 - 0.999**step
        w -= rate * (mw / c1) / (np.sqrt(vw / c2) + 1e-9)
        b -= rate * (mb / c1) / (np.sqrt(vb / c2) + 1e-9)
    weights = np.zeros(size, np.float32)
    weights[columns] = w * ratio[columns]
    # The sample holds more toxic rows than the labels do: shift back to their share.
    return ToxicityModel(weights, float(b + _logit(prior) - _logit(y.mean())))


def score_of(spark: SparkSession, model: ToxicityModel, text: Column) -> Column:
    """Score of a text column. The broadcast model has a fixed size of 4 MB."""
    shared = spark.sparkContext.broadcast(model)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weights, intercept = shared.value.weights, shared.value.intercept
        stamp = np.zeros(len(weights), np.int64)
        for column in columns:
            scores = []
            for t in column.to_pylist():
                ids = _ngrams(t)
                at = np.arange(len(ids))
                stamp[ids] = at  # the last of equal n-grams counts
                z = intercept + float(weights[ids[stamp[ids] == at]].sum(dtype=np.float64))
                scores.append(float(1 / (1 + np.exp(-np.clip(z, -40, 40)))))
            yield pa.array(scores, pa.float64())

    return F.arrow_udf(run, "double")(text.cast("string"))


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = id_remainder(F.col("doc_id"), 4)
    model = fit(docs.where(remainder != 2), table(spark, sf_dir, "labels").where(remainder != 2))
    return docs.select("doc_id", score_of(spark, model, F.col("text")).alias("score")).select(
        "doc_id",
        F.coalesce(remainder == 2, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
    )
