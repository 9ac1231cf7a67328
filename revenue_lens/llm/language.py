"""Language identification: averaged embeddings of hashed subwords under a linear softmax.

A text is its character 2- to 4-grams (lower case, everything but letters and marks as one space), hashed to
16,384 buckets. A bucket has an embedding of 16 numbers; the mean over the text goes through a
linear layer and a softmax. Both are trained together by stochastic gradient descent in numpy, on a
bounded sample of every language. A held-back fifth of the sample sets the temperature that makes the
probabilities honest, and the least probability from which predictions are accepted: the lowest at which at
least 99 % of what is accepted is right.

Nulls and empties: a null text or one without a letter is ``und`` with score 0, as is every text when
nothing could be learnt; neither is accepted. Null languages and rows without a doc_id teach nothing.
Repeated rows are scored alike, and equal texts of the sample count once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revenue_lens.llm.catalog import id_remainder, query, table
from revenue_lens.operators.storage import materialize

#: Rows of each language to learn from: those with the smallest hashes of doc_id.
ROWS_PER_LANGUAGE = 1500
#: Rows of all languages: the more languages, the fewer rows of each, but one at least.
ROWS_IN_ALL = 300000
#: First bits of the hash by which rows are counted before they are ranked.
PART_BITS = 12
BITS, WIDTH = 14, 16
SIZES = (2, 3, 4)
UNKNOWN = "und"
PRECISION = 0.99


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # logits that each bucket adds: embeddings times the linear layer
    bias: np.ndarray
    temperature: float
    threshold: float


def letters(text: str | None) -> str:
    """Lower-case letters and marks, runs of anything else as a space; empty without a letter."""
    if not text:
        return ""
    kept = "".join(c if c.isalpha() else " " for c in text.lower()) if not text.isascii() else text.lower().translate(_ASCII)
    return " ".join(kept.split())


_ASCII = {i: 32 for i in range(128) if not chr(i).isalpha()}


def buckets(clean: str) -> np.ndarray:
    """Bucket of every n-gram of a cleaned text, with repeats."""
    codes = np.frombuffer(f" {clean} ".encode("utf-32-le", "surrogatepass"), np.uint32)
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
    return np.concatenate(parts)


def _count_batches(batches):
    for batch in batches:
        ids, counts = [], []
        for text in batch["text"].to_pylist():
            clean = letters(text)
            k, c = np.unique(buckets(clean), return_counts=True) if clean else (np.empty(0, np.uint32), np.empty(0, np.int64))
            ids.append(k.astype(np.uint16).tobytes())
            counts.append(c.astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(ids, pa.binary()), pa.array(counts, pa.binary())], ["lang", "ids", "counts"])


def _picked(marked: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows of each language of ``marked(doc_id, lang)`` with the smallest hashes. Counts by the first bits of the
    hash tell which rows can be among them; only those are ranked, so that no task has all rows of a language."""
    part = F.shiftright(F.xxhash64("doc_id"), 64 - PART_BITS)
    counts = marked.groupBy("lang", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("part")) - F.col("n")
    last = counts.withColumn("before", before).where(F.col("before") < k).groupBy("lang").agg(F.max("part").alias("last"))
    near = marked.join(F.broadcast(last), "lang").where(part <= F.col("last")).select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    return near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= k).select("doc_id", "lang")


def fit(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, rows_in_all: int = ROWS_IN_ALL) -> LanguageModel:
    """Learn every language of ``docs(doc_id, text, lang)``; the counts of at most ``rows_per_language`` rows of each
    language and ``rows_in_all`` in all (or one of each), 16,384 buckets each at most, come to the driver."""
    marked = docs.where("doc_id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("lang").cast("string").alias("lang"))
    languages = marked.select("lang").distinct().count()
    rows_per_language = max(1, min(rows_per_language, rows_in_all // max(1, languages)))
    picked = _picked(materialize(marked.distinct()), rows_per_language)
    # At most rows_in_all ids, or one of each language.
    sample = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").join(F.broadcast(picked), ["doc_id", "lang"])
    rows = sample.select("lang", "text").mapInArrow(_count_batches, "lang string, ids binary, counts binary").collect()
    distinct = sorted({(r["lang"], bytes(r["ids"]), bytes(r["counts"])) for r in rows if r["ids"]})
    return _fit_sample([x[0] for x in distinct], [(np.frombuffer(i, np.uint16), np.frombuffer(c, np.float32)) for _, i, c in distinct])


def _dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    x = np.zeros((len(rows), 2**BITS), np.float32)
    for k, (ids, counts) in enumerate(rows):
        x[k, ids] = counts / counts.sum()
    return x


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _fit_sample(names: list[str], rows: list, passes: int = 6, batch: int = 64, rate: float = 20.0, seed: int = 0) -> LanguageModel:
    languages = sorted(set(names))
    if not languages:
        return LanguageModel([], np.zeros((2**BITS, 0), np.float32), np.zeros(0, np.float32), 1.0, 1.0)
    rng = np.random.default_rng(seed)
    y = np.array([languages.index(n) for n in names])
    order = rng.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    e = rng.normal(0, 0.1, (2**BITS, WIDTH)).astype(np.float32)
    w = rng.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32)
    b = np.zeros(len(languages), np.float32)
    steps, done = passes * -(-len(used) // batch), 0
    for _ in range(passes):
        used = rng.permutation(used)
        for at in range(0, len(used), batch):
            part = used[at : at + batch]
            x = _dense([rows[k] for k in part])
            h = x @ e
            g = _softmax(h @ w + b)
            g[np.arange(len(part)), y[part]] -= 1
            g /= len(part)
            step = rate * (1 - done / steps)
            grown = g @ w.T
            w -= 0.1 * step * (h.T @ g)
            b -= 0.01 * step * g.sum(axis=0)
            e -= step * (x.T @ grown)
            done += 1
    logits = np.concatenate([_dense([rows[k] for k in held[at : at + 256]]) @ e @ w + b for at in range(0, len(held), 256)]) if len(held) else np.zeros((0, len(languages)))
    temperature, threshold = _calibrated(logits.astype(np.float64), y[held])
    return LanguageModel(languages, (e @ w).astype(np.float32), b, temperature, threshold)


def _calibrated(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Temperature of the least log loss, and the least probability to accept."""
    if not len(y):
        return 1.0, 0.0
    choices = np.geomspace(0.05, 20, 121)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in choices]
    temperature = float(choices[int(np.argmin(loss))])
    p = _softmax(logits / temperature)
    top = p.max(axis=1)
    order = np.argsort(-top, kind="stable")
    right = np.cumsum(p.argmax(axis=1)[order] == y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(right >= PRECISION)
    return temperature, float(top[order[good[-1]]]) if len(good) else 1.0


_RESULT = "struct<lang_pred:string,score:double,accepted:boolean>"


def predicted(spark: SparkSession, model: LanguageModel, text: Column) -> Column:
    """(lang_pred, score, accepted) of a text column. The broadcast model holds 16,384 numbers per language."""
    shared = spark.sparkContext.broadcast(model)

    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for column in columns:
            found, scores, accepted = [], [], []
            for t in column.to_pylist():
                clean = letters(t) if m.languages else ""
                if clean:
                    counts = np.bincount(buckets(clean), minlength=2**BITS).astype(np.float32)
                    p = _softmax(((counts / counts.sum()) @ m.table + m.bias)[None, :].astype(np.float64) / m.temperature)[0]
                    best = int(p.argmax())
                    found.append(m.languages[best])
                    scores.append(float(p[best]))
                    accepted.append(bool(p[best] >= m.threshold))
                else:
                    found.append(UNKNOWN)
                    scores.append(0.0)
                    accepted.append(False)
            yield pa.StructArray.from_arrays([pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())], ["lang_pred", "score", "accepted"])

    return F.arrow_udf(run, _RESULT)(text.cast("string"))


@query("op6_language")
def op6_language(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = id_remainder(F.col("doc_id"), 4)
    model = fit(docs.where(remainder != 2))
    rows = docs.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), predicted(spark, model, F.col("text")).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.accepted")
