"""Ranked lexical search: best-first document intervals bounded by range-maximum sparse tables.

One pass over the texts counts terms and stores, for blocks of documents in the order of doc_id, the postings of the terms
that any item asks for. Statistics (documents, length, document frequencies) are sums over these blocks. A search
task reads block by block: it turns each posting into its impact (the integer score of that term in that
document), lays a sparse table of range maxima over every posting list, and searches each item best first. A
frontier interval of documents is bounded by the sum, over the item's terms, of the largest impact of its
postings there. The interval with the largest bound is split at the document of its largest single impact: that document
is scored in full, the parts left and right of it get bounds of their own. The search ends when no bound beats the worst of the
documents found, which a task carries on from block to block; equal scores prefer the smaller doc_id, so an
interval of copies is left as soon as its first document cannot enter. Nothing is dropped before its bound says so.

Intervals are split in batches, so that bounds are computed in numpy. Blocks have a bounded number of documents;
items are taken in slices of a bounded size, one pass over the documents for each.

Nulls and empties: a null or empty text has no terms, counts nowhere and is never found; an item without terms has no
results. A document without a doc_id is ranked like others, after those of equal score that have one. Rows that
repeat a doc_id are documents of their own, items that repeat an item_id items of their own. A long text is split into
terms as a whole. An empty table gives no rows. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from revenue_lens.llm.catalog import query, table
from revenue_lens.llm.text import byte_texts
from revenue_lens.operators.storage import materialize

BEST = 20
#: Documents and postings of a block at most (a document's postings stay together).
BLOCK_DOCS, BLOCK_POSTINGS = 1 << 15, 1 << 21
#: Text of the items that one pass over the documents looks for.
SLICE_BYTES = 4 << 20
#: Intervals split at once.
BATCH = 64
#: Fixed values of the score: scale of weights, scale of impacts, saturation, parts of the length norm in percent.
WEIGHT_SCALE, IMPACT_SCALE, SATURATION, LENGTH_SHARE = 1000, 1_000_000_000, 12, 25

# Letters and digits of ASCII in lower case, all other ASCII as a space; bytes of longer characters stay.
_TERM_BYTES = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else 32 if b < 128 else b for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text."""
    return text.translate(_TERM_BYTES).split() if text else []


# --- index ----------------------------------------------------------------------------

_SEGMENT = "docs bigint, length bigint, ids binary, missing binary, lengths binary, starts binary, terms binary, counts binary"


class _Block:
    """Collects the postings of documents up to the bounds of a block."""

    def __init__(self):
        self.docs = self.length = self.postings = 0
        self.ids, self.lengths, self.rows = [], [], []

    def add(self, doc_id, text: bytes, wanted: dict) -> None:
        found = terms(text)
        if not found:
            return
        self.docs += 1
        self.length += len(found)
        counts = Counter(map(wanted.get, found))
        counts.pop(None, None)
        if counts:
            self.ids.append(doc_id)
            self.lengths.append(len(found))
            self.rows.append((np.fromiter(counts.keys(), np.int32, len(counts)), np.fromiter(counts.values(), np.int64, len(counts))))
            self.postings += len(counts)

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.postings >= BLOCK_POSTINGS

    def segment(self) -> pa.RecordBatch:
        """Documents with postings, ascending by doc_id (missing ones last); postings by document."""
        order = sorted(range(len(self.ids)), key=lambda k: (self.ids[k] is None, self.ids[k] or 0))
        ids = np.array([self.ids[k] or 0 for k in order], np.int64)
        missing = np.array([self.ids[k] is None for k in order], bool)
        starts = np.zeros(len(order) + 1, np.int64)
        np.cumsum([len(self.rows[k][0]) for k in order], out=starts[1:])
        found = np.concatenate([np.empty(0, np.int32), *[self.rows[k][0] for k in order]])
        counts = np.concatenate([np.empty(0, np.int64), *[self.rows[k][1] for k in order]])
        parts = [ids, missing, np.array([self.lengths[k] for k in order], np.int64), starts, found, counts]
        columns = [pa.array([self.docs], pa.int64()), pa.array([self.length], pa.int64()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _SEGMENT.split(", ")])


def indexed(docs: DataFrame, numbers) -> DataFrame:
    """Segments of ``docs(doc_id, text)`` for the terms of the broadcast ``numbers``, {term: number}."""

    def run(batches):
        block, wanted = _Block(), numbers.value
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), byte_texts(batch["text"])):
                block.add(doc_id, text, wanted)
                if block.full():
                    yield block.segment()
                    block = _Block()
        if block.docs:
            yield block.segment()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _SEGMENT)


def _document_frequencies(segments: DataFrame, n: int) -> np.ndarray:
    """In how many documents each of ``n`` terms occurs."""

    def run(batches):
        total = np.zeros(n, np.int64)
        for batch in batches:
            for found in batch["terms"]:
                total += np.bincount(np.frombuffer(found.as_buffer(), np.int32), minlength=n)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "df"])

    sums = segments.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(n, np.int64)
    df[sums["term"].to_numpy()] = sums["df"].to_numpy()
    return df


# --- search ---------------------------------------------------------------------------


@dataclass
class Items:
    """Items of a slice: their row numbers, their terms and how often each occurs; and the terms' weights."""

    rows: list[int]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    weights: np.ndarray | None = None
    documents: int = 0
    length: int = 0


def length_norms(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Each document's length norm; exact where the product leaves 64 bits."""
    if len(lengths) and int(lengths.max()) * documents * LENGTH_SHARE >= 2**63:
        share = [int(n) * documents * LENGTH_SHARE // total for n in lengths]
        return 100 - LENGTH_SHARE + np.array(share, np.int64)
    return 100 - LENGTH_SHARE + LENGTH_SHARE * lengths * documents // total


class SparseTables:
    """Range maxima over the impacts of all posting lists, which lie behind each other."""

    def __init__(self, impacts: np.ndarray, longest: int):
        n = len(impacts)
        self.impacts = impacts
        # Level k, of the same length as the first, holds the leftmost place of the maximum of 2**k impacts.
        self.flat = np.zeros(max(longest, 1).bit_length() * n, np.int32)
        self.flat[:n] = np.arange(n, dtype=np.int32)
        for k in range(1, max(longest, 1).bit_length()):
            width, last = 1 << (k - 1), self.flat[(k - 1) * n : k * n]
            left, right = last[: n - 2 * width + 1], last[width : n - width + 1]
            self.flat[k * n : (k + 1) * n - 2 * width + 1] = np.where(impacts[right] > impacts[left], right, left)

    def argmax(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Leftmost place of the largest impact in each [low, high), which hold something."""
        level = (np.frexp((high - low).astype(np.float64))[1] - 1).astype(np.int64)
        base = level * len(self.impacts)
        left, right = self.flat[base + low], self.flat[base + high - (1 << level)]
        return np.where(self.impacts[right] > self.impacts[left], right, left)


class BlockSearch:
    """One block: posting lists by term, impacts, sparse tables."""

    def __init__(self, segment: dict, items: Items):
        of = lambda name, kind: np.frombuffer(segment[name], kind)
        self.ids, self.missing = of("ids", np.int64), of("missing", bool)
        starts, found, counts = of("starts", np.int64), of("terms", np.int32), of("counts", np.int64)
        self.docs = len(self.ids)
        doc = np.repeat(np.arange(self.docs), np.diff(starts))
        norms = length_norms(of("lengths", np.int64), items.documents, items.length)
        impacts = items.weights[found] * (IMPACT_SCALE * counts // (WEIGHT_SCALE * counts + SATURATION * norms[doc]))
        order = np.argsort(found, kind="stable")
        doc, impacts = doc[order], impacts[order]
        self.doc, self.impacts = doc, impacts
        sizes = np.bincount(found, minlength=len(items.weights))
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        # (term, document) as one ascending key.
        self.keys = found[order].astype(np.int64) * self.docs + doc
        self.tables = SparseTables(impacts, int(sizes.max(initial=0)))

    def _bounds(self, low: np.ndarray, high: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound of each interval (row) and the document to split it at."""
        held = high > low
        places = self.tables.argmax(np.where(held, low, 0), np.where(held, high, 1))
        most = np.where(held, self.impacts[places], 0)
        rows = np.arange(len(low))
        best = most.argmax(axis=1)
        return (most * repeats).sum(axis=1), self.doc[places[rows, best]]

    def search(self, item_terms: np.ndarray, repeats: np.ndarray, best: Best) -> None:
        """Offer the documents of this block that can be among the best."""
        held = self.first[item_terms + 1] > self.first[item_terms]
        item_terms, repeats = item_terms[held], repeats[held]
        if not len(item_terms):
            return
        base = item_terms.astype(np.int64) * self.docs
        low, high = self.first[item_terms][None, :], self.first[item_terms + 1][None, :]
        bound, at = self._bounds(low, high, repeats)
        start = np.zeros(1, np.int64)  # first document of each interval
        while True:
            open_ = bound > 0
            if best.full():
                score, doc_key = best.worst()
                first_key = self._keys(start)
                open_ &= (bound > score) | ((bound == score) & (first_key < doc_key))
            if not open_.any():
                return
            if not open_.all():
                low, high, bound, at, start = low[open_], high[open_], bound[open_], at[open_], start[open_]
            if len(bound) > BATCH:  # the best bounds; of equal ones the first documents
                order = np.lexsort((start, -bound))
                now, later = order[:BATCH], order[BATCH:]
            else:
                now, later = np.arange(len(bound)), np.empty(0, np.int64)
            split = at[now]
            place = np.searchsorted(self.keys, base[None, :] + split[:, None])
            hit = place < high[now]
            hit &= self.doc[np.minimum(place, len(self.doc) - 1)] == split[:, None]
            score = (np.where(hit, self.impacts[np.minimum(place, len(self.doc) - 1)], 0) * repeats).sum(axis=1)
            best.offer(score, self.ids[split], self.missing[split])
            child_low = np.concatenate([low[now], place + hit])
            child_high = np.concatenate([place, high[now]])
            child_bound, child_at = self._bounds(child_low, child_high, repeats)
            child_start = np.concatenate([start[now], split + 1])
            low, high = np.concatenate([low[later], child_low]), np.concatenate([high[later], child_high])
            bound, at, start = np.concatenate([bound[later], child_bound]), np.concatenate([at[later], child_at]), np.concatenate([start[later], child_start])

    def _keys(self, documents: np.ndarray) -> np.ndarray:
        at = np.minimum(documents, self.docs - 1)
        return doc_keys(self.ids[at], self.missing[at])


def doc_keys(ids: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """Order of documents of equal score: by id, those without one last."""
    return np.where(missing, np.inf, ids.astype(np.longdouble))


class Best:
    """The best documents so far, by score and then doc_id."""

    def __init__(self, size: int):
        self.size = size
        self.scores, self.ids, self.missing = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def full(self) -> bool:
        return len(self.scores) == self.size

    def worst(self) -> tuple[int, float]:
        return self.scores[-1], doc_keys(self.ids[-1:], self.missing[-1:])[0]

    def offer(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        new = scores > 0
        if self.full():
            new &= scores >= self.scores[-1]
        if not new.any():
            return
        scores, ids, missing = np.concatenate([self.scores, scores[new]]), np.concatenate([self.ids, ids[new]]), np.concatenate([self.missing, missing[new]])
        order = np.lexsort((ids, missing, -scores))[: self.size]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


def _found(segments: DataFrame, items, size: int) -> DataFrame:
    """(item, score, doc_id) of the best of each task."""
    names = [f.split()[0] for f in _SEGMENT.split(", ")][2:]

    def run(batches: Iterator[pa.RecordBatch]):
        asked = items.value
        best = [Best(size) for _ in asked.rows]
        for batch in batches:
            for k in range(batch.num_rows):
                if len(batch["ids"][k].as_buffer() or b""):
                    block = BlockSearch({n: batch[n][k].as_buffer() for n in names}, asked)
                    for terms_, repeats, found in zip(asked.terms, asked.repeats, best):
                        block.search(terms_, repeats, found)
        for row, found in zip(asked.rows, best):
            if len(found.scores):
                ids = pa.array(found.ids, mask=found.missing)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found.scores), row, np.int64)), pa.array(found.scores), ids], ["item", "score", "doc_id"])

    return segments.mapInArrow(run, "item bigint, score bigint, doc_id bigint")


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(WEIGHT_SCALE * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


def ranked(docs: DataFrame, items: DataFrame, best: int = BEST, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` rows of ``docs(doc_id, text)`` for each row of ``items(item_id, text)``."""
    spark = docs.sparkSession
    own = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    own = materialize(own)
    size = own.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    slices = max(1, -(-size // slice_bytes))
    found = None
    for k in range(slices):
        part = own.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == k)
        one = _ranked_slice(spark, docs, part, best)
        if one is not None:
            found = one if found is None else found.unionByName(one)
    if found is None:
        return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    top = found.withColumn("rank", place).where(F.col("rank") <= best)
    return top.join(own.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _ranked_slice(spark: SparkSession, docs: DataFrame, part: DataFrame, best: int) -> DataFrame | None:
    # A slice of the items, of a bounded size.
    numbers: dict[bytes, int] = {}
    asked = Items([], [], [])
    for r in part.where("text IS NOT NULL").select("item", "text").collect():
        counts = Counter(terms(r["text"].encode("utf-8", "surrogatepass")))
        if counts:
            asked.rows.append(r["item"])
            asked.terms.append(np.array([numbers.setdefault(t, len(numbers)) for t in counts], np.int64))
            asked.repeats.append(np.array(list(counts.values()), np.int64))
    if not numbers:
        return None
    segments = materialize(indexed(docs, spark.sparkContext.broadcast(numbers)))
    sums = segments.agg(F.sum("docs").alias("docs"), F.sum("length").alias("length")).first()
    if not sums["docs"]:
        return None
    asked.documents, asked.length = sums["docs"], sums["length"]
    asked.weights = weights(_document_frequencies(segments, len(numbers)), asked.documents)
    # Blocks are dealt anew, as few tasks may have read large files.
    blocks = segments.drop("docs", "length").withColumn("docs", F.lit(0)).withColumn("length", F.lit(0))
    dealt = blocks.repartition(F.xxhash64("ids"))
    return materialize(_found(dealt, spark.sparkContext.broadcast(asked), best))


_SQL = r"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY doc_id, term),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
al AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS total FROM n),
m AS (SELECT doc_id, 100 - 25 + ((25 * n * n_docs) // total) AS m FROM n, al),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, al GROUP BY term, n_docs),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 20
"""


@query("op13_ranked_search", _SQL)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
