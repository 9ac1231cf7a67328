"""Exact top-k by inner product on a bit-sliced index.

Components become whole numbers floor(256 * x). The index holds, for every block of rows and every dimension,
one bitmap per bit (slice) of the component above the block's least value of it. A query adds up the slices of
its dimensions, each shifted by the signed digits of the query's weight, with bitmap arithmetic (full
adders on whole bitmaps); negative digits use the complement. The sum is a bit-sliced number per row:
from its most significant slice downwards the rows that can still be among the best k are told apart,
and ties at the boundary go to the smaller vec_id. Blocks propose their best k of each query; the best k
of those are the result.

Nulls and empties: rows with a null vec_id, a null vector, or a null or non-finite component take no part, nor do
empty vectors. Vectors meet only vectors of their own length. Rows that repeat a vec_id are rows of their
own; rows with the query's vec_id are never its answers. Components of any finite size take part: sums are exact whole
numbers of any length, and only an answer whose score does not fit into a long ends the query. Extra columns are not read.

Queries are taken in slices of a bounded size, each broadcast to one pass over the index, of which no block is shuffled more
than once a slice; where there are fewer blocks than cores, several tasks share a block and answer different queries.
"""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revenue_lens.llm.catalog import query, table
from revenue_lens.operators.storage import materialize

SCALE = 256.0
TOP = 5
#: A block of the index: long bitmaps, so that each bitmap operation does much work, of bounded memory.
BLOCK_ROWS, BLOCK_VALUES = 32768, 1 << 22
#: Values of the queries that are sent to all tasks at once.
SLICE_VALUES = 1 << 23
#: Whole numbers below this are kept in 64 bits.
SMALL = 2.0**61


def _usable(vectors: DataFrame) -> DataFrame:
    vec = F.col("embedding").cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), vec.alias("vec")).where(F.col("vec_id").isNotNull() & (F.size(vec) > 0) & finite)


def _whole(vector: np.ndarray) -> np.ndarray:
    """floor(256 * x) of each component, as Python integers where 64 bits may not hold them or their differences."""
    scaled = np.floor(SCALE * vector)
    if np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    return np.array([int(v) for v in scaled.tolist()], object)


def _blocks_of(rows: int, pack, names: list[str]):
    """A mapInArrow function: vectors of one length, ``rows`` at a time (fewer if they are long), through
    ``pack(ids, values)``."""

    def run(batches):
        waiting: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for key, vec in zip(batch["vec_id"].to_pylist(), batch["vec"]):
                x = vec.values.to_numpy()
                ids, vectors = waiting.setdefault(len(x), ([], []))
                ids.append(key)
                vectors.append(_whole(x))
                if len(ids) >= min(rows, max(64, BLOCK_VALUES // len(x))):
                    yield _row(pack(np.array(ids, np.int64), np.array(vectors)), names)
                    del waiting[len(x)]
        for ids, vectors in waiting.values():
            yield _row(pack(np.array(ids, np.int64), np.array(vectors)), names)

    return run


def _row(values: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], names)


def _sliced(ids: np.ndarray, values: np.ndarray) -> list:
    """Slices of a block: rows in the order of their ids, (dimension, bit, bitmap)."""
    order = np.argsort(ids, kind="stable")
    ids, values = ids[order], values[order]
    low = values.min(axis=0)
    above = values - low
    bits = max(1, int(above.max()).bit_length())
    width = -(-len(ids) // 64) * 64
    padded = np.zeros((width, values.shape[1]), above.dtype)
    padded[: len(ids)] = above
    slices = np.stack([np.packbits(((padded.T >> b) & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(bits)], axis=1)
    return [values.shape[1], bits, ids.tobytes(), json.dumps([int(v) for v in low]), slices.tobytes()]


def index(vectors: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """A stored row per block of ``vectors(vec_id, embedding)``: dims, bits, ids, lows, slices. Rows are dealt
    evenly, so that bitmaps are long however small the files are."""
    names = ["dims", "bits", "ids", "lows", "slices"]
    usable = materialize(_usable(vectors))
    room = F.least(F.lit(rows), F.greatest(F.lit(64), F.floor(BLOCK_VALUES / F.size("vec"))))
    blocks = usable.agg(F.coalesce(F.sum(1 / room), F.lit(0.0))).first()[0]
    parts = max(1, math.ceil(blocks * 20 / 19))
    return materialize(usable.repartition(parts).mapInArrow(_blocks_of(rows, _sliced, names), "dims bigint, bits bigint, ids binary, lows string, slices binary"))


def _add(total: list, slices: list, shift: int) -> None:
    """total += slices << shift, slice by slice; None is a slice of zeros."""
    carry, k = None, shift
    while k < shift + len(slices) or carry is not None:
        while len(total) <= k:
            total.append(None)
        t, s = total[k], slices[k - shift] if k < shift + len(slices) else None
        operands = [x for x in (t, s, carry) if x is not None]
        if len(operands) == 3:
            half = t ^ s
            total[k], carry = half ^ carry, (t & s) | (half & carry)
        elif len(operands) == 2:
            total[k], carry = operands[0] ^ operands[1], operands[0] & operands[1]
        else:
            total[k], carry = operands[0] if operands else None, None
        if carry is not None and not carry.any():
            carry = None
        k += 1


def weighted_sum(weights: list[int], slices: np.ndarray) -> tuple[list, int]:
    """Slices of the sum of w * u up to a constant, and that constant; (dimension, bit, words). Weights are taken in
    signed digits, no two neighbours of which are set: a digit of -1 adds the complement, -u = (top - u) - top."""
    total: list = []
    constant, top = 0, (1 << slices.shape[1]) - 1
    inverse = ~slices
    for w, plain, flipped in zip(weights, slices, inverse):
        bit = 0
        while w:
            if w & 1:
                digit = 2 - (w & 3)
                _add(total, list(plain if digit > 0 else flipped), bit)
                constant -= top << bit if digit < 0 else 0
                w -= digit
            w >>= 1
            bit += 1
    return total, constant


def best_rows(total: list, allowed: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k rows of the largest sums among the ``allowed`` bits; ties to smaller numbers."""
    sure, maybe, missing = np.zeros_like(allowed), allowed.copy(), k
    for s in reversed(total):
        if s is None:
            continue
        ones = maybe & s
        count = int(np.bitwise_count(ones).sum())
        if count >= missing:  # the last places are among those with a one
            maybe = ones
        else:
            sure, maybe, missing = sure | ones, maybe & ~s, missing - count
    number = lambda m: np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little"))
    return np.concatenate([number(sure), number(maybe)[:missing]])


def _search(block: dict, queries: list[tuple[int, list[int]]], k: int) -> list[tuple[int, int, int]]:
    ids = np.frombuffer(block["ids"], np.int64)
    dims, bits = block["dims"], block["bits"]
    slices = np.frombuffer(block["slices"], np.uint8).reshape(dims, bits, -1).view(np.uint64)
    lows = json.loads(block["lows"])
    every = np.packbits(np.arange(slices.shape[2] * 64) < len(ids), bitorder="little").view(np.uint64)
    found = []
    for key, weights in queries:
        own = slice(np.searchsorted(ids, key), np.searchsorted(ids, key, side="right"))
        allowed = every
        if own.stop > own.start:
            flags = np.arange(slices.shape[2] * 64)
            allowed = every & ~np.packbits((flags >= own.start) & (flags < own.stop), bitorder="little").view(np.uint64)
        total, constant = weighted_sum(weights, slices)
        constant += sum(w * low for w, low in zip(weights, lows))
        for r in best_rows(total, allowed, k).tolist():
            word, bit = divmod(r, 64)
            value = constant + sum(1 << p for p, s in enumerate(total) if s is not None and int(s[word]) >> bit & 1)
            if not -(2**63) <= value < 2**63:
                raise OverflowError(f"the score of {key} and {int(ids[r])} does not fit into a long")
            found.append((key, int(ids[r]), value))
    return found


def top_k(blocks: DataFrame, queries: DataFrame, k: int = TOP, slice_values: int = SLICE_VALUES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of the index ``blocks`` for ``queries(vec_id, embedding)``."""
    context = blocks.sparkSession.sparkContext
    usable = materialize(_usable(queries))
    values = usable.agg(F.sum(F.size("vec"))).first()[0] or 0
    slices = max(1, -(-values // slice_values))
    shares = max(1, -(-2 * context.defaultParallelism // max(1, blocks.count())))
    cells = blocks.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def answers(asked):
        def run(batches):
            for batch in batches:
                for r in range(batch.num_rows):
                    row = {c: batch[c][r].as_py() for c in batch.schema.names}
                    found = _search(row, asked.value.get(row["dims"], [])[row["share"] :: shares], k)
                    yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in found], pa.int64()) for j in range(3)], ["query_id", "vec_id", "score"])

        return run

    proposed = None
    for number in range(slices):
        part = usable.where(F.pmod(F.xxhash64("vec_id", F.lit("slice")), F.lit(slices)) == number).toArrow()  # of bounded size
        by_length: dict[int, list] = {}
        for key, vec in zip(part["vec_id"].to_pylist(), part["vec"]):
            weights = _whole(vec.values.to_numpy()).tolist()
            by_length.setdefault(len(weights), []).append((key, weights))
        asked = context.broadcast(by_length)
        dealt = cells.repartition(2 * context.defaultParallelism, F.xxhash64("ids", "dims"), "share") if shares > 1 else cells
        found = dealt.mapInArrow(answers(asked), "query_id bigint, vec_id bigint, score bigint")
        found = materialize(found) if slices > 1 else found  # a slice's queries leave the workers before the next
        proposed = found if proposed is None else proposed.unionByName(found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return proposed.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0
), s AS (
    SELECT a.vec_id AS query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op2_bit_sliced", _SQL)
def op2_bit_sliced(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(index(vectors), vectors.where(F.col("vec_id") % 50 == 0))
