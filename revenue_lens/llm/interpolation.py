"""Language-model scores by deleted interpolation of bigrams.

The probability of a token mixes three estimates: how often it followed the word before (maximum
likelihood), how often it occurs at all, and one over the vocabulary with one unknown word. The weights
depend on how often the context occurred, in buckets by powers of two. They are learnt by
expectation-maximisation on tokens that a tenth of the training documents holds back, against
the counts of the other nine; the scores then use the counts of all training documents.

How it runs: texts are packed into blocks of about 8 MB and stored. Every block sends, for each key
range, its distinct word and bigram hashes (64 bits) with their counts, packed; a group per key range adds them up
over the corpus and answers each block with the totals of its own keys, in the order they came. No word,
however frequent, is sent more than once per block, and no table of the vocabulary is gathered
anywhere. The number of key ranges follows the number of tokens.

Nulls and empties: a null text is an empty one, with the end as its only token. Rows without a doc_id
are scored and never learnt from. Repeated rows count as often as they occur. With nothing to learn
from, the mixture keeps its starting weights and every token is unknown.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_lens.llm.catalog import id_remainder, query, table
from revenue_lens.llm.text import WordHashes, byte_texts, mixed, words
from revenue_lens.operators.storage import materialize

BLOCK_BYTES = 8 << 20
#: Keys that one group adds up; its memory is about 60 bytes a key.
KEYS_PER_RANGE = 3_000_000
CONTEXT_BUCKETS = 16
START_WEIGHTS = (0.5, 0.4, 0.1)  # bigram, word, uniform
_END = np.uint64(0x6A09E667F3BCC909)
_BEGIN = np.uint64(0xBB67AE8584CAA73B)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Probabilities are counted in steps of a quarter of a power of two for learning the weights.
_STEPS = 4.0


def _pack(values: np.ndarray) -> bytes:
    """Byte planes, compressed: the high bytes of small numbers cost next to nothing."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T) if len(values) else np.empty(0, np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return _pack(np.diff(keys, prepend=np.uint64(0)))


def _unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def blocks(docs: DataFrame) -> DataFrame:
    """Stored (block, held, tokens, train_tokens, data) from ``docs(doc_id, text, role)``: role 0 is only
    scored, 1 trains, 2 trains and is held back for the weights (in blocks of its own: held)."""

    def run(batches):
        task, made = TaskContext.get().partitionId(), 0
        waiting = {False: [[], [], [], 0], True: [[], [], [], 0]}

        def full(held):
            nonlocal made
            ids, roles, texts, _ = waiting[held]
            counts = [len(words(t)) + 1 for t in texts]
            data = zstandard.ZstdCompressor(level=3).compress(pickle.dumps((ids, roles, texts)))
            row = [pa.array([(task << 32) + made]), pa.array([held]), pa.array([sum(counts)]), pa.array([sum(c for c, r in zip(counts, roles) if r)]), pa.array([data], pa.binary())]
            waiting[held] = [[], [], [], 0]
            made += 1
            return pa.RecordBatch.from_arrays(row, ["block", "held", "tokens", "train_tokens", "data"])

        for batch in batches:
            for key, role, text in zip(batch["doc_id"].to_pylist(), batch["role"].to_pylist(), byte_texts(batch["text"])):
                part = waiting[role == 2]
                part[0].append(key)
                part[1].append(role)
                part[2].append(text or b"")
                part[3] += len(text or b"") + 100
                if part[3] >= BLOCK_BYTES:
                    yield full(role == 2)
        for held in (False, True):
            if waiting[held][0]:
                yield full(held)

    return materialize(docs.select("doc_id", "text", "role").mapInArrow(run, "block bigint, held boolean, tokens bigint, train_tokens bigint, data binary"))


class Block:
    """The tokens of a block: one entry per token for its word and for its bigram."""

    def __init__(self, data: bytes):
        self.ids, self.roles, texts = pickle.loads(zstandard.ZstdDecompressor().decompress(data))
        cache, singles, pairs, self.lengths = WordHashes(), [], [], []
        for text in texts:
            h = np.append(cache.of(words(text)), _END)
            before = np.append(_BEGIN, h[:-1])
            singles.append(h)
            pairs.append(mixed(before * _A + mixed(h) * _B))
            self.lengths.append(len(h))
        self.words, self.word_at = np.unique(mixed(np.concatenate(singles)), return_inverse=True)
        self.bigrams, self.bigram_at = np.unique(np.concatenate(pairs), return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.trains = np.repeat(np.array(self.roles) > 0, self.lengths)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.bincount(at[self.trains], minlength=len(keys)).astype(np.uint32) for keys, at in ((self.words, self.word_at), (self.bigrams, self.bigram_at)))

    def estimates(self, word_totals: np.ndarray, bigram_totals: np.ndarray, tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: the count of its word, of its context, and the two relative frequencies."""
        word = word_totals[self.word_at]
        context = np.empty_like(word)
        context[1:] = word[:-1]
        # A text begins as often as it ends.
        end = np.searchsorted(self.words, mixed(np.array([_END])))[0]
        context[self.starts] = word_totals[end]
        pair = bigram_totals[self.bigram_at]
        return word, context, np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0), word / max(1, tokens)


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """First key number of each range and the end: sorted keys fall into ranges one after another."""
    edges = np.array([-(-(k << 64) // ranges) for k in range(1, ranges)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _requests(packed: DataFrame, ranges: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block, held, data in zip(batch["block"].to_pylist(), batch["held"].to_pylist(), batch["data"].to_pylist()):
                b = Block(data)
                word_counts, bigram_counts = b.counts()
                w, g = _range_of(b.words, ranges), _range_of(b.bigrams, ranges)
                cut = lambda pack, x, at: pa.array([pack(x[at[k] : at[k + 1]]) for k in range(ranges)], pa.binary())
                columns = [cut(_pack_keys, b.words, w), cut(_pack, word_counts, w), cut(_pack_keys, b.bigrams, g), cut(_pack, bigram_counts, g)]
                rows = [pa.array(range(ranges), pa.int32()), pa.array([block] * ranges), pa.array([held] * ranges), *columns]
                yield pa.RecordBatch.from_arrays(rows, ["range", "block", "held", "words", "word_counts", "bigrams", "bigram_counts"])

    return packed.select("block", "held", "data").mapInArrow(run, "range int, block bigint, held boolean, words binary, word_counts binary, bigrams binary, bigram_counts binary")


def _answer(table: pa.Table) -> pa.Table:
    """Totals of one key range for every block that asked; the row without a block counts the words."""
    held = table["held"].to_pylist()
    out = {"words": [], "bigrams": [], "words_kept": [], "bigrams_kept": []}
    distinct = distinct_kept = 0
    for name, counted in (("words", "word_counts"), ("bigrams", "bigram_counts")):
        keys = [_unpack_keys(x) for x in table[name].to_pylist()]
        counts = [_unpack(x, np.uint32) for x in table[counted].to_pylist()]
        unique, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=np.concatenate(counts), minlength=len(unique))
        from_held = np.concatenate([c if h else np.zeros(len(c), np.uint32) for c, h in zip(counts, held)])
        kept = total - np.bincount(at, weights=from_held, minlength=len(unique))
        if name == "words":
            distinct, distinct_kept = int((total > 0).sum()), int((kept > 0).sum())
        start = 0
        for k, h in zip(keys, held):
            mine = at[start : start + len(k)]
            start += len(k)
            out[name].append(_pack(total[mine].astype(np.uint64)))
            out[name + "_kept"].append(_pack(kept[mine].astype(np.uint64)) if h else None)
    rows = table.num_rows
    number = table["range"][0].as_py()
    return pa.table({
        "range": pa.array([number] * (rows + 1), pa.int32()),
        "block": pa.array([*table["block"].to_pylist(), None], pa.int64()),
        **{k: pa.array([*v, None], pa.binary()) for k, v in out.items()},
        "distinct": pa.array([0] * rows + [distinct], pa.int64()),
        "distinct_kept": pa.array([0] * rows + [distinct_kept], pa.int64()),
    })


_ANSWERS = "range int, block bigint, words binary, bigrams binary, words_kept binary, bigrams_kept binary, distinct bigint, distinct_kept bigint"


def _joined(answers: pa.Table, name: str) -> np.ndarray:
    ordered = answers.sort_by("range")
    return np.concatenate([_unpack(x, np.uint64) for x in ordered[name].to_pylist()]).astype(np.float64)


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then one bucket per power of two."""
    return np.where(count > 0, 1 + np.minimum(np.floor(np.log2(np.maximum(count, 1))), CONTEXT_BUCKETS - 2), 0).astype(np.int64)


def _code(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.minimum(np.rint(-_STEPS * np.log2(np.where(p > 0, p, 1))), 400), -1).astype(np.int64)


def learnt_weights(cells: list[tuple[int, int, int, int]], uniform: float, rounds: int = 100) -> np.ndarray:
    """(bucket, 3) weights by expectation-maximisation from (bucket, bigram code, word code, tokens)."""
    weights = np.tile(np.array(START_WEIGHTS), (CONTEXT_BUCKETS, 1))
    weights[0] = 0, START_WEIGHTS[1], START_WEIGHTS[2]  # an unseen context has no bigrams
    weights[0] /= weights[0].sum()
    x = np.array(cells, np.int64).reshape(-1, 4)
    value = lambda code: np.where(code >= 0, 2.0 ** (-code / _STEPS), 0.0)
    for bucket in np.unique(x[:, 0]):
        part = x[x[:, 0] == bucket]
        p = np.stack([value(part[:, 1]), value(part[:, 2]), np.full(len(part), uniform)], axis=1)
        w = weights[bucket]
        for _ in range(rounds):
            mass = p * w
            w = ((mass / mass.sum(axis=1, keepdims=True)) * part[:, 3:]).sum(axis=0) / part[:, 3].sum()
        w = np.maximum(w, [0.0, 1e-6, 1e-6])  # every token keeps a probability
        weights[bucket] = w / w.sum()
    return weights


def scores(docs: DataFrame) -> DataFrame:
    """(doc_id, role, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs(doc_id, text, role)``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("role").cast("int").alias("role"))
    packed = blocks(docs)
    sums = packed.agg(F.sum("tokens").alias("all"), F.sum("train_tokens").alias("train"), F.sum(F.when(F.col("held"), F.col("train_tokens"))).alias("held")).first()
    train, held = sums["train"] or 0, sums["held"] or 0
    ranges = max(1, -(-2 * (sums["all"] or 0) // KEYS_PER_RANGE))
    answers = materialize(_requests(packed, ranges).groupBy("range").applyInArrow(_answer, _ANSWERS))
    distinct = answers.where("block IS NULL").agg(F.sum("distinct").alias("v"), F.sum("distinct_kept").alias("kept")).first()
    size, size_kept = distinct["v"] or 0, distinct["kept"] or 0
    answers = answers.where("block IS NOT NULL").drop("distinct", "distinct_kept")

    def cells(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Block(left["data"][0].as_py())
        _, context, pair, word = b.estimates(_joined(right, "words_kept"), _joined(right, "bigrams_kept"), train - held)
        found, n = np.unique(np.stack([context_bucket(context), _code(pair), _code(word)]), axis=1, return_counts=True)
        return pa.table([pa.array(x) for x in (*found, n)], names=["bucket", "pair", "word", "n"])

    together = lambda rows: rows.groupBy("block").cogroup(answers.groupBy("block"))
    held_rows = packed.where("held").select("block", "data").groupBy("block").cogroup(answers.where("words_kept IS NOT NULL").groupBy("block"))
    counted = held_rows.applyInArrow(cells, "bucket bigint, pair bigint, word bigint, n bigint").groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n"))
    # At most 16 buckets times 402 * 402 codes; a few thousand in practice.
    weights = learnt_weights([tuple(r) for r in counted.collect()], 1 / (size_kept + 1))

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Block(left["data"][0].as_py())
        count, context, pair, word = b.estimates(_joined(right, "words"), _joined(right, "bigrams"), train)
        w = weights[context_bucket(context)]
        p = w[:, 0] * pair + w[:, 1] * word + w[:, 2] / (size + 1)
        base = np.log10((count + 0.1) / (train + 0.1 * (size + 1)))
        add = lambda x: np.add.reduceat(x, b.starts)
        return pa.table({
            "doc_id": pa.array(b.ids, pa.int64()),
            "role": pa.array(b.roles, pa.int32()),
            "n_tokens": pa.array(b.lengths, pa.int64()),
            "n_known": pa.array(add((count > 0).astype(np.int64))),
            "train_tokens": pa.array([train] * len(b.ids), pa.int64()),
            "base_score": pa.array(add(base)),
            "score": pa.array(add(np.log10(p))),
        })

    return together(packed.select("block", "data")).applyInArrow(scored, "doc_id bigint, role int, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


@query("op7_interpolation")
def op7_interpolation(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    remainder = id_remainder(F.col("doc_id"), 10)
    role = F.when(F.coalesce(remainder, F.lit(0)) == 0, 0).when(remainder == 1, 2).otherwise(1)
    return scores(docs.select("doc_id", "text", role.alias("role"))).select(
        "doc_id", F.coalesce(remainder == 0, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
