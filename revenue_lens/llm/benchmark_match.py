"""Benchmark decontamination: windows of a document as long as a benchmark item, found by SimHash.

A text is the sequence of its five-word shingles (A-Z in lower case; fewer words are one shingle). For
an item of L shingles every window of L shingles that holds at least one shingle of an item of that
size gets a 64-bit SimHash, each shingle weighing as often as it occurs; windows without a common
shingle cannot be similar. A shorter document is one window. Eight 8-bit blocks index the items of a size:
two fingerprints within 31 bits differ by at most 3 bits in some block, so every item within the radius
of 27 bits is found (a pair at similarity 0.75 differs in 11 of 64 bits on average, with
a deviation of 3). The exact weighted Jaccard similarity of the shingle counts then decides: a window matches
from 0.75.

The items are worked through in slices of bounded size, each one broadcast.

Nulls and empties: texts and items that are null or without words match nothing, also not each
other. An item or document of fewer than five words matches only its own words as a whole text. Repeated rows
are judged alike; a null item_id is reported as null. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenue_lens.llm.catalog import query, table
from revenue_lens.llm.text import WordHashes, byte_texts, shingle_hashes, words
from revenue_lens.operators.storage import materialize

PERCENT = 75
RADIUS = 27
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 8, 8, 3  # finds all within BLOCKS * (BLOCK_RADIUS + 1) - 1 = 31 bits
#: Text of the items that are broadcast at a time; the index takes about four times as much.
SLICE_BYTES = 16 << 20
WINDOWS_AT_ONCE = 1024
MATCHES = "array<struct<item_id:bigint,similarity:double,first_shingle:bigint,shingles:bigint>>"
_FOUND = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("first_shingle", pa.int64()), ("shingles", pa.int64())]))


def fingerprints(shingles: np.ndarray, length: int) -> np.ndarray:
    """SimHash of each window of ``length`` shingles: bit by bit what most of them have."""
    bits = ((shingles[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int32)
    sums = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    most = 2 * (sums[length:] - sums[:-length]) > length
    return np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()


class BlockIndex:
    """Fingerprints of the items of one size, by the value of each 8-bit block."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        values = prints.view(np.uint8).reshape(-1, BLOCKS)
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :]) <= BLOCK_RADIUS
        # A row of bits over the items for each block and value: within three bits of the item's block.
        self.rows = [np.packbits(near[:, values[:, b]], axis=1) for b in range(BLOCKS)]

    def within(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) numbers of all pairs within the radius."""
        values = windows.view(np.uint8).reshape(-1, BLOCKS)
        some = self.rows[0][values[:, 0]]
        for b in range(1, BLOCKS):
            some = some | self.rows[b][values[:, b]]
        w, i = np.nonzero(np.unpackbits(some, axis=1, count=len(self.prints)))
        kept = np.bitwise_count(windows[w] ^ self.prints[i]) <= RADIUS
        return w[kept], i[kept]


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sums of the lesser and of the greater count over all shingles."""
    ka, ca = np.unique(a, return_counts=True)
    kb, cb = np.unique(b, return_counts=True)
    _, x, y = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    least = int(np.minimum(ca[x], cb[y]).sum())
    return least, len(a) + len(b) - least


class ItemIndex:
    """Items (id, text) by shingle and by size."""

    def __init__(self, items: list[tuple]):
        cache = WordHashes()
        self.ids, self.items = [], []
        for item_id, text in items:
            s = shingle_hashes(cache.of(words(text.encode() if text else None)))
            if len(s):
                self.ids.append(item_id)
                self.items.append(s)
        sizes = np.array([len(s) for s in self.items], np.int64)
        pairs = np.unique(np.array([(k, n) for s, n in zip(self.items, sizes) for k in s.tolist()], dtype=[("k", np.uint64), ("n", np.int64)])) if self.items else np.empty(0, [("k", np.uint64), ("n", np.int64)])
        self.keys, self.first = np.unique(pairs["k"], return_index=True)
        self.sizes_of = np.split(pairs["n"], self.first[1:])  # of the items that hold a key
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        self.by_size = {}
        for n in np.unique(sizes).tolist():
            members = np.flatnonzero(sizes == n)
            self.by_size[n] = members, BlockIndex(np.concatenate([fingerprints(self.items[m], n) for m in members]))

    def matches(self, text: bytes | None, cache: WordHashes) -> list[dict]:
        s = shingle_hashes(cache.of(words(text)))
        if not len(s) or not len(self.keys):
            return []
        at = np.flatnonzero(self.maybe[(s >> np.uint64(44)).astype(np.int64)])
        found = np.minimum(np.searchsorted(self.keys, s[at]), len(self.keys) - 1)
        exact = self.keys[found] == s[at]
        at, found = at[exact], found[exact]
        if not len(at):
            return []
        hits: dict[int, list[int]] = {}
        for p, k in zip(at.tolist(), found.tolist()):
            for n in self.sizes_of[k].tolist():
                hits.setdefault(n, []).append(p)
        best: dict[int, tuple] = {}
        for n, places in hits.items():
            for start, stop, length in _runs(places, n, len(s)):
                self._search(s[start : stop + length], start, length, n, best)
        return [{"item_id": self.ids[i], "similarity": x, "first_shingle": p, "shingles": length} for i, (x, p, length) in sorted(best.items())]

    def _search(self, part: np.ndarray, start: int, length: int, n: int, best: dict) -> None:
        members, index = self.by_size[n]
        w, i = index.within(fingerprints(part, length))
        for one in np.unique(i).tolist():
            item = self.items[members[one]]
            windows = w[i == one]
            common = np.concatenate([[0], np.cumsum(np.isin(part, item))])
            most = common[windows + length] - common[windows]  # at least the common weight
            for k in np.argsort(-most, kind="stable").tolist():
                bound = int(min(most[k], n))
                at_best = best.get(int(members[one]), (0.0,))[0]
                if 100 * bound < PERCENT * (length + n - bound) or bound / (length + n - bound) <= at_best:
                    break
                p = int(windows[k])
                least, total = similarity(part[p : p + length], item)
                if 100 * least >= PERCENT * total and least / total > at_best:
                    best[int(members[one])] = least / total, start + p, length


def _runs(places: list[int], n: int, m: int) -> Iterator[tuple[int, int, int]]:
    """(first start, last start, length) of runs of windows that hold one of the places."""
    if m <= n:
        yield 0, 0, m
        return
    start, stop = None, -1
    for p in places:
        low, high = max(0, p - n + 1, stop + 1), min(p, m - n)
        if start is not None and (low > stop + 1 or stop - start >= WINDOWS_AT_ONCE):
            yield start, stop, n
            start = None
        if high >= low:
            start = low if start is None else start
            stop = high
    if start is not None:
        yield start, stop, n


def _matches(index, text: Column) -> Column:
    def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = WordHashes()
        for column in columns:
            yield pa.array([index.value.matches(t, cache) for t in byte_texts(column)], _FOUND)

    return F.arrow_udf(run, MATCHES)(text)


def with_matches(docs: DataFrame, benchmark: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(row, matches): ``row`` holds the columns of ``docs(text, ...)``; a match is the best window of an item."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    slices = max(1, -(-size // slice_bytes))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.array().cast(MATCHES).alias("matches"))
    for k in range(slices):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)
        index = spark.sparkContext.broadcast(ItemIndex([(r["item_id"], r["text"]) for r in part.sort("item_id", "text").collect()]))
        rows = rows.select("row", F.concat("matches", _matches(index, F.col("row.text").cast("string"))).alias("matches"))
        if k + 1 < slices:  # one slice of the index at a time in a worker
            rows = materialize(rows)
    return rows


@query("op8_benchmark_match")
def op8_benchmark_match(spark, sf_dir) -> DataFrame:
    found = with_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("row.doc_id", (F.size("matches") > 0).alias("contaminated"), F.array_sort(F.array_distinct("matches.item_id")).alias("item_ids"), F.array_max("matches.similarity").alias("similarity"))
