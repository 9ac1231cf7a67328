"""Near duplicates: one-permutation MinHash with optimal densification, bands and star candidates.

A document's set holds its distinct five-word shingles (A-Z in lower case, words split at space and
\\x09-\\x0D); fewer words are one shingle. Documents are linked if 100 * |A & B| >= 75 * |A | B|, and a
component is what links reach.

1. One permutation cuts the hash range into 128 bins; the least hash of each bin is the signature. An
   empty bin borrows from the first occupied bin in a random order of its own, the same for all
   documents. Equal sets become one class by a 128-bit digest of the whole set.
2. Four bins make a band, 32 bands a document; classes that share a band are candidates. A pair at 0.75
   is in no common band with probability (1 - 0.75^4)^32 = 5e-6, at 0.8 with 5e-8.
3. Every bucket proposes stars, never all its pairs. First a class is checked against the smallest of the
   least classes of its buckets; then, round after round, each bucket that still holds several components
   proposes the edges to three more centres that join different ones, until a round finds no new link.
4. A bucket of more members than centres and one may still hold untested pairs of different components. Its
   members are joined by their rarest shingles (prefix filter with bounds of position and size), which misses no
   pair at 0.75: what is left is linked, in one component, or ruled out.
5. A proposed edge counts once the full sets, recomputed from the texts, confirm it.

Nulls and empties: null and empty texts, or texts without words, have no shingles and are linked with
nothing. Rows without a doc_id keep their count, have a null component and are kept. Rows that
repeat doc_id and text are judged alike. A doc_id given to two texts is one node if it is the smallest of
both their classes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_lens.llm.catalog import query, table
from revenue_lens.llm.components import components, relabelled
from revenue_lens.llm.text import WordHashes, byte_texts, mixed, shingle_hashes, words
from revenue_lens.operators.storage import materialize

BINS, BAND_BINS = 128, 4
PERCENT = 75
#: Stars that a bucket proposes in a round.
CENTRES = 3
#: Members checked against one copy of a centre's set.
MEMBERS_PER_TASK = 512
#: Bits of the filter that keeps most texts without candidates out of a shuffle: 2 MB, whatever the input.
FILTER_BITS, BITMAP_BITS = 1 << 24, 1 << 15
#: Counters by which shingles are called rare: 8 MB, whatever the input. Shingles that share one count together,
#: which changes the work but not the result.
COUNTERS = 1 << 20
#: Blocks of set sizes: one for each factor of e^(1/16). Members of one cell of a prefix join, each side.
BLOCKS_PER_E, CELL = 16, 512
_EDGES = np.array([(k << 64) // BINS for k in range(BINS)], dtype=np.uint64)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)


def probe_orders(seed: int = 1) -> np.ndarray:
    """For each bin the order in which it looks for an occupied one."""
    return np.random.default_rng(seed).permuted(np.tile(np.arange(BINS, dtype=np.uint8), (BINS, 1)), axis=1)


def signature(shingles: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """Least hash of each bin for sorted distinct ``shingles`` (one at least)."""
    first = np.searchsorted(shingles, _EDGES)
    occupied = first < np.append(first[1:], len(shingles))
    found = shingles[np.minimum(first, len(shingles) - 1)]
    empty = np.flatnonzero(~occupied)
    if len(empty):
        found[empty] = found[orders[empty, occupied[orders[empty]].argmax(axis=1)]]
    return found


def band_keys(found: np.ndarray) -> np.ndarray:
    bands = found.reshape(-1, BAND_BINS)
    return mixed((mixed(bands) * _FACTORS).sum(axis=1, dtype=np.uint64) + np.arange(len(bands), dtype=np.uint64) * _FACTORS[0])


def _set_of(text: bytes | None, cache: WordHashes) -> np.ndarray:
    return np.unique(shingle_hashes(cache.of(words(text))))


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signatures(docs: DataFrame) -> DataFrame:
    orders = probe_orders()

    def run(batches):
        cache = WordHashes()
        for batch in batches:
            sizes, digests, bands = [], [], []
            for text in byte_texts(batch["text"]):
                s = _set_of(text, cache)
                sizes.append(len(s))
                digests.append(_digest(s) if len(s) else None)
                bands.append(band_keys(signature(s, orders)).view(np.int64) if len(s) else None)
            columns = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "digest", "bands"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, digest binary, bands array<bigint>")


def _confirmed(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b) = (x, y) of those ``edges(a, b, x, y)`` whose full sets confirm a, b. A centre with many members is
    dealt, with copies of its text, to several groups; within a group its text comes first."""
    group = F.xxhash64("a", F.pmod(F.xxhash64("b"), F.ceil(F.col("members") / MEMBERS_PER_TASK)))
    counted = edges.join(edges.groupBy("a").agg(F.count(F.lit(1)).alias("members")), "a").select("a", "b", "x", "y", group.alias("g"))
    counted = materialize(counted)  # both roles read it
    roles = counted.select("a", "g", F.col("b").alias("node"), F.lit(1).alias("role"), "x", "y").unionByName(
        counted.select("a", "g").distinct().select("a", "g", F.col("a").alias("node"), F.lit(0).alias("role"), F.col("a").alias("x"), F.col("a").alias("y"))
    )
    texts = _perhaps_among(texts, "node", roles.select("node"))
    sided = roles.join(texts, "node").repartition("g").sortWithinPartitions("g", "a", "role")

    def run(batches):
        cache, at, centre = WordHashes(), None, []
        for batch in batches:
            a, b = [], []
            sides = zip(*(batch[c].to_pylist() for c in ("a", "g", "role", "x", "y")), byte_texts(batch["text"]))
            for key, g, role, x, y, text in sides:
                s = _set_of(text, cache)
                if at != (key, g):
                    at, centre = (key, g), []
                if role == 0:
                    centre.append(s)
                    continue
                for c in centre:
                    both = len(np.intersect1d(c, s, assume_unique=True))
                    if 100 * both >= PERCENT * (len(c) + len(s) - both):
                        a.append(x)
                        b.append(y)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return sided.select("a", "g", "role", "x", "y", "text").mapInArrow(run, "a bigint, b bigint")


def _shingle_counts(sets: DataFrame) -> np.ndarray:
    """How often a counter's shingles occur in the texts of ``sets(node, text)``."""

    def run(batches):
        cache, counts = WordHashes(), np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for text in byte_texts(batch["text"]):
                counts[(_set_of(text, cache) % np.uint64(COUNTERS)).astype(np.int64)] += 1
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], ["at", "n"])

    # A row per counter at most.
    found = sets.select("text").mapInArrow(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[found["at"].to_numpy()] = found["n"].to_numpy()
    return counts


def _reach(n, position):
    """The largest set that can be alike with one of ``n`` shingles whose first common one is at ``position``: all common
    ones are then among the last n - position, and (100 + PERCENT) * common >= PERCENT * (n + m)."""
    return (100 * n - (100 + PERCENT) * position) // PERCENT


def _prefixes(sets: DataFrame) -> DataFrame:
    """(shingle, block, probe, node, n, reach): the rarest shingles of ``sets(node, text)``. The smaller set of a pair
    looks (probe 0) in all blocks of sizes that it reaches; the larger is found (probe 1) in its own."""
    shared = sets.sparkSession.sparkContext.broadcast(_shingle_counts(sets))

    def run(batches):
        cache, counts = WordHashes(), shared.value
        block = lambda n: np.floor(np.log(n) * BLOCKS_PER_E).astype(np.int64)
        for batch in batches:
            parts = []
            for node, text in zip(batch["node"].to_pylist(), byte_texts(batch["text"])):
                s = _set_of(text, cache)
                n = len(s)
                if not n:
                    continue
                s = s[np.lexsort((s, counts[(s % np.uint64(COUNTERS)).astype(np.int64)]))]
                reach = _reach(n, np.arange(n, dtype=np.int64))
                first, last = int((reach >= n).sum()), int((100 * reach >= PERCENT * n).sum())
                own = block(np.array([n]))[0]
                copies = block(reach[:first]) - own + 1
                at = np.repeat(np.arange(first), copies)
                blocks = own + np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                at, blocks = np.append(at, np.arange(last)), np.append(blocks, np.full(last, own))
                probe = np.arange(len(at)) >= len(at) - last
                parts.append((s[at].view(np.int64), blocks, probe.astype(np.int64), np.full(len(at), node), np.full(len(at), n), reach[at]))
            if parts:
                columns = [pa.array(np.concatenate(c).astype(np.int64), pa.int64()) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "block", "probe", "node", "n", "reach"])

    return sets.select("node", "text").mapInArrow(run, "shingle bigint, block bigint, probe bigint, node bigint, n bigint, reach bigint")


def _by_rare_shingles(texts: DataFrame, labels: DataFrame) -> DataFrame:
    """(a, b, x, y): pairs a < b of different components x, y, every one at PERCENT among them, of the nodes of
    ``labels(node, root)``. Of a group by shingle and size the members of its largest component meet only the others;
    large groups are dealt to cells of both sides."""
    sets = materialize(texts.join(labels.select("node"), "node"))
    entries = materialize(_prefixes(sets).join(labels, "node"))
    per_root = entries.groupBy("shingle", "block", "root").agg(F.sum(1 - F.col("probe")).alias("i"), F.sum("probe").alias("p"))
    groups = per_root.groupBy("shingle", "block").agg(F.max(F.struct((F.col("i") + F.col("p")).alias("size"), "root", "i", "p")).alias("big"), F.sum("i").alias("i"), F.sum("p").alias("p"))
    others, rest = F.col("i") - F.col("big.i"), F.col("p") - F.col("big.p")
    pieces = lambda size: F.greatest(F.ceil(size / CELL), F.lit(1))
    # part 0: other components look at all; part 1: the largest component looks at the others.
    groups = groups.where(((others > 0) & (F.col("p") > 0)) | ((F.col("big.i") > 0) & (rest > 0)))
    groups = groups.select("shingle", "block", F.col("big.root").alias("big"), F.array(pieces(others), pieces(F.col("big.i"))).alias("rows"), F.array(pieces(F.col("p")), pieces(rest)).alias("columns"))
    met = materialize(entries.join(groups, ["shingle", "block"]))
    mine, cell = F.col("root") == F.col("big"), lambda size: F.pmod(F.xxhash64("node"), size)
    every = lambda size: F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1))
    keys = ["shingle", "block", "part", "row", "column"]
    look = met.where("probe = 0").withColumn("part", mine.cast("int"))
    look = look.withColumn("row", cell(F.get("rows", F.col("part")))).withColumn("column", every(F.get("columns", F.col("part"))))
    seen = met.where("probe = 1").withColumn("part", F.explode(F.when(mine, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))))
    seen = seen.withColumn("column", cell(F.get("columns", F.col("part")))).withColumn("row", every(F.get("rows", F.col("part"))))
    look = look.select(*keys, "node", "n", "reach", "root")
    seen = seen.select(*keys, *[F.col(c).alias(f"other_{c}") for c in ("node", "n", "reach", "root")])
    fits = (F.col("n") <= F.col("other_n")) & (F.col("other_n") <= F.col("reach")) & (F.col("n") <= F.col("other_reach")) & (F.col("root") != F.col("other_root"))
    ends = F.struct(F.least("root", "other_root").alias("x"), F.greatest("root", "other_root").alias("y"))
    pairs = look.join(seen, keys).where(fits).groupBy(F.least("node", "other_node").alias("a"), F.greatest("node", "other_node").alias("b"))
    return pairs.agg(F.min(ends).alias("e")).select("a", "b", "e.x", "e.y")


def _perhaps_among(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not in ``keys``. The bitmaps are at most
    FILTER_BITS / 8 bytes in all; the more keys, the more other rows stay."""
    at = F.pmod(F.xxhash64(F.col(column)), F.lit(FILTER_BITS))
    bitmap, bit = F.floor(at / BITMAP_BITS).cast("int"), (at % BITMAP_BITS).cast("bigint")
    bits = keys.groupBy(bitmap.alias("bitmap")).agg(F.bitmap_construct_agg(bit).alias("bits"))
    placed = rows.withColumns({"bitmap": bitmap, "bit": bit}).join(F.broadcast(bits), "bitmap")
    byte = F.conv(F.hex(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return placed.where(F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1).select(*rows.columns)


def _still_open(placed: DataFrame, later: DataFrame) -> DataFrame:
    """The entries ``placed(key, node, n, root)`` with the roots of ``later(node, root)``, without the buckets that these close: no
    round looks at one again."""
    up = later.select(F.col("node").alias("from"), F.col("root").alias("to"))
    moved = materialize(placed.join(up, F.col("root") == F.col("from"), "left").select("key", "node", "n", F.coalesce("to", "root").alias("root")))
    several = moved.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return materialize(moved.join(several.select("key"), "key", "left_semi"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs(doc_id, text, ...)``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = materialize(_signatures(docs))
    usable = sets.where("n > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("digest").agg(F.min(F.struct("doc_id", "n", "bands")).alias("c")).select("digest", F.col("c.doc_id").alias("node"), F.col("c.n").alias("n"), F.col("c.bands").alias("bands"))
    classes = materialize(classes)
    entries = classes.select(F.explode("bands").alias("key"), "node", "n")
    shared = entries.join(entries.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low <> high").select("key"), "key")
    shared = materialize(shared)
    wanted = materialize(shared.select("node").distinct())
    # A doc_id with several texts is a node with several sets.
    texts = _perhaps_among(docs.withColumnRenamed("doc_id", "node"), "node", wanted).join(wanted, "node").groupBy("node").agg(F.collect_set("text").alias("texts"))
    texts = materialize(texts.select("node", F.explode("texts").alias("text")))
    labels, tested, turn = None, None, 0
    placed = shared.withColumn("root", F.col("node"))
    while True:
        marks = [F.col("node")] if turn == 0 else [F.xxhash64("node", F.lit(CENTRES * turn + k)) for k in range(CENTRES)]
        least = [F.min(F.struct(mark.alias("mark"), "node", "n", "root")) for mark in marks]
        stars = placed.groupBy("key").agg(F.array(*least).alias("centres"), F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("key", "centres")
        alike = F.least("n", "c.n") * 100 >= F.greatest("n", "c.n") * PERCENT
        proposed = placed.join(stars, "key").withColumn("c", F.explode(F.array_distinct("centres"))).where((F.col("root") != F.col("c.root")) & alike)
        low, high = F.least("node", "c.node"), F.greatest("node", "c.node")
        if turn == 0:
            proposed = proposed.groupBy(high.alias("b")).agg(F.min(low).alias("a")).select("a", "b", F.col("a").alias("x"), F.col("b").alias("y"))
        else:
            ends = F.struct(F.least("root", "c.root").alias("x"), F.greatest("root", "c.root").alias("y"))
            proposed = proposed.groupBy(low.alias("a"), high.alias("b")).agg(F.min(ends).alias("e")).select("a", "b", "e.x", "e.y").join(tested, ["a", "b"], "left_anti")
        proposed = materialize(proposed)
        found = materialize(_confirmed(proposed, texts))
        tested = proposed.select("a", "b") if tested is None else tested.unionByName(proposed.select("a", "b"))
        if turn and not found.take(1):
            break
        new = components(found)
        labels = new if labels is None else materialize(relabelled(labels, new))
        placed = _still_open(placed, new)
        turn += 1
    # Buckets of more members have pairs without a centre.
    several = placed.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min("root").alias("low"), F.max("root").alias("high")).where((F.col("members") > CENTRES + 1) & (F.col("low") != F.col("high")))
    open_nodes = materialize(placed.join(several.select("key"), "key").select("node", "root").distinct())
    if open_nodes.take(1):
        proposed = materialize(_by_rare_shingles(texts, open_nodes).join(tested, ["a", "b"], "left_anti"))
        labels = materialize(relabelled(labels, components(materialize(_confirmed(proposed, texts)))))
    component = classes.join(labels, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    joined = sets.select("doc_id", "n", "digest").join(component, "digest", "left")
    mine = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), mine.alias("component_id"), F.coalesce(mine == F.col("doc_id"), F.lit(True)).alias("kept"))


@query("op5_minhash")
def op5_minhash(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
