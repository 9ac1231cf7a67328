"""Merkle manifest of a dataset: a postorder append log, and the proof of every document from it.

Each lang is a tree of arity 8 over its documents, ascending by doc_id; the subroots, ordered by lang (null first,
then by UTF-8 bytes), are the leaves of a tree of trees, whose root stands for the whole table. A digest is
a SHA-256; an inner node hashes the hexadecimal digests of its run of children, of which the last run may have
fewer, even one.

Leaves are numbered by a range partition and the running sum of its counts. An aligned builder takes 512 of them
(three levels) and appends its nodes in the order in which they are complete: every leaf, and each inner node behind
its last child. Its segment is one row. The roots of the segments are the leaves of the next round, which is 512
times smaller. In a postorder log the place of a node follows from the sizes of the subtrees before it
(``place``), so a proof reads its siblings straight from the segment: of the segments of the last round first, whose
paths are handed down to the segments below, until those of the first round meet their documents.
Texts are hashed where they are read; only digests and keys are shuffled.

Nulls and empties: a null field counts as ``-``, an empty text as ``0:``; documents without a doc_id come first in their
lang. Documents that share lang and doc_id are ordered by their digest; repeated rows are leaves of their own and equal
digests may change places without changing a hash, but the proof belongs to the row's own place. A long text is one
value of its row and is hashed as such. An empty table has neither root nor rows. Extra columns are not hashed.
"""

from __future__ import annotations

import hashlib
from binascii import hexlify, unhexlify
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from revenue_lens.llm.catalog import query, table
from revenue_lens.operators.storage import materialize

ARITY = 8
#: Levels that a builder closes, so that its segment has ARITY**LEVELS leaves.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# --- closed forms ---------------------------------------------------------------------


def height(leaves: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // ARITY), levels + 1
    return levels


def place(level: int, i: int, leaves: int, top: int) -> int:
    """Place of node ``i`` of a level in the postorder log of a tree of ``leaves``, ``top`` levels high: what is
    complete with its last leaf, up to its own level, and above it what was complete before its first."""
    first, end = i * ARITY**level, min((i + 1) * ARITY**level, leaves)
    return sum(-(-end // ARITY**k) for k in range(level + 1)) + sum(first // ARITY**k for k in range(level + 1, top + 1)) - 1


def run_of(i: int, nodes: int) -> tuple[int, int]:
    """First and end of the run of siblings of node ``i`` on a level of ``nodes``."""
    first = i - i % ARITY
    return first, min(first + ARITY, nodes)


def append_log(leaves: list[bytes], top: int) -> bytes:
    """The digests of a tree in the order of their completion."""
    out, open_runs = bytearray(), [[] for _ in range(top + 1)]

    def append(level: int, digest: bytes) -> None:
        out.extend(digest)
        open_runs[level].append(digest)
        if level < top and len(open_runs[level]) == ARITY:
            close(level)

    def close(level: int) -> None:
        run, open_runs[level] = open_runs[level], []
        append(level + 1, hashlib.sha256(hexlify(b"".join(run))).digest())

    for leaf in leaves:
        append(0, leaf)
    for level in range(top):
        if open_runs[level]:
            close(level)
    return bytes(out)


def siblings(log: bytes, leaves: int, top: int, i: int, levels: range) -> bytes:
    """Hexadecimal digests of the siblings of leaf ``i`` and of its ancestors on ``levels``, level by level."""
    parts = []
    for level in levels:
        own, nodes = i // ARITY**level, -(-leaves // ARITY**level)
        first, end = run_of(own, nodes)
        for k in range(first, end):
            if k != own:
                p = 32 * place(level, k, leaves, top)
                parts.append(log[p : p + 32])
    return hexlify(b"".join(parts))


def fold(digest: bytes, i: int, leaves: int, proof: bytes) -> tuple[bytes, int]:
    """The root that a leaf digest (hexadecimal) and its siblings lead to, and how much of the proof was used."""
    at = 0
    while leaves > 1:
        first, end = run_of(i, leaves)
        split, stop = at + 64 * (i - first), at + 64 * (end - first - 1)
        if stop > len(proof):
            raise ValueError("the proof is too short")
        digest = hexlify(hashlib.sha256(proof[at:split] + digest + proof[split:stop]).digest())
        at, i, leaves = stop, i // ARITY, -(-leaves // ARITY)
    return digest, at


# --- leaves and their numbers ---------------------------------------------------------


def leaf_digest(text: Column | None = None) -> Column:
    """Hexadecimal digest of a document's fields, with ``text`` in place of its own if given."""
    field = lambda c: F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    values = {c: F.col(c).cast("string") for c in FIELDS} | ({} if text is None else {"text": text})
    return F.sha2(F.concat(*[field(values[c]) for c in FIELDS]).cast("binary"), 256)


def _tree(lang: Column) -> Column:
    """Key of a lang's tree, in the order of the subroots."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add ``i``, the rank from 0 within ``tree`` by ``order``, and ``leaves``, the size of the tree.
    Rows that agree in all of ``order`` are dealt like others."""
    spread = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "_row").sortWithinPartitions("tree", *order, "_row")
    placed = materialize(spread.drop("_row").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    blocks = placed.groupBy(F.col("tree").alias("_tree"), part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    # One row per tree and partition.
    earlier = Window.partitionBy("_tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "_tree", "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(Window.partitionBy("_tree")).alias("leaves")
    )
    return placed.join(offsets, (F.col("tree") == F.col("_tree")) & (part == F.col("_part"))).withColumn("i", F.col("_at") + F.col("_shift")).drop("_at", "_tree", "_part", "_shift")


# --- the log --------------------------------------------------------------------------

_BLOCK = ARITY**LEVELS
_SEGMENT = "tree string, block bigint, leaves bigint, inputs int, top int, log binary"


def _grouped(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    """Rows of sorted Arrow batches as tuples."""
    for batch in batches:
        yield from zip(*[batch[c].to_pylist() for c in columns])


def _build(batches):
    key, run, found = None, [], []

    def segment():
        tree, block, leaves = key
        top = min(LEVELS, height(leaves))
        return tree, block, leaves, len(run), top, append_log(run, top)

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()])], ["tree", "block", "leaves", "inputs", "top", "log"])

    for tree, block, leaves, digest in _grouped(batches, ["tree", "block", "leaves", "digest"]):
        if key != (tree, block, leaves):
            if key:
                found.append(segment())
            key, run = (tree, block, leaves), []
        run.append(digest)
        if len(found) == 256:
            yield rows()
            found = []
    if key:
        found.append(segment())
    if found:
        yield rows()


def segments(nodes: DataFrame) -> DataFrame:
    """The builders' segments (tree, block, leaves, inputs, top, log) of ``nodes(tree, i, leaves, digest)``, which all lie
    on one level; ``log`` holds digests of 32 bytes."""
    dealt = nodes.select("tree", F.expr(f"i div {_BLOCK}").alias("block"), "i", "leaves", "digest").repartition("tree", "block").sortWithinPartitions("tree", "block", "i")
    return dealt.mapInArrow(_build, _SEGMENT)


def build(leaves: DataFrame) -> list[DataFrame]:
    """The rounds of the log over ``leaves(tree, i, leaves, digest)``, lowest first; the last holds one segment a tree."""
    rounds = [materialize(segments(leaves))]
    most = rounds[0].agg(F.max("leaves")).first()[0] or 0
    while most > _BLOCK:
        most = -(-most // _BLOCK)
        upper = rounds[-1].select("tree", F.col("block").alias("i"), F.ceil(F.col("leaves") / _BLOCK).alias("leaves"), F.expr("substring(log, -32, 32)").alias("digest"))
        rounds.append(materialize(segments(upper)))
    return rounds


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree."""
    return rounds[-1].select("tree", F.expr("substring(log, -32, 32)").alias("digest"))


# --- proofs ---------------------------------------------------------------------------


def _paths(batches):
    """(tree, i, path) of all inputs of each segment, its own path behind theirs."""
    for batch in batches:
        for tree, block, leaves, inputs, top, log, above in _grouped([batch], ["tree", "block", "leaves", "inputs", "top", "log", "path"]):
            found = [siblings(log, inputs, top, k, range(top)) + above for k in range(inputs)]
            yield pa.RecordBatch.from_arrays([pa.array([tree] * inputs), pa.array(range(block * _BLOCK, block * _BLOCK + inputs), pa.int64()), pa.array(found, pa.binary())], ["tree", "i", "path"])


def handed_down(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """(tree, block, log, path) of the lowest segments: ``path`` leads from a segment's root through its tree, then
    along ``above(tree, path)``."""
    own = rounds[-1].join(above, "tree")
    for lower in reversed(rounds[:-1]):
        down = materialize(own.mapInArrow(_paths, "tree string, i bigint, path binary")).withColumnRenamed("i", "block")
        own = lower.join(down, ["tree", "block"])
    return own


#: Proofs that are handed on at once: one takes some kilobytes.
_PROOFS = 512


def _proofs(columns: int, places: tuple[str, str]):
    def run(batches):
        segment = shared = None
        for whole in batches:
            for first in range(0, whole.num_rows, _PROOFS):
                batch = whole.slice(first, _PROOFS)
                found, roots_ = [], []
                for k, log, path, inputs, top, i, above, leaves, digest in _grouped([batch], ["kind", "log", "path", "inputs", "top", "i", "above", "leaves_", "digest_"]):
                    if k == 0:
                        segment, shared = (log, path, inputs, top, [above[c] for c in places]), (None, None)
                        continue
                    log, path, inputs, top, over = segment
                    j = i % _BLOCK
                    if shared[0] != j // ARITY:  # the levels above are the same for a run
                        shared = j // ARITY, siblings(log, inputs, top, j, range(1, top)) + path
                    proof = siblings(log, inputs, top, j, range(min(top, 1))) + shared[1]
                    found.append(proof)
                    roots_.append(_folded(digest, [i, leaves, *over], proof))
                kept = batch.filter(pa.compute.equal(batch["kind"], 1))
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns[:columns], pa.array(found, pa.binary()).cast(pa.string()), pa.array(roots_, pa.binary())], [*batch.schema.names[:columns], "proof", "folded"]
                )

    return run


def _folded(digest: bytes | None, numbers: list[int], proof: bytes) -> bytes | None:
    """The root (32 bytes) that a digest and a proof lead to through the trees of ``numbers``, each the number of the leaf and of
    the leaves."""
    if digest is None:
        return None
    found = hexlify(digest)
    for t in range(0, len(numbers), 2):
        found, used = fold(found, numbers[t], numbers[t + 1], proof)
        proof = proof[used:]
    if proof:
        raise ValueError("the proof is too long")
    return unhexlify(found)


def proofs(leaves: DataFrame, lowest: DataFrame, keep: list[str], digest: Column | None = None, above: tuple[str, str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``leaves(tree, i, leaves, ...)``; ``proof``: the hexadecimal digests of its siblings, level by level up
    to the root; and ``folded``: the root that ``digest`` (32 bytes) and the proof lead to, null without a digest. ``above`` names the
    columns of ``lowest`` that give the place of the tree among the trees, and their number, where the proof leads through those.
    A segment and its documents meet in one task, the segment first."""
    block = F.expr(f"i div {_BLOCK}")
    none = lambda t: F.lit(None).cast(t)
    places = above or ()
    over = "struct<" + ", ".join(f"{c}: bigint" for c in places or ("none",)) + ">"
    bodies = leaves.select(
        *keep, F.lit(1).alias("kind"), "tree", block.alias("block"), "i", none("binary").alias("log"), none("binary").alias("path"), none("int").alias("inputs"), none("int").alias("top"),
        none(over).alias("above"), F.col("leaves").alias("leaves_"), (none("binary") if digest is None else digest).alias("digest_"),
    )
    types = dict(leaves.dtypes)
    held = {"tree", "i"}
    heads = lowest.select(
        *[none(types[c]).alias(c) for c in keep], F.lit(0).alias("kind"), "tree", "block", F.lit(-1).cast("bigint").alias("i"), "log", "path", "inputs", "top",
        (F.struct(*[F.col(c).cast("bigint").alias(c) for c in places]) if places else none(over)).alias("above"), none("bigint").alias("leaves_"), none("binary").alias("digest_"),
    )
    if held & set(keep):
        raise ValueError("give tree and i other names to keep them")
    dealt = heads.unionByName(bodies).repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "i")
    schema = ", ".join(f"`{c}` {types[c]}" for c in keep)
    return dealt.mapInArrow(_proofs(len(keep), places), f"{schema}, proof string, folded binary")


def folded(digest: Column, places: list[tuple[Column, Column]], proof: Column) -> Column:
    """The root that ``digest`` and ``proof`` (hexadecimal) lead to through the trees at ``places``, each the number of the
    leaf and of the leaves."""

    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in columns:
            digests, proofs_, *numbers = [c.to_pylist() for c in batch]
            found = []
            for k, (d, p) in enumerate(zip(digests, proofs_)):
                found.append(hexlify(_folded(unhexlify(d), [n[k] for n in numbers], p.encode())).decode())
            yield pa.array(found, pa.string())

    return F.arrow_udf(run, "string")(digest, proof, *[c for pair in places for c in pair])


def manifest(docs: DataFrame, altered_text: Column | None = None) -> DataFrame:
    """(doc_id, lang, leaf, altered_leaf, subroot, root, proof, folded_root, place, leaves, tree_place, trees) of every row of
    ``docs(doc_id, source, lang, n_chars, text)``.

    ``altered_leaf`` is the leaf with ``altered_text`` in place of the text, null where that is null. ``folded_root`` is the root
    that the altered leaf, else the leaf, and the proof lead to; it is computed where the proof is read, as proofs are long.
    """
    altered = F.lit(None).cast("string") if altered_text is None else F.when(altered_text.isNotNull(), leaf_digest(altered_text))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", _tree(F.col("lang").cast("string")).alias("tree"), leaf_digest().alias("leaf"), altered.alias("altered_leaf"))
    # Digests are kept as 32 bytes.
    stored = materialize(own.withColumns({"leaf": F.unhex("leaf"), "altered_leaf": F.unhex("altered_leaf")}))
    leaves = materialize(numbered(stored, ["doc_id", "leaf"]))
    rounds = build(leaves.withColumnRenamed("leaf", "digest"))
    subroots = materialize(numbered(roots(rounds).select(F.lit("").alias("tree"), F.col("tree").alias("sub"), "digest"), ["sub"]))
    top = build(subroots)
    above = handed_down(top, roots(top).select("tree", F.lit(b"").alias("path")))
    heads = proofs(subroots, above, ["sub"]).select(F.col("sub").alias("tree"), F.col("proof").cast("binary").alias("path"))
    numbers = subroots.select(F.col("sub").alias("tree"), F.col("i").alias("tree_place"), F.col("leaves").alias("trees"))
    lowest = handed_down(rounds, materialize(heads)).join(F.broadcast(numbers), "tree")  # a row per lang
    whole = F.lower(F.hex("digest"))
    trees = subroots.select(F.col("sub").alias("of"), F.col("i").alias("tree_place"), F.col("leaves").alias("trees"), whole.alias("subroot"))
    root = roots(top).select(whole.alias("root"))  # one row
    trees = trees.join(F.broadcast(root))
    named = leaves.withColumns({"of": F.col("tree"), "place": F.col("i")})
    found = proofs(named, lowest, ["doc_id", "lang", "leaf", "altered_leaf", "of", "place", "leaves"], F.coalesce("altered_leaf", "leaf"), ("tree_place", "trees"))
    hexed = found.withColumnRenamed("folded", "folded_root").withColumns({c: F.lower(F.hex(c)) for c in ("leaf", "altered_leaf", "folded_root")})
    return hexed.join(trees, "of").select("doc_id", "lang", "leaf", "altered_leaf", "subroot", "root", "proof", "folded_root", "place", "leaves", "tree_place", "trees")


_SQL = """
WITH RECURSIVE d AS (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
    list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
  FROM documents),
e AS (SELECT doc_id, lang, coalesce(xor(crc, 4294967295) % 3 = 0, false) AS altered,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    text, low FROM d),
l AS (SELECT doc_id, lang, altered, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(low) || ':' || low, '-')) AS low_leaf FROM e),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM l),
up AS (SELECT lang, 0 AS level, i, n, leaf AS h FROM leaves
  UNION ALL SELECT lang, level + 1, j, max((n + 7) // 8), sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, i // 8 AS j FROM up WHERE n > 1) GROUP BY lang, level, j),
sub AS (SELECT lang, level AS height, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
over AS (SELECT 0 AS level, i, n, h FROM sub
  UNION ALL SELECT level + 1, j, max((n + 7) // 8), sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, i // 8 AS j FROM over WHERE n > 1) GROUP BY level, j),
nodes AS (SELECT lang, false AS above, level, i, n, h FROM up UNION ALL SELECT s.lang, true, o.level, o.i, o.n, o.h FROM over o, sub s),
fold AS (SELECT doc_id, lang, leaf, false AS above, 0 AS level, i, n, CASE WHEN altered THEN low_leaf ELSE leaf END AS h, '' AS proof, i AS own FROM leaves
  UNION ALL SELECT doc_id, lang, leaf, above, level, i, n, h, proof, own FROM (
    SELECT f.doc_id, f.lang, f.leaf, f.above, f.level + 1 AS level, f.i // 8 AS i, (f.n + 7) // 8 AS n,
      sha256(string_agg(CASE WHEN u.i = f.i THEN f.h ELSE u.h END, '' ORDER BY u.i)) AS h,
      f.proof || coalesce(string_agg(u.h, '' ORDER BY u.i) FILTER (u.i <> f.i), '') AS proof, f.own
    FROM fold f JOIN nodes u ON u.lang IS NOT DISTINCT FROM f.lang AND u.above = f.above AND u.level = f.level AND u.i // 8 = f.i // 8
    WHERE f.n > 1 GROUP BY f.doc_id, f.lang, f.leaf, f.above, f.level, f.i, f.n, f.proof, f.own, f.h
    UNION ALL SELECT f.doc_id, f.lang, f.leaf, true, 0, s.i, s.n, f.h, f.proof, f.own
    FROM fold f JOIN sub s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1 AND NOT f.above))
SELECT f.doc_id, f.leaf, s.h AS subroot, o.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = o.h AS verified
FROM fold f JOIN sub s ON s.lang IS NOT DISTINCT FROM f.lang, over o WHERE f.above AND f.n = 1 AND o.n = 1
"""


@query("op12_merkle", _SQL)
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = manifest(table(spark, sf_dir, "documents"), F.when(chosen, F.translate("text", _UPPER, _LOWER)))
    root = rows.select("doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root")
    return root.withColumn("verified", F.col("folded_root") == F.col("root"))
