"""Mixing sources to target weights: exact block quotas, dealt to output shards by a splitting tree.

Documents are cut into blocks of 256 words and the blocks of a source are put in a random order that depends
on their content only. A source whose target is below its size draws a prefix of that order; above it,
every block once and a prefix twice. That gives the source's exact quota of blocks. A binary tree then
splits the quotas of all sources at once: a node with its share of output shards gives its left child a
multivariate hypergeometric draw, so the shards are distributed as if all drawn blocks had been shuffled
together and cut into equal parts. The order of a source, cut at its quotas, gives every shard disjoint
blocks, which are shuffled inside the shard. Only DataFrame functions are used.

What a source takes is within half a block of its target; it is what the shards hold, so a draw that no shard has room
for would be missing. There are as many shards as the drawn words ask for, each a partition of the result. Quotas are one
array with a number per source for each node of the tree, and one with a number per shard for each source; nothing
else is gathered, and a draw finds its shard by halving.

Nulls and empties: null and empty texts have size 0 and take nothing; a null source is a source of its own and
comes last; a null doc_id is like any other. Rows that repeat everything have blocks of their own, and which of
them is drawn more often is arbitrary. An empty table gives an empty mix. Other columns pass through.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revenue_lens.llm.catalog import query, table
from revenue_lens.operators.storage import materialize

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS = 256
#: Drawn words of an output shard, some 50 MB of text.
SHARD_WORDS = 1 << 23
#: Blocks of a source that are put in order in one group.
BUCKET_BLOCKS = 4096
_WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """Stored (row_id, doc_id, source, th, size) per row of ``docs(doc_id, text, source, ...)``."""
    size = F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit(_WORD)))
    return materialize(docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", F.col("source").cast("string").alias("source"), F.xxhash64(F.col("text").cast("string")).alias("th"), size.cast("bigint").alias("size")))


def targets(sizes: DataFrame) -> DataFrame:
    """(sid, source, source_size, blocks, target) per source: shares by weight, none above ``MOST`` times its
    size, the rest shared again. A row per source; the windows run over that table only."""
    blocks = F.ceil(F.col("size") / BLOCK_WORDS)
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(blocks).alias("blocks"))
    sid = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    sources = sources.withColumn("sid", sid).withColumn("weight", weight).withColumn("cap", F.col("source_size") * MOST)
    # Sources fill up in the order of cap / weight; the level is what an open source takes for a weight of 1.
    order = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    whole = Window.partitionBy(F.lit(0))
    filled = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    still_open = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (F.sum("source_size").over(whole) * SHARE - filled) / still_open
    sources = sources.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct(F.col("cap") / F.col("weight"), F.col("sid"), F.col("level")))
    sources = sources.withColumn("level", F.min(fits).over(whole)["level"])
    target = F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap")))
    return sources.select("sid", "source", "source_size", "blocks", target.alias("target"))


def _uniform(*keys: Column) -> Column:
    """In (0, 1), from the keys alone."""
    return (F.shiftrightunsigned(F.xxhash64(*keys), 12).cast("double") + 0.5) / float(2**52)


def hypergeometric(population: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``good`` are among ``draws`` out of ``population``, at quantile ``u``.

    The probabilities follow from each other, upwards from eight deviations below the mode to
    eight above (all values, where there are fewer); what lies beyond weighs less than 1e-14.
    """
    n, k, d = population.cast("double"), good.cast("double"), draws.cast("double")
    some = F.greatest(F.lit(1.0), n)
    spread = F.sqrt(F.greatest(F.lit(0.0), d * k / some * (n - k) / some * (n - d) / F.greatest(F.lit(1.0), n - 1))) * 8 + 8
    mode = F.floor((d + 1) * (k + 1) / (n + 2))
    low = F.greatest(F.lit(0).cast("bigint"), draws - (population - good), F.ceil(mode - spread))
    high = F.greatest(low, F.least(draws, good, F.floor(mode + spread)))
    values = F.when(population > 0, F.sequence(low, high)).otherwise(F.array(F.lit(0).cast("bigint")))

    def later(acc, x):
        return acc["p"] * (acc["k"] - x) * (acc["d"] - x) / ((x + 1) * (acc["n"] - acc["k"] - acc["d"] + x + 1))

    given = [n.alias("n"), k.alias("k"), d.alias("d")]
    carried = lambda acc: [acc[c].alias(c) for c in "nkd"]
    total = F.aggregate(
        values,
        F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), *given),
        lambda acc, x: F.struct(F.coalesce(later(acc, x), F.lit(0.0)).alias("p"), (acc["sum"] + acc["p"]).alias("sum"), *carried(acc)),
        lambda acc: acc["sum"],
    )
    return F.aggregate(
        values,
        F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), *given, (u * total).alias("goal"), F.lit(-1).cast("bigint").alias("at"), F.lit(0).cast("bigint").alias("last")),
        lambda acc, x: F.struct(
            F.coalesce(later(acc, x), F.lit(0.0)).alias("p"),
            (acc["sum"] + acc["p"]).alias("sum"),
            *carried(acc),
            acc["goal"].alias("goal"),
            F.when((acc["at"] < 0) & (acc["sum"] + acc["p"] >= acc["goal"]), x).otherwise(acc["at"]).alias("at"),
            x.alias("last"),
        ),
        lambda acc: F.when(acc["at"] < 0, acc["last"]).otherwise(acc["at"]),
    )


def _first_draws(quotas: Column, draws: Column, *keys: Column) -> Column:
    """A multivariate hypergeometric draw: how many of each source are among ``draws``."""
    zero = F.lit(0).cast("bigint")
    start = F.struct(F.aggregate(quotas, zero, lambda x, y: x + y).alias("population"), draws.cast("bigint").alias("draws"), F.array().cast("array<bigint>").alias("out"))

    def step(acc, quota):
        # One element, so that the draw is computed once and both the rest and the list take it.
        drawn = F.array(hypergeometric(acc["population"], quota, acc["draws"], _uniform(*keys, F.size(acc["out"]))))
        after = F.transform(drawn, lambda x: F.struct((acc["population"] - quota).alias("population"), (acc["draws"] - x).alias("draws"), F.concat(acc["out"], F.array(x)).alias("out")))
        return F.get(after, F.lit(0))

    return F.aggregate(quotas, start, step, lambda acc: acc["out"])


def split_quotas(quotas: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """(sid, ends) from ``quotas(sid, quota)``: ``ends[j]`` draws of a source go to shards 0..j. Sources are
    numbered from 0 without gaps."""
    listed = F.array_sort(F.collect_list(F.struct("sid", "quota")))  # a number per source
    nodes = quotas.agg(listed.alias("q")).select(F.transform("q", lambda x: x["quota"].cast("bigint")).alias("q"), F.aggregate("q", F.lit(0).cast("bigint"), lambda a, x: a + x["quota"]).alias("total"), F.lit(0).alias("low"), F.lit(shards).alias("n"))
    upto = lambda shard: F.floor(shard * F.col("total") / shards).cast("bigint")
    for _ in range((shards - 1).bit_length()):  # levels of the tree
        half = F.floor(F.col("n") / 2).cast("int")
        draws = upto(F.col("low") + half) - upto(F.col("low"))
        drawn = F.when(half > 0, _first_draws(F.col("q"), draws, F.lit(seed), F.col("low"), F.col("n")))
        nodes = nodes.select("*", drawn.alias("drawn"), half.alias("half"))
        left = F.struct(F.col("drawn").alias("q"), "total", "low", F.col("half").alias("n"))
        right = F.struct(F.zip_with("q", "drawn", lambda a, b: a - b).alias("q"), "total", (F.col("low") + F.col("half")).alias("low"), (F.col("n") - F.col("half")).alias("n"))
        nodes = materialize(nodes.select(F.inline(F.when(F.col("half") > 0, F.array(left, right)).otherwise(F.array(F.struct("q", "total", "low", "n"))))))
    each = nodes.select("low", F.posexplode("q").alias("sid", "part"))
    parts = each.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("low", "part"))).alias("parts"))  # a number per shard
    ends = F.aggregate("parts", F.array().cast("array<bigint>"), lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0).cast("bigint")) + x["part"])))
    return parts.select("sid", ends.alias("ends"))


def _placed(sizes: DataFrame, goals: DataFrame, seed: int) -> DataFrame:
    """Stored (row_id, sid, block, words, place, blocks, copies) per block: its place in its source's order
    and how often it is drawn."""
    goal = goals.where("source_size > 0")
    blocks = sizes.where("size > 0").join(goal, sizes["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    blocks = blocks.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("size") / BLOCK_WORDS) - 1)))
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "th", "block"), 1)
    bucket = F.floor(F.shiftright("key", 32) * F.ceil(F.col("blocks") / BUCKET_BLOCKS) / float(2**31))
    blocks = blocks.select("row_id", "sid", "block", F.least(F.lit(BLOCK_WORDS), F.col("size") - F.col("block") * BLOCK_WORDS).cast("bigint").alias("words"), "blocks", "source_size", "target", key.alias("key"))
    blocks = blocks.withColumn("bucket", bucket.cast("bigint"))
    buckets = blocks.groupBy("sid", "bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("words").alias("w"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    starts = buckets.select("sid", "bucket", F.coalesce(F.sum("n").over(before), zero).alias("n_before"), F.coalesce(F.sum("w").over(before), zero).alias("w_before"))
    inside = Window.partitionBy("sid", "bucket").orderBy("key", "row_id", "block")
    ranked = blocks.withColumn("rank", F.row_number().over(inside)).withColumn("upto", F.sum("words").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    full = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - full * F.col("source_size")
    extra = (F.col("w_before") + F.col("upto") - F.col("words") / 2 <= rest).cast("bigint")
    return materialize(
        ranked.join(starts, ["sid", "bucket"]).select("row_id", "sid", "block", "words", (F.col("n_before") + F.col("rank") - 1).alias("place"), "blocks", (full + extra).cast("bigint").alias("copies"))
    )


def _shard_of(ends: Column, draw: Column, shards: int) -> Column:
    """The first shard whose end lies beyond ``draw``; ``shards`` if none does."""
    start = F.struct(F.lit(0).alias("low"), F.lit(shards).alias("high"))

    def halve(acc, _):
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        beyond = F.get(ends, middle) > draw
        low = F.when(~beyond & (acc["low"] < acc["high"]), middle + 1).otherwise(acc["low"])
        return F.struct(low.alias("low"), F.when(beyond, F.least(middle, acc["high"])).otherwise(acc["high"]).alias("high"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards.bit_length())), start, halve, lambda acc: acc["low"])


def shards_of(goals: DataFrame) -> int:
    """Shards that the targets ask for."""
    words = goals.agg(F.sum("target")).first()[0] or 0.0
    return max(1, math.ceil(words / SHARD_WORDS))


def mix(sizes: DataFrame, goals: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """(row_id, block, words, copy, shard, mix_key): a row per drawn block; inside a shard, ``mix_key`` is the order."""
    placed = _placed(sizes, goals, seed)
    quotas = goals.select("sid").join(placed.groupBy("sid").agg(F.sum("copies").alias("quota")), "sid", "left").select("sid", F.coalesce("quota", F.lit(0).cast("bigint")).alias("quota"))
    ends = split_quotas(quotas, shards, seed)
    draws = placed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))).withColumn("draw", F.col("copy") * F.col("blocks") + F.col("place"))
    dealt = draws.join(ends, "sid").withColumn("shard", _shard_of(F.col("ends"), F.col("draw"), shards)).where(F.col("shard") < shards)
    return dealt.select("row_id", "block", "words", "copy", "shard", F.xxhash64(F.lit(seed + 1), "sid", "draw").alias("mix_key"))


def mixed_sizes(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """(doc_id, size, source_size, target, taken, shard_words) per row of ``docs(doc_id, text, source, ...)``; ``shard_words``
    lists the words that each shard holds of it."""
    sizes = sized(docs)
    goals = materialize(targets(sizes))
    drawn = mix(sizes, goals, shards or shards_of(goals)).groupBy("row_id", "shard").agg(F.sum("words").alias("words"))
    parts = F.array_sort(F.collect_list(F.struct("shard", "words"))).alias("shard_words")  # at most twice the blocks of one document
    taken = drawn.groupBy("row_id").agg(F.sum("words").alias("taken"), parts)
    per_source = goals.select(F.col("source").alias("of"), "source_size", "target")
    rows = sizes.join(per_source, F.col("source").eqNullSafe(F.col("of"))).join(taken, "row_id", "left")
    none = F.array().cast("array<struct<shard:int,words:bigint>>")
    return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken"), F.coalesce("shard_words", none).alias("shard_words"))


def mixed_texts(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """(shard, mix_key, doc_id, source, copy, block, words, text): the mix itself, shard by shard in its order.

    Word ``i`` of a document comes with the white space behind it, so the blocks of a document,
    put together, are its text from its first word on.
    """
    sizes = sized(docs)
    goals = materialize(targets(sizes))
    shards = shards or shards_of(goals)
    drawn = mix(sizes, goals, shards)
    per_row = drawn.groupBy("row_id").agg(F.collect_list(F.struct("shard", "mix_key", "copy", "block", "words")).alias("draws"))  # at most twice the blocks of one document
    wanted = sizes.join(per_row, "row_id").groupBy("doc_id", "source", "th").agg(F.flatten(F.collect_list("draws")).alias("draws"))
    text = docs.select(F.col("doc_id").alias("id"), F.col("source").cast("string").alias("of"), F.col("text").cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    # Rows that repeat id, source and text share one list of draws: one of them is enough.
    text = text.groupBy("id", "of", "hash").agg(F.first("text").alias("text"))
    match = F.col("id").eqNullSafe(F.col("doc_id")) & F.col("of").eqNullSafe(F.col("source")) & F.col("hash").eqNullSafe(F.col("th"))
    pieces = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    # inline() puts the words in a column of their own, so that they are not searched again for each block.
    split = wanted.join(text, match).select("doc_id", "source", "draws", F.inline(F.array(F.struct(pieces.alias("pieces")))))
    cut = F.transform("draws", lambda d: F.struct(d["shard"], d["mix_key"], d["copy"], d["block"], d["words"], F.array_join(F.slice("pieces", (d["block"] * BLOCK_WORDS + 1).cast("int"), BLOCK_WORDS), "").alias("text")))
    rows = split.select("doc_id", "source", F.inline(cut).alias("shard", "mix_key", "copy", "block", "words", "text"))
    return rows.select("shard", "mix_key", "doc_id", "source", "copy", "block", "words", "text").repartitionById(shards, F.col("shard")).sortWithinPartitions("mix_key")


@query("op9_source_mix")
def op9_source_mix(spark, sf_dir) -> DataFrame:
    """``shard_words`` as text: shard:words of every shard that holds words of the document."""
    parts = F.transform("shard_words", lambda x: F.concat_ws(":", x["shard"].cast("string"), x["words"].cast("string")))
    return mixed_sizes(table(spark, sf_dir, "documents")).withColumn("shard_words", F.array_join(parts, " "))
