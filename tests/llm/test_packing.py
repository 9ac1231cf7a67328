"""Packing: every id once and in place, all three limits, little padding, ids as the library gives them."""

import random
from collections import defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from revenue_lens.llm import packing
from revenue_lens.llm.packing import Limits

BYTES = packing.tokenizer_file(public_tokenizers.path("byte_bpe_50k.json"))
WORDS = packing.tokenizer_file(public_tokenizers.path("word_bpe_49k.json"))
PARTS = ["a", "Foo", "don't", "é", " ", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\x1c", "\x85", "　", "日本", "1", "23", "!", ".", "'s", "<|endoftext|>", "zzz,", " b", "x\ny"]


library = lru_cache(Tokenizer.from_str)


def by_library(content, text):
    return library(content).encode(text or "", add_special_tokens=False).ids + [0]


@pytest.mark.parametrize("part_bytes", [12, 1 << 20])
def test_ids_are_those_of_the_library(monkeypatch, part_bytes):
    monkeypatch.setattr(packing, "PART_BYTES", part_bytes)
    own, r = packing.TextIds(BYTES), random.Random(part_bytes)
    assert own.ranked is not None
    for parts in (PARTS, ["foo", "Bar", " ", " ", " ", "\n", ".", "é"]):
        texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(3000)] + [None, ""]
        for first in range(0, len(texts), 500):
            some = texts[first : first + 500]
            ids, starts = own.of_texts(pa.array(some, pa.string()))
            assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [by_library(BYTES, t) for t in some]


def test_other_tokenizers_are_left_to_the_library():
    own = packing.TextIds(WORDS)
    ids, starts = own.of_texts(pa.array(["Some text, and more", None]))
    assert own.ranked is None and ids.tolist() == by_library(WORDS, "Some text, and more") + [0] and starts.tolist() == [0, len(ids) - 1, len(ids)]


def checked(rows, docs, limits, content=BYTES):
    """The rows cover the documents and keep the limits; returns the lengths of the sequences."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    want = defaultdict(list)
    for i, text in docs:
        want[i].append(by_library(content, text))
    for i, copies in want.items():
        # Repeated rows: each document's ids as often as it comes.
        assert sum(r["length"] for r in pieces[i]) == sum(map(len, copies))
        if len(copies) == 1:
            found = sorted(pieces[i], key=lambda r: r["start"])
            assert [r["start"] for r in found] == np.cumsum([0, *[r["length"] for r in found]])[:-1].tolist()
            assert np.frombuffer(b"".join(r["ids"] for r in found), "<u4").tolist() == copies[0]
            assert {r["doc_tokens"] for r in found} == {len(copies[0])}
    assert set(pieces) == set(want)
    sizes = []
    for members in sequences.values():
        members.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in members] == np.cumsum([0, *[r["length"] for r in members]])[:-1].tolist()
        assert all(r["loss_tokens"] == r["length"] - (r["start"] == 0) for r in members)
        sizes.append(sum(r["length"] for r in members))
        assert sizes[-1] <= limits.tokens and len(members) <= limits.segments and sum(r["loss_tokens"] for r in members) <= limits.loss
    return sizes


def documents():
    r = random.Random(3)
    docs = [(k, " ".join(r.choice(["alpha", "beta", "gam-ma", "délta", "e\nf", "g  h"]) for _ in range(int(r.expovariate(1 / 60))))) for k in range(400)]
    return docs + [(900, "long words here " * 5000), (901, None), (902, ""), (903, "twice"), (903, "twice"), (None, "no id")]


@pytest.mark.parametrize("limits", [Limits(), Limits(256, 4, 200), Limits(128, 64, 128), Limits(100, 3, 7)])
def test_packed_documents(spark, limits):
    docs = spark.createDataFrame(documents(), "doc_id bigint, text string").repartition(2)
    rows = packing.packed_documents(docs.withColumns({"ids": F.lit(1), "start": F.lit("x")}), BYTES, limits).collect()
    sizes = checked(rows, documents(), limits)
    if limits.segments >= 64:  # the other limits leave room; without padding but at powers of two
        assert all(n in (limits.tokens, n & -n) for n in sizes)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string, tokens bigint, loss_tokens bigint")
    assert packing.packed_documents(empty, BYTES).collect() == packing.packed_examples(empty).collect() == []


def test_long_text_in_parts(spark):
    text = "some long text with ordinary words. " * 60_000 + "\n\n" + "x" * 50_000
    rows = packing.packed_documents(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), BYTES).collect()
    checked(rows, [(1, text)], Limits())


def test_whole_examples_keep_all_limits(spark):
    r = random.Random(8)
    rows = [(k, r.randint(0, 300), None) for k in range(1500)]
    rows = [(k, n, r.randint(0, n)) for k, n, _ in rows] + [(-1, 2000, 10), (-2, 500, 400), (-3, None, None)]
    limits = Limits(1024, 12, 300)
    examples = spark.createDataFrame(rows, "key bigint, tokens bigint, loss_tokens bigint").repartition(2)
    sequences = defaultdict(list)
    for x in packing.packed_examples(examples, limits).collect():
        sequences[x["sequence_id"]].append(x)
    assert sorted(x["key"] for s in sequences.values() for x in s) == sorted(k for k, *_ in rows)
    n = 0
    for s in sequences.values():
        if any(x["oversize"] for x in s):
            assert len(s) == 1 and s[0]["key"] in (-1, -2)
            continue
        n += 1
        s.sort(key=lambda x: (x["offset"], x["tokens"] or 0))
        assert [x["offset"] for x in s] == np.cumsum([0, *[x["tokens"] or 0 for x in s]])[:-1].tolist()
        assert sum(x["tokens"] or 0 for x in s) <= 1024 and len(s) <= 12 and sum(x["loss_tokens"] or 0 for x in s) <= 300
    least = max(sum(x[1] for x in rows[:1500]) / 1024, sum(x[2] for x in rows[:1500]) / 300, 1500 / 12)
    assert n <= 1.1 * least + 2


def test_the_dot_product_weighs_all_limits():
    # By tokens alone the large ones would come first and leave no room for their loss-heavy partners.
    packer = packing.Packer(Limits(100, 10, 45), cut=False)
    for k in range(50):
        packer.add(("tokens", k), 60, 5)
    for k in range(50):
        packer.add(("loss", k), 40, 40)
    packer.finish()
    kinds = defaultdict(list)
    for (kind, _), _, _, sequence, _ in packer.placed:
        kinds[sequence].append(kind)
    assert packer.next == 50 and all(sorted(k) == ["loss", "tokens"] for k in kinds.values())


def test_limits_that_admit_nothing(spark):
    with pytest.raises(ValueError):
        packing.packed_documents(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"), BYTES, Limits(segments=0))
