"""Ranked search against scoring every document: ties, copies, repeats, nulls, several blocks and slices."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revenue_lens.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = [f"w{i}" for i in range(60)] + ["é", "naïve", "日本", "x1", "the"]


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, best=20):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    found = []
    for item, text in items:
        asked = [t for t in terms(text) if df[t]]
        scored = []
        for i, c, n in counts:
            m = 75 + 25 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in asked if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        found += [(item, rank, None if none else i, -score) for rank, (score, none, i) in enumerate(sorted(scored)[:best], 1)]
    return sorted(found, key=repr)


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) if r.random() < 0.7 else f"rare{r.randint(0, 400)}" for _ in range(n))


def corpus():
    docs = [(k, prose(k, 1 + k * 13 % 90)) for k in range(300)]
    docs += [(1000 - k, "copied text w1 w2 rare7") for k in range(120)]  # equal scores, in falling order of id
    docs += [(2000, None), (2001, ""), (2002, " ..!"), (None, "copied text w1 rare8"), (None, "copied text w1 rare8"), (2003, "THE-w5_w5 É é"), (2003, "THE-w5_w5 É é"), (-5, "copied text w1 w2 rare7")]
    return docs


ITEMS = [(1, prose(9001, 30)), (2, prose(9002, 12)), (3, "copied text w1 w2"), (4, None), (5, ""), (6, "w5 w5 the É nowhere"), (6, "copied rare8"), (7, "nowhere else"), (None, "rare3 rare4")]


def tables(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")


def found(docs, items, **more):
    return sorted((tuple(r) for r in ranked_search.ranked(docs, items, **more).collect()), key=repr)


def test_ranked_equals_scoring_all(spark):
    docs, items = tables(spark, corpus(), ITEMS)
    assert found(docs.withColumns({"n": F.lit(1), "score": F.lit("x"), "term": F.lit(0)}), items.withColumn("item", F.lit(9))) == plain(corpus(), ITEMS)


def test_small_blocks_batches_and_slices(spark, monkeypatch, many_blocks):
    for name, value in (("BLOCK_DOCS", 16), ("BATCH", 2)):
        monkeypatch.setattr(ranked_search, name, value)
    docs, items = tables(spark, corpus(), ITEMS)
    assert found(docs.repartition(5), items, best=3, slice_bytes=100) == plain(corpus(), ITEMS, 3)


def test_empty_tables(spark):
    docs, items = tables(spark, corpus()[:9], ITEMS)
    assert found(docs.limit(0), items) == found(docs, items.limit(0)) == found(docs.where("text = 'nothing'"), items) == []


def test_long_text(spark):
    rows = [(1, prose(1, 300_000)), (2, prose(2, 40)), (3, "w1 " * 500_000)]
    docs, items = tables(spark, rows, ITEMS)
    assert found(docs, items) == plain(rows, ITEMS)


def test_bounds_leave_most_documents_out(monkeypatch):
    import numpy as np

    offered = []
    monkeypatch.setattr(ranked_search.Best, "offer", lambda self, scores, *more, keep=ranked_search.Best.offer: (offered.append(len(scores)), keep(self, scores, *more)))
    r = random.Random(5)
    numbers = {f"t{k}".encode(): k for k in range(300)}
    block = ranked_search._Block()
    for k in range(4000):
        block.add(k, " ".join(f"t{min(int(r.expovariate(0.03)), 299)}" for _ in range(40)).encode(), numbers)
    segment = {n: c[0].as_buffer() for n, c in zip(block.segment().schema.names, block.segment().columns) if n not in ("docs", "length")}
    items = ranked_search.Items([0], [np.array([250, 280, 299, 3])], [np.ones(4, np.int64)], None, block.docs, block.length)
    df = np.bincount(np.frombuffer(segment["terms"], np.int32), minlength=300)
    items.weights = ranked_search.weights(df, block.docs)
    best = ranked_search.Best(20)
    ranked_search.BlockSearch(segment, items).search(items.terms[0], items.repeats[0], best)
    assert best.full() and sum(offered) < 1000


@pytest.mark.parametrize("n", [1, 2, 7, 33])
def test_range_maxima(n):
    import numpy as np

    values = np.random.default_rng(n).integers(0, 5, n)
    tables_ = ranked_search.SparseTables(values, n)
    for low in range(n):
        for high in range(low + 1, n + 1):
            assert tables_.argmax(np.array([low]), np.array([high]))[0] == low + int(values[low:high].argmax())


def test_length_norms_beyond_64_bits():
    import numpy as np

    big = ranked_search.length_norms(np.array([10**9, 1]), 5 * 10**10, 10**13)
    assert big.tolist() == [75 + 25 * 10**9 * 5 * 10**10 // 10**13, 75]
