"""Plain versions of the results, for small tables."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import pytest


def tokens(text) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(text) -> list[tuple]:
    w = tokens(text)
    return [tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))] if w else []


def components(docs) -> dict:
    """{doc_id: (set size, smallest reachable)} for (doc_id, text) pairs."""
    sets = {i: set(shingles(t)) for i, t in docs}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def unigrams(docs) -> dict:
    """{doc_id: (tokens, known, training tokens, base score)}"""
    seen = {i: [*tokens(t), None] for i, t in docs}
    counts = Counter(w for i, ws in seen.items() if zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {i: (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in seen.items()}


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def make_docs(spark):
    """Rows of (doc_id, text[, lang[, source]])."""

    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", None if r[1] is None else len(r[1])) for r in rows], DOCS)

    return make
