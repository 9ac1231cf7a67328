"""The Merkle manifest against plain recursion: ragged trees, several rounds, nulls, repeats, other columns."""

import hashlib
import random
import zlib

import pytest
from llm_helpers import make_docs  # noqa: F401
from pyspark.sql import functions as F

from revenue_lens.llm import merkle

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text) -> str:
    doc_id, _, lang, source, n = row
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)])


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest(*found[-1][k : k + 8]) for k in range(0, len(found[-1]), 8)])
    return found


def proof(tree, i):
    parts = []
    for nodes in tree[:-1]:
        first = i - i % 8
        parts += [x for k, x in enumerate(nodes[first : first + 8], first) if k != i]
        i //= 8
    return parts


def folded(value, i, tree):
    for nodes in tree[:-1]:
        first = i - i % 8
        run = [value if k == i else x for k, x in enumerate(nodes[first : first + 8], first)]
        value, i = digest(*run), i // 8
    return value


def plain(rows):
    """Sorted (doc_id, leaf, subroot, root, siblings, folded root) of (doc_id, text, lang, source, n_chars) rows."""
    by_lang = {}
    for r in rows:
        by_lang.setdefault(r[2], []).append(r)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    order = {lang: sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for lang in langs}
    trees = {lang: levels([leaf(r, r[1]) for r in order[lang]]) for lang in langs}
    top = levels([trees[lang][-1][0] for lang in langs])
    found = []
    for t, lang in enumerate(langs):
        for i, r in enumerate(order[lang]):
            altered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None
            start = leaf(r, r[1].translate(LOWER) if altered else r[1])
            found.append((r[0], leaf(r, r[1]), trees[lang][-1][0], top[-1][0], "".join(proof(trees[lang], i) + proof(top, t)), folded(folded(start, i, trees[lang]), t, top)))
    return sorted(found, key=repr)


def run(docs):
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = merkle.manifest(docs, F.when(chosen, F.translate("text", merkle._UPPER, merkle._LOWER)))
    places = [(F.col("place"), F.col("leaves")), (F.col("tree_place"), F.col("trees"))]
    back = merkle.folded(F.coalesce("altered_leaf", "leaf"), places, F.col("proof"))
    return sorted((tuple(r) for r in rows.select("doc_id", "leaf", "subroot", "root", "proof", back).collect()), key=repr)


def texts(n, seed=0):
    r = random.Random(seed)
    return ["".join(r.choice("abcXYZ é\n") for _ in range(r.randint(0, 30))) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 65, 1100])
def test_manifest_equals_recursion(spark, make_docs, n):
    rows = [(k * 7 % 5000, t, ("en", "de", None, "é")[k % 5 % 4], f"s{k % 3}", len(t)) for k, t in enumerate(texts(n))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert run(docs) == plain(rows)


def test_manifest_in_several_rounds(spark, monkeypatch, many_blocks):
    # Segments of 8 leaves: four rounds over 600 documents of one lang, two over 70 langs.
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "_BLOCK", 8)
    rows = [(k, t, "en" if k < 600 else f"l{k}", "s", None) for k, t in enumerate(texts(670))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert run(docs) == plain(rows)


def test_nulls_repeats_and_other_columns(spark):
    rows = [(None, "A", "en", None, 1), (3, None, None, "s", None), (3, "", "en", "s", 0), (4, "Same", "en", "s", 4), (4, "Same", "en", "s", 4), (4, "Other", "en", "s", 5), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    clashing = docs.withColumns({c: F.lit(c) for c in ("tree", "i", "leaves", "leaf", "digest", "proof", "root", "block")})
    assert run(clashing) == plain(rows)
    assert run(docs.limit(0)) == []


def test_proofs_are_folded_where_they_are_read(spark):
    """Proofs went to a second Python worker, which took an executor over its memory."""
    rows = [(k, t, "en" if k % 3 else None, "s", 1) for k, t in enumerate(texts(1200))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    found = merkle.manifest(docs, F.when(F.col("doc_id") % 2 == 0, F.lit("other")))
    assert "ArrowEvalPython" not in found._jdf.queryExecution().toString()
    places = [(F.col("place"), F.col("leaves")), (F.col("tree_place"), F.col("trees"))]
    back = found.select("doc_id", "root", "folded_root", merkle.folded(F.coalesce("altered_leaf", "leaf"), places, F.col("proof")).alias("back")).collect()
    assert len(back) == 1200 and all(r["folded_root"] == r["back"] and (r["root"] == r["back"]) == (r["doc_id"] % 2 == 1) for r in back)


def test_long_text(spark):
    rows = [(k, "Long " * 400_000 if k == 5 else "short", "en", "s", 1) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert run(docs) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 8, 9, 63, 64, 65, 200, 511, 512])
def test_places_are_the_order_of_completion(n):
    top = merkle.height(n)
    leaves = [hashlib.sha256(str(k).encode()).digest() for k in range(n)]
    log = merkle.append_log(leaves, top)
    tree = levels([x.hex() for x in leaves])
    seen = set()
    for level, nodes in enumerate(tree):
        for i, node in enumerate(nodes):
            p = merkle.place(level, i, n, top)
            assert log[32 * p : 32 * p + 32].hex() == node
            if level:  # behind its last child, before the next run
                assert p == merkle.place(level - 1, min(8 * i + 7, len(tree[level - 1]) - 1), n, top) + 1
            seen.add(p)
    assert seen == set(range(len(log) // 32))


def test_a_proof_of_another_length_is_refused():
    with pytest.raises(ValueError):
        merkle.fold(b"0" * 64, 0, 9, b"1" * 64)
