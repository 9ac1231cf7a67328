"""The operators against plain versions on small tables: nulls, empties, ties, repeats, empty tables, other columns."""

import hashlib
import random
from collections import Counter

import duckdb
import pytest
from conftest import SF_DIR
from llm_helpers import components, make_docs, shingles, unigrams  # noqa: F401
from pyspark.sql import functions as F

from revenue_lens.llm import benchmark_match, bit_sliced, interpolation, language, line_windows, minhash, reply_trees, source_mix, toxicity, warc
from revenue_lens.llm.queries import ORACLES, QUERIES

WORDS = [f"w{i}" for i in range(400)]
TABLES = "documents embeddings pages benchmark labels conversations".split()


def prose(seed, n):
    r = random.Random(seed)
    return [r.choice(WORDS) for _ in range(n)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    found = QUERIES[name](spark, SF_DIR)
    assert sorted(names) == sorted(found.columns)
    assert sorted(map(repr, (tuple(r) for r in found.select(*names).collect()))) == sorted(map(repr, cursor.fetchall()))


def test_minhash_equals_all_pairs(make_docs):
    rows, key = [], 0
    for base in range(6):
        text = prose(base, 60)
        for copy in range(5):
            w = list(text)
            for k in range(copy):  # each change costs five shingles
                w[(7 + 13 * k) % 60] = f"x{base}{copy}{k}"
            rows.append((key, " ".join(w)))
            key += 1
    rows += [(100, None), (101, ""), (102, " \n"), (103, "one two"), (104, "ONE\ttwo"), (105, "lone words only here"), (106, rows[0][1].upper()), (107, "é é é é é"), (107, "é é é é é")]
    found = minhash.near_duplicates(make_docs([*rows, (None, rows[3][1])]).withColumn("key", F.lit(1)).withColumn("root", F.lit("x"))).collect()
    want = components(dict(rows).items())
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None} == want
    assert [tuple(r)[1:] for r in found if r["doc_id"] is None] == [(56, None, True)]
    assert all(r["kept"] == (r["component_id"] in (None, r["doc_id"])) for r in found) and len(found) == len(rows) + 1


def test_minhash_links_the_two_with_short_tails_behind_one_passage(make_docs):
    # Every common bucket of the two holds many documents, which are not linked to each other.
    passage = " ".join(prose(11, 100))
    tails = {key: 12 if key in (131, 257) else 28 + key % 9 for key in range(300)}
    rows = [(key, f"{passage} " + " ".join(f"t{key}x{k}" for k in range(n))) for key, n in tails.items()]
    found = minhash.near_duplicates(make_docs(rows)).collect()
    want = components(rows)
    assert want[257][1] == 131 and len({c for _, c in want.values()}) == 299
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want


def test_minhash_prefix_join_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CELL", 3)
    base = prose(12, 60)
    rows = []
    for key in range(60):
        r = random.Random(key)
        w = [f"y{key}{k}" if r.random() < key % 5 / 60 else x for k, x in enumerate(base[: 40 + key % 4 * 5])]
        rows.append((key, " ".join(w), key // 7))
    sets = {key: set(shingles(text)) for key, text, _ in rows}
    root = {key: r for key, _, r in rows}
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    want = {(a, b) for a in sets for b in sets if a < b and root[a] != root[b] and alike(a, b)}
    texts = spark.createDataFrame([r[:2] for r in rows], "node bigint, text string")
    labels = spark.createDataFrame([(key, r) for key, r in root.items()], "node bigint, root bigint")
    found = minhash._by_rare_shingles(texts, labels).collect()
    assert want and want <= {(r["a"], r["b"]) for r in found}
    assert all(r["a"] < r["b"] and r["x"] < r["y"] and {r["x"], r["y"]} == {root[r["a"]], root[r["b"]]} for r in found)
    assert len({(r["a"], r["b"]) for r in found}) == len(found)


def test_minhash_of_an_empty_table(make_docs):
    assert minhash.near_duplicates(make_docs([])).collect() == []


def test_line_windows(make_docs):
    passage = "alpha line\nbeta line\ngamma line"
    rows = [(1, f"start\n{passage}\nend one"), (2, f"other\n\n{passage}\nend two"), (3, "\n".join(["same"] * 6)), (4, None), (5, ""), (None, "a\nb"), (6, passage), (6, passage)]
    docs = make_docs(rows).withColumn("gone", F.lit("kept column"))
    found = line_windows.remove_repeated_windows(docs).select("row.doc_id", "row.gone", "text", "n_lines", "n_removed").collect()
    got = Counter((r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in found)
    assert got == Counter({(1, rows[0][1], 5, 0): 1, (2, "other\n\nend two", 6, 3): 1, (3, "same\nsame\nsame", 6, 3): 1, (4, None, 0, 0): 1, (5, "", 1, 0): 1, (None, "a\nb", 2, 0): 1, (6, "", 3, 3): 2})
    assert {r["gone"] for r in found} == {"kept column"}
    assert line_windows.remove_repeated_windows(make_docs([])).collect() == []


def test_benchmark_windows(spark, make_docs):
    item, short = prose(1, 40), prose(2, 16)
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short)), (3, None), (4, ""), (5, "just three words")], "item_id bigint, text string")
    one_word = [*item[:20], "changed", *item[21:]]
    many = [w if i % 6 else "no" for i, w in enumerate(item)]
    rows = [
        (1, " ".join([*prose(3, 300), *item, *prose(4, 50)]).upper()),
        (2, " ".join([*prose(5, 80), *one_word])),
        (3, " ".join([*prose(6, 80), *many])),
        (4, " ".join(short)),
        (5, None),
        (6, ""),
        (7, "Just three\nwords"),
        (8, "just three words more"),
        (9, " ".join([*short, *prose(7, 2000), *item])),
    ]
    docs = make_docs(rows).withColumn("matches", F.lit(0))
    for slice_bytes in (benchmark_match.SLICE_BYTES, 100):
        found = {r["doc_id"]: [m["item_id"] for m in r["matches"]] for r in benchmark_match.with_matches(docs, items, slice_bytes).select("row.doc_id", "matches").collect()}
        assert {k: sorted(v) for k, v in found.items()} == {1: [1], 2: [1], 3: [], 4: [2], 5: [], 6: [], 7: [5], 8: [], 9: [1, 2]}
    assert benchmark_match.with_matches(make_docs([]), items).collect() == []
    assert {len(r["matches"]) for r in benchmark_match.with_matches(docs, items.limit(0)).collect()} == {0}


def test_every_fingerprint_within_the_radius_is_found():
    import numpy as np

    rng = np.random.default_rng(0)
    items = rng.integers(0, 2**63, 200).astype(np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, benchmark_match.RADIUS, replace=False)) for _ in items], dtype=np.uint64)
    w, i = benchmark_match.BlockIndex(items).within(items ^ flips)
    assert {(k, k) for k in range(200)} <= set(zip(w.tolist(), i.tolist()))


def test_mix(make_docs):
    rows = [(i, " ".join(prose(i, 5 + 37 * i % 900)), "en", f"s{i % 4}" if i % 9 else None) for i in range(120)] + [(500, None, "en", "s1"), (501, "", "en", "empty"), (502, "twice here", "en", "s1"), (502, "twice here", "en", "s1")]
    docs = make_docs(rows)
    found = source_mix.mixed_sizes(docs.withColumn("sid", F.lit(9)).withColumn("shard", F.lit(1))).collect()
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((i, len((t or "").split())) for i, t, *_ in rows)
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    sizes, source = Counter(), {i: s for i, _, _, s in rows}
    for i, t, _, s in rows:
        sizes[s] += len((t or "").split())
    # Shares by weight, filled up to twice the size.
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    left, open_, target = 1.5 * sum(sizes.values()), set(order), {}
    while open_:
        over = [s for s in open_ if left * weight[s] / sum(weight[o] for o in open_) >= 2 * sizes[s]]
        if not over:
            target |= {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= set(over)
    taken = Counter()
    for r in found:
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]]) and r["source_size"] == sizes[source[r["doc_id"]]]
        taken[source[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= source_mix.BLOCK_WORDS for s in order)
    again = source_mix.mixed_sizes(docs.repartition(5)).collect()
    assert Counter(map(repr, again)) == Counter(map(repr, found))
    assert source_mix.mixed_sizes(make_docs([])).collect() == []


def test_mixed_texts_hold_what_is_taken(make_docs):
    rows = [(i, "\n" + "  ".join(prose(i, 300 + 50 * i)), "en", f"s{i % 3}") for i in range(12)]
    pieces = source_mix.mixed_texts(make_docs(rows), shards=4).collect()
    whole = {i: t for i, t, *_ in rows}
    assert all(p["text"] in whole[p["doc_id"]] and len(p["text"].split()) == p["words"] for p in pieces)
    per_shard = Counter(p["shard"] for p in pieces)
    assert max(per_shard.values()) - min(per_shard.values()) <= 1
    assert len({(p["doc_id"], p["copy"], p["block"]) for p in pieces}) == len(pieces)


@pytest.mark.parametrize("shards", [1, 5])
def test_the_shards_hold_what_is_taken(make_docs, shards):
    rows = [(i, " ".join(prose(i, 20 + 97 * i % 2000)), "en", f"s{i % 3}") for i in range(60)]
    found = source_mix.mixed_sizes(make_docs(rows), shards).collect()
    per_shard = Counter()
    for r in found:
        assert r["taken"] == sum(x["words"] for x in r["shard_words"]) and len({x["shard"] for x in r["shard_words"]}) == len(r["shard_words"])
        per_shard.update({x["shard"]: x["words"] for x in r["shard_words"]})
    assert set(per_shard) == set(range(shards))
    assert {r["doc_id"]: r["taken"] for r in found} == {r["doc_id"]: r["taken"] for r in source_mix.mixed_sizes(make_docs(rows), 7).collect()}


def test_shard_of_a_draw(spark):
    ends = [0, 3, 3, 10, 11]
    rows = spark.range(13).select("id", source_mix._shard_of(F.array(*[F.lit(e).cast("bigint") for e in ends]), F.col("id"), len(ends)).alias("s")).collect()
    assert {r["id"]: r["s"] for r in rows} == {k: next((j for j, e in enumerate(ends) if e > k), len(ends)) for k in range(13)}


def test_a_tree_over_many_sources(spark):
    quotas = {k: 1 + k * 7 % 40 for k in range(2000)}
    ends = {r["sid"]: r["ends"] for r in source_mix.split_quotas(spark.createDataFrame(list(quotas.items()), "sid int, quota bigint"), 3).collect()}
    assert {s: e[-1] for s, e in ends.items()} == quotas
    per_shard = [sum(e[j] - (e[j - 1] if j else 0) for e in ends.values()) for j in range(3)]
    assert max(per_shard) - min(per_shard) <= 1


def test_split_quotas_adds_up(spark):
    quotas = {0: 1000, 1: 0, 2: 37, 3: 5000}
    for shards in (1, 3, 8):
        ends = {r["sid"]: r["ends"] for r in source_mix.split_quotas(spark.createDataFrame(list(quotas.items()), "sid int, quota bigint"), shards).collect()}
        assert {s: e[-1] for s, e in ends.items()} == quotas and all(e == sorted(e) and len(e) == shards for e in ends.values())
        sizes = [sum(e[j] - (e[j - 1] if j else 0) for e in ends.values()) for j in range(shards)]
        assert max(sizes) - min(sizes) <= 1


def test_hypergeometric_has_its_mean_and_deviation(spark):
    rows = spark.range(4000).select(source_mix.hypergeometric(F.lit(500).cast("bigint"), F.lit(120).cast("bigint"), F.lit(200).cast("bigint"), (F.col("id") + 0.5) / 4000).alias("x"))
    r = rows.agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).first()
    assert r["m"] == pytest.approx(48, abs=0.02) and r["s"] == pytest.approx((200 * 0.24 * 0.76 * 300 / 499) ** 0.5, rel=0.01)


def test_interpolation(spark, make_docs):
    rows = [(i, " ".join(prose(i % 40, 30 + i % 50))) for i in range(300)] + [(1000, None), (1001, ""), (1002, "neverseen words"), (1003, "Tab\tand\x0bline\n")]
    docs = make_docs(rows)
    remainder = interpolation.id_remainder(F.col("doc_id"), 10)
    role = F.when(remainder == 0, 0).when(remainder == 1, 2).otherwise(1)
    found = {r["doc_id"]: r for r in interpolation.scores(docs.withColumn("role", role).withColumn("block", F.lit(1))).collect()}
    want = unigrams(rows)
    assert found.keys() == want.keys()
    for i, (n, known, train, base) in want.items():
        r = found[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, train) and r["base_score"] == pytest.approx(base)
    assert sum(r["score"] for r in found.values()) > sum(r["base_score"] for r in found.values())
    assert interpolation.scores(make_docs([]).withColumn("role", F.lit(1))).collect() == []
    none = interpolation.scores(make_docs([(None, "a b")]).withColumn("role", F.lit(0))).first()
    assert (none["n_tokens"], none["n_known"], none["train_tokens"]) == (3, 0, 0)


def test_language_and_toxicity_without_anything_to_learn(spark, make_docs):
    docs = make_docs([(1, "some text", None), (2, None, None), (3, "123", None)])
    model = language.fit(docs)
    assert {r["p"]["lang_pred"] for r in docs.select(language.predicted(spark, model, F.col("text")).alias("p")).collect()} == {"und"}
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {round(r["s"], 3) for r in docs.select(toxicity.score_of(spark, toxicity.fit(docs, labels), F.col("text")).alias("s")).collect()} == {0.0}


def test_language_learns(spark, make_docs):
    makers = {"aa": "bal kor sin tem", "bb": "wuf zog pixy quo"}
    rows = [(i, " ".join(random.Random(i).choices(makers[l].split(), k=12)), l) for i in range(200) for l in [("aa", "bb")[i % 2]]]
    model = language.fit(make_docs(rows))
    docs = make_docs([*rows, (900, None), (901, "12 34"), (902, "")])
    found = {r["doc_id"]: r["p"] for r in docs.select("doc_id", language.predicted(spark, model, F.col("text")).alias("p")).collect()}
    assert all(found[i]["lang_pred"] == l for i, _, l in rows) and all(0 <= p["score"] <= 1 for p in found.values())
    assert {found[i]["lang_pred"] for i in (900, 901, 902)} == {"und"}


def test_language_learns_the_rare_ones_of_many(make_docs):
    docs = make_docs([(i, f"w{i % 230}x text", f"l{i % 230}") for i in range(460)])
    assert len(language.fit(docs).languages) == 230


def test_language_sample_ranks_few_rows(spark):
    marked = spark.range(50000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 1000 == 0, "bb").otherwise("aa").alias("lang"))
    hashed = sorted((r["h"], r["doc_id"], r["lang"]) for r in marked.withColumn("h", F.xxhash64("doc_id")).collect())
    want = {x[1] for l in ("aa", "bb") for x in [y for y in hashed if y[2] == l][:60]}
    picked = language._picked(marked, 60)
    assert {r["doc_id"] for r in picked.collect()} == want and len(want) == 110
    # The rows under the last window, which ranks by the whole hash.
    near = picked._jdf.queryExecution().optimizedPlan()
    while not near.toString().startswith("Window"):
        near = near.children().head()
    assert spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, near.children().head()).count() < 200


def test_toxicity_learns(spark, make_docs):
    rows = [(i, " ".join([*prose(i, 80), *(["vileword"] if i % 5 == 0 else [])])) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(300)] + [(0, None), (None, 1)], "doc_id bigint, toxic int")
    docs = make_docs([*rows, (None, "vileword"), (901, ""), (902, None)])
    model = toxicity.fit(docs, labels)
    found = {r["doc_id"]: r["s"] for r in docs.select("doc_id", toxicity.score_of(spark, model, F.col("text")).alias("s")).collect()}
    assert all((found[i] >= toxicity.THRESHOLD) == (i % 5 == 0) for i in range(300, 400))
    assert found[901] == found[902] < toxicity.THRESHOLD <= found[None]


def test_warc_round_trip(spark, tmp_path):
    big, odd = "é<p>\r\n\r\nWARC/1.1\r\n" * 3000, "x" * 1000
    rows = [(1, "http://a b\r\n", big), (5, None, big), (3, "u", big), (7, "u", None), (8, "u", ""), (9, "u", odd), (10, "u", odd), (11, "u", "x" * 999), (12, "u", "x" * 999), (None, "u", odd), (20, "u", odd + "y"), (20, "v", odd + "y")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("record", F.lit(0))
    warc.write_archives(pages, f"{tmp_path}/warc", chunk_bytes=1000)
    found = warc.resolved(warc.read_archives(spark, f"{tmp_path}/warc")).collect()
    size = lambda t: len((t or "").encode())
    digest = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    last = {1: 5, 3: 5, 9: 10}
    want = Counter((i, size(t), digest(t), "revisit" if i in last else "response", last.get(i)) for i, _, t in rows)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found) == want
    chunks = warc.chunked(pages, 1000).where("page_id = 1").orderBy("chunk").collect()
    assert b"".join(bytes(c["data"]) for c in chunks).decode() == big and max(len(c["data"]) for c in chunks) == 1000
    assert [c["digest"] for c in chunks][1] == hashlib.sha1(big.encode()[:2000]).hexdigest()


def test_warc_payloads_that_end_like_records(spark, tmp_path):
    ends = ["\r", "\n", "\r\n", "\r\n\r", "\r\n\r\n", "\n\r\n", "\r\r\n\r\n\r\n", ""]
    rows = [(k * 10 + n, "u", "x" * n + e) for k, e in enumerate(ends) for n in (0, 1, 7, 8)]
    for files, chunk_bytes in ((1, 4), (3, 1 << 16)):
        pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
        folder = f"{tmp_path}/{files}"
        warc.write_archives(pages, folder, chunk_bytes)
        found = {r["page_id"]: (r["payload_bytes"], r["payload_digest"]) for r in warc.read_archives(spark, folder).collect()}
        assert found == {i: (len(t), hashlib.sha1(t.encode()).hexdigest()) for i, _, t in rows}
    for page_id, _, t in rows[::8]:  # as the last record of a file
        warc.write_archives(pages.where(F.col("page_id") == page_id), f"{tmp_path}/last{page_id}", 4)
        assert [r["payload_bytes"] for r in warc.read_archives(spark, f"{tmp_path}/last{page_id}").collect()] == [len(t)]


def test_warc_of_an_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    warc.write_archives(pages, f"{tmp_path}/none")
    assert warc.resolved(warc.read_archives(spark, f"{tmp_path}/none")).collect() == []


def test_warc_refuses_broken_archives():
    reader = warc._Reader()
    with pytest.raises(ValueError):
        reader.take(b"no header")
    reader = warc._Reader()
    reader.take(b"WARC/1.1\r\nWARC-Type: revisit\r\nWARC-Record-ID: r\r\nWARC-Payload-Digest: sha1:0\r\nContent-Length: 0")
    with pytest.raises(ValueError):
        reader.take(b"more")


def test_top_k_equals_all_scores(spark):
    r = random.Random(3)
    rows = [(i, [r.choice([-0.5, 0.25, r.uniform(-1, 1)]) for _ in range(8)]) for i in range(0, 700)] + [(800, None), (801, [0.1, None]), (802, [float("nan")] * 8), (803, []), (None, [0.1] * 8), (900, [0.5] * 8), (900, [0.5] * 8), (950, [0.1, 0.2])]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("q", F.lit(1))
    found = bit_sliced.top_k(bit_sliced.index(vectors, 64), vectors.where("vec_id % 50 = 0"), 5)
    import numpy as np

    whole = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int)) for i, v in rows if i is not None and v and None not in v and v[0] == v[0]]
    want = []
    for q, v in whole:
        if q % 50 == 0:
            scores = sorted(((-int(v @ u), i) for i, u in whole if i != q and len(u) == len(v)))[:5]
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)]
    assert set(map(tuple, found.collect())) >= {w for w in want if w[0] != 900}
    sliced = bit_sliced.top_k(bit_sliced.index(vectors, 64), vectors.where("vec_id % 50 = 0"), 5, 40)  # several slices of queries
    assert sorted(map(tuple, sliced.collect())) == sorted(map(tuple, found.collect()))


def test_top_k_of_large_components(spark):
    r = random.Random(9)
    rows = [(i, [r.uniform(-5e6, 5e6), r.choice([0.0, 5e6, -3e6]), r.uniform(-1, 1)]) for i in range(120)]
    rows += [(200, [0.0, 0.0, 1e16]), (250, [0.0, 0.0, 0.004]), (201, [0.0, 0.0, -1e16])]
    queries = {i: v for i, v in rows if i in (0, 50, 100, 250)}
    whole = {i: [int(x) for x in (256 * y // 1 for y in v)] for i, v in rows}
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    small = vectors.where("abs(embedding[2]) < 1e10")
    want = []
    for q in queries:
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and (i < 200 or q == 250))[:5]
        want += [(q, k, i, -s) for k, (s, i) in enumerate(scores, 1)]
    found = [tuple(x) for x in bit_sliced.top_k(bit_sliced.index(small.where("vec_id < 200"), 64), small.where("vec_id IN (0, 50, 100)")).collect()]
    found += [tuple(x) for x in bit_sliced.top_k(bit_sliced.index(vectors, 64), vectors.where("vec_id = 250")).collect()]
    assert sorted(found) == sorted(want)
    with pytest.raises(Exception, match="does not fit"):
        bit_sliced.top_k(bit_sliced.index(vectors), vectors.where("vec_id = 200")).collect()


def test_top_k_of_an_empty_table(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<double>")
    assert bit_sliced.top_k(bit_sliced.index(none), none).collect() == []


def test_reply_paths(spark):
    schema = "tree_id bigint, node_id bigint, parent_id bigint, score double, role string, text string"
    rows = [(1, 10, None, 1.0, "user", "q"), (1, 11, 10, 2.0, "assistant", "a"), (1, 12, 10, 5.0, "assistant", "b"), (1, 13, 11, 4.0, "user", "c"), (2, 20, 99, None, "user", None), (3, 30, 31, 1.0, "user", "cycle"), (3, 31, 30, 1.0, "user", "cycle")]
    rows += [(4, 100 + i, 99 + i if i else None, 1.0, "user", str(i)) for i in range(40)]
    found = reply_trees.paths(spark.createDataFrame(rows, schema)).orderBy("tree_id", "branch", "pos").collect()
    lines = {}
    for r in found:
        lines.setdefault((r["tree_id"], r["branch"]), []).append(r["text"])
    assert lines == {(1, 1): ["q", "a", "c"], (1, 2): ["q", "b"], (2, 1): [None], (4, 1): [str(i) for i in range(40)]}
    assert reply_trees.paths(spark.createDataFrame(rows, schema), branches=1).select("tree_id", "branch").distinct().count() == 3
    with pytest.raises(ValueError):
        reply_trees.paths(spark.createDataFrame([rows[0], rows[0]], schema))


def test_conversations_come_back(spark):
    tricky = ["<|im_end|>\n", "<\\|im_start|>", "\\", "\\n<", "plain\n", None, "", "<|im_start|>assistant\nno"]
    rows = [(1, i, ("user", "assistant", "a\nb", None)[i % 4], t) for i, t in enumerate(tricky)] + [(None, 0, "assistant", "x"), (2, 0, "assistant", "twice"), (2, 0, "assistant", "twice"), (2, None, "user", "first")]
    given = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("leaf", F.lit(0))
    for part_chars in (10, 1 << 20):
        written = reply_trees.formatted(reply_trees.paths(reply_trees.conversation_turns(given)), part_chars)
        found = {r["tree_id"]: r for r in reply_trees.read_back(written).collect()}
        for key in (1, 2, None):
            turns = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0))
            text = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns)
            loss = "".join(r[3] or "" for r in turns if r[2] == "assistant")
            got = found[key]
            assert (got["n_turns"], got["turns_sha256"], got["loss_chars"], got["loss_sha256"]) == (len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_shingles_of_the_helper():
    assert len(shingles("a b c d e f")) == 2 and shingles("a B") == [(b"a", b"b")] and shingles(" ") == []
