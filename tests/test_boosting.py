"""Histogram boosting and the Shapley values of its trees, against plain versions on small tables."""

import heapq
import math
import pickle
from dataclasses import replace
from itertools import combinations

import numpy as np
import pytest
from pyspark import RDD, SparkContext
from pyspark.ml import PipelineModel
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql import functions as F

from revenue_lens.operators import boosting, tree_shapley
from revenue_lens.operators.boosting import BoostedTreesModel, Booster, Tree
from revenue_lens.sources.registry import ModelRegistry

FEATURES = ["a", "b", "c"]
PLAIN = Booster("m", 4, 0.3, "w", max_depth=3, min_rows=5)


def points(n=260, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 40, n) / 4, rng.normal(size=n), rng.integers(0, 3, n).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(a / 3 - 1.5 + b * (c - 1))))).astype(int)
    return [(i, int(y[i]), i % 5, float(a[i]), float(b[i]), float(c[i]), 0.5 + (i % 7) / 4, 1.0) for i in range(n)]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(points(), "key long, y int, fold int, a double, b double, c double, w double, v double").cache()


def fit(rows, *boosters, **more):
    return boosting.fit(rows, FEATURES, "y", "key", list(boosters), seed=3, **more)


def plain_trees(data, booster, cuts):
    """The same model by sorting every node's rows; for boosters without samples."""
    keep = [r for r in data if r[2] != booster.fold]
    x = np.array([r[3:6] for r in keep])
    bins = np.stack([np.searchsorted(cuts[j], x[:, j]) for j in range(3)], axis=1)
    y, w = np.array([r[1] for r in keep]), np.array([round(r[6 if booster.weight == "w" else 7] * boosting.UNIT) for r in keep])
    margin = np.full(len(keep), math.log(w[y == 1].sum() / w[y == 0].sum()))
    found = []
    for _ in range(booster.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = (p - y) * w / boosting.UNIT, p * (1 - p) * w / boosting.UNIT

        def best(index, depth):
            if depth >= booster.max_depth:
                return None
            score = lambda i: g[i].sum() ** 2 / (h[i].sum() + booster.l2)
            top = None
            for f in range(3):
                for cut in range(len(cuts[f])):
                    left, right = index[bins[index, f] <= cut], index[bins[index, f] > cut]
                    if min(len(left), len(right)) >= booster.min_rows and min(h[left].sum(), h[right].sum()) >= booster.min_hessian:
                        gain = score(left) + score(right) - score(index)
                        if gain > 1e-9 and (top is None or gain > top[0] + 1e-9):
                            top = gain, f, cut, left, right
            return top

        leaves, heap, count = {0: np.arange(len(keep))}, [], 1
        if top := best(leaves[0], 0):
            heap.append((-top[0], 0, 0, top))
        while heap and len(leaves) < booster.max_leaves:
            _, node, depth, (_, _, _, left, right) = heapq.heappop(heap)
            del leaves[node]
            for part in (left, right):
                leaves[count] = part
                if top := best(part, depth + 1):
                    heapq.heappush(heap, (-top[0], count, depth + 1, top))
                count += 1
        for part in leaves.values():
            margin[part] -= booster.rate * g[part].sum() / (h[part].sum() + booster.l2)
        found.append(len(leaves))
    return margin, [r[0] for r in keep], found


@pytest.mark.parametrize("booster", [PLAIN, replace(PLAIN, max_depth=20, max_leaves=7), replace(PLAIN, l2=1.0, min_hessian=1.0, weight="v", fold=2)])
def test_trees_equal_a_search_over_all_splits(rows, booster):
    run = fit(rows, replace(booster, fold=None), booster) if booster.fold is not None else fit(rows, booster)
    fitted = run.models["m"]
    margin, keys, leaves = plain_trees(points(), booster, fitted.cuts)
    if booster.fold is None:
        assert [int((t.feature < 0).sum()) for t in fitted.trees] == leaves
        scored = rows.withColumn("m", BoostedTreesModel.of(fitted).margin())
        found = {r["key"]: r["m"] for r in scored.collect()}
        assert [found[k] for k in keys] == pytest.approx(margin.tolist(), abs=1e-4)
    else:
        held = [r for r in run.held_out.collect() if r["model"] == "m"]
        assert sum(r["n"] for r in held) == sum(r[2] == 2 for r in points())


BOOSTERS = [
    replace(PLAIN, name="depth", row_share=0.85, feature_share=0.7),
    replace(PLAIN, name="fold", row_share=0.85, feature_share=0.7, fold=1),
    replace(PLAIN, name="leaves", max_depth=30, max_leaves=9, weight="v", rounds=3),
]


def test_tasks_and_jobs_grow_the_same_trees(rows, monkeypatch, many_blocks):
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    monkeypatch.setattr(boosting, "DIRECT_BLOCKS", 2)
    one, many = fit(rows, *BOOSTERS), fit(rows.repartition(7), *BOOSTERS, block_rows=60)
    for name in ("depth", "leaves"):
        for a, b in zip(one.models[name].trees, many.models[name].trees, strict=True):
            assert all(np.array_equal(getattr(a, c), getattr(b, c)) for c in vars(a))
    assert sorted(map(tuple, one.held_out.collect())) == sorted(map(tuple, many.held_out.collect()))
    assert all((t.feature < 0).sum() <= 9 for t in one.models["leaves"].trees) and len(one.models["leaves"].trees) == 3


def test_tables_of_several_blocks_still_go_to_a_task_per_model(rows, monkeypatch):
    """Up to BLOCK_ROWS no step is a job: 90,000 customers made thousands of jobs of two tasks."""
    monkeypatch.setattr(boosting, "JOB_ROWS", 60)
    monkeypatch.setattr(boosting, "_grown_by_jobs", None)
    assert boosting.BLOCK_ROWS >= 1 << 20
    assert len(fit(rows, *BOOSTERS).models["depth"].trees) == 4


def test_the_driver_gets_splits_only(rows, monkeypatch, many_blocks):
    """A histogram of a node takes 3 * 256 numbers a feature; of each wanted node only its best split may come back."""
    sizes = []
    collect = RDD.collect

    def counted(self):
        found = collect(self)
        sizes.append((len(pickle.dumps(found)), sum(len(s[0]) for _, s in found)))
        return found

    monkeypatch.setattr(RDD, "collect", counted)
    monkeypatch.setattr(RDD, "treeReduce", None)
    fit(rows, replace(PLAIN, rounds=1), block_rows=60)
    assert len(sizes) == 3 and all(size < 1000 + 200 * nodes for size, nodes in sizes)


def test_the_block_of_the_tasks_stays_out_of_the_driver(rows, monkeypatch):
    """It holds up to 32 MB; the tasks read it from storage, each for its own model."""
    sizes = []
    collect = DataFrame.collect

    def counted(self):
        found = collect(self)
        sizes.append(len(pickle.dumps(found)))
        return found

    expected = fit(rows, *BOOSTERS)
    monkeypatch.setattr(SparkContext, "broadcast", None)
    monkeypatch.setattr(DataFrame, "collect", counted)
    monkeypatch.setattr(DataFrame, "first", None)
    monkeypatch.setattr(boosting, "_grown_by_jobs", None)
    many = [replace(b, name=f"{b.name}{k}") for k in range(3) for b in BOOSTERS]
    found = fit(rows, *many)
    for name in ("depth", "leaves"):
        for a, b in zip(expected.models[name].trees, found.models[f"{name}0"].trees, strict=True):
            assert all(np.array_equal(getattr(a, c), getattr(b, c)) for c in vars(a))
    assert len(found.models) == 6 and 0 < max(sizes) < 20_000


def test_the_tasks_of_a_step_do_not_grow_with_the_rows(spark, rows, monkeypatch, many_blocks):
    """Every task reports some kB to the driver in each of some 1,600 steps."""
    parts = []
    persist = RDD.persist

    def counted(self, *level):
        parts.append(self.getNumPartitions())
        return persist(self, *level)

    monkeypatch.setattr(RDD, "persist", counted)
    monkeypatch.setattr(boosting, "TASKS_PER_CORE", 1, raising=False)
    expected = fit(rows, replace(PLAIN, rounds=2)).models["m"]
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a partition per file
    try:
        found = fit(rows, replace(PLAIN, rounds=2), block_rows=8).models["m"]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert parts and max(parts) <= spark.sparkContext.defaultParallelism
    for a, b in zip(expected.trees, found.trees, strict=True):
        assert all(np.array_equal(getattr(a, c), getattr(b, c)) for c in vars(a))


@pytest.mark.parametrize("times", [1, 1000, 1 << 40])
def test_numbers_summed_side_by_side_or_apart_grow_the_same_trees(monkeypatch, times):
    """A double holds the sums of hessians and row counts of a part; not where counts are too large."""
    rng = np.random.default_rng(8)
    bins = rng.integers(0, 200, (3, 900)).astype(np.uint8)
    plain = {"bins": bins, "label": (rng.random(900) < bins[0] / 256).astype(np.int8), "fold": rng.integers(0, 5, 900).astype(np.int8), "bucket": rng.integers(0, 20, 900).astype(np.int8), "n": rng.integers(1, 4, 900) * float(times), "weights": {0: rng.integers(1, 1 << 23, 900).astype(float)}}
    boosters = [replace(PLAIN, rounds=3, max_depth=6, row_share=0.85), replace(PLAIN, rounds=3, max_depth=20, max_leaves=9, fold=1)]

    def grown():
        found = []
        for b in boosters:
            block = plain | {"margins": {0: np.full(900, 0.1)}}
            found.append((boosting._grown({0: b}, ["w"], 3, 5, *boosting._in_place(block))[0], block["margins"][0]))
        return found

    one = grown()
    monkeypatch.setattr(boosting, "PART", 64)
    monkeypatch.setattr(boosting, "LEAST_TOGETHER", 1 if times == 1 else 1 << 60)
    for (a, before), (b, after) in zip(one, grown()):
        assert np.array_equal(before, after)
        assert all(np.array_equal(getattr(x, c), getattr(y, c)) for x, y in zip(a, b, strict=True) for c in vars(x))
        margins = np.full(900, 0.1)
        for tree in a:
            margins += tree.value[tree.places(bins.T)]
        assert np.array_equal(margins, after) and max(t.rows[0] for t in a) > 500 * times


def test_millions_of_rows_go_to_a_task_per_model(spark):
    """5.4 million customers made thousands of jobs; a task reads its rows in small batches, not as one pickled block."""
    assert boosting.BLOCK_ROWS >= 5_400_000
    assert 5.4 * sum(a.nbytes for a in boosting._scratch(1000).values()) / 1000 < 300  # MB of a task beside the rows
    met = boosting.each_task(spark.range(25_000).toDF("x"), 3)
    sizes = met.mapInArrow(lambda batches: (type(b).from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint").collect()
    assert met.rdd.getNumPartitions() == 3 and sum(r["n"] for r in sizes) == 75_000 and max(r["n"] for r in sizes) <= 10_000


def test_repeated_rows_weigh_like_one_row_with_their_weight(spark, rows):
    twice = rows.union(rows).withColumn("w", F.col("w") / 2)
    one, two = fit(rows, replace(PLAIN, min_rows=1)), fit(twice, replace(PLAIN, min_rows=1))
    pairs = list(zip(one.models["m"].trees, two.models["m"].trees))
    assert all(np.array_equal(a.feature, b.feature) and np.allclose(a.value, b.value, atol=1e-4) and np.array_equal(2 * a.rows, b.rows) for a, b in pairs)


def test_cuts_are_exact_ranks(spark):
    values = [0.0] * 50 + [float(k) for k in range(1, 51)]
    found = boosting.feature_cuts(spark.createDataFrame([(v,) for v in values], "x double"), ["x"], bins=4)[0]
    assert found.tolist() == [0.0, 25.0]  # half of the rows hold one value
    assert boosting.binned([np.array([-1.0, 0.0, 0.5, 25.0, 99.0])], [found]).ravel().tolist() == [0, 0, 1, 1, 2]


def test_one_class_is_refused(rows):
    with pytest.raises(ValueError, match="both classes"):
        fit(rows.where("y = 1"), PLAIN)


def test_a_saved_model_scores_alike(spark, rows, tmp_path):
    model = PipelineModel(stages=[BoostedTreesModel.of(fit(rows, PLAIN).models["m"])])
    registry = ModelRegistry(spark, str(tmp_path))
    registry.save_model(model, "boosted", "m")
    scored = lambda m: sorted((r["key"], r["probability"][1]) for r in m.transform(rows).collect())
    assert scored(registry.load("boosted")) == scored(model)
    assert sum(model.stages[0].featureImportances) == pytest.approx(1)


# --- Shapley values -------------------------------------------------------------------


def worth(tree: Tree, bins, members, node=0):
    """What a tree gives a coalition: its own side at splits on members, the mean of both sides by their rows at others."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in members:
        return worth(tree, bins, members, left if bins[f] <= tree.cut[node] else right)
    return (tree.rows[left] * worth(tree, bins, members, left) + tree.rows[right] * worth(tree, bins, members, right)) / tree.rows[node]


def test_tree_shapley_equals_all_coalitions(rows):
    fitted = fit(rows, replace(PLAIN, max_depth=30, max_leaves=15, rounds=5)).models["m"]
    assert max(t.feature.size for t in fitted.trees) > 20
    model = PipelineModel(stages=[BoostedTreesModel.of(fitted)])
    found = {r["key"]: r for r in tree_shapley.tree_shapley_values(model, rows, "key").collect()}
    margins = {r["key"]: r["m"] for r in rows.withColumn("m", model.stages[0].margin()).collect()}
    assert len(found) == len(points())
    for r in points()[::9]:
        bins = boosting.binned([np.array([v]) for v in r[3:6]], fitted.cuts)[0]
        value = {s: fitted.base + sum(worth(t, bins, s) for t in fitted.trees) for k in range(4) for s in combinations(range(3), k)}
        for j, name in enumerate(FEATURES):
            others = [k for k in range(3) if k != j]
            phi = sum(
                math.factorial(len(s)) * math.factorial(2 - len(s)) / 6 * (value[tuple(sorted((*s, j)))] - value[s]) for k in range(3) for s in combinations(others, k)
            )
            assert found[r[0]][f"phi_{name}"] == pytest.approx(phi, abs=1e-9)
        assert found[r[0]]["base"] == pytest.approx(value[()], abs=1e-9)
        assert found[r[0]]["prediction"] == pytest.approx(margins[r[0]], abs=1e-9)


def test_incomplete_rows_are_not_explained(spark, rows):
    model = PipelineModel(stages=[BoostedTreesModel.of(fit(rows, PLAIN).models["m"])])
    holes = rows.withColumn("b", F.when(F.col("key") > 3, F.col("b")))
    assert tree_shapley.tree_shapley_values(model, holes, "key").count() == len(points()) - 4
    assert tree_shapley.tree_shapley_values(model, rows.limit(0), "key").collect() == []
