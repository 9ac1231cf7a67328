"""The histogram forest against a plain search over all splits, on small tables."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from revenue_lens.operators import attribution, churn, forest
from revenue_lens.operators.boosting import UNIT, binned
from revenue_lens.operators.forest import ForestModel
from revenue_lens.settings import CHURN_FEATURES
from revenue_lens.sources.registry import ModelRegistry


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    a, b, c = rng.integers(0, 30, 300) / 4, rng.normal(size=300), rng.integers(0, 3, 300).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(-(a / 3 - 1.5 + b * (c - 1))))).astype(int)
    data = [(i, int(y[i]), float(a[i]), float(b[i]), float(c[i]), (i % 6) / 4) for i in range(300)]
    return spark.createDataFrame(data, "key long, y int, a double, b double, c double, w double").cache()


def fit(rows, features, trees=3, depth=5, **more):
    return forest.fit(rows, features, "y", "key", "w", trees, depth, seed=7, **more)


def test_trees_equal_a_search_over_all_splits(rows):
    """With two features every node may use both."""
    found = fit(rows, ["a", "b"])
    data = rows.withColumn("h", F.xxhash64("key")).collect()
    bins = binned([np.array([r["a"] for r in data]), np.array([r["b"] for r in data])], found.cuts)
    y, hashes = np.array([r["y"] for r in data]), np.array([r["h"] for r in data]).view(np.uint64)
    for t, tree in enumerate(found.trees):
        w = np.rint(np.array([r["w"] for r in data]) * UNIT) * forest.drawn(hashes, 7, t)
        stack, seen = [(0, np.flatnonzero(w > 0), 0)], 0
        while stack:
            node, own, depth = stack.pop()
            seen += 1
            gini = lambda at: 2 * (w[at] * y[at]).sum() * (w[at] * (1 - y[at])).sum() / w[at].sum()
            gains = {(f, c): gini(own) - gini(own[bins[own, f] <= c]) - gini(own[bins[own, f] > c]) for f in range(2) for c in range(len(found.cuts[f])) if 0 < (bins[own, f] <= c).sum() < len(own)}
            best = max(gains.values(), default=0.0)
            if tree.feature[node] < 0:
                assert depth == 5 or best < 1e-3
                assert tree.value[node] == pytest.approx((w[own] * y[own]).sum() / w[own].sum())
                continue
            assert depth < 5 and gains[tree.feature[node], tree.cut[node]] == pytest.approx(best)
            left = bins[own, tree.feature[node]] <= tree.cut[node]
            stack += [(tree.left[node], own[left], depth + 1), (tree.right[node], own[~left], depth + 1)]
        assert seen == len(tree.feature) > 15


def same(one, many):
    for a, b in zip(one.trees, many.trees, strict=True):
        assert all(np.array_equal(getattr(a, c), getattr(b, c)) for c in vars(a))


def test_tasks_and_jobs_grow_the_same_trees(rows, monkeypatch, many_blocks):
    one = fit(rows, ["a", "b", "c"], trees=7, depth=6)
    same(one, fit(rows.repartition(7).orderBy(F.desc("key")), ["a", "b", "c"], trees=7, depth=6))
    monkeypatch.setattr(forest, "TREES_PER_JOB", 4)
    same(one, fit(rows, ["a", "b", "c"], trees=7, depth=6, block_rows=60))
    assert len({t.feature.tobytes() for t in one.trees}) == 7  # each its own rows


def test_rows_summed_in_parts_give_the_same_sums(monkeypatch):
    rng = np.random.default_rng(5)
    block = {"bins": rng.integers(0, 32, 900).astype(np.uint8), "label": rng.integers(0, 2, 300).astype(np.int32), "weight": rng.integers(0, 9, 300).astype(float), "hash": rng.integers(0, 1 << 63, 300).astype(np.uint64)}
    step, allowed = forest._Step(np.array([1]), np.array([15]), np.array([[0, 1]]), 2), np.array([[0, 1], [1, 2]])

    def sums():
        sample = forest._Sample(block, 3, 1, 0)
        sample.move(step)
        return sample.sums(allowed)

    whole = sums()
    monkeypatch.setattr(forest, "PART", 50)
    assert np.array_equal(whole, sums()) and whole.sum() == 2 * (block["weight"] * forest.drawn(block["hash"], 1, 0)).sum()


def test_draws_are_poisson_numbers():
    n = 200_000
    times = np.stack([forest.drawn(np.random.default_rng(1).integers(0, 1 << 63, n).astype(np.uint64), 42, t) for t in (0, 1)])
    for k in range(5):
        assert np.mean(times[0] == k) == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.005)
    assert np.corrcoef(times)[0, 1] == pytest.approx(0, abs=0.01)


def test_the_model_gives_the_mean_share_and_survives_saving(spark, rows, tmp_path):
    fitted = fit(rows, ["a", "b", "c"])
    model = PipelineModel(stages=[ForestModel.of(fitted)])
    scored = lambda m: {r["key"]: r["probability"][1] for r in m.transform(rows).collect()}
    found, data = scored(model), rows.collect()
    bins = binned([np.array([r[c] for r in data]) for c in "abc"], fitted.cuts)
    expected = sum(t.value[t.places(bins)] for t in fitted.trees) / 3
    assert [found[r["key"]] for r in data] == pytest.approx(expected.tolist())
    registry = ModelRegistry(spark, str(tmp_path))
    registry.save_model(model, "forest", "m")
    assert scored(registry.load("forest")) == found


def test_one_class_is_refused(rows):
    with pytest.raises(ValueError, match="both classes"):
        fit(rows.where("y = 1"), ["a", "b"])


def test_jobs_of_a_forest_do_not_grow_with_its_trees(spark, monkeypatch):
    """A pass over all rows and trees per level took 401 s on 674,955 customers."""
    rng = np.random.default_rng(2)
    data = [(i, int(rng.random() < 0.4), *map(float, rng.integers(0, 9, 5)), 1.0) for i in range(200)]
    train = spark.createDataFrame(data, ["customer_id", "churned", *CHURN_FEATURES, "w_balanced"])

    def jobs(trees):
        group = f"forest {trees}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            model, _ = churn.candidates(churn.Sizes(forest_trees=trees, forest_depth=12))["random_forest"](train)
            return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)), model
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    (few, _), (many, model) = jobs(5), jobs(60)
    assert few == many < 20
    phi = attribution.attribution_of(churn.candidates(churn.Sizes(forest_trees=3, forest_depth=2))["random_forest"](train)[0], train, train).collect()
    assert len(phi) == 200 and all(sum(r[f"phi_{c}"] for c in CHURN_FEATURES) == pytest.approx(r["prediction"] - r["base"], abs=1e-9) for r in phi)
