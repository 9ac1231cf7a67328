"""All starts of K-Means in one step, against plain steps on the same points."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector

from revenue_lens.operators import lloyd, segments
from revenue_lens.settings import BEHAVIOUR_FEATURES


def cloud(n=400):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(c, 0.4, (n // 4, 3)) for c in ([0, 0, 0], [4, 0, 1], [0, 5, 0], [4, 4, 4])])
    return np.concatenate([x, np.repeat(x[:1], 150, axis=0)])  # a third of the points are one


@pytest.fixture(scope="module")
def points(spark):
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(cloud())], "id int, a array<double>")
    return df.select("id", array_to_vector("a").alias("x")).repartition(5).cache()


def plain(x, centres, steps, rest):
    at = centres.copy()
    for step in range(steps + 1):
        d = ((x[:, None] - at[None]) ** 2).sum(axis=2)
        nearest, cost = d.argmin(axis=1), d.min(axis=1).sum()
        later = np.array([x[nearest == c].mean(axis=0) if (nearest == c).any() else at[c] for c in range(len(at))])
        if step == steps or ((later - at) ** 2).sum() <= rest:
            return at, cost
        at = later


def test_every_model_takes_its_own_steps(points, monkeypatch):
    starts = {}
    monkeypatch.setattr(lloyd, "_start", lambda *a, keep=lloyd._start: starts.setdefault((a[2], a[3][2]), keep(*a)))
    best = lloyd.k_means(points, {2: 3, 4: 2}, seed=1, steps=30, rest=0.0)
    for k, n in ((2, 3), (4, 2)):
        runs = [plain(cloud(), starts[k, i], 30, 0.0) for i in range(n)]
        at, cost = min(runs, key=lambda r: r[1])
        assert best[k].cost == pytest.approx(cost) and best[k].at == pytest.approx(at)


def test_four_clouds_are_found(points):
    best = lloyd.k_means(points, {4: 10}, seed=3)[4]
    rows = best.transform(points).collect()
    groups = {g: {r["kmeans_cluster"] for r in rows if g * 100 <= r["id"] < g * 100 + 100} for g in range(4)}
    assert all(len(c) == 1 for c in groups.values()) and len(set.union(*groups.values())) == 4


def test_seeding_draws_equal_points_once(points):
    candidates, weights = lloyd.seeds(points.select(lloyd.vector_to_array("x").alias("x")), 8, 5)
    assert weights.sum() == len(cloud()) and len(np.unique(candidates, axis=0)) == len(candidates) < 200


def test_fewer_points_than_centres(spark):
    points = spark.createDataFrame([(i, [float(i % 2), 1.0]) for i in range(9)], "id int, a array<double>").select(array_to_vector("a").alias("x"))
    best = lloyd.k_means(points, {3: 2}, seed=1)[3]
    assert best.cost == 0.0 and best.at.shape == (3, 2)


def test_few_jobs_for_all_starts(spark):
    rows = [(i, *[float(v) for v in (r[0], r[1], r[2], r[0] * r[1])]) for i, r in enumerate(cloud(200))]
    customers = spark.createDataFrame(rows, ["customer_id", *BEHAVIOUR_FEATURES])
    context = spark.sparkContext
    context.setJobGroup("kmeans", "all starts")
    _, meta = segments.kmeans_segmentation(customers)
    found = len(context.statusTracker().getJobIdsForGroup("kmeans"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert set(meta["silhouette_by_k"]) == set(range(3, 9)) and 10 < found < 200
