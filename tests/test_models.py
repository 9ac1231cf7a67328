import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from revenue_lens.functions import heuristic_probability, risk_tier
from revenue_lens.operators import attribution, churn, segments
from revenue_lens.operators.ranking_metrics import calibration, leaderboard, ranking_metrics
from revenue_lens.operators.regression import profit_drivers
from revenue_lens.plans import model_queries
from revenue_lens.settings import BEHAVIOUR_FEATURES, CHURN_FEATURES

SMALL = churn.Sizes(boosting_rounds=5, tuned_rounds=3, forest_trees=10, depth_grid=(2, 3), leaves_grid=(2, 3))


def scored(spark, labels, probs, model="m"):
    return spark.createDataFrame([(model, int(y), float(p)) for y, p in zip(labels, probs)], "model string, label int, prob double")


def brute_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def brute_ap(y, p):
    total, before = 0.0, 0
    for cut in sorted(set(p), reverse=True):
        chosen = p >= cut
        hits = (y[chosen] == 1).sum()
        total += (hits - before) / (y == 1).sum() * hits / chosen.sum()
        before = hits
    return total


def test_ranking_metrics_golden(spark):
    row = ranking_metrics(scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.7, 0.7])).first()
    assert (row["auc_roc"], row["pr_auc"]) == pytest.approx((0.625, 0.75))


def test_ranking_metrics_against_brute_force(spark, many_blocks):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, 600)
    # A third of the scores are one value.
    p = np.where(rng.random(600) < 0.33, 0.5, rng.random(600).round(3))
    row = ranking_metrics(scored(spark, y, p).repartition(6)).first()
    assert row["auc_roc"] == pytest.approx(brute_auc(y, p))
    assert row["pr_auc"] == pytest.approx(brute_ap(y, p))


def test_one_class_has_no_auc(spark):
    row = ranking_metrics(scored(spark, [1, 1], [0.1, 0.2])).first()
    assert (row["auc_roc"], row["pr_auc"]) == (None, None)


def test_models_are_ranked_separately(spark):
    both = scored(spark, [1, 0], [0.9, 0.1], "good").unionByName(scored(spark, [1, 0], [0.1, 0.9], "bad"))
    assert [(r["model"], r["auc_roc"]) for r in leaderboard(ranking_metrics(both)).collect()] == [("good", 1.0), ("bad", 0.0)]


def test_calibration_bins(spark):
    rows = {r["bin"]: r for r in calibration(scored(spark, [1, 0, 1, 1], [0.0, 0.125, 0.1251, 1.0])).collect()}
    assert {b: r["n"] for b, r in rows.items()} == {0: 2, 1: 1, 7: 1}
    assert rows[0]["observed"] == 0.5


def test_heuristic_score_and_strict_tiers(spark):
    request = spark.createDataFrame([(15.0, 12.0, 2500.0, 400.0)], BEHAVIOUR_FEATURES)
    p = request.select(heuristic_probability().alias("p")).first()["p"]
    assert p == pytest.approx(1 / (1 + math.exp(0.03)))
    tiers = spark.createDataFrame([(0.6,), (0.6001,), (0.3,), (0.3001,)], "p double").select(risk_tier(F.col("p"))).collect()
    assert [t[0] for t in tiers] == ["Medium", "High", "Low", "Medium"]


@pytest.fixture(scope="module")
def customers(spark):
    """Churn follows the lagged frequency; some customers have no lagged orders."""
    rng = np.random.default_rng(12)
    rows = []
    for i in range(1, 401):
        freq = float(rng.integers(0, 8))
        money, tenure = freq * float(rng.uniform(50, 150)), float(rng.integers(0, 900))
        churned = int(rng.random() < 1 / (1 + math.exp(freq - 3)))
        rows.append((i, churned, freq, money, tenure, tenure / max(freq, 1), money * (freq + 1) / 30))
    columns = "customer_id long, churned int, " + ", ".join(f"{c} double" for c in CHURN_FEATURES)
    return spark.createDataFrame(rows, columns).cache()


def test_split_is_stratified_and_stable(spark, customers, many_blocks):
    split = churn.stratified_split(customers)
    per_class = {r["churned"]: (r["n"], r["t"]) for r in split.groupBy("churned").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect()}
    assert all(t == math.floor(n * 0.25 + 0.5) for n, t in per_class.values())
    again = churn.stratified_split(customers.repartition(13).orderBy(F.desc("customer_id")))
    pick = lambda df: {r["customer_id"] for r in df.where("is_test").collect()}
    assert pick(split) == pick(again)


def test_weights(customers):
    rows = churn.sample_weights(customers).collect()
    assert all(r["w"] == pytest.approx(math.log1p(r["lag_clv_proxy"])) for r in rows)
    share = {y: [r["w_balanced"] / r["w"] for r in rows if r["churned"] == y and r["w"] > 0] for y in (0, 1)}
    counts = {y: sum(r["churned"] == y for r in rows) for y in (0, 1)}
    for y in (0, 1):
        assert share[y] == pytest.approx([len(rows) / (2 * counts[y])] * len(share[y]))


@pytest.fixture(scope="module")
def run(customers):
    return churn.train_churn_models(churn.training_rows(customers), SMALL)


def test_five_models_compete(run):
    board = leaderboard(run.metrics).collect()
    assert len(board) == 5 and not run.errors
    aucs = [r["auc_roc"] for r in board]
    assert aucs == sorted(aucs, reverse=True) and min(aucs) > 0.5
    assert run.best == board[0]["model"]
    assert run.params["boosted_by_depth"]["maxDepth"] in (2, 3)
    assert run.scores.where("prob < 0 OR prob > 1").count() == 0


def test_training_uses_only_lagged_columns(run):
    for model in run.models.values():
        assert model.stages[0].getInputCols() == CHURN_FEATURES


def test_boosted_candidates_that_fail_are_recorded(customers, monkeypatch):
    def broken(*a, **k):
        raise RuntimeError("does not grow")

    monkeypatch.setattr(churn.boosting, "fit", broken)
    result = churn.train_churn_models(churn.training_rows(customers), SMALL, names=["logistic_regression", *churn.BOOSTED])
    assert result.errors == dict.fromkeys(churn.BOOSTED, "does not grow") and result.best == "logistic_regression"


def test_a_failing_candidate_is_recorded(customers, monkeypatch):
    def broken(train):
        raise RuntimeError("does not fit")

    original = churn.candidates
    monkeypatch.setattr(churn, "candidates", lambda *a: {**original(*a), "random_forest": broken})
    result = churn.train_churn_models(churn.training_rows(customers), SMALL, names=["logistic_regression", "random_forest"])
    assert result.errors == {"random_forest": "does not fit"} and result.best == "logistic_regression"


@pytest.mark.parametrize("name", ["logistic_regression", "boosted_by_depth"])
def test_refit_scores_everybody_with_the_winner(customers, run, name):
    model = churn.refit(customers, name, run.params[name], SMALL)
    assert type(model.stages[-1]) is type(run.models[name].stages[-1])
    scores = churn.score(model, customers)
    assert scores.count() == 400
    assert scores.where("churn_prob BETWEEN 0 AND 1").count() == 400


def test_requests_use_the_model_or_the_heuristic(spark, run):
    request = spark.createDataFrame([(1, 15.0, 12.0, 2500.0, 400.0, 25.0, 80.0)], ["customer_id", *BEHAVIOUR_FEATURES, "avg_interpurchase_days", "clv_proxy"])
    plain = churn.score_requests(request).first()
    assert (plain["churn_probability"], plain["risk_tier"], plain["model_version"]) == (0.4925, "Medium", "heuristic_fallback")
    fitted = churn.score_requests(request, run.models["logistic_regression"]).first()
    assert fitted["model_version"] == "registry_latest" and 0 <= fitted["churn_probability"] <= 1


def test_shapley_values_add_up_and_ignore_unused_features(customers, run):
    model = run.models["hist_gradient_boosting"]
    rows = attribution.shapley_values(model, customers, customers, background_rows=20).collect()
    assert len(rows) == 400
    for r in rows:
        assert sum(r[f"phi_{c}"] for c in CHURN_FEATURES) == pytest.approx(r["prediction"] - r["base"], abs=1e-9)
    used = {CHURN_FEATURES[i] for i, v in enumerate(model.stages[-1].featureImportances.toArray()) if v > 0}
    for unused in set(CHURN_FEATURES) - used:
        assert max(abs(r[f"phi_{unused}"]) for r in rows) < 1e-12


@pytest.mark.parametrize("name", ["hist_gradient_boosting", "logistic_regression"])
def test_shapley_values_rest_on_the_whole_background(customers, run, name):
    model = run.models[name]
    background = customers.orderBy("customer_id").limit(130)
    rows = {r["customer_id"]: r for r in attribution.shapley_values(model, customers, background).collect()}
    data = {r["customer_id"]: [float(r[c]) for c in CHURN_FEATURES] for r in customers.select("customer_id", *CHURN_FEATURES).collect()}
    behind = [data[k] for k in sorted(data)[:130]]
    n, table = len(CHURN_FEATURES), attribution.coalition_weights(len(CHURN_FEATURES))
    asked = sorted(data)[::100]
    mixed = [(k, m, *[data[k][j] if m >> j & 1 else b[j] for j in range(n)]) for k in asked for m in range(2**n) for b in behind]
    plain = customers.sparkSession.createDataFrame(mixed, ["k", "m", *CHURN_FEATURES])
    scored = model.transform(plain).groupBy("k", "m").agg(F.avg(churn.positive_probability()).alias("v"))
    worth = {(r["k"], r["m"]): r["v"] for r in scored.collect()}
    assert len(rows) == len(data)
    for k in asked:
        assert rows[k]["base"] == pytest.approx(worth[k, 0], abs=1e-9) and rows[k]["prediction"] == pytest.approx(worth[k, 2**n - 1], abs=1e-9)
        for j, c in enumerate(CHURN_FEATURES):
            assert rows[k][f"phi_{c}"] == pytest.approx(sum(worth[k, m] * table[m][j] for m in range(2**n)), abs=1e-9)


def test_coalition_weights_give_the_shapley_value_of_a_game():
    # phi of a weighted-majority-like game by averaging over all orders of arrival.
    from itertools import permutations

    n, worth = 3, [0, 1, 2, 5, 3, 4, 9, 12]
    table = attribution.coalition_weights(n)
    found = [sum(worth[m] * table[m][j] for m in range(2**n)) for j in range(n)]
    expected = [0.0] * n
    for order in permutations(range(n)):
        mask = 0
        for j in order:
            expected[j] += (worth[mask | 1 << j] - worth[mask]) / math.factorial(n)
            mask |= 1 << j
    assert found == pytest.approx(expected)


def test_logistic_attribution_adds_up_on_the_margin(customers, run):
    model = run.models["logistic_regression"]
    rows = attribution.attribution_of(model, customers, customers).collect()
    p = {r["customer_id"]: r["churn_prob"] for r in churn.score(model, customers).collect()}
    assert len(rows) == 400
    for r in rows:
        assert sum(r[f"phi_{c}"] for c in CHURN_FEATURES) == pytest.approx(r["prediction"] - r["base"], abs=1e-9)
        assert 1 / (1 + math.exp(-r["prediction"])) == pytest.approx(p[r["customer_id"]], abs=1e-9)
    assert sum(r["prediction"] for r in rows) / 400 == pytest.approx(rows[0]["base"])


def test_boosted_models_are_explained_along_their_paths(customers, run):
    model = run.models["boosted_by_leaves"]
    rows = attribution.attribution_of(model, customers, customers).collect()
    p = {r["customer_id"]: r["churn_prob"] for r in churn.score(model, customers).collect()}
    assert all(1 / (1 + math.exp(-r["prediction"])) == pytest.approx(p[r["customer_id"]], abs=1e-9) for r in rows)


def test_folds_are_stratified(customers):
    rows = churn.training_rows(customers).where("NOT is_test")
    n = {(r["churned"], r["fold"]): r["n"] for r in rows.groupBy("churned", "fold").agg(F.count("*").alias("n")).collect()}
    for y in (0, 1):
        sizes = [n[y, f] for f in range(churn.FOLDS)]
        assert max(sizes) - min(sizes) <= 1


def test_linear_attribution_and_drivers(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (2, 3.0, 10.0)], "customer_id long, a double, b double")
    phi = attribution.linear_attribution(df, {"a": 2.0, "b": 1.0})
    assert {r["customer_id"]: (r["phi_a"], r["phi_b"]) for r in phi.collect()} == {1: (-2.0, 0.0), 2: (2.0, 0.0)}
    assert [(r["feature"], r["importance"]) for r in attribution.global_importance(phi).collect()] == [("a", 2.0), ("b", 0.0)]
    top = attribution.top_drivers(phi, top=1).collect()
    assert {(r["customer_id"], r["position"], r["feature"], r["contribution"]) for r in top} == {(1, 1, "a", -2.0), (2, 1, "a", 2.0)}


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(3)
    centres = [(0, 0, 0, 0), (100, 1, 10, 5), (0, 50, 1000, 300), (60, 60, 20, 900)]
    rows = [(i, *[float(v + rng.normal(scale=2)) for v in centres[i % 4]]) for i in range(200)]
    return spark.createDataFrame(rows, ["customer_id", *BEHAVIOUR_FEATURES])


def test_kmeans_finds_the_blobs_and_marks_missing_rows(spark, blobs):
    missing = spark.createDataFrame([(999, None, 1.0, 1.0, 1.0)], blobs.schema)
    clustered, meta = segments.kmeans_segmentation(blobs.unionByName(missing), n_init=3)
    assert meta["best_k"] == 4 and set(meta["silhouette_by_k"]) == set(range(3, 9))
    assert meta["silhouette_chosen"] > 0.8
    labels = {r["customer_id"]: r["kmeans_cluster"] for r in clustered.collect()}
    assert labels.pop(999) == -1
    assert len({(i % 4, c) for i, c in labels.items()}) == 4


def test_fewer_customers_than_clusters(blobs):
    _, meta = segments.kmeans_segmentation(blobs.limit(5), n_init=2)
    assert set(meta["silhouette_by_k"]) == {3, 4}


def test_silhouette_against_brute_force(spark):
    x = np.random.default_rng(1).normal(size=(40, 4))
    g = np.arange(40) % 3
    df = spark.createDataFrame([(i, *map(float, r), int(g[i])) for i, r in enumerate(x)], ["customer_id", *BEHAVIOUR_FEATURES, "kmeans_cluster"])
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    d = ((z[:, None] - z) ** 2).sum(axis=2)
    s = []
    for i in range(40):
        a = d[i, g == g[i]].sum() / ((g == g[i]).sum() - 1)
        b = min(d[i, g == o].mean() for o in set(g) - {g[i]})
        s.append((b - a) / max(a, b))
    assert segments.silhouette(segments.standardised(df)) == pytest.approx(np.mean(s))


def test_crosstab_rows_sum_to_one(spark):
    df = spark.createDataFrame([(0, "loyal"), (0, "loyal"), (0, "other"), (1, "at_risk"), (None, "loyal")], "kmeans_cluster int, rfm_segment string")
    rows = {r["kmeans_cluster"]: r.asDict() for r in segments.cluster_segment_crosstab(df).collect()}
    assert set(rows) == {0, 1}
    assert rows[0]["loyal"] == pytest.approx(2 / 3) and rows[1]["at_risk"] == 1.0 and rows[1]["loyal"] == 0.0


def test_profit_drivers_against_least_squares(spark):
    rng = np.random.default_rng(7)
    x = np.column_stack([rng.integers(0, 9, 200), rng.integers(0, 300, 200), rng.integers(0, 900, 200)]).astype(float)
    y = np.expm1(np.abs(1 + 0.5 * x[:, 0] - 0.001 * x[:, 1] + rng.normal(scale=0.1, size=200)))
    df = spark.createDataFrame([(float(m), *map(float, r)) for m, r in zip(y, x)], "monetary_365d double, frequency_365d double, recency_days double, tenure_days double")
    rows = {r["term"]: r for r in profit_drivers(df).collect()}
    design = np.column_stack([x, np.ones(200)])
    coef, ssr, *_ = np.linalg.lstsq(design, np.log1p(y), rcond=None)
    assert [rows[t]["coef"] for t in ("frequency_365d", "recency_days", "tenure_days", "const")] == pytest.approx(list(coef), abs=1e-8)
    assert rows["const"]["aic"] == pytest.approx(200 * (math.log(2 * math.pi) + math.log(ssr[0] / 200) + 1) + 8)
    assert rows["frequency_365d"]["p_value"] < 1e-6 < 0.01 < rows["tenure_days"]["p_value"]
    assert 0 <= rows["const"]["r2"] <= 1


@pytest.mark.parametrize("name", ["q_churn_leaderboard", "q_churn_scores"])
def test_a_failed_candidate_fails_the_queries(spark, customers, monkeypatch, name):
    """Four rows in place of five looked like a whole comparison, and one run serves both queries."""

    def broken(train):
        raise MemoryError()

    original, train = churn.candidates, churn.train_churn_models
    monkeypatch.setattr(churn, "candidates", lambda *a: {**original(*a), "random_forest": broken})
    monkeypatch.setattr(churn, "train_churn_models", lambda rows: train(rows, SMALL, names=["logistic_regression", "random_forest"]))
    monkeypatch.setattr(model_queries, "features_now", lambda *a: customers)
    monkeypatch.setattr(model_queries, "_RUNS", {})
    with pytest.raises(RuntimeError, match="random_forest.*MemoryError"):
        getattr(model_queries, name)(spark, "")
    assert not model_queries._RUNS
    run = train(churn.training_rows(customers), SMALL, names=["logistic_regression", "random_forest"])
    assert [(r["model"], r["auc_roc"] is None, r["error"]) for r in run.board.collect()] == [("logistic_regression", False, None), ("random_forest", True, "MemoryError")]
