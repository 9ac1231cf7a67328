"""Churn classifiers on the lagged snapshot."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenue_lens.functions import hash_uniform, heuristic_probability, risk_tier
from revenue_lens.operators import boosting, forest
from revenue_lens.operators.boosting import BoostedTreesModel, Booster
from revenue_lens.operators.forest import ForestModel
from revenue_lens.operators.ranking import beyond, closing_ranks, part_of, rows_at_ranks
from revenue_lens.operators.ranking_metrics import leaderboard, metrics_of_counts, ranking_metrics
from revenue_lens.operators.storage import materialize
from revenue_lens.settings import CHURN_FEATURES, CHURN_TEST_SHARE, SEED

LABEL = "churned"
KEY = "customer_id"
FOLDS = 5


@dataclass(frozen=True)
class Sizes:
    """Model sizes; the defaults are the full ones (fixed values)."""

    logistic_iterations: int = 200
    forest_trees: int = 200
    forest_depth: int = 12
    boosting_rounds: int = 200
    boosting_depth: int = 5
    boosting_leaves: int = 31
    boosting_min_rows: int = 20
    boosting_rate: float = 0.06
    tuned_rounds: int = 250
    tuned_rate: float = 0.08
    tuned_subsample: float = 0.85
    depth_grid: tuple[int, ...] = (3, 6)
    leaves_grid: tuple[int, ...] = (31, 63)


def stratified_split(customers: DataFrame, share: float = CHURN_TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Add ``is_test``: in each class the ``share`` with the lowest hash of the customer id.

    Per class only the hash that closes the test part comes back, so no class is gathered
    in one task.
    """
    hashed = customers.withColumn("_u", hash_uniform(seed, F.col(KEY)))
    test_size = lambda n: [int(n * share + 0.5)]
    closing = rows_at_ranks(hashed.select(LABEL, "_u", KEY), LABEL, "_u", KEY, test_size)
    is_test = F.lit(False)
    for label, (last,) in closing.items():
        is_test = F.when(F.col(LABEL) == label, ~beyond(F.col("_u"), F.col(KEY), last)).otherwise(is_test)
    return hashed.withColumn("is_test", is_test).drop("_u")


def sample_weights(customers: DataFrame) -> DataFrame:
    """Add ``w`` = log1p of the lagged CLV proxy, and ``w_balanced`` with equal class totals."""
    counts = {r[LABEL]: r["count"] for r in customers.groupBy(LABEL).count().collect()}
    total = sum(counts.values())
    balance = F.lit(1.0)
    for label, n in counts.items():
        balance = F.when(F.col(LABEL) == label, total / (len(counts) * n)).otherwise(balance)
    weight = F.log1p(F.greatest(F.col("lag_clv_proxy"), F.lit(0.0)))
    return customers.withColumn("w", weight).withColumn("w_balanced", F.col("w") * balance)


def with_folds(customers: DataFrame, seed: int = SEED) -> DataFrame:
    """Add ``fold``: each class cut into ``FOLDS`` equal parts by the hash of the customer id."""
    hashed = customers.withColumn("_u", hash_uniform(seed, "fold", F.col(KEY)))
    closing = rows_at_ranks(hashed.select(LABEL, "_u", KEY), LABEL, "_u", KEY, lambda n: closing_ranks(n, FOLDS))
    fold = F.lit(0)
    for label, cuts in closing.items():
        fold = F.when(F.col(LABEL) == label, part_of(F.col("_u"), F.col(KEY), cuts) - 1).otherwise(fold)
    return hashed.withColumn("fold", fold).drop("_u")


def training_rows(customers: DataFrame, share: float = CHURN_TEST_SHARE, seed: int = SEED) -> DataFrame:
    """Complete rows with split, weights and fold number, stored for the many fits.

    Class balance and folds are taken over the training part only.
    """
    complete = customers.select(KEY, LABEL, *CHURN_FEATURES).na.drop()
    split = materialize(stratified_split(complete, share, seed))
    train = with_folds(sample_weights(split.where("NOT is_test")), seed)
    test = split.where("is_test").withColumns({"w": F.lit(0.0), "w_balanced": F.lit(0.0), "fold": F.lit(None).cast("int")})
    return materialize(train.unionByName(test))


def _scaled(classifier) -> Pipeline:
    assembler = VectorAssembler(inputCols=CHURN_FEATURES, outputCol="x_raw")
    return Pipeline(stages=[assembler, StandardScaler(inputCol="x_raw", outputCol="x", withMean=True, withStd=True), classifier])


#: Names of the candidates; those of the boosted ones are grown together.
BOOSTED = ("hist_gradient_boosting", "boosted_by_depth", "boosted_by_leaves")


def boosters(name: str, sizes: Sizes = Sizes()) -> list[tuple[dict | None, Booster]]:
    """The grid of a boosted candidate: parameters and how to grow each of its points (fixed values)."""
    if name == "hist_gradient_boosting":
        return [(None, Booster(name, sizes.boosting_rounds, sizes.boosting_rate, "w", sizes.boosting_depth, sizes.boosting_leaves, min_rows=sizes.boosting_min_rows))]
    if name == "boosted_by_depth":
        share = sizes.tuned_subsample
        more = {"l2": 1.0, "min_hessian": 1.0, "row_share": share, "feature_share": share}
        return [({"maxDepth": d}, Booster(name, sizes.tuned_rounds, sizes.tuned_rate, "w", d, **more)) for d in sizes.depth_grid]
    more = {"min_rows": sizes.boosting_min_rows}
    return [({"maxLeaves": n}, Booster(name, sizes.tuned_rounds, sizes.tuned_rate, "w_balanced", max_leaves=n, **more)) for n in sizes.leaves_grid]


def fit_boosted(train: DataFrame, names: list[str], sizes: Sizes = Sizes(), seed: int = SEED) -> dict[str, tuple[PipelineModel, dict | None]]:
    """The boosted candidates ``names`` with their parameters. All grid points, each on all rows and without each fold, grow
    at the same time; the point with the best mean AUC on the folds left out is chosen."""
    plans, points = [], []
    for name in names:
        grid = boosters(name, sizes)
        for k, (params, booster) in enumerate(grid):
            points.append((name, k, params))
            folds = [None, *range(FOLDS)] if len(grid) > 1 else [None]
            plans += [replace(booster, name=f"{name}|{k}|{'all' if f is None else f}", fold=f) for f in folds]
    run = boosting.fit(train, CHURN_FEATURES, LABEL, KEY, plans, seed)
    mean = {}
    if any(p.fold is not None for p in plans):
        counts = run.held_out.groupBy("model", F.col("margin").alias("prob")).agg(
            F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("label") != 1, F.col("n")).otherwise(0)).alias("neg")
        )
        # A row per model and fold.
        for r in metrics_of_counts(materialize(counts)).collect():
            mean.setdefault(r["model"].rsplit("|", 1)[0], []).append(r["auc_roc"] or 0.0)
    found = {}
    for name in names:
        own = [(k, params) for n, k, params in points if n == name]
        k, params = max(own, key=lambda p: (sum(mean.get(f"{name}|{p[0]}", [0.0])), -p[0]))
        found[name] = PipelineModel(stages=[BoostedTreesModel.of(run.models[f"{name}|{k}|all"])]), params
    return found


def candidates(sizes: Sizes = Sizes(), seed: int = SEED) -> dict[str, Callable[[DataFrame], tuple[PipelineModel, dict | None]]]:
    """Fit functions by model name; each takes weighted training rows."""

    def logistic(train):
        # Same penalty as a unit ridge on the summed loss.
        total = train.agg(F.sum("w_balanced")).first()[0]
        classifier = LogisticRegression(
            featuresCol="x", labelCol=LABEL, weightCol="w_balanced", maxIter=sizes.logistic_iterations,
            regParam=1.0 / total, standardization=False,
        )
        return _scaled(classifier).fit(train), None

    def trees(train):
        fitted = forest.fit(train, CHURN_FEATURES, LABEL, KEY, "w_balanced", sizes.forest_trees, sizes.forest_depth, seed)
        return PipelineModel(stages=[ForestModel.of(fitted)]), None

    return {"logistic_regression": logistic, "random_forest": trees}


def positive_probability() -> Column:
    return vector_to_array("probability")[1]


def score(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """(customer_id, churn_prob) for every row."""
    return model.transform(rows).select(KEY, positive_probability().alias("churn_prob"))


@dataclass
class ChurnRun:
    """Holdout scores of every model, their metrics, and the fitted models with parameters. ``errors`` names the candidates that
    failed, ``causes`` holds what stopped them."""

    scores: DataFrame
    metrics: DataFrame
    models: dict[str, PipelineModel]
    params: dict[str, dict | None]
    errors: dict[str, str]
    causes: dict[str, Exception] = field(default_factory=dict)

    def whole(self) -> ChurnRun:
        """The run, if no candidate failed: for readers to whom fewer models would look like all of them."""
        if self.errors:
            raise RuntimeError(f"churn models failed: {self.errors}") from next(iter(self.causes.values()), None)
        return self

    @property
    def board(self) -> DataFrame:
        """The leaderboard with the reason in ``error`` and no metrics for each candidate that failed."""
        failed = self.metrics.sparkSession.createDataFrame(list(self.errors.items()), "model string, error string")
        return leaderboard(self.metrics.withColumn("error", F.lit(None).cast("string")).unionByName(failed, allowMissingColumns=True))

    @property
    def best(self) -> str:
        # At most one row per model.
        rows = {r["model"]: r["auc_roc"] for r in self.metrics.collect() if r["auc_roc"] is not None}
        return max(self.models, key=lambda name: rows.get(name, -1.0))


def train_churn_models(rows: DataFrame, sizes: Sizes = Sizes(), seed: int = SEED, names: list[str] | None = None) -> ChurnRun:
    """Fit every candidate on the training part and score the test part.

    A model that fails is recorded in ``errors`` and left out; ``whole()`` refuses such a run. Rows of weight 0
    do not move a weighted fit, but count in the validation folds like all others.
    """
    train = materialize(rows.where("NOT is_test"))
    test = rows.where("is_test")
    chosen = {n: fit for n, fit in candidates(sizes, seed).items() if names is None or n in names}
    boosted = [n for n in BOOSTED if names is None or n in names]
    tasks = {**chosen, **({"": lambda rows: fit_boosted(rows, boosted, sizes, seed)} if boosted else {})}

    def attempt(name: str):
        try:
            return tasks[name](train)
        except Exception as problem:  # noqa: BLE001 - a failing candidate must not stop the others
            return problem

    # The candidates are independent; their many small jobs interleave on the cluster.
    with ThreadPool(max(len(tasks), 1)) as pool:
        outcomes = dict(zip(tasks, pool.map(inheritable_thread_target(rows.sparkSession)(attempt), tasks)))
    if boosted:
        together = outcomes.pop("")
        outcomes |= {n: together if isinstance(together, Exception) else together[n] for n in boosted}
    models, params, causes, scored = {}, {}, {}, None
    for name, outcome in outcomes.items():
        if isinstance(outcome, Exception):
            causes[name] = outcome
            continue
        models[name], params[name] = outcome
        part = models[name].transform(test).select(
            F.lit(name).alias("model"), KEY, F.col(LABEL).alias("label"), positive_probability().alias("prob")
        )
        scored = part if scored is None else scored.unionByName(part)
    errors = {name: next(iter(str(cause).splitlines()), type(cause).__name__) for name, cause in causes.items()}
    if scored is None:
        raise RuntimeError(f"no churn model could be fitted: {errors}") from next(iter(causes.values()), None)
    scores = materialize(scored)
    return ChurnRun(scores, materialize(ranking_metrics(scores)), models, params, errors, causes)


def refit(customers: DataFrame, name: str, params: dict | None, sizes: Sizes = Sizes(), seed: int = SEED) -> PipelineModel:
    """Fit the winner again on all complete rows, with its tuned parameters."""
    rows = sample_weights(customers.select(KEY, LABEL, *CHURN_FEATURES).na.drop())
    if name not in BOOSTED:
        return candidates(sizes, seed)[name](rows)[0]
    booster = next(b for p, b in boosters(name, sizes) if not params or p == params)
    run = boosting.fit(materialize(rows.withColumn("fold", F.lit(0))), CHURN_FEATURES, LABEL, KEY, [booster], seed)
    return PipelineModel(stages=[BoostedTreesModel.of(run.models[name])])


def score_requests(requests: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Probability (4 places), tier and model version for valid scoring requests.

    With a model the request's current values fill the lagged inputs; without one the
    heuristic score is used. Stateless, so it also runs on a stream.
    """
    if model is None:
        probed = requests.withColumns({"_p": heuristic_probability(), "model_version": F.lit("heuristic_fallback")})
    else:
        inputs = requests.withColumns({c: F.col(c.removeprefix("lag_")).cast("double") for c in CHURN_FEATURES})
        probed = model.transform(inputs).withColumns({"_p": positive_probability(), "model_version": F.lit("registry_latest")})
    return probed.select(KEY, F.round("_p", 4).alias("churn_probability"), risk_tier(F.col("_p")).alias("risk_tier"), "model_version")
