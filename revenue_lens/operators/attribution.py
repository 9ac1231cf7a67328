"""Shapley values: in closed form for linear scores and boosted trees, by all coalitions for any model."""

from __future__ import annotations

import math
import re
from math import factorial

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import StandardScalerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_lens.functions import hash_uniform
from revenue_lens.functions.scoring import HEURISTIC_WEIGHTS
from revenue_lens.operators.boosting import BoostedTreesModel
from revenue_lens.operators.forest import ForestModel
from revenue_lens.operators.storage import materialize
from revenue_lens.operators.tree_shapley import boosted_stage, tree_shapley_values
from revenue_lens.settings import CHURN_FEATURES, SEED

TOP_FEATURES = 5
#: Rows of both sides that meet in one cell.
CELL = 256


def linear_attribution(customers: DataFrame, weights: dict[str, float] = HEURISTIC_WEIGHTS, key: str = "customer_id") -> DataFrame:
    """(key, phi_<feature>...) of a linear score: weight times distance from the mean."""
    means = customers.agg(*[F.avg(c).alias(c) for c in weights]).first()
    return customers.select(key, *[(F.lit(w) * (F.col(c) - F.lit(means[c]))).alias(f"phi_{c}") for c, w in weights.items()])


def coalition_weights(n: int) -> list[list[float]]:
    """``table[mask][j]``: factor of the mean prediction of coalition ``mask`` in phi_j."""
    share = [factorial(s) * factorial(n - s - 1) / factorial(n) for s in range(n)]
    table = []
    for mask in range(2**n):
        size = bin(mask).count("1")
        table.append([share[size - 1] if mask >> j & 1 else -share[size] for j in range(n)] if 0 < size < n else
                     [share[n - 1] if size else -share[0]] * n)
    return table


def _cuts(model: PipelineModel, features: list[str]) -> list[list[float]] | None:
    """Sorted split values of each feature of a tree model; None for other models."""
    last = model.stages[-1]
    if isinstance(last, (BoostedTreesModel, ForestModel)):
        fitted = last.fitted
        used = [{int(c) for t in fitted.trees for f, c in zip(t.feature, t.cut) if f == j} for j in range(len(features))]
        return [[float(fitted.cuts[j][c]) for c in sorted(cuts)] for j, cuts in enumerate(used)] if fitted.features == features else None
    if len(model.stages) != 2 or not hasattr(last, "trees") or list(model.stages[0].getInputCols()) != features:
        return None
    found: list[set[float]] = [set() for _ in features]
    for j, cut in re.findall(r"If \(feature (\d+) <= (\S+)\)", last.toDebugString):
        found[int(j)].add(float(cut))
    return [sorted(x) for x in found]


def _points(rows: DataFrame, features: list[str], cuts: list[list[float]] | None) -> DataFrame:
    """``rows`` with _x0, _x1, ...: the features, for a tree model the least split value that is not below (or one above
    all), which every split sends the same way."""
    values = [F.col(f).cast("double") for f in features]
    if cuts is not None:
        not_below = lambda v, c: F.get(F.filter(F.array(*map(F.lit, c)), lambda cut: cut >= v), 0)
        least = [not_below(v, c) if c else F.lit(None) for v, c in zip(values, cuts)]
        above = [F.lit(math.nextafter(c[-1], math.inf) if c else 0.0) for c in cuts]
        values = [F.when(v.isNotNull(), F.coalesce(x, top)) for v, x, top in zip(values, least, above)]
    return rows.withColumns({f"_x{j}": v for j, v in enumerate(values)})


def shapley_values(
    model: PipelineModel,
    rows: DataFrame,
    background: DataFrame,
    features: list[str] = CHURN_FEATURES,
    key: str = "customer_id",
    background_rows: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Exact interventional Shapley values of the positive-class probability.

    Every row is scored under all 2^n coalitions against all rows of ``background`` (or
    ``background_rows`` of them, by a hash of the key): coalition members keep the row's value, the
    others take the background's. Of a coalition only distinct values of its members meet distinct
    values of the others, which carry their counts; values that no split of a tree model tells apart
    are one. The sums of a coalition combine on the map side. phi sums to ``prediction - base``.

    With trees the work is bounded by the product of the split counts; other models score, in the
    worst case, every row against every background row.
    """
    n = len(features)
    if background_rows is not None:
        background = background.orderBy(hash_uniform(seed, "background", F.col(key)), key).limit(background_rows)
    cuts, xs = _cuts(model, features), [f"_x{j}" for j in range(n)]
    placed = materialize(_points(rows.select(key, *features), features, cuts).select(key, *xs))
    points = materialize(placed.select(*xs).distinct())
    behind = materialize(_points(background.select(*features), features, cuts).groupBy(*xs).agg(F.count(F.lit(1)).alias("_n")))
    total = behind.agg(F.sum("_n")).first()[0]
    masks = F.explode(F.sequence(F.lit(0), F.lit(2**n - 1)))
    member = lambda j: F.col("_mask").bitwiseAND(1 << j) != 0
    inside = [F.when(member(j), F.col(x)).otherwise(0.0).alias(f"_m{j}") for j, x in enumerate(xs)]
    ms, bs = [f"_m{j}" for j in range(n)], [f"_b{j}" for j in range(n)]
    mine = materialize(points.withColumn("_mask", masks).select("_mask", *inside).distinct())
    outside = [F.when(member(j), 0.0).otherwise(F.col(x)).alias(f"_b{j}") for j, x in enumerate(xs)]
    theirs = materialize(behind.withColumn("_mask", masks).select("_mask", "_n", *outside).groupBy("_mask", *bs).agg(F.sum("_n").alias("_n")))
    sizes = [dict(side.groupBy("_mask").count().collect()) for side in (mine, theirs)]  # a number per coalition
    down, across = [[max(1, -(-size.get(mask, 0) // CELL)) for mask in range(2**n)] for size in sizes]
    of = lambda table: F.get(F.array(*map(F.lit, table)), F.col("_mask"))
    every = lambda table: F.explode(F.sequence(F.lit(0), of(table) - 1))
    cells = sum(r * c for r, c in zip(down, across))
    parts = min(cells, 4096)
    left = mine.withColumn("_r", F.pmod(F.xxhash64(*ms), of(down)).cast("int")).withColumn("_c", every(across)).repartition(parts, "_mask", "_r", "_c")
    right = theirs.withColumn("_c", F.pmod(F.xxhash64(*bs), of(across)).cast("int")).withColumn("_r", every(down)).repartition(parts, "_mask", "_r", "_c")
    mixed = left.join(right, ["_mask", "_r", "_c"]).select(
        "_mask", "_n", *ms, *[F.when(member(j), F.col(f"_m{j}")).otherwise(F.col(f"_b{j}")).alias(f) for j, f in enumerate(features)]
    )
    p = vector_to_array("probability")[1]
    scored = model.transform(mixed).select("_mask", *ms, (p * F.col("_n")).alias("_p"))
    worth = materialize(scored.groupBy("_mask", *ms).agg((F.sum("_p") / total).alias("_v")))
    factors = F.array(*[F.array(*map(F.lit, row)) for row in coalition_weights(n)])
    met = points.withColumn("_mask", masks).select("_mask", *xs, *inside).join(worth, ["_mask", *ms])
    phis = met.groupBy(*xs).agg(
        *[F.sum(F.get(F.get(factors, F.col("_mask")), F.lit(j)) * F.col("_v")).alias(f"phi_{f}") for j, f in enumerate(features)],
        F.max(F.when(F.col("_mask") == 0, F.col("_v"))).alias("base"),
        F.max(F.when(F.col("_mask") == 2**n - 1, F.col("_v"))).alias("prediction"),
    )
    return placed.join(phis, xs).select(key, *[f"phi_{f}" for f in features], "base", "prediction")


def logistic_attribution(model: PipelineModel, rows: DataFrame, background: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, phi_<feature>..., base, prediction) of a scaled logistic model on the margin, where it is linear."""
    scaler, classifier = model.stages[1:]
    features = model.stages[0].getInputCols()
    weights = {f: float(c) / float(s) if s else 0.0 for f, c, s in zip(features, classifier.coefficients.toArray(), scaler.std.toArray())}
    centre = dict(zip(features, scaler.mean.toArray()))
    means = background.agg(*[F.avg(c).alias(c) for c in features]).first()
    base = float(classifier.intercept) + sum(w * (means[f] - float(centre[f])) for f, w in weights.items())
    phis = [(F.lit(w) * (F.col(f) - F.lit(means[f]))).alias(f"phi_{f}") for f, w in weights.items()]
    complete = rows.na.drop(subset=features).select(key, *phis)
    return complete.select("*", F.lit(base).alias("base"), sum((F.col(f"phi_{f}") for f in features), F.lit(base)).alias("prediction"))


def attribution_of(model: PipelineModel, rows: DataFrame, background: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, phi_<feature>..., base, prediction) of every row: on the margin, in one pass over the rows, for boosted trees and the
    logistic model; of the probability, by coalitions, for any other."""
    if boosted_stage(model) is not None:
        return tree_shapley_values(model, rows, key)
    if isinstance(model.stages[-1], LogisticRegressionModel) and len(model.stages) == 3 and isinstance(model.stages[1], StandardScalerModel):
        return logistic_attribution(model, rows, background, key)
    return shapley_values(model, rows, background, list(model.stages[0].getInputCols()), key)


def _phis(attribution: DataFrame) -> list[str]:
    return [c for c in attribution.columns if c.startswith("phi_")]


def long_attribution(attribution: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, feature, phi) rows."""
    cells = [F.struct(F.lit(c.removeprefix("phi_")).alias("feature"), F.col(c).alias("phi")) for c in _phis(attribution)]
    return attribution.select(key, F.inline(F.array(*cells)))


def global_importance(attribution: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    means = attribution.agg(*[F.avg(F.abs(c)).alias(c) for c in _phis(attribution)])
    cells = [F.struct(F.lit(c.removeprefix("phi_")).alias("feature"), F.col(c).alias("importance")) for c in _phis(attribution)]
    return means.select(F.inline(F.array(*cells))).orderBy(F.desc("importance"), "feature")


def top_drivers(attribution: DataFrame, key: str = "customer_id", top: int = TOP_FEATURES) -> DataFrame:
    """The strongest contributions of each row with their position, sorted inside the row."""
    cells = F.array(*[
        F.struct((-F.abs(c)).alias("order"), F.lit(c.removeprefix("phi_")).alias("feature"), F.col(c).alias("contribution"))
        for c in _phis(attribution)
    ])
    best = F.slice(F.array_sort(cells), 1, top)
    return attribution.select(key, F.posexplode(best).alias("position", "driver")).select(
        key, (F.col("position") + 1).alias("position"), "driver.feature", "driver.contribution"
    )
