"""Shapley values of boosted trees along their paths: exact, on the margin, one pass over the rows.

What a tree is worth to a coalition follows its paths: at a split on a member the row's side is taken, at a split on any other
feature both sides, in the shares of the learnt rows. Then a leaf is worth its value times a factor per feature on its path: for
a member whether the row passes all of the path's splits on it, for another feature the product of their shares. A feature's
Shapley value of the leaf depends on nothing but which of these features the row passes, so every leaf carries a table of
2**features entries, and a row adds up one entry per leaf. The trees are a small table; no coalition of rows and no
background is scored, so the work is linear in the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revenue_lens.operators.boosting import BoostedTreesModel, Fitted, Tree, binned

#: Features of a model at most (a table has 2**features entries), and rows explained at once.
MOST_FEATURES, ROWS = 14, 1024


@dataclass
class Leaves:
    """The leaves of a tree: passed where ``low`` < bin <= ``high`` for each feature; ``phi`` [leaf, passed features, feature]."""

    low: np.ndarray
    high: np.ndarray
    phi: np.ndarray
    expected: float


def _leaf_phi(value: float, on_path: list[int], shares: list[float], features: int) -> np.ndarray:
    """Shapley values of one leaf for every set of passed features (as bits)."""
    n = len(on_path)
    passed = np.arange(2**features)
    one = {k: (passed >> f & 1).astype(float) for k, f in enumerate(on_path)}
    found = np.zeros((2**features, features))
    for k, f in enumerate(on_path):
        others = [j for j in range(n) if j != k]
        # Coefficient s: the sum, over coalitions of s others, of the product of all their factors.
        by_size = [np.ones(2**features)] + [np.zeros(2**features) for _ in others]
        for j in others:
            for s in range(len(others), 0, -1):
                by_size[s] = by_size[s] * shares[j] + by_size[s - 1] * one[j]
            by_size[0] = by_size[0] * shares[j]
        weight = sum(factorial(s) * factorial(n - s - 1) / factorial(n) * total for s, total in enumerate(by_size))
        found[:, f] = value * (one[k] - shares[k]) * weight
    return found


def leaves_of(tree: Tree, features: int) -> Leaves:
    low, high, phi, expected = [], [], [], 0.0
    stack = [(0, [-1] * features, [np.iinfo(np.int64).max] * features, {})]
    while stack:
        node, above, upto, shares = stack.pop()
        f = int(tree.feature[node])
        if f < 0:
            low.append(above)
            high.append(upto)
            value = float(tree.value[node])
            phi.append(_leaf_phi(value, list(shares), list(shares.values()), features))
            expected += value * float(np.prod(list(shares.values())))
            continue
        for child, is_left in ((int(tree.left[node]), True), (int(tree.right[node]), False)):
            share = tree.rows[child] / tree.rows[node]
            a, u = list(above), list(upto)
            if is_left:
                u[f] = min(u[f], int(tree.cut[node]))
            else:
                a[f] = max(a[f], int(tree.cut[node]))
            stack.append((child, a, u, shares | {f: shares.get(f, 1.0) * share}))
    return Leaves(np.array(low), np.array(high), np.array(phi), expected)


def explained(fitted: Fitted, bins: np.ndarray, trees: list[Leaves]) -> np.ndarray:
    """phi of each row and feature."""
    found = np.zeros((len(bins), len(fitted.features)))
    for first in range(0, len(bins), ROWS):
        part = bins[first : first + ROWS].astype(np.int64)
        for leaves in trees:
            passed = np.zeros((len(part), len(leaves.low)), np.int64)
            for f in range(part.shape[1]):
                ok = (part[:, f, None] > leaves.low[:, f]) & (part[:, f, None] <= leaves.high[:, f])
                passed |= ok.astype(np.int64) << f
            found[first : first + ROWS] += leaves.phi[np.arange(len(leaves.low)), passed].sum(axis=1)
    return found


def boosted_stage(model: PipelineModel) -> BoostedTreesModel | None:
    """The boosted trees of a pipeline that ends with them."""
    last = model.stages[-1]
    return last if isinstance(last, BoostedTreesModel) else None


def tree_shapley_values(model: PipelineModel, rows: DataFrame, key: str = "customer_id") -> DataFrame:
    """(key, phi_<feature>..., base, prediction) of every row with all features, on the margin: phi sums to ``prediction - base``,
    ``base`` is the mean margin in the shares of the learnt rows."""
    fitted = boosted_stage(model).fitted
    if len(fitted.features) > MOST_FEATURES:
        raise ValueError(f"more than {MOST_FEATURES} features")
    trees = [leaves_of(t, len(fitted.features)) for t in fitted.trees]
    base = fitted.base + sum(t.expected for t in trees)
    shared = rows.sparkSession.sparkContext.broadcast(trees)  # the model

    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in columns:
            bins = binned([c.to_numpy(zero_copy_only=False) for c in batch], fitted.cuts)
            yield pa.array(list(explained(fitted, bins, shared.value)), pa.list_(pa.float64()))

    complete = rows.select(key, *fitted.features).na.drop(subset=fitted.features)
    phi = F.arrow_udf(run, "array<double>")(*[F.col(f).cast("double") for f in fitted.features])
    held = complete.select(key, phi.alias("_phi"))
    total = F.aggregate("_phi", F.lit(0.0), lambda a, x: a + x)
    return held.select(key, *[F.get("_phi", F.lit(j)).alias(f"phi_{f}") for j, f in enumerate(fitted.features)], F.lit(base).alias("base"), (F.lit(base) + total).alias("prediction"))
