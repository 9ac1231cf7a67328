"""K-Means for many starts at once: each step of all models is one aggregation.

A task goes through its points once a step, finds the nearest centre of every open model and sums points by (model, cluster); the
partial sums are one row per model and cluster of a task, so the shuffle does not grow with the points. Models
that have come to rest are left out of later steps.

Starts come from scalable seeding: a few rounds add to one set of candidates every point with a probability in
proportion to its squared distance from the set, the candidates are weighted by the points nearest to them,
and each start draws its centres from these weighted candidates with a seed of its own. Whether a point is drawn
follows from its values alone, so equal points are one candidate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps of a model at most, and the squared way of all its centres, as a share of the mean variance, at which it rests.
STEPS, REST = 50, 1e-4
#: Rounds of seeding, and points that a round adds on average, as multiples of the largest k.
SEED_ROUNDS, OVERSAMPLING = 5, 4


@dataclass
class Centres:
    """The centres of one model and its cost, the sum of squared distances."""

    at: np.ndarray
    cost: float
    steps: int = 0

    def nearest(self, x: Column) -> Column:
        """The number of the nearest centre of the array ``x``; of equal ones the first."""
        distances = F.array(*[sum((F.get(x, F.lit(j)) - F.lit(float(v))) ** 2 for j, v in enumerate(c)) for c in self.at])
        return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")

    def transform(self, points: DataFrame, x: str = "x", cluster: str = "kmeans_cluster") -> DataFrame:
        return points.withColumn("_x", vector_to_array(x)).withColumn(cluster, self.nearest(F.col("_x"))).drop("_x")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    return ((x[:, None, :] - centres[None, :, :]) ** 2).sum(axis=2)


def lloyd_sums(arrays: DataFrame, models: dict[int, np.ndarray]) -> DataFrame:
    """(model, cluster, n, cost, sums) of ``arrays(x)``: the points nearest to each centre of each model."""

    def run(batches: Iterator[pa.RecordBatch]):
        totals = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch["x"])
            for m, centres in models.items():
                distances = _distances(x, centres)
                nearest = distances.argmin(axis=1)
                k = len(centres)
                n = np.bincount(nearest, minlength=k)
                cost = np.bincount(nearest, distances[np.arange(len(x)), nearest], k)
                sums = np.stack([np.bincount(nearest, x[:, j], k) for j in range(x.shape[1])], axis=1)
                old = totals.get(m)
                totals[m] = (n, cost, sums) if old is None else tuple(a + b for a, b in zip(old, (n, cost, sums)))
        rows = [(m, c, int(n[c]), float(cost[c]), sums[c].tolist()) for m, (n, cost, sums) in totals.items() for c in range(len(n)) if n[c]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["model", "cluster", "n", "cost", "sums"])

    partial = arrays.mapInArrow(run, "model int, cluster int, n bigint, cost double, sums array<double>")
    dims = len(next(iter(models.values()))[0])
    each = [F.sum(F.get("sums", F.lit(j))).alias(f"s{j}") for j in range(dims)]
    totals = partial.groupBy("model", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *each)
    return totals.select("model", "cluster", "n", "cost", F.array(*[f"s{j}" for j in range(dims)]).alias("sums"))


def _cost_and_counts(arrays: DataFrame, centres: np.ndarray) -> tuple[float, np.ndarray]:
    rows = lloyd_sums(arrays, {0: centres}).select("cluster", "n", "cost").collect()  # a row per centre
    counts = np.zeros(len(centres))
    for r in rows:
        counts[r["cluster"]] = r["n"]
    return sum(r["cost"] for r in rows), counts


def _drawn(arrays: DataFrame, centres: np.ndarray, cost: float, wanted: float, seed: int) -> np.ndarray:
    """Points drawn in proportion to their squared distance, ``wanted`` of them on average."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch["x"])
                chance = wanted * _distances(x, centres).min(axis=1) / cost
                u = np.array([xxhash.xxh64_intdigest(np.ascontiguousarray(r).tobytes(), seed & 0xFFFFFFFF) for r in x]) / 2.0**64
                yield batch.filter(pa.array(u < chance))

    found = arrays.mapInArrow(run, "x array<double>").distinct().collect()  # ``wanted`` on average
    return np.array([r["x"] for r in found]).reshape(len(found), centres.shape[1])


def _start(candidates: np.ndarray, weights: np.ndarray, k: int, seed: list[int]) -> np.ndarray:
    """k of the weighted candidates: the first by weight, the next by weight times squared distance from those before."""
    chance = np.random.default_rng(seed)
    chosen = [int(chance.choice(len(candidates), p=weights / weights.sum()))]
    while len(chosen) < k:
        left = weights * _distances(candidates, candidates[chosen]).min(axis=1)
        if left.sum() <= 0:  # fewer different points than centres
            left = np.ones(len(candidates))
        chosen.append(int(chance.choice(len(candidates), p=left / left.sum())))
    return candidates[chosen]


def seeds(arrays: DataFrame, k_max: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates for the centres and how many points are nearest to each."""
    centre = np.array(arrays.agg(*[F.avg(F.get("x", F.lit(j))) for j in range(len(arrays.first()["x"]))]).first(), float)
    candidates = centre[None, :]
    for round_ in range(SEED_ROUNDS):
        cost, _ = _cost_and_counts(arrays, candidates)
        if cost <= 0:
            break
        drawn = _drawn(arrays, candidates, cost, OVERSAMPLING * k_max, seed * 1000 + round_)
        candidates = np.concatenate([candidates, drawn[np.lexsort(drawn.T[::-1])]])
    _, counts = _cost_and_counts(arrays, candidates)
    return candidates[counts > 0], counts[counts > 0]


def k_means(points: DataFrame, starts: dict[int, int], seed: int, steps: int = STEPS, rest: float = REST) -> dict[int, Centres]:
    """The best of ``starts[k]`` starts for each k, over the vectors ``x`` of stored ``points``."""
    arrays = points.select(vector_to_array("x").alias("x"))
    candidates, weights = seeds(arrays, max(starts), seed)
    spread = float((weights[:, None] * (candidates - np.average(candidates, axis=0, weights=weights)) ** 2).sum() / weights.sum()) / candidates.shape[1]
    models = {}
    for k, n in starts.items():
        for i in range(n):
            models[len(models)] = Centres(_start(candidates, weights, k, [seed, k, i]), float("inf"))
    open_ = dict(models)
    for step in range(steps + 1):
        if not open_:
            break
        sums: dict[int, list] = {}
        for r in lloyd_sums(arrays, {m: c.at for m, c in open_.items()}).collect():  # a row per model and cluster
            sums.setdefault(r["model"], []).append(r)
        for m, rows in sums.items():
            model, later = open_[m], open_[m].at.copy()
            for r in rows:
                later[r["cluster"]] = np.array(r["sums"]) / r["n"]  # a centre without points stays
            # The cost belongs to the centres that the points were compared with.
            model.cost, model.steps = sum(r["cost"] for r in rows), step
            if step == steps or ((later - model.at) ** 2).sum() <= rest * spread:
                del open_[m]
            else:
                model.at = later
    best = {}
    for model in models.values():
        k = len(model.at)
        if k not in best or model.cost < best[k].cost:
            best[k] = model
    return best
