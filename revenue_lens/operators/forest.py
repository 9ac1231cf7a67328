"""Random forest on histograms: bootstrapped trees, some features a node, weighted Gini gain, grown level by level.

Features are cut into at most 32 bins by exact ranks. How often a tree draws a row is a Poisson(1) number from a hash of the key
and the tree, so trees do not depend on partitions. In each step a tree sums the weights of both classes by (open node, one of its
features, bin); weights are whole multiples of 2**-20, so neither does the order of rows matter.

Up to BLOCK_ROWS rows a task grows TREES_PER_TASK whole trees and reads the stored rows itself. More rows lie in blocks of JOB_ROWS;
there a level of TREES_PER_JOB trees is a job over all blocks, whose shuffle adds up the sums and picks the splits. The trees are the same.
"""

from __future__ import annotations

import base64
import io
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenue_lens.operators.boosting import BLOCK_ROWS, JOB_ROWS, SCORED_ROWS, TASKS_PER_CORE, UNIT, Fitted, Tree, bins_column, binned, each_task, feature_cuts, read_bins
from revenue_lens.operators.storage import materialize

BINS = 32
TREES_PER_TASK, TREES_PER_JOB = 5, 25
#: Rows of a block that are summed at once.
PART = 1 << 17
#: Poisson(1) number of each value of 16 random bits.
_DRAWS = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)

#: Arrays of some rows by name: ``bins`` by row and feature in one line, ``label``, ``weight``, ``hash``.
_Block = dict[str, np.ndarray]


def drawn(hashes: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often ``tree`` draws each row."""
    found = np.empty(len(hashes), np.uint8)
    start = np.uint64((seed * 0x9E3779B97F4A7C15 + (tree + 1) * 0xD1B54A32D192ED03) % (1 << 64))
    for first in range(0, len(hashes), PART):
        z = hashes[first : first + PART] + start
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        found[first : first + PART] = _DRAWS[(z ^ (z >> np.uint64(31))) >> np.uint64(48)]
    return found


@dataclass
class _Step:
    """What became of the open nodes of a level: split at (feature, cut), rows go to place ``to`` [node, right] among the next
    level's open nodes; ``open`` of those, and that number for rows of closed nodes."""

    feature: np.ndarray
    cut: np.ndarray
    to: np.ndarray
    open: int


class _Sample:
    """The rows of a block that a tree draws, by the open nodes of its level."""

    def __init__(self, block: _Block, features: int, seed: int, tree: int):
        times = drawn(block["hash"], seed, tree)
        rows = np.flatnonzero((times > 0) & (block["weight"] > 0))
        self.bins, self.at = block["bins"], rows * features
        self.weight, self.label = block["weight"][rows] * times[rows], block["label"][rows]
        self.node, self.open = np.zeros(len(rows), np.int32), 1

    def move(self, step: _Step) -> None:
        to, feature, cut = np.append(step.to, [[step.open] * 2], 0).ravel().astype(np.int32), np.append(step.feature, 0), np.append(step.cut, 0)
        for first in range(0, len(self.at), PART):
            part = slice(first, first + PART)
            node = self.node[part]
            right = self.bins[self.at[part] + feature[node]] > cut[node]
            self.node[part] = to[node * 2 + right]
        self.open = step.open
        closed = self.node == step.open
        if np.count_nonzero(closed) * 8 > len(closed):
            kept = np.flatnonzero(~closed)
            self.at, self.weight, self.label, self.node = (v[kept] for v in (self.at, self.weight, self.label, self.node))

    def sums(self, allowed: np.ndarray) -> np.ndarray:
        """Weights [node, one of the node's features, bin, class]."""
        found = np.zeros((allowed.shape[1], (self.open + 1) * BINS * 2))
        places = np.append(allowed, [[0] * allowed.shape[1]], 0).T.copy()
        for first in range(0, len(self.at), PART):
            part = slice(first, first + PART)
            node, at, weight = self.node[part], self.at[part], self.weight[part]
            own = node * (BINS * 2) + self.label[part]
            for j, feature in enumerate(places):
                found[j] += np.bincount(own + 2 * self.bins[at + feature[node]].astype(np.int32), weight, found.shape[1])
        return found.reshape(len(found), -1, BINS, 2)[:, :-1].swapaxes(0, 1)


#: (gain, place among the node's features, cut, left sums) of the best split of each open node, and the sums of the nodes.
_Best = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def best_splits(sums: np.ndarray) -> _Best:
    """Of equal gains the first feature and the lowest cut wins. The gain is the fall of the weighted Gini impurity up to a factor of
    the node; exactly 0 in pure nodes."""
    left = np.cumsum(sums, axis=2)
    total = left[:, :, -1:]
    right = total - left
    in_left, in_right = left.sum(axis=-1), right.sum(axis=-1)
    both = np.minimum(in_left, in_right) > 0
    apart = left[..., 1] / np.where(both, in_left, 1) - right[..., 1] / np.where(both, in_right, 1)
    gain = np.where(both, apart**2 * in_left * in_right, 0.0).reshape(len(sums), -1)
    at = gain.argmax(axis=1)
    place, cut, nodes = at // BINS, at % BINS, np.arange(len(sums))
    return gain[nodes, at], place, cut, left[nodes, place, cut], total[:, 0, 0]


class _Growing:
    """One tree while it grows."""

    def __init__(self, features: int, depth: int, seed: int, tree: int):
        self.features, self.depth, self.chance = features, depth, np.random.default_rng([seed, tree])
        self.feature, self.cut, self.left, self.sums = np.array([-1]), np.array([0]), np.array([-1]), np.zeros((1, 2))
        self.open, self.steps = np.array([0]), []
        self._choose()

    def _choose(self) -> None:
        """The square root of all features, rounded up, for each open node."""
        some = math.isqrt(self.features - 1) + 1
        self.allowed = np.sort(np.argsort(self.chance.random((len(self.open), self.features)), axis=1)[:, :some], axis=1)

    def learn(self, best: _Best) -> None:
        gain, place, cut, left, total = best
        if not self.steps:
            self.sums = total.copy()
        split = np.flatnonzero(gain > 0)
        parents, size = self.open[split], len(self.feature)
        feature = self.allowed[np.arange(len(self.open)), place]
        self.feature[parents], self.cut[parents], self.left[parents] = feature[split], cut[split], size + 2 * np.arange(len(split))
        children = np.stack([left[split], total[split] - left[split]], axis=1).reshape(-1, 2)
        self.feature = np.append(self.feature, np.full(len(children), -1))
        self.cut, self.left = np.append(self.cut, np.zeros(len(children), np.int64)), np.append(self.left, np.full(len(children), -1))
        self.sums = np.append(self.sums, children, 0)
        goes_on = (children.min(axis=1) > 0) & (len(self.steps) + 1 < self.depth)
        number = int(goes_on.sum())
        to = np.full((len(self.open), 2), number)
        to[split] = np.where(goes_on, np.cumsum(goes_on) - 1, number).reshape(-1, 2)
        self.steps.append(_Step(feature, cut, to, number))
        self.open = size + np.flatnonzero(goes_on)
        self._choose()

    def tree(self) -> Tree:
        value = self.sums[:, 1] / self.sums.sum(axis=1)
        right = np.where(self.left < 0, -1, self.left + 1)
        return Tree(self.feature, self.cut, self.left, right, np.where(self.left < 0, value, 0.0), np.zeros(0, np.int64))


def fit(rows: DataFrame, features: list[str], label: str, key: str, weight: str, trees: int, depth: int, seed: int = 0, block_rows: int = BLOCK_ROWS) -> Fitted:
    """Grow a forest over ``rows(<features>, <label>, <key>, <weight>)``; values of leaves are shares of label 1."""
    cuts = feature_cuts(rows, features, BINS)
    whole = F.round(F.col(weight) * UNIT).cast("bigint")
    table = materialize(rows.select(bins_column(features, cuts).alias("bins"), F.col(label).cast("int").alias("label"), whole.alias("weight"), F.xxhash64(key).alias("hash")))
    classes = {r["label"]: r for r in table.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")).collect()}
    if any(y not in classes or classes[y]["weight"] <= 0 for y in (0, 1)):
        raise ValueError("both classes need rows of positive weight")
    count = sum(r["n"] for r in classes.values())
    grow = _grown_by_task if count <= block_rows else _grown_by_jobs
    return Fitted(features, cuts, 0.0, grow(table, len(features), trees, depth, seed, -(-count // min(block_rows, JOB_ROWS))))


def _block(batches: list[pa.RecordBatch], features: int) -> _Block:
    of = lambda c, t: np.concatenate([b[c].to_numpy().astype(t) for b in batches])
    return {"bins": read_bins(batches, features).ravel(), "label": of("label", np.int32), "weight": of("weight", np.float64), "hash": of("hash", np.int64).view(np.uint64)}


def _grown_by_task(table: DataFrame, features: int, trees: int, depth: int, seed: int, parts: int) -> list[Tree]:
    """A task for some trees, which reads the rows itself; the driver gets the trees."""

    def run(batches):
        held = list(batches)
        if not held:
            return
        first, block = held[0]["id"][0].as_py() * TREES_PER_TASK, _block(held, features)
        held.clear()
        for t in range(first, min(first + TREES_PER_TASK, trees)):
            growing, sample = _Growing(features, depth, seed, t), _Sample(block, features, seed, t)
            while len(growing.open):
                growing.learn(best_splits(sample.sums(growing.allowed)))
                sample.move(growing.steps[-1])
            yield pa.RecordBatch.from_pydict({"t": [t], "tree": [pickle.dumps(vars(growing.tree()))]})

    done = materialize(each_task(table, -(-trees // TREES_PER_TASK)).mapInArrow(run, "t bigint, tree binary"))
    return [Tree(**pickle.loads(r["tree"])) for r in done.orderBy("t").collect()]


def _grown_by_jobs(table: DataFrame, features: int, trees: int, depth: int, seed: int, parts: int) -> list[Tree]:
    """A job per level of some trees. A block finds its rows' nodes from the tree so far; the driver gets splits only."""

    def pack(batches):
        if held := list(batches):
            yield pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(_block(held, features))], pa.binary())})

    spark = table.sparkSession
    blocks = materialize(table.repartition(parts, "hash").mapInArrow(pack, "block binary"))
    few = blocks.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism).rdd
    found = []
    for first in range(0, trees, TREES_PER_JOB):
        group = {t: _Growing(features, depth, seed, t) for t in range(first, min(first + TREES_PER_JOB, trees))}
        while open_ := {t: g for t, g in group.items() if len(g.open)}:
            best = few.flatMap(_level(open_, features, seed)).reduceByKey(np.add, len(open_)).mapValues(best_splits)
            for t, splits in best.collect():
                open_[t].learn(splits)
        found += [g.tree() for g in group.values()]
    return found


def _level(open_: dict[int, _Growing], features: int, seed: int):
    asked = {t: (g.steps, g.allowed) for t, g in open_.items()}

    def run(row):
        block = pickle.loads(row["block"])
        for t, (steps, allowed) in asked.items():
            sample = _Sample(block, features, seed, t)
            for step in steps:
                sample.move(step)
            yield t, sample.sums(allowed)

    return run


# --- the model ------------------------------------------------------------------------


class ForestModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (a vector of two): the mean share of label 1 in the leaves of a row, over all trees."""

    content = Param(Params._dummy(), "content", "cuts and nodes, as a compressed archive in base 64", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, content=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, fitted: Fitted) -> ForestModel:
        joined = lambda k, t: np.concatenate([getattr(tree, k) for tree in fitted.trees]).astype(t)
        nodes = {"feature": joined("feature", np.int8), "cut": joined("cut", np.uint8), "left": joined("left", np.int32), "value": joined("value", np.float64)}
        held = io.BytesIO()
        sizes = {"sizes": np.array([len(t.feature) for t in fitted.trees])}
        np.savez_compressed(held, **nodes, **sizes, **{f"cuts{j}": c for j, c in enumerate(fitted.cuts)})
        return cls(inputCols=fitted.features, content=base64.b64encode(held.getvalue()).decode())

    @property
    def fitted(self) -> Fitted:
        with np.load(io.BytesIO(base64.b64decode(self.getOrDefault(self.content)))) as held:
            nodes = {k: held[k].astype(np.float64 if k == "value" else np.int64) for k in ("feature", "cut", "left", "value")}
            ends = np.cumsum(held["sizes"])
            cuts = [held[f"cuts{j}"] for j in range(len(self.getInputCols()))]
        trees = []
        for start, end in zip([0, *ends[:-1]], ends):
            own = {k: v[start:end] for k, v in nodes.items()}
            trees.append(Tree(**own, right=np.where(own["left"] < 0, -1, own["left"] + 1), rows=np.zeros(0, np.int64)))
        return Fitted(self.getInputCols(), cuts, 0.0, trees)

    def share(self) -> Column:
        fitted = self.fitted
        ready = []
        for t in fitted.trees:
            inner, itself = t.feature >= 0, np.arange(len(t.feature))
            # Rows stay in a leaf: no bin lies above 255.
            ready.append((np.where(inner, t.feature, 0), np.where(inner, t.cut, 255).astype(np.uint8), np.where(inner, t.left, itself), t.value, _levels(t)))

        def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for batch in columns:
                bins = binned([c.to_numpy(zero_copy_only=False) for c in batch], fitted.cuts)
                found = np.zeros(len(bins))
                for first in range(0, len(bins), SCORED_ROWS):
                    part = bins[first : first + SCORED_ROWS]
                    flat, start = part.ravel(), np.arange(len(part)) * part.shape[1]
                    for feature, cut, left, value, levels in ready:
                        at = np.zeros(len(part), np.int64)
                        for _ in range(levels):
                            at = left[at] + (flat[start + feature[at]] > cut[at])
                        found[first : first + SCORED_ROWS] += value[at]
                yield pa.array(found / len(ready), pa.float64())

        return F.arrow_udf(run, "double")(*[F.col(f).cast("double") for f in fitted.features])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = F.col("_share")
        return dataset.withColumn("_share", self.share()).withColumn("probability", array_to_vector(F.array(1.0 - p, p))).drop("_share")


def _levels(tree: Tree) -> int:
    """Splits on the longest path."""
    found, nodes = 0, np.array([0])
    while len(nodes := nodes[tree.feature[nodes] >= 0]):
        found, nodes = found + 1, np.concatenate([tree.left[nodes], tree.right[nodes]])
    return found
