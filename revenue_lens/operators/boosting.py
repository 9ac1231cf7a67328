"""Gradient boosting on histograms: many models grow side by side, one aggregation per level for all of them.

Features are cut into at most 256 bins by exact ranks. Rows that agree in bins, label, fold and bucket have the same
prediction in every model, so they collapse to one weighted row. A model is a grid point and the fold it leaves
out. In each step every unfinished tree names the nodes it wants to know; gradients, hessians and row counts are summed by
(model, node, feature, bin). Leaves are split in the order of their gains up to a number of leaves, a depth or both;
nodes that may still be split are looked up ahead of their turn, so a step serves a whole level.

Up to BLOCK_ROWS collapsed rows (about 80 bytes each) the jobs of the steps would take longer than the sums, so every model takes
its steps in a task of its own, which reads the rows from storage, keeps those of each node and gets the larger of two siblings as
their parent less the smaller one. More rows lie in blocks of JOB_ROWS; there a step is one job over all blocks for all models. Histograms are added
up per model in the shuffle and its tasks pick the splits, so that the driver gets nothing but those; a job has
TASKS_PER_CORE tasks a core at most, so that their reports do not grow with the rows either. The trees are the same.

Weights and gradients are whole multiples of 2**-20, so sums do not depend on the order of rows or on their partitions. Row
samples leave out buckets of a hash of the key; samples of features and buckets come from a generator seeded per model.
"""

from __future__ import annotations

import heapq
import json
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenue_lens.functions import hash_uniform
from revenue_lens.operators.ranking import running_totals
from revenue_lens.operators.storage import materialize, shared_folder

BINS = 256
#: Whole parts of a weight of 1.
UNIT = 1 << 20
#: Parts of the rows that row samples are made of.
BUCKETS = 20
#: Collapsed rows that a task may hold for a model, those of a block where there are more, and rounds between two cuts of the lineage.
BLOCK_ROWS, JOB_ROWS, CHECKPOINT_ROUNDS = 1 << 23, 1 << 16, 25
#: Tasks that add up histograms, at most, and tasks of a core that read the blocks of a step.
DIRECT_BLOCKS, TASKS_PER_CORE = 32, 2
#: Rows that a model scores at once.
SCORED_ROWS = 4096
#: Rows of a block that are summed at once, and the fewest for which it pays to sum two numbers as one.
PART, LEAST_TOGETHER = 1 << 14, 1 << 10


@dataclass(frozen=True)
class Booster:
    """How one model is grown. ``fold``: the fold it does not learn from."""

    name: str
    rounds: int
    rate: float
    weight: str
    max_depth: int = 64
    max_leaves: int = 1 << 16
    l2: float = 0.0
    min_rows: int = 1
    min_hessian: float = 1e-3
    row_share: float = 1.0
    feature_share: float = 1.0
    fold: int | None = None
    seed: int = 0


@dataclass
class Tree:
    """Nodes as arrays; node 0 is the root, ``feature`` -1 marks a leaf, values up to bin ``cut`` go left. ``rows`` counts
    the learnt rows of each node."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    rows: np.ndarray

    def places(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of ``bins``."""
        at = np.zeros(len(bins), np.int64)
        if self.feature[0] < 0:
            return at
        rows = np.arange(len(bins))
        while len(rows):
            here = at[rows]
            goes_left = bins[rows, self.feature[here]] <= self.cut[here]
            at[rows] = np.where(goes_left, self.left[here], self.right[here])
            rows = rows[self.feature[at[rows]] >= 0]
        return at


@dataclass
class Fitted:
    """A grown model: margin of a row = ``base`` + the values of its leaves."""

    features: list[str]
    cuts: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)


# --- bins -----------------------------------------------------------------------------


def feature_cuts(rows: DataFrame, features: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Per feature the largest value of each bin but the last. A value that c of n rows do not exceed lies in bin
    floor((c - 1) * bins / n); bins without a value are left out."""
    cells = F.array(*[F.struct(F.lit(k).alias("feature"), F.col(f).cast("double").alias("x")) for k, f in enumerate(features)])
    by_value = rows.select(F.inline(cells)).groupBy("feature", "x").agg(F.count(F.lit(1)).alias("n"))
    at = running_totals(by_value, "feature", "x", ["n"])
    number = F.floor((F.col("cum_n") - 1) * bins / F.col("all_n"))
    ends = at.groupBy("feature", number.alias("bin")).agg(F.max("x").alias("x")).select("feature", "x").toArrow()
    feature, x = ends["feature"].to_numpy(), ends["x"].to_numpy()
    return [np.sort(x[feature == k])[:-1] for k in range(len(features))]


def binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of cuts below it."""
    return np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, values)], axis=1).astype(np.uint8)


def bins_column(features: list[str], cuts: list[np.ndarray]) -> Column:
    def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in columns:
            found = binned([c.to_numpy(zero_copy_only=False) for c in batch], cuts)
            yield pa.array([r.tobytes() for r in found], pa.binary())

    return F.arrow_udf(run, "binary")(*[F.col(f).cast("double") for f in features])


def read_bins(batches: list[pa.RecordBatch], features: int) -> np.ndarray:
    """The column ``bins`` of ``batches`` by row and feature."""
    held = []
    for batch in batches:
        _, ends, content = batch["bins"].buffers()
        ends = np.frombuffer(ends, np.int32)[batch["bins"].offset :][: batch.num_rows + 1]
        held.append(np.frombuffer(content, np.uint8)[ends[0] : ends[-1]])
    return np.concatenate(held).reshape(-1, features)


def each_task(table: DataFrame, tasks: int) -> DataFrame:
    """The rows of a stored ``table`` for every ``id`` below ``tasks``: a partition per id, whose task reads them itself."""
    numbers = table.sparkSession.range(0, tasks, 1, tasks)
    return table.coalesce(1).crossJoin(numbers.hint("shuffle_replicate_nl"))  # only the numbers are held back by the join


def collapsed(rows: DataFrame, features: list[str], cuts: list[np.ndarray], label: str, key: str, weights: list[str], seed: int) -> DataFrame:
    """(bins, label, fold, bucket, n, <weights in whole parts>): rows that no model can tell apart, as one."""
    bucket = F.floor(hash_uniform(seed, "bucket", F.col(key)) * BUCKETS).cast("int")
    whole = [F.round(F.col(w) * UNIT).cast("bigint").alias(w) for w in weights]
    cells = rows.select(bins_column(features, cuts).alias("bins"), F.col(label).cast("int").alias("label"), "fold", bucket.alias("bucket"), *whole)
    return cells.groupBy("bins", "label", "fold", "bucket").agg(F.count(F.lit(1)).alias("n"), *[F.sum(w).alias(w) for w in weights])


#: Arrays of one block by name, a plain dict that any worker can unpickle; ``bins`` is by feature and row, ``weights`` by weight
#: column and row, ``margins`` by model and row.
_Block = dict[str, np.ndarray]


def _blocks(table: DataFrame, rows: int, features: int, weights: list[str], block_rows: int = JOB_ROWS) -> DataFrame:
    """The collapsed ``rows`` in pickled blocks of about ``block_rows``, JOB_ROWS at most."""
    parts = max(1, -(-rows // min(block_rows, JOB_ROWS)))

    def pack(batches):
        tables = list(batches)
        if not sum(b.num_rows for b in tables):
            return
        whole = pa.Table.from_batches(tables)
        of = lambda c: whole[c].to_numpy()
        bins = np.frombuffer(b"".join(whole["bins"].to_pylist()), np.uint8).reshape(-1, features)
        small = {c: of(c).astype(np.int8) for c in ("label", "fold", "bucket")}
        block = {"bins": np.ascontiguousarray(bins.T), **small, "n": of("n").astype(np.float64), "weights": np.stack([of(w) for w in weights])}
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block)], pa.binary())], ["block"])

    keys = ["bins", "label", "fold", "bucket"]
    return materialize(table.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(pack, "block binary"))


# --- histograms -----------------------------------------------------------------------


@dataclass
class _Ask:
    """Nodes of a model's open tree that are wanted: the root, or pairs of siblings, the smaller one first."""

    model: int
    booster: Booster
    weight: int
    buckets: np.ndarray | None  # those of the row sample
    allowed: np.ndarray  # features
    tree: Tree
    nodes: list[int]


class _Places:
    """Numbers of rows by the nodes of a tree, as stretches of two arrays: the children of a node take its stretch of the other one.
    Nothing is allocated while a tree grows; memory fresh from the system costs more than the sums."""

    def __init__(self, columns: np.ndarray, rows: np.ndarray, arrays: np.ndarray):
        self.columns, self.arrays, self.of = columns, arrays, {0: (0, 0, len(rows))}
        arrays[0, : len(rows)] = rows

    def parts(self, node: int, size: int) -> Iterator[np.ndarray]:
        side, start, end = self.of[node]
        for first in range(start, end, size):
            yield self.arrays[side, first : min(first + size, end)]

    def descend(self, tree: Tree) -> None:
        """Hand the rows of nodes that are split by now to their children."""
        split = [node for node in self.of if tree.feature[node] >= 0]
        while split:
            node = split.pop()
            column, cut = self.columns[tree.feature[node]], tree.cut[node]
            side, start, end = self.of[node]
            upto, other = end, self.arrays[1 - side]
            for rows in self.parts(node, PART):
                goes_left = column.take(rows) <= cut
                left = rows.compress(goes_left)
                right = rows.compress(np.logical_not(goes_left, out=goes_left))
                other[start : start + len(left)], other[upto - len(right) : upto] = left, right
                start, upto = start + len(left), upto - len(right)
            first = self.of.pop(node)[1]
            for child, stretch in ((int(tree.left[node]), (1 - side, first, start)), (int(tree.right[node]), (1 - side, start, end))):
                self.of[child] = stretch
                if tree.feature[child] >= 0:
                    split.append(child)


def _close_together(bins: np.ndarray) -> np.ndarray:
    """An order of the rows of ``bins`` [feature, row], by the feature with the most values first: rows of a node then lie close together,
    which the sums read a sixth faster."""
    values = [np.count_nonzero(np.bincount(column, minlength=BINS)) for column in bins]
    return np.lexsort([bins[f] for f in np.argsort(values, kind="stable")])


def _scratch(rows: int) -> dict[str, np.ndarray]:
    """Arrays that the trees of a model use one after the other."""
    whole = lambda *shape: np.empty(shape, np.int32)
    return {"numbers": np.empty((rows, 3)), "learnt": whole(2, rows), "rest": whole(2, rows), "leaf": whole(rows)}


class _Rows:
    """The rows of a block that a tree learns from, by the nodes of the open tree, with their gradients; ``rest``: the others.

    Hessians and row counts are one number: a double holds the sums of both of up to ``size`` rows side by side, the count in whole
    multiples of ``unit``. Where weights and counts are too large for that they are numbers of their own."""

    def __init__(self, block: _Block, ask: _Ask):
        margins, w, n = block["margins"][ask.model], block["weights"][ask.weight], block["n"]
        scratch = block["scratch"] if "scratch" in block else _scratch(len(n))
        use = np.ones(len(n), bool)
        if ask.booster.fold is not None:
            use &= block["fold"] != ask.booster.fold
        if ask.buckets is not None:
            use &= ask.buckets[block["bucket"]]
        self.learnt = _Places(block["bins"], np.flatnonzero(use), scratch["learnt"])
        self.rest = _Places(block["bins"], np.flatnonzero(~use), scratch["rest"])
        most = max(float(w.max(initial=0)) / 4, 1.0)  # of a hessian
        size = min(PART, int(math.sqrt(2**51 / (most * max(float(n.max(initial=0)), 1.0)))))
        self.unit = 2.0 ** math.ceil(math.log2(size * most + 1)) if size >= LEAST_TOGETHER else 0.0
        self.size, count = (size, 2) if self.unit else (PART, 3)
        self.numbers = scratch["numbers"].reshape(-1)[: count * len(n)].reshape(-1, count)
        for first in range(0, len(n), PART):
            part = slice(first, first + PART)
            p = 1.0 / (1.0 + np.exp(-margins[part]))
            np.rint((p - block["label"][part]) * w[part], out=self.numbers[part, 0])
            hessian = np.rint(p * (1.0 - p) * w[part])
            if self.unit:
                self.numbers[part, 1] = n[part] * self.unit + hessian
            else:
                self.numbers[part, 1], self.numbers[part, 2] = hessian, n[part]

    def histogram(self, node: int) -> np.ndarray:
        """Gradients, hessians and row counts [3, feature, bin] of the rows of a node."""
        columns, count = self.learnt.columns, self.numbers.shape[1]
        found, sums = np.zeros((3, len(columns), BINS)), np.empty((count, len(columns), BINS))
        for rows in self.learnt.parts(node, self.size):
            rows = rows.astype(np.intp)
            values = self.numbers.take(rows, axis=0).T.copy()
            for f, column in enumerate(columns):
                at = column.take(rows).astype(np.intp)
                for k, v in enumerate(values):
                    sums[k, f] = np.bincount(at, v, BINS)
            if self.unit:
                n = np.floor(sums[1] / self.unit)
                found[0] += sums[0]
                found[1] += sums[1] - n * self.unit
                found[2] += n
            else:
                found += sums
        return found.astype(np.int64)


#: (gain, feature, cut, left sums) of the best split of each wanted node, and the sums of the nodes.
_Splits = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def _splits(ask: _Ask, histograms: np.ndarray) -> _Splits:
    settings = [np.full(len(histograms), v) for v in (ask.booster.l2, ask.booster.min_rows, ask.booster.min_hessian)]
    allowed = np.broadcast_to(ask.allowed, (len(histograms), len(ask.allowed)))
    return *best_splits(histograms, *settings, allowed), histograms[:, :, 0].sum(axis=-1)


def _histograms(asks: list[_Ask]):
    def run(block: _Block):
        for ask in asks:
            rows = _Rows(block, ask)
            rows.learnt.descend(ask.tree)
            yield ask.model, np.stack([rows.histogram(node) for node in ask.nodes])

    return run


def _with_trees(trees: list[tuple[int, Tree]]):
    def run(block: _Block):
        margins = block["margins"].copy()
        for model, tree in trees:
            margins[model] += tree.value[tree.places(block["bins"].T)]
        return block | {"margins": margins}

    return run


def split_gains(histograms: np.ndarray, l2: np.ndarray, min_rows: np.ndarray, min_hessian: np.ndarray, allowed: np.ndarray):
    """Gain [node, feature, cut] of every split of the nodes of ``histograms`` [node, 3, feature, bin] (gradients and hessians in
    whole parts, rows), -inf where it is not allowed, and the sums left of it."""
    left = np.cumsum(histograms, axis=-1)
    total = left[..., -1:]
    right = total - left
    column = lambda v: v[:, None, None]
    score = lambda s: (s[:, 0] / UNIT) ** 2 / np.maximum(s[:, 1] / UNIT + column(l2), 1e-16)
    fits = (np.minimum(left[:, 2], right[:, 2]) >= column(np.maximum(min_rows, 1))) & (np.minimum(left[:, 1], right[:, 1]) >= column(min_hessian) * UNIT) & allowed[:, :, None]
    return np.where(fits, score(left) + score(right) - score(total), -np.inf), left


def best_splits(histograms: np.ndarray, *settings: np.ndarray):
    """(gain, feature, cut, left sums) per node; gain 0 or less where no split helps. Of equal gains the first feature and the
    lowest cut wins."""
    gain, left = split_gains(histograms, *settings)
    gain = gain.reshape(len(histograms), -1)
    at = gain.argmax(axis=1)
    feature, cut = at // histograms.shape[-1], at % histograms.shape[-1]
    nodes = np.arange(len(histograms))
    return gain[nodes, at], feature, cut, left[nodes, :, feature, cut]


class _Growing:
    """One tree while it grows."""

    def __init__(self, booster: Booster, allowed: np.ndarray):
        self.booster, self.allowed = booster, allowed
        self.feature, self.cut, self.left, self.right, self.depth, self.parent = [-1], [0], [-1], [-1], [0], [-1]
        self.sums: list = [None]  # gradient, hessian, rows
        self.split: list = [None]  # gain, feature, cut, left sums
        self.accepted: list[int] = []
        self.heap: list = []
        self.wanted = [0]

    def learn(self, found: _Splits) -> None:
        """Take what is known of the wanted nodes."""
        for node, gain, feature, cut, left, total in zip(self.wanted, *found):
            self.split[node] = float(gain), int(feature), int(cut), left
            if node == 0:
                self.sums[0] = total

    def advance(self) -> bool:
        """Accept splits in the order of their gains as far as they are known; True when the tree is complete."""
        self.wanted = []
        if not self.accepted and not self.heap:
            self._open(0)
        while self.heap and len(self.accepted) + 1 < self.booster.max_leaves:
            node = self.heap[0][1]
            if self.left[node] < 0:
                break
            heapq.heappop(self.heap)
            self.accepted.append(node)
            self._open(self.left[node])
            self._open(self.right[node])
        else:
            return True
        room = self.booster.max_leaves - len(self.accepted) - 1
        for _, node in heapq.nsmallest(room, self.heap):
            if self.left[node] < 0:
                self._expand(node)
        return False

    def _open(self, node: int) -> None:
        if self.split[node] is not None and self.split[node][0] > 0:
            heapq.heappush(self.heap, (-self.split[node][0], node))

    def _expand(self, node: int) -> None:
        _, feature, cut, left_sums = self.split[node]
        self.feature[node], self.cut[node] = feature, cut
        children = []
        for sums in (left_sums, self.sums[node] - left_sums):
            children.append(len(self.feature))
            for column, value in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.split, None)):
                column.append(value)
            self.depth.append(self.depth[node] + 1)
            self.parent.append(node)
            self.sums.append(sums)
        self.left[node], self.right[node] = children
        if self.depth[node] + 1 < self.booster.max_depth and any(self.sums[c][2] >= 2 * self.booster.min_rows for c in children):
            self.wanted += sorted(children, key=lambda c: self.sums[c][2])

    def so_far(self) -> Tree:
        none = np.zeros(len(self.feature))
        return Tree(np.array(self.feature), np.array(self.cut), np.array(self.left), np.array(self.right), none, none)

    def _numbers(self) -> dict[int, int]:
        """Number in the finished tree of each node that it keeps."""
        number = {0: 0}
        for node in self.accepted:
            for child in (self.left[node], self.right[node]):
                number[child] = len(number)
        return number

    def kept_as(self) -> list[int]:
        """Of each node, the number of the finished tree's node that its rows belong to."""
        number, found = self._numbers(), []
        for node, parent in enumerate(self.parent):  # children follow their parents
            found.append(number[node] if node in number else found[parent])
        return found

    def tree(self) -> Tree:
        """The accepted splits only."""
        number = self._numbers()
        inner = set(self.accepted)
        ordered = sorted(number, key=number.get)
        sums = np.array([self.sums[node] for node in ordered], np.float64)
        value = -self.booster.rate * (sums[:, 0] / UNIT) / np.maximum(sums[:, 1] / UNIT + self.booster.l2, 1e-16)
        pick = lambda column, of: np.array([of(column[n]) if n in inner else -1 for n in ordered], np.int64)
        same = lambda v: v
        left, right = pick(self.left, number.get), pick(self.right, number.get)
        return Tree(pick(self.feature, same), pick(self.cut, same), left, right, np.where(left < 0, value, 0.0), sums[:, 2].astype(np.int64))


# --- fitting --------------------------------------------------------------------------


@dataclass
class BoostRun:
    """Fitted models by name, and (model, label, margin, n) of the rows that each model with a fold left out."""

    models: dict[str, Fitted]
    held_out: DataFrame


_HELD_OUT = "model string, label int, margin double, n bigint"


def _base_margins(table: DataFrame, boosters: list[Booster], weights: list[str]) -> list[float]:
    """Log odds of the weighted share of label 1 among each model's rows."""
    sums = table.groupBy("fold", "label").agg(*[F.sum(w).alias(w) for w in weights]).collect()  # two rows a fold
    found = []
    for b in boosters:
        total = [sum(r[b.weight] for r in sums if r["label"] == y and r["fold"] != b.fold) for y in (0, 1)]
        if min(total) <= 0:
            raise ValueError("both classes need rows of positive weight")
        found.append(math.log(total[1] / total[0]))
    return found


def _grown(boosters: dict[int, Booster], weights: list[str], features: int, seed: int, find, add) -> dict[int, list[Tree]]:
    """The trees of each numbered booster. ``find(asks)`` gives the best splits of the wanted nodes by model, ``add(done)`` takes the
    finished trees of a round, as they grew and as they are kept, into the margins."""
    trees: dict[int, list[Tree]] = {m: [] for m in boosters}
    chance = {m: np.random.default_rng([seed, m]) for m in boosters}
    for round_ in range(max(b.rounds for b in boosters.values())):
        growing, samples = {}, {}
        for m, b in boosters.items():
            if round_ < b.rounds:
                kept = max(1, int(b.feature_share * features))
                allowed = np.zeros(features, bool)
                allowed[chance[m].permutation(features)[:kept]] = True
                growing[m] = _Growing(b, allowed)
                if b.row_share < 1:
                    samples[m] = np.zeros(BUCKETS, bool)
                    samples[m][chance[m].permutation(BUCKETS)[: max(1, round(b.row_share * BUCKETS))]] = True
        open_ = dict(growing)
        while open_:
            asks = [_Ask(m, boosters[m], weights.index(boosters[m].weight), samples.get(m), g.allowed, g.so_far(), g.wanted) for m, g in open_.items()]
            for m, found in find(asks).items():
                open_[m].learn(found)
            open_ = {m: g for m, g in open_.items() if not _settled(g)}
        done = {m: g.tree() for m, g in growing.items()}
        for m, tree in done.items():
            trees[m].append(tree)
        add([(m, growing[m], tree) for m, tree in done.items()])
    return trees


def _settled(growing: _Growing) -> bool:
    """Go on as long as nothing is wanted; True when the tree is complete."""
    while True:
        if growing.advance():
            return True
        if growing.wanted:
            return False


def _with_margins(block: _Block, bases: list[float]) -> _Block:
    return block | {"margins": np.repeat(np.array(bases)[:, None], len(block["label"]), axis=1)}


def _left_out(block: _Block, m: int, b: Booster) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(model, label, margin, n) of the rows that a model with a fold left out, by column."""
    out = block["fold"] == b.fold
    n = block["n"][out].astype(np.int64)
    return [b.name] * len(n), block["label"][out].astype(np.int32), block["margins"][m][out], n


def fit(rows: DataFrame, features: list[str], label: str, key: str, boosters: list[Booster], seed: int = 0, block_rows: int = BLOCK_ROWS) -> BoostRun:
    """Grow all ``boosters`` over ``rows(<features>, <label>, <key>, fold, <weights>)``. Up to ``block_rows`` collapsed rows go to a
    task per model; more stay in their blocks, and each step of all models is one job. Both give the same trees."""
    weights = sorted({b.weight for b in boosters})
    cuts = feature_cuts(rows, features)
    table = materialize(collapsed(rows, features, cuts, label, key, weights, seed))
    bases = _base_margins(table, boosters, weights)
    numbered = dict(enumerate(boosters))
    count = table.count()
    if count <= block_rows:
        trees, held_out = _grown_by_task(table, numbered, bases, weights, len(features), seed)
    else:
        blocks = _blocks(table, count, len(features), weights, block_rows)
        trees, held_out = _grown_by_jobs(blocks, numbered, bases, weights, len(features), seed)
    models = {b.name: Fitted(features, cuts, bases[m], trees[m]) for m, b in numbered.items() if m in trees}
    return BoostRun(models, held_out)


def _grown_by_task(table: DataFrame, boosters: dict[int, Booster], bases: list[float], weights: list[str], features: int, seed: int):
    """A task per model over the same rows, at most BLOCK_ROWS. Each task reads them itself; a broadcast would take them through the
    driver."""
    held_type = [pa.field("model", pa.string()), pa.field("label", pa.int32()), pa.field("margin", pa.float64()), pa.field("n", pa.int64())]
    longest_first = sorted(boosters, key=lambda m: (boosters[m].rounds * min(boosters[m].max_leaves, 2 ** boosters[m].max_depth), boosters[m].fold is None), reverse=True)

    def rows_of(m, content, held):
        rows = len(held[0])
        return pa.RecordBatch.from_arrays([pa.array([m] * rows, pa.int64()), pa.array([content] * rows, pa.binary()), *held], ["m", "trees", *[f.name for f in held_type]])

    def run(batches):
        held = list(batches)
        if not held:
            return
        m = longest_first[held[0]["id"][0].as_py()]
        own, used = {m: boosters[m]}, weights.index(boosters[m].weight)
        bins = read_bins(held, features).T
        order = _close_together(bins)
        of = lambda c, t: np.concatenate([b[c].to_numpy().astype(t) for b in held])[order]
        block = {"bins": np.stack([column[order] for column in bins]), **{c: of(c, np.int8) for c in ("label", "fold", "bucket")}, "n": of("n", np.float64)}
        block |= {"weights": {used: of(weights[used], np.float64)}, "margins": {m: np.full(len(block["n"]), bases[m])}}
        held.clear()
        trees = _grown(own, weights, features, seed, *_in_place(block))[m]
        nothing = [pa.nulls(1, f.type) for f in held_type]
        if own[m].fold is None:
            yield rows_of(m, pickle.dumps([vars(t) for t in trees]), nothing)
        else:
            yield rows_of(m, None, [pa.array(c, f.type) for c, f in zip(_left_out(block, m, own[m]), held_type)])

    done = materialize(each_task(table, len(boosters)).mapInArrow(run, f"m bigint, trees binary, {_HELD_OUT}"))
    trees = {r["m"]: [Tree(**t) for t in pickle.loads(r["trees"])] for r in done.where("trees IS NOT NULL").select("m", "trees").collect()}
    return trees, done.where("trees IS NULL").select("model", "label", "margin", "n")


def _in_place(block: _Block):
    """``find`` and ``add`` for one model whose rows all lie in ``block``."""
    rows, known, block = [None], {}, block | {"scratch": _scratch(len(block["n"]))}

    def find(asks):
        (ask,) = asks
        if ask.nodes == [0]:
            rows[0] = _Rows(block, ask)
            known.clear()
            known[0] = rows[0].histogram(0)
        else:
            rows[0].learnt.descend(ask.tree)
            parent = {int(c): node for node in np.flatnonzero(ask.tree.feature >= 0).tolist() for c in (ask.tree.left[node], ask.tree.right[node])}
            for small, large in zip(ask.nodes[::2], ask.nodes[1::2]):
                known[small] = rows[0].histogram(small)
                known[large] = known.pop(parent[small]) - known[small]
        return {ask.model: _splits(ask, np.stack([known[node] for node in ask.nodes]))}

    def add(done):
        ((m, growing, tree),) = done
        rows[0].learnt.descend(growing.so_far())
        rows[0].rest.descend(tree)
        leaf, margins = block["scratch"]["leaf"], block["margins"][m]
        for places, kept in ((rows[0].learnt, growing.kept_as()), (rows[0].rest, range(len(tree.feature)))):
            for node in places.of:
                for own in places.parts(node, PART):
                    leaf[own] = kept[node]
        for first in range(0, len(leaf), PART):
            part = slice(first, first + PART)
            margins[part] += tree.value.take(leaf[part])

    return find, add


def _grown_by_jobs(blocks: DataFrame, boosters: dict[int, Booster], bases: list[float], weights: list[str], features: int, seed: int):
    """A job per step over all blocks. They are an RDD, as each job adds arrays that rows of a DataFrame would have to be packed
    and unpacked for; margins stay in memory and on disk, and their lineage is cut every CHECKPOINT_ROUNDS rounds."""
    spark = blocks.sparkSession
    shared_folder(spark)  # names the folder of checkpoints on a local master
    few = blocks.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    first = few.rdd.map(lambda r: _with_margins(pickle.loads(r["block"]), bases))
    states = [first.persist(StorageLevel.MEMORY_AND_DISK)]

    def find(asks):
        found = states[-1].flatMap(_histograms(asks)).reduceByKey(np.add, min(len(asks), DIRECT_BLOCKS))
        by_model = {ask.model: ask for ask in asks}
        splits = dict(found.map(lambda r: (r[0], _splits(by_model[r[0]], r[1]))).collect())  # some numbers a node
        for old in states[:-1]:  # read for the last time
            old.unpersist()
        del states[:-1]
        return splits

    def add(done):
        states.append(states[-1].map(_with_trees([(m, tree) for m, _, tree in done])).persist(StorageLevel.MEMORY_AND_DISK))
        rounds[0] += 1
        if rounds[0] % CHECKPOINT_ROUNDS == 0:
            states[-1].checkpoint()
            states[-1].count()

    rounds = [0]
    trees = _grown(boosters, weights, features, seed, find, add)

    def left_out(block):
        for m, b in boosters.items():
            if b.fold is not None:
                names, *columns = _left_out(block, m, b)
                yield from zip(names, *[c.tolist() for c in columns])

    held_out = materialize(spark.createDataFrame(states[-1].flatMap(left_out), _HELD_OUT))
    for state in states:
        state.unpersist()
    return trees, held_out


def root_gains(rows: DataFrame, features: list[str], label: str, booster: Booster) -> DataFrame:
    """(feature, cut, rows_left, gain) of every split that the root of the first tree may take over all ``rows``."""
    spark = rows.sparkSession
    cuts = feature_cuts(rows, features)
    table = materialize(collapsed(rows.withColumns({"fold": F.lit(0), "_one": F.lit(0)}), features, cuts, label, "_one", [booster.weight], 0))
    bases = _base_margins(table, [booster], [booster.weight])
    blocks = _blocks(table, table.count(), len(features), [booster.weight])
    leaf = np.array([-1])
    ask = _Ask(0, booster, 0, None, np.ones(len(features), bool), Tree(leaf, leaf, leaf, leaf, leaf, leaf), [0])
    of_block = lambda r: next(_histograms([ask])(_with_margins(pickle.loads(r["block"]), bases)))
    histogram = blocks.rdd.map(of_block).reduceByKey(np.add, 1).values().first()[0]
    own = lambda v: np.array([v])
    gain, left = split_gains(histogram[None], own(booster.l2), own(booster.min_rows), own(booster.min_hessian), np.ones((1, len(features)), bool))
    found = [(features[f], float(cuts[f][c]), int(left[0, 2, f, c]), float(gain[0, f, c])) for f, c in zip(*np.nonzero(np.isfinite(gain[0])))]
    return spark.createDataFrame(found, "feature string, cut double, rows_left bigint, gain double")


# --- the model ------------------------------------------------------------------------


class BoostedTreesModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (a vector of two) to rows that hold the input columns; saved and loaded as a pipeline stage."""

    content = Param(Params._dummy(), "content", "base margin, cuts and nodes as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, content=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, fitted: Fitted) -> BoostedTreesModel:
        trees = [{k: getattr(t, k).tolist() for k in ("feature", "cut", "left", "right", "value", "rows")} for t in fitted.trees]
        return cls(inputCols=fitted.features, content=json.dumps({"base": fitted.base, "cuts": [c.tolist() for c in fitted.cuts], "trees": trees}))

    @property
    def fitted(self) -> Fitted:
        content = json.loads(self.getOrDefault(self.content))
        trees = [Tree(**{k: np.array(v, np.float64 if k == "value" else np.int64) for k, v in t.items()}) for t in content["trees"]]
        return Fitted(self.getInputCols(), [np.array(c, np.float64) for c in content["cuts"]], content["base"], trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Share of the splits of each feature."""
        counts = np.zeros(len(self.getInputCols()))
        for tree in self.fitted.trees:
            used = tree.feature[tree.feature >= 0]
            counts += np.bincount(used, minlength=len(counts))
        return DenseVector(counts / max(counts.sum(), 1.0))

    def margin(self) -> Column:
        fitted = self.fitted

        def run(columns: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for batch in columns:
                bins = binned([c.to_numpy(zero_copy_only=False) for c in batch], fitted.cuts)
                found = np.full(len(bins), fitted.base)
                for first in range(0, len(bins), SCORED_ROWS):
                    part = slice(first, first + SCORED_ROWS)
                    for tree in fitted.trees:
                        found[part] += tree.value[tree.places(bins[part])]
                yield pa.array(found, pa.float64())

        return F.arrow_udf(run, "double")(*[F.col(f).cast("double") for f in fitted.features])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = 1.0 / (1.0 + F.exp(-F.col("_margin")))
        return dataset.withColumn("_margin", self.margin()).withColumn("probability", array_to_vector(F.array(1.0 - p, p))).drop("_margin")
