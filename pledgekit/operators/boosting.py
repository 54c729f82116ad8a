"""Spark ML's boosted regression trees, fitted on blocks of binned rows.

Spark's own fit reads an object per row and adds to the bins of every slot at every level of every tree. Here rows are
kept as columns of bin numbers, eight two-level slots to a byte, and tasks return the sums per bin. Bins, splits, stopping
rules and pruning are Spark's, and so is the model; sums are added up in another order. Functions that run in tasks travel
with their code, so executors need numpy and pyarrow but not this package.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
from py4j.java_gateway import JavaObject
from pyspark import RDD, SparkContext, StorageLevel
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml import Estimator
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgekit.functions.columns import quoted

try:
    import pyarrow as pa
except ModuleNotFoundError:  # fits stay with Spark
    pa = None

# Rows of a block, which a task holds at a time, and rows that a task reads.
BLOCK_ROWS, PASS_ROWS = 100_000, 1_000_000

# Bytes of sums that a task returns at a time; further nodes of a level take a pass of their own.
SUM_BYTES = 8_000_000

# Gain of a split that is not allowed, and the impurity below which a node is pure (Spark's).
NO_GAIN, PURE = -sys.float_info.max, 2.0**-52


@dataclass(frozen=True)
class Layout:
    """Columns of bin numbers: ordered slots, then slots of several levels, then bytes of two-level slots."""

    cuts: list[tuple[int, np.ndarray]]
    levels: list[tuple[int, int]]
    pairs: list[int]

    @property
    def widths(self) -> list[int]:
        return [len(c) + 1 for _, c in self.cuts] + [n for _, n in self.levels] + [256] * -(-len(self.pairs) // 8)


@dataclass
class Tree:
    """Nodes by number, the root first: count, sum and sum of squares; of inner ones also children, gain and split."""

    sums: list[np.ndarray]
    children: list[tuple[int, int] | None] = field(default_factory=lambda: [None])
    splits: list[Split | None] = field(default_factory=lambda: [None])
    depth: int = 0

    @property
    def values(self) -> np.ndarray:
        return np.array([s[1] / s[0] if s[0] else 0.0 for s in self.sums])

    def steps(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Per node the column that it splits on, and the next node of each bin; leaves lead to themselves."""
        column = np.zeros(len(self.sums), np.int64)
        step = np.repeat(np.arange(len(self.sums), dtype=np.int64)[:, None], width, axis=1)
        for i, (split, below) in enumerate(zip(self.splits, self.children, strict=True)):
            if split is not None:
                column[i] = split.column
                step[i, : len(split.left)] = np.where(split.left, *below)
        return column, step


@dataclass
class Split:
    gain: float
    slot: int
    column: int
    left: np.ndarray  # per bin of the column
    sums: tuple[np.ndarray, np.ndarray]  # of the left and of the right side
    threshold: float | None = None
    categories: tuple[list[float], int] | None = None


def _impurity(sums: np.ndarray) -> np.ndarray:
    n, s, q = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n == 0, 0.0, (q - s * s / n) / n)


def _means(sums: np.ndarray) -> np.ndarray:
    """Mean of each level; absent ones come last."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(sums[0] == 0, sys.float_info.max, sums[1] / sums[0])


def _gains(left: np.ndarray, whole: np.ndarray, least_rows: int, least_gain: float) -> np.ndarray:
    """Gain of each split, from the sums of its left side."""
    right = whole[:, None] - left
    gain = _impurity(whole) - left[0] / whole[0] * _impurity(left) - right[0] / whole[0] * _impurity(right)
    return np.where((left[0] < least_rows) | (right[0] < least_rows) | (gain < least_gain), NO_GAIN, gain)


BITS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(float)


def best_split(hist: Sequence[np.ndarray], layout: Layout, least_rows: int, least_gain: float) -> Split | None:
    """The split of the largest gain, the lowest slot among equals; None if none gains. ``hist`` has (3, bins) per column."""
    whole, found = hist[0].sum(axis=1), []
    for at, (slot, cuts) in enumerate(layout.cuts):
        if len(cuts):
            left = hist[at].cumsum(axis=1)[:, :-1]
            gains = _gains(left, whole, least_rows, least_gain)
            k = int(gains.argmax())
            side = np.arange(len(cuts) + 1) <= k
            found.append(Split(gains[k], slot, at, side, (left[:, k], whole - left[:, k]), threshold=float(cuts[k])))
    for at, (slot, n) in enumerate(layout.levels, len(layout.cuts)):
        found.append(_by_level(hist[at], whole, slot, at, n, least_rows, least_gain))
    if layout.pairs:
        found.append(_of_pairs(hist, whole, layout, least_rows, least_gain))
    best = max(sorted(found, key=lambda s: s.slot), key=lambda s: s.gain, default=None)
    return best if best is not None and best.gain > 0 else None


def _by_level(sums: np.ndarray, whole: np.ndarray, slot: int, at: int, n: int, least_rows: int, least_gain: float) -> Split:
    """The best cut of the levels of a slot, sorted by their mean."""
    order = _means(sums).argsort(kind="stable")
    left = sums[:, order].cumsum(axis=1)[:, :-1]
    gains = _gains(left, whole, least_rows, least_gain)
    k = int(gains.argmax())
    side = np.zeros(n, bool)
    side[order[: k + 1]] = True
    return Split(gains[k], slot, at, side, (left[:, k], whole - left[:, k]), categories=([float(c) for c in order[: k + 1]], n))


def _of_pairs(hist: Sequence[np.ndarray], whole: np.ndarray, layout: Layout, least_rows: int, least_gain: float) -> Split:
    """The best of the two-level slots, whose sums come from those of the bytes that hold them."""
    first = len(layout.cuts) + len(layout.levels)
    ones = np.concatenate([h @ BITS for h in hist[first:]], axis=1)[:, : len(layout.pairs)]
    zeros = whole[:, None] - ones
    low = _means(ones) < _means(zeros)  # the side of ones is the left one
    left = np.where(low, ones, zeros)
    gains = _gains(left, whole, least_rows, least_gain)
    k = int(gains.argmax())
    side = BITS[:, k % 8] == low[k]
    return Split(gains[k], layout.pairs[k], first + k // 8, side, (left[:, k], whole - left[:, k]), categories=([float(low[k])], 2))


def _binned(batches: Iterable[pa.RecordBatch], layout: Layout) -> Iterator[pa.RecordBatch]:
    """Blocks of bin numbers and targets, from batches of vectors and targets."""
    kind = np.min_scalar_type(max(layout.widths, default=1) - 1)
    held, rows = [], 0

    def block() -> pa.RecordBatch:
        codes, target = np.concatenate([c for c, _ in held], axis=1), np.concatenate([t for _, t in held])
        return pa.RecordBatch.from_pydict({"codes": pa.array([codes.tobytes()], pa.large_binary()), "target": pa.array([target.tobytes()], pa.binary())})

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
        for slot, levels in [*layout.levels, *[(slot, 2) for slot in layout.pairs]]:
            if x[:, slot].min() < 0 or x[:, slot].max() >= levels:
                raise ValueError(f"slot {slot} has {levels} levels, found {x[:, slot].min():g} to {x[:, slot].max():g}")
        columns = [np.searchsorted(cuts, x[:, slot], side="left") for slot, cuts in layout.cuts]
        columns += [x[:, slot].astype(np.int64) for slot, _ in layout.levels]
        for i in range(0, len(layout.pairs), 8):
            ones = x[:, layout.pairs[i : i + 8]].astype(np.uint8)
            columns.append(np.packbits(ones, axis=1, bitorder="little")[:, 0])
        held.append((np.array(columns).astype(kind), batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)))
        rows += n
        if rows >= BLOCK_ROWS:
            yield block()
            held, rows = [], 0
    if held:
        yield block()


Block = tuple[np.ndarray, np.ndarray, np.ndarray]


def _nodes(codes: np.ndarray, column: np.ndarray, step: np.ndarray, depth: int) -> np.ndarray:
    """Node of each row after ``depth`` steps from the root."""
    n = codes.shape[1]
    if not depth or not n:
        return np.zeros(n, np.int64)
    at, rows, flat, width = step[0].take(codes[column[0]]), np.arange(n), codes.ravel(), step.shape[1]
    for _ in range(depth - 1):
        code = flat.take(column.take(at) * n + rows)
        at = step.ravel().take(at * width + code)
    return at


def _counted(blocks: Iterable[Block], widths: Sequence[int], column, step, depth: int, slots: np.ndarray, first: bool) -> list[np.ndarray]:
    """Sums (count, residual, squared residual) per column, open node and bin; ``slots`` numbers the open nodes."""
    n_open = int(slots.max()) + 1
    out = [np.zeros((3, n_open, w)) for w in widths]
    for codes, target, predicted in blocks:
        open_node = slots.take(_nodes(codes, column, step, depth))
        residual = target if first else 2.0 * (target - predicted)
        if (open_node < 0).any():
            kept = np.flatnonzero(open_node >= 0)
            open_node, residual, codes = open_node[kept], residual[kept], codes[:, kept]
        squared = residual * residual
        for total, w, bins in zip(out, widths, codes, strict=True):
            cell = open_node * w
            cell += bins
            for k, weights in enumerate((None, residual, squared)):
                total[k] += np.bincount(cell, weights, n_open * w).reshape(n_open, w)
    return out


def _advanced(block: Block, column, step, depth: int, values: np.ndarray) -> Block:
    codes, target, predicted = block
    return codes, target, predicted + values.take(_nodes(codes, column, step, depth))


def _grow(rows: RDD, layout: Layout, first: bool, max_depth: int, least_rows: int, least_gain: float) -> Tree:
    """One tree, level by level; a level is one job, or several if its sums are many."""
    widths, tree, opened = layout.widths, Tree([np.zeros(3)]), [0]
    at_once = max(1, SUM_BYTES // (24 * sum(widths)))
    for depth in range(max_depth):
        column, step = tree.steps(max(widths))
        below, n = [], len(tree.sums)
        for i in range(0, len(opened), at_once):
            slots = np.full(n, -1, np.int64)
            slots[opened[i : i + at_once]] = np.arange(len(opened[i : i + at_once]))
            parts = rows.mapPartitions(lambda p, a=(widths, column, step, depth, slots, first): [_counted(p, *a)]).collect()
            hist = [np.sum(h, axis=0) for h in zip(*parts, strict=True)]
            if not depth:
                tree.sums[0] = hist[0].sum(axis=(1, 2))
            for k, node in enumerate(opened[i : i + at_once]):
                split = best_split([h[:, k] for h in hist], layout, least_rows, least_gain)
                if split is None:
                    continue
                tree.splits[node], tree.children[node], tree.depth = split, (len(tree.sums), len(tree.sums) + 1), depth + 1
                for side in split.sums:
                    if abs(_impurity(side)) >= PURE:
                        below.append(len(tree.sums))
                    tree.sums.append(side)
                    tree.splits.append(None)
                    tree.children.append(None)
        opened = below
    return tree


def _boost(blocks: RDD, layout: Layout, rounds: int, rate: float, max_depth: int, least_rows: int, least_gain: float) -> list[Tree]:
    """Trees of all rounds; predictions are kept beside the bins and brought forward once a round."""
    trees, state = [], blocks
    state.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for m in range(rounds):
            trees.append(_grow(state, layout, m == 0, max_depth, least_rows, least_gain))
            if m:
                before.unpersist()
            if m + 1 < rounds:
                before = state
                tree = trees[-1]
                values = tree.values * (rate if m else 1.0)
                state = before.map(lambda b, a=(*tree.steps(max(layout.widths)), tree.depth, values): _advanced(b, *a))
                state.persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        state.unpersist()
    return trees


class BlockGBT(GBTRegressor):
    """``GBTRegressor`` with the same parameters and the same model, fitted on blocks of binned rows."""

    def __init__(self, like: GBTRegressor) -> None:
        super().__init__()
        self._resetUid(like.uid)
        like._copyValues(self)

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        self._transfer_params_to_java()
        sc, jvm, own = dataset.sparkSession.sparkContext, dataset.sparkSession._jvm, self._java_obj
        ml = jvm.org.apache.spark.ml
        none = jvm.scala.Option.empty()
        utils, forest = (getattr(getattr(p, n), "MODULE$") for p, n in ((ml.util, "DatasetUtils$"), (ml.tree.impl, "RandomForest$")))
        instances = utils.extractInstances(own, dataset._jdf, none)
        levels = ml.util.MetadataUtils.getCategoricalFeatures(dataset._jdf.schema().apply(self.getFeaturesCol()))
        regression = jvm.org.apache.spark.mllib.tree.configuration.Algo.Regression()
        strategy = own.getOldBoostingStrategy(levels, regression).treeStrategy()
        meta = ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, "all")
        cuts = forest.findSplits(instances, meta, self.getSeed())
        width, rows = meta.numFeatures(), meta.numExamples()
        arity = {i: int(levels.apply(i)) for i in range(width) if levels.contains(i)}
        layout = Layout(
            [(i, np.array([s.threshold() for s in cuts[i]], float)) for i in range(width) if i not in arity],
            [(i, n) for i, n in arity.items() if n > 2],
            [i for i, n in arity.items() if n == 2],
        )
        if not layout.widths or not self.getMaxDepth():
            return super()._fit(dataset)
        blocks = self._blocks(dataset, layout)
        blocks = blocks.coalesce(max(sc.defaultParallelism, math.ceil(rows / PASS_ROWS)))
        trees = _boost(
            blocks, layout, self.getMaxIter(), self.getStepSize(), self.getMaxDepth(), self.getMinInstancesPerNode(), self.getMinInfoGain()
        )
        spark_trees = _SparkTrees(sc, width)
        weights = spark_trees.doubles([[self.getStepSize() if i else 1.0 for i in range(len(trees))]])[0]
        java_model = ml.regression.GBTRegressionModel(self.uid, spark_trees.array(trees), weights, width).setParent(own)
        model = self._copyValues(self._create_model(java_model))
        model._transfer_params_to_java()
        return model

    def _blocks(self, dataset: DataFrame, layout: Layout) -> RDD:
        vectors = dataset.select(
            vector_to_array(quoted(self.getFeaturesCol())).alias("vector"), quoted(self.getLabelCol()).cast("double").alias("target")
        )
        kind, columns = np.min_scalar_type(max(layout.widths, default=1) - 1), len(layout.widths)

        def block(row) -> Block:
            target = np.frombuffer(row.target)
            return np.frombuffer(row.codes, kind).reshape(columns, len(target)), target, np.zeros(len(target))

        return vectors.mapInArrow(lambda batches: _binned(batches, layout), "codes binary, target binary").rdd.map(block)


class _SparkTrees:
    """Spark's trees; one call per array, since each call to the JVM takes a fraction of a millisecond."""

    def __init__(self, sc: SparkContext, width: int) -> None:
        ml, tree = sc._jvm.org.apache.spark.ml, sc._jvm.org.apache.spark.ml.tree
        self.sc, self.width, self.model = sc, width, ml.regression.DecisionTreeRegressionModel
        self.leaf, self.inner, self.cut, self.choice = tree.LeafNode, tree.InternalNode, tree.ContinuousSplit, tree.CategoricalSplit
        self.sums = sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def doubles(self, rows: Sequence[Sequence[float]]) -> list[JavaObject]:
        return [v.toArray() for v in _py2java(self.sc, [DenseVector(r) for r in rows])]

    def array(self, trees: Sequence[Tree]) -> JavaObject:
        made = self.sc._gateway.new_array(self.model, len(trees))
        for i, tree in enumerate(trees):
            sums = [self.sums(stats, int(s[0])) for stats, s in zip(self.doubles(tree.sums), tree.sums, strict=True)]
            made[i] = self.model(self._node(tree, sums, 0)[0], self.width)
        return made

    def _node(self, tree: Tree, sums: list[JavaObject], i: int) -> tuple[JavaObject, float | None]:
        """A node, and its prediction if it is a leaf; two leaves of one prediction are one leaf."""
        value, impurity, split = float(tree.values[i]), float(_impurity(tree.sums[i])), tree.splits[i]
        if split is None:
            return self.leaf(value, impurity, sums[i]), value
        (left, a), (right, b) = (self._node(tree, sums, j) for j in tree.children[i])
        if a is not None and a == b:
            return self.leaf(a, impurity, sums[i]), a
        if split.threshold is not None:
            cut = self.cut(split.slot, split.threshold)
        else:
            categories, n = split.categories
            cut = self.choice(split.slot, self.doubles([categories])[0], n)
        return self.inner(value, impurity, float(split.gain), left, right, cut, sums[i]), None


def in_blocks(estimator: Estimator) -> Estimator:
    """The estimator itself, or, for boosted trees whose fit does not depend on samples or weights, its form on blocks.

    Without pyarrow it is the estimator itself, too.
    """
    plain = (
        pa is not None
        and type(estimator) is GBTRegressor
        and estimator.getLossType() == "squared"
        and estimator.getImpurity() == "variance"
        and estimator.getSubsamplingRate() == 1.0
        and estimator.getFeatureSubsetStrategy() == "all"
        and estimator.getMinWeightFractionPerNode() == 0.0
        and not estimator.isDefined("validationIndicatorCol")
        and not estimator.isDefined("weightCol")
    )
    return BlockGBT(estimator) if plain else estimator


register_pickle_by_value(sys.modules[__name__])
