"""Boosted regression trees for squared loss (I15): all rows, all rounds, and the
trees that MLlib's ``GBTRegressor`` grows from the same rows. Where many rows are
dealt anew, sums may differ in their last digits, as MLlib's do from run to run on
a cluster; then of two features that part the rows alike either may be chosen.

Rows are binned once and kept as blocks of columns, a byte a value. Each level of
a tree is one pass: every task adds up its rows by (node, feature, bin), and the
best splits are found from these sums, whose size does not depend on the rows.
"""

from __future__ import annotations

import json
import time
from functools import partial
from operator import add
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_DEPTH, MAX_BINS = 7, 256                            # node and bin numbers fit a byte
BLOCK_ROWS = 32_768
CANDIDATE_ROWS = 10_000     # rows from which split candidates are drawn, as many as MLlib draws
DRIVER_PARTS = 64           # with more tasks their sums are added up on the executors first
KEPT = StorageLevel.MEMORY_AND_DISK_DESER
KEEP_ROUNDS = 20            # rounds from one checkpoint to the next
EPSILON = float(np.finfo(float).eps)
NODE_DATA = ("id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, "
             "leftChild int, rightChild int, "
             "split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>")


class Node(NamedTuple):
    """Rows, sum and sum of squares of a node; its split, if it is no leaf:
    rows with a bin up to ``bin`` go to node ``2 i + 1``, the others to ``2 i + 2``."""

    stats: np.ndarray
    impurity: float
    gain: float = -1.0
    feature: int = -1
    bin: int = -1

    @property
    def prediction(self) -> float:
        return float(self.stats[1] / self.stats[0])


def fits(gbt: GBTRegressor, given: set[str]) -> bool:
    """Whether ``fit`` has all ``given`` parameters of ``gbt``, in these sizes."""
    return (given <= {"maxIter", "stepSize", "maxDepth", "maxBins", "seed"}
            and 0 < gbt.getMaxDepth() <= MAX_DEPTH and gbt.getMaxBins() <= MAX_BINS)


def fit(assembled: DataFrame, gbt: GBTRegressor) -> GBTRegressionModel:
    """Fit ``gbt`` (its columns, rounds, rate, depth, bins and seed) to all rows."""
    from tripflow.session import checkpoint_dir
    spark = assembled.sparkSession
    checkpoint_dir(spark)
    points = assembled.select(vector_to_array(gbt.getFeaturesCol()).alias("x"), F.col(gbt.getLabelCol()).alias("y"))
    n = points.count()
    if not n:
        raise ValueError("no rows to fit a model to")
    cuts = candidates(points, n, gbt.getMaxBins(), gbt.getSeed())
    blocks = points.mapInArrow(partial(_binned, cuts=cuts), "x binary, y binary")
    cores = spark.sparkContext.defaultParallelism
    if n > 2 * cores * BLOCK_ROWS:          # a pass is as long as its longest task: as many blocks for each core
        blocks = blocks.repartition(cores)
    state = blocks.rdd.map(_block).persist(KEPT)
    trees, rates, old, kept = [], [], None, None
    while True:
        trees.append(_grow(state, cuts, gbt.getMaxDepth()))
        rates.append(gbt.getStepSize() if old else 1.0)
        if old:
            old.unpersist()
        if state.isCheckpointed():
            _delete(spark, kept)
            kept = state.getCheckpointFile()
        if len(trees) == gbt.getMaxIter():
            break
        old, state = state, state.map(partial(_boosted, tree=trees[-1], rate=rates[-1])).persist(KEPT)
        if len(trees) % KEEP_ROUNDS == 0:
            state.checkpoint()
    state.unpersist()
    _delete(spark, kept)
    return _model(spark, gbt, cuts, trees, rates)


def _delete(spark: SparkSession, path: str | None) -> None:
    if path:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


# ---- split candidates and blocks ---------------------------------------------------

def candidates(points: DataFrame, n: int, bins: int, seed: int) -> list[np.ndarray]:
    """For each feature at most ``bins - 1`` thresholds, from those of the ``n``
    rows that MLlib draws for them: the same sampler with the same seed."""
    spark = points.sparkSession
    bins = min(bins, n)
    share = min(1.0, max(bins * bins, CANDIDATE_ROWS) / n)
    drawn = points._jdf.javaRDD().sample(
        False, share, spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt())
    sample = DataFrame(spark._jsparkSession.createDataFrame(drawn, points._jdf.schema()), spark)
    values = np.array([r.x for r in sample.select("x").collect()], float)       # about CANDIDATE_ROWS rows
    if not len(values):
        return [np.zeros(0) for _ in points.first().x]
    return [_cuts(column, share * n, bins - 1) for column in values.T]


def _cuts(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """At most ``most`` thresholds that deal the values to equal shares; what is
    missing to the expected number of rows counts as zeros."""
    v, n = np.unique(values[values != 0], return_counts=True)
    if not len(v):
        return v
    n, zeros = n.astype(float), expected - n.sum()
    if zeros > EPSILON * n.sum() * 100:
        at = np.searchsorted(v, 0.0)
        v, n = np.insert(v, at, 0.0), np.insert(n, at, zeros)
    middle = (v[:-1] + v[1:]) / 2
    if len(middle) <= most:
        return middle
    stride = target = expected / (most + 1)
    out, seen = [], n[0]
    for i in range(1, len(v)):
        before, seen = seen, seen + n[i]
        if abs(before - target) < abs(seen - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def _binned(batches, cuts: list[np.ndarray]):
    """Blocks of rows in their order: the bins, feature by feature, and the labels."""
    def block(some):
        t = pa.Table.from_batches(some).combine_chunks()
        y = t.column("y").to_numpy().astype(float)
        x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
        if not (np.isfinite(x).all() and np.isfinite(y).all()):
            raise ValueError("features and labels must not be null, NaN or infinite")
        bins = np.array([np.searchsorted(c, x[:, k]) for k, c in enumerate(cuts)]).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([bins.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())],
                                          names=["x", "y"])

    some, rows = [], 0
    for batch in batches:
        some.append(batch)
        rows += batch.num_rows
        if rows >= BLOCK_ROWS:
            yield block(some)
            some, rows = [], 0
    if rows:
        yield block(some)


def _block(row) -> tuple:
    """(bins, labels, predictions); before the first tree there are none."""
    y = np.frombuffer(row.y)
    return np.frombuffer(row.x, np.uint8).reshape(-1, len(y)), y, None


# ---- growing a tree ----------------------------------------------------------------

def _leaves(x: np.ndarray, tree: dict[int, Node]) -> np.ndarray:
    """The node that each row of a block has come to."""
    at = np.zeros(x.shape[1], np.uint8)
    for i in sorted(tree):
        if tree[i].feature >= 0:
            at += (at == i) * ((x[tree[i].feature] > tree[i].bin) + np.uint8(i + 1))
    return at


def _boosted(block: tuple, tree: dict[int, Node], rate: float) -> tuple:
    """The block with the tree's predictions added."""
    x, y, f = block
    value = np.zeros(max(tree) + 1)
    for i, node in tree.items():
        value[i] = node.prediction * rate
    step = value[_leaves(x, tree)]
    return x, y, step if f is None else f + step


def _sums(blocks, tree: dict[int, Node], todo: list[int], bins: int):
    """(node, sums) of a task for the nodes to split: rows, residuals and their
    squares by feature and bin, added up row by row."""
    place = np.full(2 ** (MAX_DEPTH + 1), len(todo))    # the last place is for rows of leaves
    place[todo] = np.arange(len(todo))
    place, size = place * bins, (len(todo) + 1) * bins
    rows = sums = None
    for x, y, f in blocks:
        if rows is None:
            rows, sums = np.zeros((len(x), size)), np.zeros((len(x), size), complex)
        r = y if f is None else 2.0 * (y - f)
        both = r + 1j * (r * r)                         # two sums in one pass
        start = place[_leaves(x, tree)]
        at = np.empty_like(start)
        for k in range(len(x)):
            np.add(start, x[k], out=at)
            rows[k] += np.bincount(at, minlength=size)
            np.add.at(sums[k], at, both)
    if rows is not None:
        for i, node in enumerate(todo):
            part = slice(i * bins, (i + 1) * bins)
            yield node, np.stack([rows[:, part], sums.real[:, part], sums.imag[:, part]])


def _variance(stats: np.ndarray) -> np.ndarray:
    with np.errstate(all="ignore"):
        return (stats[2] - stats[1] * stats[1] / stats[0]) / stats[0]


def _split(sums: np.ndarray, node: Node | None, n_cuts: np.ndarray) -> tuple:
    """The node with its best split and the statistics of both sides; a leaf, if no split gains."""
    sums = np.cumsum(sums, axis=2)
    left, right = sums[:, :, :-1], sums[:, :, -1:] - sums[:, :, :-1]
    cut = np.arange(left.shape[2]) < n_cuts[:, None]
    if node:
        stats, impurity = node.stats, node.impurity
    else:                                               # the root: as its first split gives it
        first = (slice(None), *np.argwhere(cut)[0]) if cut.any() else None
        stats = left[first] + right[first] if first else sums[:, 0, -1]
        impurity = float(_variance(stats))
    rows = left[0] + right[0]
    with np.errstate(all="ignore"):
        gain = impurity - left[0] / rows * _variance(left) - right[0] / rows * _variance(right)
    gain = np.where(cut & (left[0] >= 1) & (right[0] >= 1) & (gain >= 0), gain, -np.inf)
    k, b = np.unravel_index(gain.argmax(), gain.shape) if cut.any() else (0, 0)
    if not cut.any() or not gain[k, b] > 0:
        return Node(stats, impurity if cut.any() and gain[k, b] == 0 else -1.0), ()
    return Node(stats, impurity, float(gain[k, b]), int(k), int(b)), (left[:, k, b], right[:, k, b])


def _grow(state, cuts: list[np.ndarray], depth: int) -> dict[int, Node]:
    """One tree, level by level."""
    tree, todo = {}, [0]
    n_cuts = np.array([len(c) for c in cuts])
    for level in range(depth):
        if not todo:
            break
        sums = state.mapPartitions(partial(_sums, tree=tree, todo=todo, bins=int(n_cuts.max()) + 1))
        if state.getNumPartitions() > DRIVER_PARTS:
            sums = sums.reduceByKey(add, len(todo))
        whole, todo = {}, []
        for i, part in sums.collect():                  # a node's sums: 10 kB with 13 features of 32 bins
            whole[i] = whole[i] + part if i in whole else part
        for i, part in whole.items():
            tree[i], sides = _split(part, tree.get(i), n_cuts)
            for child, stats in zip((2 * i + 1, 2 * i + 2), sides):
                tree[child] = Node(stats, float(_variance(stats)))
                if level + 1 < depth and not abs(tree[child].impurity) < EPSILON:
                    todo.append(child)
        todo.sort()
    return tree


# ---- the model ---------------------------------------------------------------------

def _node_data(tree: dict[int, Node], cuts: list[np.ndarray]) -> list[tuple]:
    """The nodes in the order in which MLlib numbers them; a node whose sides
    are leaves with one prediction is a leaf itself."""
    def shape(i):
        """(heap number, sides)"""
        if tree[i].feature < 0:
            return i, None
        sides = shape(2 * i + 1), shape(2 * i + 2)
        if all(s[1] is None for s in sides) and tree[sides[0][0]].prediction == tree[sides[1][0]].prediction:
            return i, None
        return i, sides

    rows = []

    def add_node(at):
        i, sides = at
        node, me = tree[i], len(rows)
        rows.append(None)
        left, right = (add_node(s) for s in sides) if sides else (-1, -1)
        split = (node.feature, [float(cuts[node.feature][node.bin])], -1) if sides else (-1, [], -1)
        rows[me] = (me, node.prediction, node.impurity, [float(s) for s in node.stats], int(node.stats[0]),
                    node.gain if sides else -1.0, left, right, split)
        return me
    add_node(shape(0))
    return rows


def _model(spark: SparkSession, gbt: GBTRegressor, cuts, trees, rates) -> GBTRegressionModel:
    """The trees as MLlib's model, through the files in which MLlib keeps one."""
    from tripflow.session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid4().hex}"

    def metadata(name, uid, leave=(), **more):
        params = [{p.name: v for p, v in m.items() if p.name not in leave} for m in (gbt._paramMap, gbt._defaultParamMap)]
        return json.dumps({"class": f"org.apache.spark.ml.regression.{name}", "timestamp": int(time.time() * 1000),
                           "sparkVersion": spark.version, "uid": uid, "paramMap": params[0], "defaultParamMap": params[1], **more})
    whole = metadata("GBTRegressionModel", gbt.uid, numFeatures=len(cuts), numTrees=len(trees))
    single = ("lossType", "maxIter", "stepSize", "featureSubsetStrategy", "subsamplingRate", "validationTol")
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame([(t, metadata("DecisionTreeRegressionModel", f"{gbt.uid}_{t}", single), float(rate))
                           for t, rate in enumerate(rates)], "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame([(t, row) for t, tree in enumerate(trees) for row in _node_data(tree, cuts)],
                          f"treeID int, nodeData struct<{NODE_DATA}>").coalesce(1).write.parquet(f"{path}/data")
    try:
        return GBTRegressionModel.load(path)
    finally:
        _delete(spark, path)
