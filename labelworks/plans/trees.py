"""Fitted tree models as node tables, and the smaller models inside a large one.

A model's nodes are read from where Spark saves them, one row a node of each tree. The
driver holds the model already, so it may hold the table, in arrays of numbers. Two things use it: scoring rows by the table alone, as a check on the model,
and scoring the models that a fitted one contains. The first trees of a forest or of a
boosted model are such a model, and so are trees cut off at a smaller depth: a node's own
counts are those of the leaf it would have been.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from labelworks.operators.keep import shared_folder
from labelworks.plans.boosting import BoostedModel
from labelworks.plans.forests import KINDS, ROWS_SIDE_BY_SIDE, WALKED, GrownForest, unpacked
from labelworks.session import on_executors

TREE_MODELS = (DecisionTreeClassificationModel, RandomForestClassificationModel, GBTClassificationModel, BoostedModel)
# Scores are sums over trees; beyond these places their order shows.
PLACES = 12
#: Rows whose scores a task gives out at a time.
ROWS_OUT = 10_000


def node_table(spark: SparkSession, folder: str, n_trees: int = 1) -> DataFrame:
    """``tree, node, left, right, feature, threshold, left_categories, value, prediction,
    impurity, gain, n_rows`` of a saved classifier, children -1 at a leaf.

    ``value`` is the share of class 1 among a node's rows, or the prediction in a tree
    that predicts numbers. Nodes are numbered from 0, parents before children, left first.
    """
    data = spark.read.parquet(f"{folder}/data")
    rows = data.select(F.col("treeID").alias("tree"), "nodeData.*") if "treeID" in data.columns else data.select(F.lit(0).alias("tree"), "*")
    split, counts = F.col("split"), F.col("impurityStats")
    inner, continuous = F.col("leftChild") >= 0, split["numCategories"] == -1
    # Counts of two classes in a classifier; number, sum and squares in a regression.
    share = F.try_divide(F.get(counts, F.lit(1)), F.aggregate(counts, F.lit(0.0), lambda t, x: t + x))
    return rows.where(F.col("tree") < n_trees).select(
        "tree",
        F.col("id").alias("node"),
        F.col("leftChild").alias("left"),
        F.col("rightChild").alias("right"),
        F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner & continuous, F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("threshold"),
        F.when(inner & ~continuous, split["leftCategoriesOrThreshold"]).alias("left_categories"),
        F.when(F.size(counts) == 2, share).otherwise(F.col("prediction")).alias("value"),
        "prediction",
        "impurity",
        "gain",
        F.col("rawCount").alias("n_rows"),
    )


@dataclass(frozen=True)
class Walk:
    """What a row needs to go down a tree; the categories that go left at a node are those of
    ``named`` from ``ends[node]`` to ``ends[node + 1]``, none where a threshold parts the rows."""

    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    ends: np.ndarray
    named: np.ndarray


@dataclass(frozen=True)
class Tree:
    """Nodes of one tree by number; ``parent`` is -1 and ``depth`` 0 at the root."""

    left: np.ndarray
    right: np.ndarray
    parent: np.ndarray
    depth: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    #: Where the categories of each node begin and end in ``named``, as in :class:`Walk`.
    ends: np.ndarray
    named: np.ndarray
    value: np.ndarray
    n_rows: np.ndarray
    gain: np.ndarray

    def walk(self) -> Walk:
        return Walk(*[a.astype(np.int32) for a in (self.left, self.right, self.feature)], self.threshold, self.ends.astype(np.int32), self.named)

    def categories(self, node: int) -> np.ndarray:
        """The categories that go left at a node, none where a threshold parts the rows."""
        return self.named[self.ends[node] : self.ends[node + 1]]

    def values_at(self, depth: int | None) -> np.ndarray:
        """For each node the value of its last ancestor down to ``depth``."""
        at = np.arange(len(self.left))
        while depth is not None and (deep := self.depth[at] > depth).any():
            at = np.where(deep, self.parent[at], at)
        return self.value[at]


@dataclass(frozen=True)
class Trees:
    trees: list[Tree]
    weights: list[float]
    boosted: bool

    @property
    def depth(self) -> int:
        return max((int(t.depth.max()) for t in self.trees), default=0)


def _trees(nodes: pa.Table, n_trees: int) -> list[Tree]:
    """The trees of a table of nodes in order; each column becomes numbers once, not once a tree or a node."""

    def numbers(name: str, missing: float = np.nan) -> np.ndarray:
        return pc.fill_null(nodes[name].cast(pa.float64()), missing).to_numpy()

    whole = [numbers("left").astype(int), numbers("right").astype(int), numbers("feature", -1).astype(int)]
    rest = [numbers(c) for c in ("threshold", "value", "n_rows", "gain")]
    lists = nodes["left_categories"].combine_chunks()
    named = pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(float)
    ends = np.concatenate([[0], pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).cumsum()]).astype(int)
    cuts = np.searchsorted(nodes["tree"].to_numpy(), np.arange(n_trees + 1)).tolist()
    return [
        _tree(*[c[a:b] for c in whole], *[c[a:b] for c in rest], ends[a : b + 1] - ends[a], named[ends[a] : ends[b]])
        for a, b in zip(cuts, cuts[1:])
    ]


def _tree(left: np.ndarray, right: np.ndarray, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray, n_rows: np.ndarray, gain: np.ndarray, ends: np.ndarray, named: np.ndarray) -> Tree:
    parent, depth = np.full(len(left), -1), np.zeros(len(left), int)
    at = np.zeros(min(1, len(left)), int)  # the inner nodes of a level, all at once
    while len(at := at[left[at] >= 0]):
        parent[left[at]] = parent[right[at]] = at
        depth[left[at]] = depth[right[at]] = depth[at] + 1
        at = np.concatenate([left[at], right[at]])
    return Tree(left, right, parent, depth, feature, threshold, ends, named, value, n_rows, gain)


def node_arrays(nodes: pa.Table, n_trees: int) -> list[Tree]:
    """The trees of a boosted model's own nodes, which are in order."""
    renamed = nodes.append_column("value", nodes["prediction"]).append_column("left_categories", pa.nulls(len(nodes), pa.list_(pa.float64())))
    return _trees(renamed, n_trees)


def _grown(packed: dict[str, bytes]) -> Tree:
    """A tree of a grown forest; columns that were not read are empty."""
    left, feature, number, share, n_rows, gain = (np.frombuffer(packed.get(c, b""), KINDS[c]) for c in (*WALKED, "share", "n_rows", "gain"))
    right = np.where(left >= 0, left + 1, -1)
    return _tree(left, right, feature, np.where(left >= 0, number, np.nan), share, n_rows, gain, np.zeros(len(left) + 1, int), np.empty(0))


def trees_of(spark: SparkSession, model: Model) -> Trees:
    """All nodes of a fitted tree model. Spark's own are saved in the shared folder and read back
    as columns of numbers: a node costs the driver about a hundred bytes, not a row of Python values."""
    if isinstance(model, BoostedModel):
        return Trees(node_arrays(model.nodes, model.getNumTrees), model.treeWeights, True)
    if isinstance(model, GrownForest):
        return Trees([_grown(row) for row in model.packed(*KINDS).to_pylist()], model.treeWeights, False)
    path, single = f"{shared_folder(spark)}/trees/{spark.sparkContext.applicationId}/{uuid4().hex}", isinstance(model, DecisionTreeClassificationModel)
    n_trees = 1 if single else model.getNumTrees
    model.write().save(path)
    columns = ["tree", "node", "left", "right", "feature", "threshold", "left_categories", "value", "n_rows", "gain"]
    nodes = node_table(spark, path, n_trees).select(*columns).toArrow()
    nodes = nodes.take(pa.array(np.lexsort((nodes["node"].to_numpy(), nodes["tree"].to_numpy()))))
    weights = [1.0] if single else list(model.treeWeights)
    return Trees(_trees(nodes, n_trees), weights, isinstance(model, GBTClassificationModel))


def _leaves(tree: Walk, x: np.ndarray) -> np.ndarray:
    """The leaf of each row of ``x``, a node a step."""
    at = np.zeros(len(x), int)
    rows = np.flatnonzero(tree.left[at] >= 0)
    while len(rows):
        node = at[rows]
        values = x[rows, tree.feature[node]]
        goes_left = values <= tree.threshold[node]
        if len(tree.named):
            # a category of each node at a time; without any the threshold has spoken
            first, last = tree.ends[node], tree.ends[node + 1]
            some = np.flatnonzero(first < last)
            while len(some):
                goes_left[some] |= tree.named[first[some]] == values[some]
                first[some] += 1
                some = some[first[some] < last[some]]
        at[rows] = node = np.where(goes_left, tree.left[node], tree.right[node])
        rows = rows[tree.left[node] >= 0]
    return at


def _points(batch: pa.RecordBatch) -> np.ndarray:
    """The last column of a batch, arrays of numbers, as a matrix; a missing row has no numbers."""
    points = batch.column(batch.num_columns - 1)
    wide = max((len(p) for p in points if p.is_valid), default=0)
    if points.null_count == 0 and len(points.flatten()) == wide * batch.num_rows:
        return points.flatten().to_numpy(zero_copy_only=False).astype(float, copy=False).reshape(batch.num_rows, wide)
    return np.array([p or [np.nan] * wide for p in points.to_pylist()], float).reshape(batch.num_rows, wide)


def _larger(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches joined until they have so many rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def table_scores(trees: Trees, encoded: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep..., score`` by the node table alone: each row goes down each tree, a node a step."""
    boosted, weights = trees.boosted, trees.weights
    walks = [(t.walk(), t.value) for t in trees.trees]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _points(batch)
            score = np.zeros(len(x))
            for (walk, value), weight in zip(walks, weights, strict=True):
                score += (weight if boosted else 1.0) * value[_leaves(walk, x)]
            score = 1 / (1 + np.exp(-2 * score)) if boosted else score / len(walks)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(score)], names=[*keep, "score"])

    table = on_executors(encoded.select(*keep, vector_to_array("features").alias("_x")))
    return table.mapInArrow(run, StructType([*table.schema.fields[:-1], StructField("score", DoubleType())]))


def nested_scores(model: Model, encoded: DataFrame, sizes: Sequence[tuple[int | None, int | None]], keep: Sequence[str]) -> DataFrame:
    """``keep..., at, score, pred``: one row for each row and each of ``sizes``, the number
    of trees and the depth (None: all there are) of a model inside ``model``.

    Rows go through the trees once, in the tasks; a leaf stands for its values at every depth,
    and sums over the first trees are read off as the trees go by.
    """
    depths = sorted({d for _, d in sizes}, key=lambda d: (d is None, d))
    if grown := isinstance(model, GrownForest):
        boosted, sent, weights = False, model.sent("share"), model.treeWeights
    else:
        trees = trees_of(encoded.sparkSession, model)
        boosted, weights = trees.boosted, trees.weights if trees.boosted else [1.0] * len(trees.trees)
        # only what a walk needs goes to the tasks
        sent = [(t.walk(), [t.values_at(d) for d in depths]) for t in trees.trees]
    ends = [(i, n or len(weights), depths.index(d)) for i, (n, d) in enumerate(sizes)]

    def scores_of(x: np.ndarray) -> np.ndarray:
        totals, scores = np.zeros((len(depths), len(x))), np.empty((len(x), len(ends)))
        for done, (held, weight) in enumerate(zip(sent.value if grown else sent, weights, strict=True), 1):
            if grown:
                tree = _grown(dict(zip((*WALKED, "share"), held)))
                walk, values = unpacked(held)[0], [tree.values_at(d) for d in depths]
            else:
                walk, values = held
            leaves = _leaves(walk, x)
            for total, value in zip(totals, values, strict=True):
                total += weight * value[leaves]
            for i, n, d in ends:
                if done == min(n, len(weights)):
                    scores[:, i] = 1 / (1 + np.exp(-2 * totals[d])) if boosted else totals[d] / n
        return scores

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # many rows at a time, so that the trees are made ready seldom
        for batch in _larger(batches, ROWS_SIDE_BY_SIDE):
            x = _points(batch)
            scores = scores_of(x)
            for a in range(0, len(x), ROWS_OUT):
                some = scores[a : a + ROWS_OUT]
                rows = pa.array(np.repeat(np.arange(a, a + len(some)), len(ends)))
                at = pa.array(np.tile(np.arange(len(ends), dtype=np.int32), len(some)))
                yield pa.RecordBatch.from_arrays([*[c.take(rows) for c in batch.columns[:-1]], at, pa.array(some.ravel())], names=[*keep, "at", "score"])

    table = on_executors(encoded.select(*keep, vector_to_array("features").alias("_x")))
    long = table.mapInArrow(run, StructType([*table.schema.fields[:-1], StructField("at", IntegerType()), StructField("score", DoubleType())]))
    return long.withColumn("pred", (F.round("score", PLACES) > 0.5).cast("int"))
