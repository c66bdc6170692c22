"""Exact Shapley values of tree models against a background sample.

The interventional value of a row: features outside a coalition take a background row's
values, and the mean over the background rows counts. For one (row, background row) a leaf is
reached by a coalition exactly if it holds all features that only the row would bring down
to the leaf, and none that only the background row would (Lundberg et al., "From local
explanations to global understanding with explainable AI for trees", 2020). With a of the
first and b of the second kind the leaf's value goes to each of the a features with weight
(a - 1)! b! / (a + b)! and from each of the b with a! (b - 1)! / (a + b)!, so one walk down
the node table for each pair gives all values, without drawing feature orders.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.operators.keep import keep
from labelworks.plans.trees import Tree, Trees
from labelworks.session import on_executors

# Rows of the background that a task may hold beside the node table.
MOST_BACKGROUND = 10_000
# Pairs of a row and a background row that go down a tree together, and groups of trees.
MOST_PAIRS = 1 << 16
MOST_GROUPS = 64
# What is known of a feature on the way down: both rows go on, only the row, only the background row.
BOTH, ROW, OTHER = 0, 1, 2


def _goes_left(tree: Tree, node: int, x: np.ndarray) -> np.ndarray:
    named = tree.categories(node)
    return np.isin(x, named) if len(named) else x <= tree.threshold[node]


def _weights(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights of a leaf for a feature that must and one that must not be in, by a and b."""
    into, out = np.zeros((most + 1, most + 1)), np.zeros((most + 1, most + 1))
    for a in range(most + 1):
        for b in range(most + 1 - a):
            if a:
                into[a, b] = factorial(a - 1) * factorial(b) / factorial(a + b)
            if b:
                out[a, b] = factorial(a) * factorial(b - 1) / factorial(a + b)
    return into, out


def pair_values(tree: Tree, xs: np.ndarray, others: np.ndarray, weights: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each row of ``xs`` the sum over the rows of ``others`` of its values in one tree, an
    entry a feature. All pairs that reach a node pass it together."""
    total = np.zeros((len(xs) * len(others), xs.shape[1]))
    stack = [(0, np.arange(len(total)), np.zeros(total.shape, np.int8))]
    while stack:
        node, alive, state = stack.pop()
        if not len(alive):
            continue
        if tree.left[node] < 0:
            a, b = (state == ROW).sum(axis=1), (state == OTHER).sum(axis=1)
            gained = np.where(state == ROW, weights[0][a, b][:, None], 0) - np.where(state == OTHER, weights[1][a, b][:, None], 0)
            total[alive] += tree.value[node] * gained
            continue
        f = tree.feature[node]
        mine, theirs = _goes_left(tree, node, xs[:, f])[alive // len(others)], _goes_left(tree, node, others[:, f])[alive % len(others)]
        before = state[:, f]
        for child, row_goes, other_goes in ((tree.left[node], mine, theirs), (tree.right[node], ~mine, ~theirs)):
            after = np.where(before != BOTH, before, np.where(other_goes, np.where(row_goes, BOTH, OTHER), ROW))
            stays = np.where(before == BOTH, other_goes | row_goes, np.where(before == ROW, row_goes, other_goes))
            if stays.any():
                kept = state[stays]
                kept[:, f] = after[stays]
                stack.append((int(child), alive[stays], kept))
    return total.reshape(len(xs), len(others), xs.shape[1]).sum(axis=1)


def _most_on_a_path(tree: Tree) -> int:
    """Most different features between the root and a leaf."""
    used: list[frozenset[int]] = [frozenset()] * len(tree.left)
    most = 0
    for node in range(len(tree.left)):
        if tree.left[node] >= 0:
            here = used[node] | {int(tree.feature[node])}
            used[tree.left[node]] = used[tree.right[node]] = here
            most = max(most, len(here))
    return most


def tree_shapley(trees: Trees, rows: DataFrame, background: DataFrame, names: Sequence[str], key: str) -> DataFrame:
    """``key, feature, value`` of every row: a row's values sum to its score minus the mean
    score of the background, in a boosted model its margin.

    Both tables have ``features``. The background is a sample that every task holds, at most
    MOST_BACKGROUND rows. A task takes rows down one group of trees, MOST_PAIRS pairs of a row
    and a background row at a time, so that few rows of a large forest are many tasks too.
    """
    held = background.select(vector_to_array("features").alias("v")).limit(MOST_BACKGROUND + 1).collect()
    if len(held) > MOST_BACKGROUND:
        raise ValueError(f"a background of more than {MOST_BACKGROUND} rows; take a sample")
    others = np.array([r["v"] for r in held], float).reshape(len(held), len(names))
    scale = np.array(trees.weights) / (1 if trees.boosted else len(trees.trees)) / max(1, len(held))
    weights = _weights(max(map(_most_on_a_path, trees.trees), default=0))

    groups = np.array_split(np.arange(len(trees.trees)), min(len(trees.trees), MOST_GROUPS)) if trees.trees else []
    step = max(1, MOST_PAIRS // max(1, len(others)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, group = np.array(batch.column(1).to_pylist(), float).reshape(-1, len(names)), batch.column(2).to_numpy()
            values = np.zeros(xs.shape)
            for g in np.unique(group):
                own = np.flatnonzero(group == g)
                for at in (own[i : i + step] for i in range(0, len(own), step)):
                    for tree in groups[g]:
                        values[at] += scale[tree] * pair_values(trees.trees[tree], xs[at], others, weights)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(values), pa.list_(pa.float64()))], names=["_row", "_group", "_values"])

    # Keys may repeat, so a row has a number of its own; it is written, so that it stays the same.
    asked = keep(on_executors(rows).select(F.col(key).alias("_key"), vector_to_array("features").alias("_v"), F.monotonically_increasing_id().alias("_row")))
    each = asked.select("_row", "_v", F.explode(F.array(*[F.lit(g) for g in range(len(groups))])).alias("_group"))
    found = each.repartition(max(1, len(groups)), "_group").mapInArrow(run, "_row bigint, _group int, _values array<double>")
    long = found.select("_row", "_group", F.posexplode("_values").alias("_at", "_value"))
    # Summed in the order of the trees, so that a sum does not depend on which task ended first.
    parts = F.array_sort(F.collect_list(F.struct("_group", "_value")))
    summed = long.groupBy("_row", "_at").agg(F.aggregate(parts, F.lit(0.0), lambda t, p: t + p["_value"]).alias("value"))
    label = F.get(F.array(*[F.lit(n) for n in names]), F.col("_at"))
    return asked.select("_row", F.col("_key").alias(key)).join(summed, "_row").select(key, label.alias("feature"), "value")
