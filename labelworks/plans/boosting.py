"""Gradient boosting of trees: many small fits side by side, each of them one task.

A round waits for the one before, and a level for the level above it. Spark's own trees start a
job for every level, thousands in a fit, and on few rows starting them takes longer than their
work: however many fits there are, the driver starts their jobs one after the other. So a table
of at most ``ROWS_A_TASK`` rows is fitted in one task, and a search is as many tasks as it has fits.
More rows than one task may hold are fitted by ``GBTClassifier``, over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.session import on_executors

KEY = "row_id"
#: Most rows of a fit in one task: nine bytes a feature and some two hundred more each.
ROWS_A_TASK = 1 << 20
#: Rows that the cuts of a feature come from, as in Spark's own trees.
CUT_ROWS = 10_000
#: Gains below this share of a node's mean square are rounding.
LEAST_GAIN = 1e-12
NODES = "tree int, id int, left int, right int, feature int, threshold double, prediction double, impurity double, gain double, n_rows bigint, weight double"
#: The columns of a saved model's nodes, in the form of Spark's tree models.
SAVED = (
    "tree AS treeID",
    """named_struct('id', id, 'prediction', prediction, 'impurity', impurity, 'impurityStats', array(weight, weight * prediction, weight * (impurity + prediction * prediction)),
    'rawCount', n_rows, 'gain', gain, 'leftChild', left, 'rightChild', right, 'split', named_struct('featureIndex', feature,
    'leftCategoriesOrThreshold', CASE WHEN left < 0 THEN cast(array() AS array<double>) ELSE array(threshold) END, 'numCategories', -1)) AS nodeData""",
)


@dataclass(frozen=True)
class Growth:
    """How a model grows; ``share`` is that of the features tried at a node."""

    rounds: int
    step: float
    depth: int
    least: int
    bins: int
    rate: float
    share: float
    seed: int



def _cuts(column: np.ndarray, weight: np.ndarray | None, bins: int) -> np.ndarray:
    """Limits of a feature: between all its values where they are few, else between those
    closest to equal parts, as Spark has them."""
    values, where = np.unique(column, return_inverse=True)
    middles = (values[:-1] + values[1:]) / 2
    if len(middles) < bins:
        return middles
    total, kept = np.bincount(where, weight, len(values)).cumsum(), []
    target = stride = total[-1] / bins
    for i in range(len(middles)):
        if abs(total[i] - target) < abs(total[i + 1] - target):
            kept.append(i)
            target += stride
    return middles[kept]


def _coded(hot: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of 0 and 1, as few codes as are found in order: of each, the code of every column, from 1
    where one of its rows has a 1, and those rows."""
    codes: list[tuple[np.ndarray, list[int]]] = []
    for j, row in enumerate(hot):
        at = np.flatnonzero(row)
        for code, among in codes:
            if not code[at].any():
                break
        else:
            code, among = np.zeros(hot.shape[1], np.int32), []
            codes.append((code, among))
        among.append(j)
        code[at] = len(among)
    return [(code, np.array(among)) for code, among in codes]


class _Booster:
    """The binned rows of a fit; ``known`` marks those that the cuts come from."""

    def __init__(self, x: np.ndarray, label: np.ndarray, weight: np.ndarray | None, known: np.ndarray, growth: Growth):
        self.growth, self.weight = growth, weight
        self.cuts = [_cuts(column, None if weight is None else weight[known], growth.bins) for column in x[known].T]
        small = np.uint8 if growth.bins <= 256 else np.int32
        self.bins = np.empty((x.shape[1], len(x)), small)
        for j, cuts in enumerate(self.cuts):
            self.bins[j] = np.searchsorted(cuts, x[:, j], "left")
        # features with as many cuts are counted side by side
        sizes = [len(c) for c in self.cuts]
        self.alike = {m: np.array([j for j, size in enumerate(sizes) if size == m]) for m in sorted(set(sizes) - {0})}
        # features with two values of which no row has two above the cut, the slots of a coded column
        # mostly, are counted as one: by a row's number it is above the cut of the first, second, ...
        self.coded = _coded(self.bins[self.alike[1]]) if 1 in self.alike else []
        self.sign = 2.0 * label - 1

    def trees(self) -> Iterator[pa.RecordBatch]:
        g, margin = self.growth, np.zeros(len(self.sign))
        for tree in range(g.rounds):
            # The loss is 2 log(1 + exp(-2 y margin)); the first tree has the labels themselves and counts whole.
            with np.errstate(over="ignore"):
                target = 4 * self.sign / (1 + np.exp(2 * self.sign * margin)) if tree else self.sign
            taken = np.random.default_rng((g.seed, tree, 1)).random(len(margin)) < g.rate
            nodes, leaf = self._grow(tree, target, taken)
            margin += (g.step if tree else 1.0) * nodes["prediction"][leaf]
            n = len(nodes["left"])
            yield pa.RecordBatch.from_pydict({"tree": np.full(n, tree, np.int32), "id": np.arange(n, dtype=np.int32), **nodes})

    def _sums(self, slot: np.ndarray, rows: np.ndarray, target: np.ndarray, k: int, inner: bool) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Of the ``k`` nodes of a level rows, weight, sum and squares; by features with as many
        cuts, the first three in each bin (the first and the third where rows weigh the same)."""
        weights = [None, target] if self.weight is None else [None, self.weight, target * self.weight]
        own = [w if w is None else w[rows] for w in weights]
        sums = [np.bincount(slot, w, k).astype(float) for w in own]
        head, cells = np.stack([sums[0], sums[-2], sums[-1], np.bincount(slot, own[-1] * target[rows], k)]), {}
        for m, features in self.alike.items() if inner else ():
            wide = m + 1
            cells[m] = made = np.empty((len(own), len(features), k, wide))
            if m == 1:
                for code, among in self.coded:
                    at = slot * (len(among) + 1) + code[rows]
                    for i, w in enumerate(own):
                        counted = np.bincount(at, w, k * (len(among) + 1)).reshape(k, -1)
                        made[i, among, :, 1] = counted[:, 1:].T
                        made[i, among, :, 0] = sums[i] - counted[:, 1:].T
                continue
            for j, feature in enumerate(features):
                at = slot * wide + self.bins[feature, rows]
                for i, w in enumerate(own):
                    made[i, j] = np.bincount(at, w, k * wide).reshape(k, wide)
        return head, cells

    def _best(self, head: np.ndarray, cells: dict[int, np.ndarray], tried: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Gain, feature and cut of the best split of each node, by the fall of the variance."""
        k, least = head.shape[1], self.growth.least
        gains, cuts = np.full((len(self.cuts), k), -np.inf), np.zeros((len(self.cuts), k), int)
        rows, weight, total = head[0], head[1], head[2]
        for m, features in self.alike.items():
            left = cells[m].cumsum(axis=3)[..., :-1]
            lefts, lw, ls = left[0], left[-2], left[-1]
            rw, rs = weight[:, None] - lw, total[:, None] - ls
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = (ls**2 / lw + rs**2 / rw - (total**2 / weight)[:, None]) / weight[:, None]
            fine = (lefts >= least) & (rows[:, None] - lefts >= least) & (lw > 0) & (rw > 0)
            gain = np.where(fine, gain, -np.inf)
            cuts[features] = at = gain.argmax(axis=2)
            gains[features] = np.take_along_axis(gain, at[..., None], 2)[..., 0]
        gains[~tried.T] = -np.inf
        feature = gains.argmax(axis=0)
        return gains[feature, np.arange(k)], feature, cuts[feature, np.arange(k)]

    def _grow(self, tree: int, target: np.ndarray, taken: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """The nodes of a tree, level by level, and the leaf of each row, whether taken or not."""
        g, width = self.growth, len(self.cuts)
        some, draws = ceil(g.share * width), np.random.default_rng((g.seed, tree, 0))
        leaf, alive, slot = np.zeros(len(target), int), np.arange(len(target)), np.zeros(len(target), int)
        levels, first, k = [], 0, 1
        for level in range(g.depth + 1):
            used = taken[alive]
            head, cells = self._sums(slot[used], alive[used], target, k, level < g.depth)
            n, weight, total, squares = head
            with np.errstate(divide="ignore", invalid="ignore"):
                mean, square = np.where(weight > 0, total / weight, 0.0), np.where(weight > 0, squares / weight, 0.0)
            gain, feature, cut = np.full(k, -1.0), np.full(k, -1), np.zeros(k, int)
            if cells:
                tried = np.zeros((k, width), bool)
                np.put_along_axis(tried, draws.random((k, width)).argsort(axis=1)[:, :some], True, axis=1)
                gain, feature, cut = self._best(head, cells, tried)
            splits = gain > LEAST_GAIN * square
            left = np.where(splits, first + k + 2 * (splits.cumsum() - 1), -1)
            threshold = np.array([self.cuts[f][c] if s else np.nan for f, c, s in zip(feature, cut, splits)])
            whole = {"left": left, "right": np.where(splits, left + 1, -1), "feature": np.where(splits, feature, -1)}
            levels.append(
                {name: v.astype(np.int32) for name, v in whole.items()}
                | {"threshold": threshold, "prediction": mean, "impurity": np.maximum(square - mean**2, 0), "gain": np.where(splits, gain, -1.0), "n_rows": n.astype(np.int64), "weight": weight}
            )
            goes_on = splits[slot]
            alive, slot = alive[goes_on], slot[goes_on]
            child = left[slot] + (self.bins[feature[slot], alive] > cut[slot])
            leaf[alive] = child
            first, slot, k = first + k, child - first - k, 2 * int(splits.sum())
            if not k:
                break
        return {name: np.concatenate([v[name] for v in levels]) for name in levels[0]}, leaf


class BoostedTrees(Estimator, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted regression trees with log-loss for labels 0 and 1, as Spark's ``GBTClassifier`` makes
    them: same loss, variance gains, cuts and leaves, other draws of rows and features.

    Draws go by round, so a model's first rounds are the model of fewer rounds. More than
    ``rowsPerTask`` rows make that ``GBTClassifier``'s model.
    """

    maxIter: Param[int] = Param(Params._dummy(), "maxIter", "rounds", TypeConverters.toInt)
    stepSize: Param[float] = Param(Params._dummy(), "stepSize", "weight of every tree but the first", TypeConverters.toFloat)
    maxDepth: Param[int] = Param(Params._dummy(), "maxDepth", "levels of splits", TypeConverters.toInt)
    minInstancesPerNode: Param[int] = Param(Params._dummy(), "minInstancesPerNode", "least rows of a node", TypeConverters.toInt)
    maxBins: Param[int] = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    subsamplingRate: Param[float] = Param(Params._dummy(), "subsamplingRate", "share of the rows of a round", TypeConverters.toFloat)
    featureShare: Param[float] = Param(Params._dummy(), "featureShare", "share of the features tried at a node", TypeConverters.toFloat)
    seed: Param[int] = Param(Params._dummy(), "seed", "draws of rows and features", TypeConverters.toInt)
    weightCol: Param[str] = Param(Params._dummy(), "weightCol", "row weight, none when empty", TypeConverters.toString)
    keyCol: Param[str] = Param(Params._dummy(), "keyCol", "row key, which fixes the order of the rows", TypeConverters.toString)
    rowsPerTask: Param[int] = Param(Params._dummy(), "rowsPerTask", "most rows of a fit in one task", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, maxIter=20, stepSize=0.1, maxDepth=5, minInstancesPerNode=1, maxBins=32, subsamplingRate=1.0, featureShare=1.0,
        seed=42, weightCol="", keyCol=KEY, rowsPerTask=ROWS_A_TASK, featuresCol="features", labelCol="label",
    ):
        super().__init__()
        self._setDefault(
            maxIter=20, stepSize=0.1, maxDepth=5, minInstancesPerNode=1, maxBins=32, subsamplingRate=1.0, featureShare=1.0, seed=42, weightCol="", keyCol=KEY, rowsPerTask=ROWS_A_TASK
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> Model:
        get, key = self.getOrDefault, self.getOrDefault(self.keyCol)
        growth = Growth(*[get(p) for p in (self.maxIter, self.stepSize, self.maxDepth, self.minInstancesPerNode, self.maxBins, self.subsamplingRate, self.featureShare, self.seed)])
        weight = F.col(get(self.weightCol)).cast("double") if get(self.weightCol) else F.lit(None).cast("double")
        keys = [F.col(key).cast("string").alias("_key")] if key in dataset.columns else [F.lit("").alias("_key")]
        rows = on_executors(dataset).select(*keys, F.col(self.getLabelCol()).cast("double").alias("_y"), weight.alias("_w"), vector_to_array(self.getFeaturesCol()).alias("_x"))
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_x")).alias("wide"), F.count_if(F.col("_y").isNull() | ~F.col("_y").isin(0.0, 1.0)).alias("odd")).first()
        if not facts["n"] or facts["odd"]:
            raise ValueError("boosting needs rows, all with label 0 or 1")
        n, wide = facts["n"], facts["wide"]
        if n > get(self.rowsPerTask):
            return self._spread(growth).fit(dataset)
        # the same rows in the same order, whichever tasks read them
        everything = ["_key", "_y", "_w", "_x"]
        share = min(1.0, max(growth.bins**2, CUT_ROWS) / n)
        known = F.pmod(F.xxhash64(F.lit(growth.seed), *everything), F.lit(1 << 30)) < int(share * (1 << 30))
        dealt = rows.repartition(1).sortWithinPartitions(*everything)
        weighted = bool(get(self.weightCol))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            columns: list[list[np.ndarray]] = [[np.empty((0, wide))], [np.empty(0)], [np.empty(0)], [np.empty(0, bool)]]
            for batch in batches:
                columns[0].append(batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, wide))
                for kept, name in zip(columns[1:], ("_y", "_w", "_known")):
                    kept.append(batch.column(name).to_numpy(zero_copy_only=False))
            x, y, w, sampled = (np.concatenate(c) for c in columns)
            booster = _Booster(x, y, w.astype(float) if weighted else None, sampled, growth)
            del x, columns  # the bins stand for them
            yield from booster.trees()

        nodes = dealt.select("_y", "_w", "_x", known.alias("_known")).mapInArrow(run, NODES).toArrow()
        model = self._copyValues(BoostedModel())._set(width=wide)
        model.nodes = nodes.sort_by([("tree", "ascending"), ("id", "ascending")])
        return model

    def _spread(self, growth: Growth) -> GBTClassifier:
        spread = GBTClassifier(
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            maxIter=growth.rounds,
            stepSize=growth.step,
            maxDepth=growth.depth,
            minInstancesPerNode=growth.least,
            maxBins=growth.bins,
            subsamplingRate=growth.rate,
            featureSubsetStrategy=str(growth.share) if growth.share < 1 else "all",
            checkpointInterval=50,
            seed=growth.seed,
        )
        weight = self.getOrDefault(self.weightCol)
        return spread.setWeightCol(weight) if weight else spread


class BoostedModel(Model, HasFeaturesCol, HasLabelCol, MLReadable, MLWritable):
    """The fitted trees, a table of nodes on the driver; saved in the form of Spark's tree models."""

    width: Param[int] = Param(Params._dummy(), "width", "length of a row's vector", TypeConverters.toInt)
    maxIter, stepSize = BoostedTrees.maxIter, BoostedTrees.stepSize
    nodes: pa.Table

    def __init__(self) -> None:
        super().__init__()

    @property
    def numFeatures(self) -> int:
        return self.getOrDefault(self.width)

    @property
    def getNumTrees(self) -> int:
        return self.getOrDefault(self.maxIter)

    @property
    def treeWeights(self) -> list[float]:
        return [1.0] + [self.getOrDefault(self.stepSize)] * (self.getNumTrees - 1)

    @property
    def featureImportances(self) -> DenseVector:
        """Gains by the weight of the rows, over all trees, as shares."""
        inner = self.nodes["left"].to_numpy() >= 0
        gained = (self.nodes["gain"].to_numpy() * self.nodes["weight"].to_numpy())[inner]
        total = np.bincount(self.nodes["feature"].to_numpy()[inner], gained, self.numFeatures)
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from labelworks.plans.trees import _leaves, node_arrays

        walks = [(t.walk(), t.value * w) for t, w in zip(node_arrays(self.nodes, self.getNumTrees), self.treeWeights, strict=True)]
        wide = self.numFeatures

        table = on_executors(dataset)

        @F.pandas_udf("double")
        def margin(points: pd.Series) -> pd.Series:
            x = np.array(points.tolist(), float).reshape(len(points), wide)
            return pd.Series(sum((value[_leaves(walk, x)] for walk, value in walks), np.zeros(len(x))))

        said = table.withColumn("_margin", margin(vector_to_array(self.getFeaturesCol())))
        share = 1 / (1 + F.exp(-2 * F.col("_margin")))
        return said.select(
            *[F.col(f"`{c}`") for c in dataset.columns],
            array_to_vector(F.array(-F.col("_margin"), F.col("_margin"))).alias("rawPrediction"),
            array_to_vector(F.array(1 - share, share)).alias("probability"),
            (F.col("_margin") > 0).cast("double").alias("prediction"),
        )

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: BoostedModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.sparkSession.createDataFrame(self.model.nodes, NODES).selectExpr(*SAVED).write.parquet(f"{path}/data")


class _Reader(MLReader):
    def load(self, path: str) -> BoostedModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = BoostedModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        node = self.sparkSession.read.parquet(f"{path}/data").selectExpr("treeID", "nodeData.*").selectExpr(
            "treeID AS tree", "id", "leftChild AS left", "rightChild AS right", "split.featureIndex AS feature",
            "get(split.leftCategoriesOrThreshold, 0) AS threshold", "prediction", "impurity", "gain", "rawCount AS n_rows", "impurityStats[0] AS weight",
        )
        model.nodes = node.toArrow().sort_by([("tree", "ascending"), ("id", "ascending")])
        return model
