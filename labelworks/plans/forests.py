"""Forests: groups of trees are tasks, and each task has all rows, binned to a byte a feature.

Spark's own forests start a job for every few nodes' levels and hold every node as an object on the
driver, so that many deep forests are bound by the driver whatever the cores. Here rows are binned
where they are read, packed, and dealt once to each group of trees; a task grows its trees level by
level, several small ones side by side. The nodes go to the shared folder as columns, one row a
tree. The driver holds none; to score rows they are sent to the tasks as they are.

Cuts, gains, leaf limits and merged leaves are those of Spark's ``RandomForestClassifier``; draws of
rows and features go by tree, so the first trees of a forest are the forest of fewer trees. Larger
tables than a task may hold, other labels than 0 and 1 and settings not handled here are fitted by it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log2, sqrt
from typing import Any
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml import Model
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import MLReader, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.operators.keep import shared_folder
from labelworks.plans.boosting import CUT_ROWS, _cuts
from labelworks.session import on_executors

KEY = "row_id"
#: Most binned values that a task holds, a byte each; a row needs some sixty bytes more.
CELLS_A_TASK = 1 << 28
ROWS_A_TASK = 1 << 22
#: Rows, counted once a tree, that are grown side by side.
ROWS_SIDE_BY_SIDE = 1 << 18
#: Gains below this are rounding.
LEAST_GAIN = 1e-12
#: One row a tree; ``number`` is a node's threshold, at a leaf the share of class 1.
PACKED = "tree int, left binary, feature binary, number binary, share binary, weight binary, n_rows binary, gain binary"
KINDS = {"left": np.int32, "feature": np.int32, "number": float, "share": float, "weight": float, "n_rows": float, "gain": float}
WALKED = ["left", "feature", "number"]
#: Parameters that Spark's forests have and their trees have not.
OF_FORESTS = {"numTrees", "bootstrap", "featureSubsetStrategy", "subsamplingRate"}
SAVED = """treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double,
leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"""


class ForestModel(RandomForestClassificationModel):
    """Spark's model without a Python object for every tree: PySpark 4.1 keeps the trees as a cached
    property, and collecting a model's parameters reads every attribute that is not a plain one.
    Saved and read back as ``RandomForestClassificationModel``."""

    @property
    def trees(self) -> list[DecisionTreeClassificationModel]:
        return super().trees

    @classmethod
    def read(cls) -> MLReader:
        return RandomForestClassificationModel.read()


@dataclass(frozen=True)
class Growth:
    """How a forest grows; ``some`` is the number of features tried at a node."""

    trees: int
    depth: int
    least: int
    least_gain: float
    some: int
    bootstrap: bool
    seed: int


@dataclass
class _Rows:
    """Rows on their way down some trees, those of class 1 first: where each is, how often its
    tree has it (None: once) and its weight (None: as often)."""

    at: np.ndarray
    slot: np.ndarray
    times: np.ndarray | None
    weight: np.ndarray | None
    ones: int

    def moved(self, places: np.ndarray) -> _Rows:
        """The rows whose slot has a place, there."""
        slot = places[self.slot]
        some = slot >= 0
        return _Rows(self.at[some], slot[some], *[v if v is None else v[some] for v in (self.times, self.weight)], int(np.count_nonzero(some[: self.ones])))

    def sums(self, cell: np.ndarray, k: int) -> list[np.ndarray]:
        """Of each of ``k`` cells the rows and the weight of class 1; last, where it is not the rows, the weight."""
        p, out = self.ones, []
        for v in (self.times,) if self.weight is None else (self.times, self.weight):
            one, other = (np.bincount(cell[part], v if v is None else v[part], k).astype(float, copy=False) for part in (slice(0, p), slice(p, None)))
            other += one
            out.append((other, one))
        return [out[0][0], out[-1][1], *[whole for whole, _ in out[1:]]]


class _Grower:
    """The binned rows of a fit, a row of ``bins`` a feature, in an order that does not depend on who read them."""

    def __init__(self, bins: np.ndarray, label: np.ndarray, weight: np.ndarray | None, cuts: list[np.ndarray], growth: Growth):
        self.growth, self.cuts, self.weight = growth, cuts, weight
        self.bins, self.n, self.positive = bins.ravel(), bins.shape[1], label > 0
        self.sizes = np.array([len(c) + 1 for c in cuts])

    def _start(self, trees: list[int]) -> _Rows:
        g, parts = self.growth, []
        counts = [np.random.default_rng((g.seed, t, 1)).poisson(1.0, self.n) if g.bootstrap else np.ones(self.n, int) for t in trees]
        for positive in (True, False):
            parts += [(np.flatnonzero((c > 0) & (self.positive == positive)), i, positive) for i, c in enumerate(counts)]
        at, slot = np.concatenate([r for r, _, _ in parts]), np.repeat([i for _, i, _ in parts], [len(r) for r, _, _ in parts])
        times = np.concatenate([counts[i][r] for r, i, _ in parts]).astype(float) if g.bootstrap else None
        weight = None if self.weight is None else self.weight[at] * (1.0 if times is None else times)
        return _Rows(at, slot, times, weight, sum(len(r) for r, _, positive in parts if positive))

    def grow(self, trees: list[int]) -> list[dict[str, np.ndarray]]:
        """The nodes of each of ``trees``, parents before children, a right child behind its left one."""
        g, rows = self.growth, self._start(trees)
        draws = [np.random.default_rng((g.seed, t, 0)) for t in trees]
        # number of rows, weight of class 1 and weight of each node of a level
        own = rows.sums(rows.slot, len(trees))
        tree, levels, first = np.arange(len(trees)), [], 0
        for level in range(g.depth + 1):
            n, ones, weight = own[0], own[1], own[-1] if len(own) > 2 else own[0]
            k = len(n)
            at = {"tree": tree, "n_rows": n, "weight": weight, "ones": ones, "left": np.full(k, -1), "feature": np.full(k, -1), "cut": np.zeros(k, int), "gain": np.full(k, -1.0)}
            levels.append(at)
            opened = np.flatnonzero((n >= 2 * g.least) & (ones > 0) & (ones < weight)) if level < g.depth else np.empty(0, int)
            if not len(opened):
                break
            places = np.full(k, -1)
            places[opened] = np.arange(len(opened))
            rows = rows.moved(places)
            found, gain, feature, cut, left = self._best(rows, [v[opened] for v in own], self._tried(draws, tree[opened]))
            if not len(found):
                break
            node = opened[found]
            at["gain"][node], at["feature"][node], at["cut"][node] = gain, feature, cut
            at["left"][node] = first + k + 2 * np.arange(len(node))
            # the children, left and right in turn, and the rows that go to them
            own = [np.stack([a, v[node] - a], axis=1).ravel() for a, v in zip(left, own)]
            tree, places = np.repeat(tree[node], 2), np.full(len(opened), -1)
            places[found] = np.arange(len(found))
            rows = rows.moved(places)
            rows.slot = 2 * rows.slot + (self.bins[(feature * self.n)[rows.slot] + rows.at] > cut[rows.slot])
            first += k
        return self._trees(levels, trees)

    def _tried(self, draws: list[np.random.Generator], tree: np.ndarray) -> np.ndarray:
        """The features tried at each node, by the draws of its tree."""
        wide, some = len(self.cuts), self.growth.some
        if some >= wide:
            return np.broadcast_to(np.arange(wide), (len(tree), wide))
        sizes = np.bincount(tree, minlength=len(draws))
        drawn = np.concatenate([d.random((size, wide), np.float32) for d, size in zip(draws, sizes) if size])
        return np.sort(np.argpartition(drawn, some - 1, axis=1)[:, :some], axis=1)

    def _best(self, rows: _Rows, own: list[np.ndarray], tried: np.ndarray) -> tuple[Any, ...]:
        """Of the nodes that a split parts: which, the gain in purity, feature, cut and the sums of the left side."""
        g, (k, some) = self.growth, tried.shape
        # the cells of a node lie side by side, feature after feature, as many as it has bins
        sizes = self.sizes[tried].ravel()
        ends = sizes.cumsum()
        starts, width = ends - sizes, int(ends[-1])
        sums = [np.zeros(width) for _ in own]
        for feature, offset in zip(np.ascontiguousarray(tried.T) * self.n, np.ascontiguousarray(starts.reshape(k, some).T)):
            place = feature[rows.slot]
            place += rows.at
            cell = offset[rows.slot]
            cell += self.bins[place]
            for total, part in zip(sums, rows.sums(cell, width), strict=True):
                total += part
        # behind an empty cell a cut parts the rows as the one before it does
        full = np.flatnonzero(sums[0])
        part = np.repeat(np.arange(k * some), sizes)[full]
        node = part // some
        lefts = []
        for total in sums:
            run = total.cumsum()
            lefts.append(run[full] - (run[starts] - total[starts])[part])
        n, ones, weight = own[0], own[1], own[-1] if len(own) > 2 else own[0]
        fine = (lefts[0] >= g.least) & (n[node] - lefts[0] >= g.least)
        if len(own) > 2:
            fine &= (lefts[-1] > 0) & (weight[node] - lefts[-1] > 0)
        node, part, full, lefts = node[fine], part[fine], full[fine], [v[fine] for v in lefts]
        if not len(node):
            return (np.empty(0, int), np.empty(0), np.empty(0, int), np.empty(0, int), lefts)
        lw, l1 = lefts[-1] if len(own) > 2 else lefts[0], lefts[1]
        rw, r1 = weight[node] - lw, ones[node] - l1
        whole = (ones**2 + (weight - ones) ** 2) / weight
        gain = ((l1**2 + (lw - l1) ** 2) / lw + (r1**2 + (rw - r1) ** 2) / rw - whole[node]) / weight[node]
        heads = np.flatnonzero(np.diff(node, prepend=-1))
        best = np.maximum.reduceat(gain, heads)
        at = np.flatnonzero(gain == np.repeat(best, np.diff(heads, append=len(gain))))
        at = at[np.flatnonzero(np.diff(node[at], prepend=-1))]
        at = at[(gain[at] > LEAST_GAIN) & (gain[at] >= g.least_gain)]
        return node[at], gain[at], tried.ravel()[part[at]], full[at] - starts[part[at]], [v[at] for v in lefts]

    def _trees(self, levels: list[dict[str, np.ndarray]], trees: list[int]) -> list[dict[str, np.ndarray]]:
        """The nodes by tree; leaves side by side that say the same are one, as in Spark's trees."""
        ends = np.cumsum([0, *[len(v["left"]) for v in levels]]).tolist()
        v = {name: np.concatenate([level[name] for level in levels]) for name in levels[0]}
        left, said, seen = v["left"], 2 * v["ones"] > v["weight"], np.zeros(ends[-1], bool)
        for a, b in list(zip(ends, ends[1:]))[::-1]:
            inner = a + np.flatnonzero(left[a:b] >= 0)
            one, other = left[inner], left[inner] + 1
            left[inner[(left[one] < 0) & (left[other] < 0) & (said[one] == said[other])]] = -1
        seen[: ends[1]] = True
        for a, b in zip(ends, ends[1:]):
            inner = a + np.flatnonzero(seen[a:b] & (left[a:b] >= 0))
            seen[left[inner]] = seen[left[inner] + 1] = True
        out = []
        for i in range(len(trees)):
            own = np.flatnonzero(seen & (v["tree"] == i))
            number = np.full(ends[-1], -1)
            number[own] = np.arange(len(own))
            mine = {name: v[name][own] for name in ("left", "feature", "cut", "weight", "n_rows", "gain")}
            inner, share = mine["left"] >= 0, v["ones"][own] / np.where(mine["weight"] > 0, mine["weight"], 1)
            mine["left"][inner] = number[mine["left"][inner]]
            mine["feature"][~inner], mine["gain"][~inner] = -1, -1.0
            limits = share.copy()
            limits[inner] = [self.cuts[f][c] for f, c in zip(mine["feature"][inner], mine["cut"][inner])]
            out.append({"tree": trees[i], **mine, "number": limits, "share": share})
        return out


class Forest(RandomForestClassifier):
    """``RandomForestClassifier`` with other draws of rows and features, grown in tasks."""

    def _create_model(self, java_model: Any) -> ForestModel:
        return ForestModel(java_model)

    @classmethod
    def read(cls) -> MLReader:
        return RandomForestClassifier.read()

    def _tries(self, wide: int) -> int | None:
        """Features tried at a node, None where Spark has to say."""
        kinds = {"all": wide, "sqrt": ceil(sqrt(wide)), "log2": max(1, ceil(log2(wide)))}
        return kinds.get(self.getFeatureSubsetStrategy())

    def _plain(self) -> bool:
        """Whether all settings are among those handled here."""
        get = self.getOrDefault
        return get(self.impurity) == "gini" and get(self.subsamplingRate) == 1 and get(self.minWeightFractionPerNode) == 0 and not get(self.leafCol) and not self.isSet(self.thresholds)

    def _fit(self, dataset: DataFrame) -> Model:
        get, spark = self.getOrDefault, dataset.sparkSession
        weighted = self.isSet(self.weightCol) and bool(get(self.weightCol))
        weight = F.col(get(self.weightCol)).cast("double") if weighted else F.lit(1.0)
        keys = [F.col(KEY).cast("string").alias("_key")] if KEY in dataset.columns else [F.lit("").alias("_key")]
        rows = on_executors(dataset).select(*keys, F.col(self.getLabelCol()).cast("double").alias("_y"), weight.alias("_w"), vector_to_array(self.getFeaturesCol()).alias("_x"))
        odd = F.col("_y").isNull() | ~F.col("_y").isin(0.0, 1.0) | F.col("_w").isNull() | (F.col("_w") < 0) | F.col("_x").isNull()
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("_x")).alias("wide"), F.min(F.size("_x")).alias("narrow"), F.count_if(odd).alias("odd")).first()
        n, wide = facts["n"], facts["wide"] or 0
        some = self._tries(wide) if wide else None
        if not n or facts["odd"] or facts["narrow"] != wide or some is None or n > ROWS_A_TASK or n * wide > CELLS_A_TASK or not self._plain():
            return super()._fit(dataset)
        growth = Growth(get(self.numTrees), get(self.maxDepth), get(self.minInstancesPerNode), get(self.minInfoGain), some, get(self.bootstrap), get(self.seed))
        most = min(get(self.maxBins), n)
        everything = ["_key", "_y", "_w", "_x"]
        hashed = F.xxhash64(F.lit(growth.seed), *everything)
        share = min(1.0, max(most**2, CUT_ROWS) / n)
        known = rows.where(F.pmod(hashed, F.lit(1 << 30)) < int(share * (1 << 30))).select("_w", "_x").toArrow()
        points, weights = known["_x"].combine_chunks().flatten().to_numpy().reshape(-1, wide), known["_w"].to_numpy() if weighted else None
        cuts = [_cuts(c[there], None if weights is None else weights[there], most) if (there := ~np.isnan(c)).any() else np.empty(0) for c in points.T]
        groups = min(growth.trees, spark.sparkContext.defaultParallelism)
        byte = np.uint8 if most <= 256 else np.int32

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, wide)
                bins = np.empty(x.shape, byte)
                for j, limits in enumerate(cuts):
                    bins[:, j] = np.searchsorted(limits, x[:, j], "left")
                parts = [bins, *[batch.column(c).to_numpy(zero_copy_only=False) for c in ("_at", "_y", "_w")]]
                yield pa.RecordBatch.from_arrays([pa.array([p.tobytes()], pa.binary()) for p in parts], names=["bins", "at", "y", "w"])

        def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts: list[list[np.ndarray]] = [[], [], [], []]
            group = 0
            for batch in batches:
                for kept, name, kind in zip(parts, ("bins", "at", "y", "w"), (byte, np.int64, float, float)):
                    kept += [np.frombuffer(memoryview(b.as_buffer()), kind) for b in batch.column(name)]
                group = batch.column("group")[0].as_py()
            if not parts[0]:
                return
            bins, at, y, w = (np.concatenate(p) for p in parts)
            parts.clear()
            # rows with the same hash are the same, so that their order does not matter
            order = np.argsort(at, kind="stable")
            bins = np.ascontiguousarray(bins.reshape(-1, wide)[order].T)
            grower = _Grower(bins, y[order], w[order] if weighted else None, cuts, growth)
            mine, lot = list(range(group, growth.trees, groups)), max(1, ROWS_SIDE_BY_SIDE // len(order))
            for a in range(0, len(mine), lot):
                for tree in grower.grow(mine[a : a + lot]):
                    columns = [pa.array([tree["tree"]], pa.int32()), *[pa.array([tree[c].astype(kind).tobytes()], pa.binary()) for c, kind in KINDS.items()]]
                    yield pa.RecordBatch.from_arrays(columns, names=["tree", *KINDS])

        packed = rows.select("_y", "_w", "_x", hashed.alias("_at")).mapInArrow(pack, "bins binary, at binary, y binary, w binary")
        dealt = packed.select("*", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")).repartitionById(groups, "group")
        path = f"{shared_folder(spark)}/trees/{spark.sparkContext.applicationId}/{uuid4().hex}"
        dealt.mapInArrow(grow, PACKED).write.parquet(path)
        model = self._copyValues(GrownForest())
        model.folder, model.wide, model.size = path, wide, growth.trees
        return model


class GrownForest(ForestModel):
    """A fitted forest whose nodes lie in the shared folder. Spark's own model of it is made, on the
    driver, only when something asks for what this class does not answer."""

    folder: str
    wide: int
    size: int
    _made: RandomForestClassificationModel | None = None

    def __init__(self) -> None:
        super().__init__()

    def __del__(self) -> None:
        """There may be nothing on the JVM to let go of; what there is lets go of itself."""

    @property
    def _java_obj(self) -> Any:
        if self._made is None and "folder" in self.__dict__:
            path = f"{self.folder}-{uuid4().hex}"
            self.write().save(path)
            self._made = RandomForestClassificationModel.load(path)
        return None if self._made is None else self._made._java_obj

    @_java_obj.setter
    def _java_obj(self, value: Any) -> None:
        """Nothing to set: Spark's model is made from the nodes."""

    @property
    def numFeatures(self) -> int:
        return self.wide

    @property
    def numClasses(self) -> int:
        return 2

    @property
    def getNumTrees(self) -> int:
        return self.size

    @property
    def treeWeights(self) -> list[float]:
        return [1.0] * self.size

    @property
    def featureImportances(self) -> DenseVector:
        """Gains by the weight of the rows, as shares of each tree and then of all."""
        wide, kinds = self.wide, KINDS

        def gained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for row in batch.to_pylist():
                    feature, weight, gain = (np.frombuffer(row[c], kinds[c]) for c in ("feature", "weight", "gain"))
                    inner = feature >= 0
                    sums = np.bincount(feature[inner], (gain * weight)[inner], wide)
                    out.append((sums / sums.sum() if sums.sum() > 0 else sums).tolist())
                yield pa.RecordBatch.from_arrays([batch.column("tree"), pa.array(out, pa.list_(pa.float64()))], names=["tree", "shares"])

        nodes = on_executors(SparkSession.active().read.schema(PACKED).parquet(self.folder).select("tree", "feature", "weight", "gain"))
        shares = sorted(tuple(r) for r in nodes.mapInArrow(gained, "tree int, shares array<double>").collect())
        total = np.sum([s for _, s in shares], axis=0)
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def packed(self, *columns: str) -> pa.Table:
        """Columns of the nodes, one row a tree, in order."""
        return SparkSession.active().read.schema(PACKED).parquet(self.folder).select("tree", *columns).toArrow().sort_by("tree")

    def sent(self, *more: str) -> Broadcast:
        """What a walk needs of every tree, and further columns, sent to the executors once; the
        driver keeps no copy in Python."""
        held = self.__dict__.setdefault("_sent", {})
        if more not in held:
            columns = [*WALKED, *more]
            table = self.packed(*columns)
            held[more] = SparkSession.active().sparkContext.broadcast([tuple(row[c] for c in columns) for row in table.to_pylist()])
            # the file that the executors are served from stays
            held[more].__dict__.pop("_value", None)
        return held[more]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from labelworks.plans.trees import _leaves

        table, sent, wide, size = on_executors(dataset), self.sent(), self.wide, self.size

        @F.pandas_udf("double")
        def share(points: pd.Series) -> pd.Series:
            x = np.array(points.tolist(), float).reshape(len(points), wide)
            total = np.zeros(len(x))
            for packed in sent.value:
                walk, number = unpacked(packed)
                total += number[_leaves(walk, x)]
            return pd.Series(total)

        votes = F.col("_votes")
        said = table.withColumn("_votes", share(vector_to_array(self.getFeaturesCol())))
        return said.select(
            *[F.col(f"`{c}`") for c in dataset.columns],
            array_to_vector(F.array(size - votes, votes)).alias("rawPrediction"),
            array_to_vector(F.array(1 - votes / size, votes / size)).alias("probability"),
            (votes > size - votes).cast("double").alias("prediction"),
        )

    def write(self) -> MLWriter:
        return _Writer(self)


def unpacked(packed: tuple[bytes, ...]) -> tuple[Any, np.ndarray]:
    """The walk of a tree, and the numbers of its nodes."""
    from labelworks.plans.trees import Walk

    left, feature, number = (np.frombuffer(b, KINDS[c]) for b, c in zip(packed, WALKED))
    return Walk(left, left + 1, feature, number, np.zeros(len(left) + 1, np.int32), np.empty(0)), number


class _Writer(MLWriter):
    """Writes a grown forest in the form of Spark's."""

    def __init__(self, model: GrownForest):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, self.sparkSession
        own, default = ({p.name: v for p, v in params.items()} for params in (model._paramMap, model._defaultParamMap))

        def metadata(kind: str, uid: str, leave: set[str], **more: int) -> str:
            of = [{name: v for name, v in params.items() if name not in leave} for params in (own, default)]
            return json.dumps({"class": f"org.apache.spark.ml.classification.{kind}", "timestamp": 0, "sparkVersion": spark.version, "uid": uid, "paramMap": of[0], "defaultParamMap": of[1], **more})

        whole = metadata("RandomForestClassificationModel", model.uid, set(), numFeatures=model.wide, numClasses=2, numTrees=model.size)
        spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        trees = [(i, metadata("DecisionTreeClassificationModel", f"dtc_{model.uid}_{i}", OF_FORESTS), 1.0) for i in range(model.size)]
        spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")

        def saved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    left, feature, number, share, weight, n_rows, gain = (np.frombuffer(row[c], kind) for c, kind in KINDS.items())
                    n, inner = len(left), left >= 0
                    limits = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], inner.cumsum()]), pa.int32()), pa.array(number[inner]))
                    stats = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * 2, pa.int32()), pa.array(np.stack([weight * (1 - share), weight * share], axis=1).ravel()))
                    split = pa.StructArray.from_arrays([pa.array(feature), limits, pa.array(np.full(n, -1, np.int32))], ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
                    node = {
                        "id": np.arange(n, dtype=np.int32), "prediction": (share > 0.5).astype(float), "impurity": 2 * share * (1 - share), "impurityStats": stats, "rawCount": n_rows.astype(np.int64),
                        "gain": gain, "leftChild": left, "rightChild": np.where(inner, left + 1, -1).astype(np.int32), "split": split,
                    }
                    data = pa.StructArray.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in node.values()], list(node))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row["tree"], np.int32)), data], names=["treeID", "nodeData"])

        nodes = on_executors(spark.read.schema(PACKED).parquet(model.folder))
        nodes.mapInArrow(saved, SAVED).write.parquet(f"{path}/data")
