"""Classifiers Spark ML does not ship: ridge, nearest neighbours, kernel SVC."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.operators.keep import keep
from labelworks.operators.neighbours import neighbour_join, neighbour_vote
from labelworks.operators.split import bounded_sample
from labelworks.plans.stages import FrameModel
from labelworks.session import on_executors

KEY = "row_id"
# Numbers that a worker holds at a time when it projects points.
PROJECTED_CELLS = 1 << 17


class RidgeClassifier(Estimator, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Least squares on labels -1 and 1 with penalty alpha; the sign decides.

    The normal equations are one distributed aggregate, solved on the driver at
    the size features x features. The model is a pipeline of the regression
    (prediction column ``margin``) and the sign.
    """

    alpha: Param[float] = Param(Params._dummy(), "alpha", "penalty on squared coefficients", TypeConverters.toFloat)
    weightCol: Param[str] = Param(Params._dummy(), "weightCol", "row weight, none when empty", TypeConverters.toString)
    maxIter: Param[int] = Param(Params._dummy(), "maxIter", "iterations with many features", TypeConverters.toInt)
    tol: Param[float] = Param(Params._dummy(), "tol", "where the iterations stop", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, alpha=1.0, featuresCol="features", labelCol="label", weightCol="", maxIter=1000, tol=1e-9):
        super().__init__()
        self._setDefault(alpha=1.0, weightCol="", maxIter=1000, tol=1e-9)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        label, weight = F.col(self.getLabelCol()), self.getOrDefault(self.weightCol)
        signed = dataset.withColumn("_y", F.when(label == 1, 1.0).otherwise(-1.0))
        w = F.col(weight) if weight else F.lit(1.0)
        row = dataset.agg(F.sum(w).alias("total"), F.sum(F.when(label == 1, w).otherwise(0.0)).alias("positive")).first()
        share = row["positive"] / row["total"]
        # The regression divides its penalty by the deviation of the label.
        deviation = 2 * np.sqrt(share * (1 - share))
        regression = LinearRegression(
            featuresCol=self.getFeaturesCol(),
            labelCol="_y",
            predictionCol="margin",
            solver="auto",  # the normal equations up to 4,096 features, iterations beyond
            maxIter=self.getOrDefault(self.maxIter),
            tol=self.getOrDefault(self.tol),
            regParam=float(self.getOrDefault(self.alpha) * deviation / row["total"]),
            elasticNetParam=0.0,
            standardization=False,
        )
        if weight:
            regression.setWeightCol(weight)
        sign = SQLTransformer(statement="SELECT *, CASE WHEN margin > 0 THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__")
        return PipelineModel([regression.fit(signed), sign])


class _NeighbourParams(HasFeaturesCol, HasLabelCol):
    k: Param[int] = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    p: Param[int] = Param(Params._dummy(), "p", "1 city block, 2 Euclidean", TypeConverters.toInt)
    votes: Param[str] = Param(Params._dummy(), "votes", "uniform or distance", TypeConverters.toString)
    keyCol: Param[str] = Param(Params._dummy(), "keyCol", "unique row key", TypeConverters.toString)


class NeighbourClassifier(Estimator, _NeighbourParams, DefaultParamsReadable, DefaultParamsWritable):
    """k nearest neighbours. Fitting only keeps the training points."""

    @keyword_only
    def __init__(self, *, k=5, p=2, votes="uniform", keyCol=KEY, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(k=5, p=2, votes="uniform", keyCol=KEY)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "NeighbourModel":
        model = self._copyValues(NeighbourModel())
        model.frames = {
            "train": dataset.select(
                F.col(self.getOrDefault(self.keyCol)).alias("train_key"),
                vector_to_array(self.getFeaturesCol()).alias("point"),
                F.col(self.getLabelCol()).alias("label"),
            )
        }
        return model


class NeighbourModel(FrameModel, _NeighbourParams):
    FRAMES = ("train",)

    def __init__(self) -> None:
        super().__init__()

    def _near(self, dataset: DataFrame, k: int) -> DataFrame:
        """The k nearest training rows of every row with a key."""
        key = self.getOrDefault(self.keyCol)
        asked = dataset.where(F.col(key).isNotNull()).select(F.col(key).alias("query_key"), vector_to_array(self.getFeaturesCol()).alias("point"))
        return neighbour_join(asked, self.frames["train"], "query_key", "train_key", "point", k, self.getOrDefault(self.p))

    def _votes(self, near: DataFrame, votes: str) -> DataFrame:
        return neighbour_vote(near, self.frames["train"], "query_key", "train_key", "label", votes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Keys must be unique. Rows without a key stay, without a score."""
        key = self.getOrDefault(self.keyCol)
        votes = self._votes(self._near(dataset, self.getOrDefault(self.k)), self.getOrDefault(self.votes))
        share = F.col("score")
        said = votes.select(
            F.col("query_key").alias(key),
            array_to_vector(F.array(1 - share, share)).alias("probability"),
            F.col("pred").cast("double").alias("prediction"),
        )
        return dataset.join(said, key, "left")

    def vote_scores(self, dataset: DataFrame, ballots: Sequence[tuple[int, str]], columns: Sequence[str]) -> DataFrame:
        """``columns..., at, score, pred``: one row for each row and each (k, votes) of
        ``ballots``, from one search for the neighbours."""
        key = self.getOrDefault(self.keyCol)
        near = keep(self._near(dataset, max(k for k, _ in ballots)))
        said = [self._votes(near.where(F.col("place") <= k), votes).withColumn("at", F.lit(i)) for i, (k, votes) in enumerate(ballots)]
        every = said[0]
        for other in said[1:]:
            every = every.unionByName(other)
        return dataset.select(F.col(key).alias("query_key"), *columns).join(every, "query_key").select(*columns, "at", "score", "pred")


class _FourierParams(HasFeaturesCol):
    dims: Param[int] = Param(Params._dummy(), "dims", "random features", TypeConverters.toInt)
    seed: Param[int] = Param(Params._dummy(), "seed", "draw of the directions", TypeConverters.toInt)
    inputs: Param[int] = Param(Params._dummy(), "inputs", "input features", TypeConverters.toInt)
    gamma: Param[float] = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)


def kernel_width(dataset: DataFrame, features: str, width: str) -> tuple[float, int]:
    """gamma of the Gaussian kernel and the number of inputs: ``scale``, 1 / (features x
    variance of all entries), ``auto``, 1 / features, or a number."""
    stats = Summarizer.metrics("mean", "normL2", "count")
    row = dataset.agg(stats.summary(F.col(features)).alias("s")).first()["s"]
    mean = np.array(row["mean"].toArray())
    squares = np.array(row["normL2"].toArray()) ** 2 / row["count"]
    variance = squares.mean() - mean.mean() ** 2
    if width == "scale":
        return (float(1.0 / (len(mean) * variance)) if variance > 0 else 1.0), len(mean)
    return (1.0 / len(mean) if width == "auto" else float(width)), len(mean)


def _in_slices(points: pd.Series, width: int, project: Callable[[np.ndarray], np.ndarray]) -> pd.Series:
    """The projected points, as arrays and not as lists of Python numbers; what lies between
    input and result holds PROJECTED_CELLS numbers at a time."""
    step, out = max(1, PROJECTED_CELLS // max(1, width)), []
    for i in range(0, len(points), step):
        out.extend(project(np.array(points[i : i + step].tolist(), dtype=float)))
    return pd.Series(out, dtype=object)


class FourierFeatures(Estimator, _FourierParams, DefaultParamsReadable, DefaultParamsWritable):
    """Random features whose inner product approximates the Gaussian kernel.

    Rahimi & Recht, "Random features for large-scale kernel machines", 2007. The
    kernel width ``width`` is ``scale``, 1 / (features x variance of all entries),
    ``auto``, 1 / features, or a number.
    """

    width: Param[str] = Param(Params._dummy(), "width", "scale, auto or a number", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, dims=128, seed=42, width="scale", featuresCol="features"):
        super().__init__()
        self._setDefault(dims=128, seed=42, width="scale")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "FourierFeaturesModel":
        gamma, inputs = kernel_width(dataset, self.getFeaturesCol(), self.getOrDefault(self.width))
        return self._copyValues(FourierFeaturesModel())._set(gamma=gamma, inputs=inputs)


class FourierFeaturesModel(Model, _FourierParams, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self) -> None:
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        dims, inputs = self.getOrDefault(self.dims), self.getOrDefault(self.inputs)
        draws = np.random.default_rng(self.getOrDefault(self.seed))
        directions = draws.normal(scale=np.sqrt(2 * self.getOrDefault(self.gamma)), size=(inputs, dims))
        phases = draws.uniform(0, 2 * np.pi, size=dims)

        @F.pandas_udf("array<double>")
        def project(points: pd.Series) -> pd.Series:
            return _in_slices(points, dims, lambda x: np.cos(x @ directions + phases) * np.sqrt(2.0 / dims))

        # the package first: a function takes along what has been sent when it is called
        table = on_executors(dataset)
        return table.withColumn("fourier", array_to_vector(project(vector_to_array(self.getFeaturesCol()))))


class _LandmarkParams(HasFeaturesCol):
    dims: Param[int] = Param(Params._dummy(), "dims", "landmarks", TypeConverters.toInt)
    seed: Param[int] = Param(Params._dummy(), "seed", "choice of the landmarks", TypeConverters.toInt)
    gamma: Param[float] = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    keyCol: Param[str] = Param(Params._dummy(), "keyCol", "unique row key", TypeConverters.toString)
    points: Param[list] = Param(Params._dummy(), "points", "the landmarks, row by row")
    root: Param[list] = Param(Params._dummy(), "root", "inverse root of the landmarks' kernel, row by row")


class LandmarkFeatures(Estimator, _LandmarkParams, DefaultParamsReadable, DefaultParamsWritable):
    """Features whose inner product approximates the Gaussian kernel by that of landmarks.

    Williams & Seeger, "Using the Nyström method to speed up kernel machines", 2000. The
    landmarks are the first ``dims`` different points in hash order of the key, a distributed
    top-n; with K their kernel, a row x becomes k(x, landmarks) K^(-1/2). The driver and
    every task hold dims x (features + dims) numbers. Rows without a key come first in the
    order; fewer different points than ``dims`` make fewer features.
    """

    width: Param[str] = Param(Params._dummy(), "width", "scale, auto or a number", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, dims=128, seed=42, width="scale", keyCol=KEY, featuresCol="features"):
        super().__init__()
        self._setDefault(dims=128, seed=42, width="scale", keyCol=KEY)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "LandmarkFeaturesModel":
        gamma, _ = kernel_width(dataset, self.getFeaturesCol(), self.getOrDefault(self.width))
        point = vector_to_array(self.getFeaturesCol()).alias("point")
        first = dataset.select(point, F.col(self.getOrDefault(self.keyCol)).cast("string").alias("key")).groupBy("point").agg(F.min("key").alias("key"))
        rows = bounded_sample(first, "key", self.getOrDefault(self.dims), self.getOrDefault(self.seed)).collect()
        points = np.array([r["point"] for r in rows], float)
        values, vectors = np.linalg.eigh(gaussian_kernel(points, points, gamma))
        # directions that the landmarks hardly span carry rounding only
        real = values > 1e-10 * values.max()
        root = vectors[:, real] / np.sqrt(values[real])
        return self._copyValues(LandmarkFeaturesModel())._set(gamma=gamma, points=points.tolist(), root=root.tolist())


def gaussian_kernel(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.exp(-gamma * np.maximum(squares, 0))


class LandmarkFeaturesModel(Model, _LandmarkParams, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self) -> None:
        super().__init__()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        points, root = np.array(self.getOrDefault(self.points)), np.array(self.getOrDefault(self.root))
        gamma = self.getOrDefault(self.gamma)

        @F.pandas_udf("array<double>")
        def project(rows: pd.Series) -> pd.Series:
            return _in_slices(rows, len(points), lambda x: gaussian_kernel(x, points, gamma) @ root)

        return on_executors(dataset).withColumn("landmarks", array_to_vector(project(vector_to_array(self.getFeaturesCol()))))


def kernel_error(model: FourierFeaturesModel | LandmarkFeaturesModel, sample: DataFrame) -> float:
    """Root mean square of (inner product of the features - Gaussian kernel) over all pairs of
    a sample's rows, which the caller bounds."""
    made = model.transform(sample)
    name = "landmarks" if isinstance(model, LandmarkFeaturesModel) else "fourier"
    rows = made.select(vector_to_array(model.getFeaturesCol()).alias("x"), vector_to_array(name).alias("z")).collect()
    x, z = (np.array([r[c] for r in rows], float) for c in ("x", "z"))
    return float(np.sqrt(np.square(z @ z.T - gaussian_kernel(x, x, model.getOrDefault(model.gamma))).mean()))


class KernelSVC(Estimator, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Support vector classifier: linear, or Gaussian through ``approximation``, the
    random features ``fourier`` or ``landmarks`` (Nyström)."""

    C: Param[float] = Param(Params._dummy(), "C", "inverse penalty", TypeConverters.toFloat)
    kernel: Param[str] = Param(Params._dummy(), "kernel", "rbf or linear", TypeConverters.toString)
    weightCol: Param[str] = Param(Params._dummy(), "weightCol", "row weight, none when empty", TypeConverters.toString)
    maxIter: Param[int] = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    gamma: Param[str] = Param(Params._dummy(), "gamma", "kernel width: scale, auto or a number", TypeConverters.toString)
    dims: Param[int] = Param(Params._dummy(), "dims", "random features or landmarks", TypeConverters.toInt)
    approximation: Param[str] = Param(Params._dummy(), "approximation", "fourier or landmarks", TypeConverters.toString)
    tol: Param[float] = Param(Params._dummy(), "tol", "where the iterations stop", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, C=1.0, kernel="rbf", featuresCol="features", labelCol="label", weightCol="", maxIter=100, gamma="scale", dims=128, tol=1e-3, approximation="fourier"):
        super().__init__()
        self._setDefault(C=1.0, kernel="rbf", weightCol="", maxIter=100, gamma="scale", dims=128, tol=1e-3, approximation="fourier")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        kernel, weight = self.getOrDefault(self.kernel), self.getOrDefault(self.weightCol)
        if kernel not in ("rbf", "linear"):
            raise ValueError(f"unknown kernel {kernel!r}")
        head, features = [], self.getFeaturesCol()
        if kernel == "rbf":
            kinds = {"fourier": FourierFeatures, "landmarks": LandmarkFeatures}
            if (kind := self.getOrDefault(self.approximation)) not in kinds:
                raise ValueError(f"unknown approximation {kind!r}")
            waves = kinds[kind](featuresCol=features, dims=self.getOrDefault(self.dims), width=self.getOrDefault(self.gamma)).fit(dataset)
            dataset, features, head = waves.transform(dataset), kind, [waves]
        total = dataset.agg(F.sum(weight) if weight else F.count(F.lit(1))).first()[0]
        svc = LinearSVC(
            featuresCol=features,
            labelCol=self.getLabelCol(),
            regParam=1.0 / (self.getOrDefault(self.C) * total),
            standardization=False,
            maxIter=self.getOrDefault(self.maxIter),
            tol=self.getOrDefault(self.tol),
        )
        if weight:
            svc.setWeightCol(weight)
        return PipelineModel([*head, svc.fit(dataset)])
