"""The model families: how each is built, its defaults and its search space."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelworks.functions.scalar import to_json
from labelworks.operators.keep import keep
from labelworks.plans.boosting import BoostedTrees
from labelworks.plans.classifiers import KernelSVC, NeighbourClassifier, NeighbourModel, RidgeClassifier
from labelworks.plans.forests import Forest
from labelworks.plans.trees import TREE_MODELS, nested_scores

SEED = 42
WEIGHT = "_class_weight"
#: Rows that a row of a fitting sample stands for.
FIT_WEIGHT = "fit_weight"
# Deepest tree Spark grows; stands in for "no limit".
DEEPEST = 30

Params = Mapping[str, Any]


@dataclass(frozen=True)
class Family:
    """``build(params, n, weight_column)`` makes the estimator for n training rows."""

    name: str
    build: Callable[[Params, int, str], Estimator]
    defaults: dict[str, Any]
    space: dict[str, list[Any]] = field(default_factory=dict)
    search: str = "grid"
    draws: int | None = None
    #: Settings of which a fit at the largest holds the smaller ones.
    nested: tuple[str, ...] = ()
    #: Another form of the settings, the same for all that give the same model.
    same: Callable[[Params], Params] = dict

    def estimator(self, params: Params, n: int, weight: str = "") -> Estimator:
        return self.build({**self.defaults, **params}, n, weight)


def balanced_weights(df: DataFrame, label: str, name: str = "weight", rows: str | None = None) -> DataFrame:
    """Weight n / (classes x rows of the class) on every row; where ``rows`` names how many
    rows a row stands for, they are counted so and the weight is that of all of them."""
    each = F.lit(1) if rows is None else F.col(rows)
    counts = df.groupBy(label).agg((F.count(each) if rows is None else F.sum(each)).alias("_n"))
    totals = counts.agg(F.struct(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    weights = counts.withColumn("_t", totals).select(label, (F.col("_t.n") / (F.col("_t.k") * F.col("_n"))).alias(name))
    weighted = df.join(keep(weights), label)
    return weighted if rows is None else weighted.withColumn(name, F.col(name) * F.col(rows))


def _leaf(p: Params) -> int:
    """Spark limits leaves only; a split of s rows leaves at least s // 2 on one side."""
    return max(p.get("min_samples_leaf", 1), p.get("min_samples_split", 2) // 2)


def _by_leaf(p: Params) -> Params:
    """Split and leaf sizes act through the leaf limit alone."""
    return {**p, "min_samples_leaf": _leaf(p), "min_samples_split": 2}


def _forest(bootstrap: bool) -> Callable[[Params, int, str], Estimator]:
    def build(p: Params, n: int, weight: str) -> Estimator:
        return _weighted(
            Forest(
                numTrees=p["n_estimators"],
                maxDepth=p["max_depth"] or DEEPEST,
                minInstancesPerNode=_leaf(p),
                featureSubsetStrategy=p["max_features"] or "all",
                maxBins=p["max_bins"],
                bootstrap=bootstrap,
                # a row's node in each tree is kept: deep trees are not walked from the root at every level
                cacheNodeIds=True,
                seed=SEED,
            ),
            weight,
        )

    return build


def _weighted(estimator: Any, weight: str) -> Any:
    return estimator.setWeightCol(weight) if weight else estimator


def _boosted(p: Params, n: int, weight: str) -> Estimator:
    return BoostedTrees(
        maxIter=p["n_estimators"],
        stepSize=p["learning_rate"],
        maxDepth=p["max_depth"],
        minInstancesPerNode=p["min_child_weight"],
        maxBins=p["max_bins"],
        subsamplingRate=p["subsample"],
        featureShare=p["colsample_bytree"],
        seed=SEED,
        weightCol=weight,
    )


def _logistic(p: Params, n: int, weight: str) -> Estimator:
    model = LogisticRegression(regParam=1.0 / (p["C"] * n), standardization=False, maxIter=p["max_iter"])
    return _weighted(model, weight)


def _linear_svc(p: Params, n: int, weight: str) -> Estimator:
    return _weighted(LinearSVC(regParam=1.0 / (p["C"] * n), standardization=False, tol=p["tol"], maxIter=p["max_iter"]), weight)


def _tree(p: Params, n: int, weight: str) -> Estimator:
    model = DecisionTreeClassifier(
        maxDepth=p["max_depth"] or DEEPEST, minInstancesPerNode=_leaf(p), minInfoGain=p["ccp_alpha"], maxBins=p["max_bins"], seed=SEED
    )
    return _weighted(model, weight)


# Defaults and search spaces every comparison is defined by.
FOREST_SPACE = {
    "n_estimators": [100, 200, 300, 500],
    "max_depth": [None, 5, 10, 20],
    "min_samples_split": [2, 5, 10],
    "min_samples_leaf": [1, 2, 4],
    "max_features": ["sqrt", "log2", None],
}
FOREST = {"max_depth": None, "min_samples_split": 2, "min_samples_leaf": 1, "max_features": "sqrt", "max_bins": 32}
BASELINE_SPACE = {"n_estimators": [100, 200, 300], "max_depth": [None, 10, 20], "min_samples_split": [2, 5, 10]}
BASELINE_DRAWS = 20
FAMILY_LIST = [
    Family("random_forest", _forest(True), {"n_estimators": 100, **FOREST}, FOREST_SPACE, "random", 15, ("n_estimators", "max_depth"), _by_leaf),
    Family("extra_trees", _forest(False), {"n_estimators": 200, **FOREST}, FOREST_SPACE, "random", 15, ("n_estimators", "max_depth"), _by_leaf),
    Family(
        "boosted_trees",
        _boosted,
        {
            "n_estimators": 200,
            "learning_rate": 0.05,
            "max_depth": 4,
            "min_child_weight": 1,
            "subsample": 0.8,
            "colsample_bytree": 0.8,
            "max_bins": 32,
        },
        {
            "n_estimators": [100, 200, 300, 500],
            "learning_rate": [0.01, 0.05, 0.1],
            "max_depth": [3, 4, 6, 8],
            "min_child_weight": [1, 3, 5],
            "subsample": [0.7, 0.8, 1.0],
            "colsample_bytree": [0.7, 0.8, 1.0],
        },
        "random",
        15,
        ("n_estimators",),
    ),
    Family(
        "logistic_regression",
        _logistic,
        {"C": 1.0, "max_iter": 2000, "class_weight": None},
        {"C": [0.01, 0.1, 1.0, 10.0], "class_weight": [None, "balanced"]},
    ),
    Family(
        "ridge_classifier",
        lambda p, n, weight: RidgeClassifier(alpha=p["alpha"], weightCol=weight),
        {"alpha": 1.0, "class_weight": None},
        {"alpha": [0.1, 1.0, 10.0], "class_weight": [None, "balanced"]},
    ),
    Family(
        "knn",
        lambda p, n, weight: NeighbourClassifier(k=p["n_neighbors"], p=p["p"], votes=p["weights"]),
        {"n_neighbors": 5, "weights": "uniform", "p": 2},
        {"n_neighbors": [3, 5, 7, 9], "weights": ["uniform", "distance"], "p": [1, 2]},
        nested=("n_neighbors", "weights"),
    ),
    Family(
        "svc",
        lambda p, n, weight: KernelSVC(C=p["C"], kernel=p["kernel"], gamma=str(p["gamma"]), dims=p["dims"], maxIter=p["max_iter"], tol=p["tol"], weightCol=weight, approximation=p["approximation"]),
        {"C": 1.0, "kernel": "rbf", "gamma": "scale", "dims": 128, "max_iter": 100, "tol": 1e-3, "class_weight": None, "approximation": "fourier"},
        {"C": [0.5, 1.0, 5.0], "kernel": ["linear", "rbf"], "gamma": ["scale"], "class_weight": [None, "balanced"]},
    ),
    Family(
        "linear_svc",
        _linear_svc,
        {"C": 1.0, "max_iter": 100, "tol": 1e-4, "class_weight": None},
        {"C": [0.1, 1.0, 10.0], "class_weight": [None, "balanced"]},
    ),
    Family(
        "decision_tree",
        _tree,
        {"max_depth": None, "min_samples_split": 2, "min_samples_leaf": 1, "ccp_alpha": 0.0, "max_bins": 32, "class_weight": None},
        {
            "max_depth": [None, 5, 10],
            "min_samples_split": [2, 5],
            "min_samples_leaf": [1, 2],
            "ccp_alpha": [0.0, 0.01],
            "class_weight": [None, "balanced"],
        },
        nested=("max_depth",),
        same=_by_leaf,
    ),
]
FAMILIES = {f.name: f for f in FAMILY_LIST}


@dataclass(frozen=True)
class Shared:
    """Settings that one fit serves: what to fit, and the points with their whole settings."""

    fit: Params
    points: list[int]
    settings: list[dict[str, Any]]


def shared_fits(family: Family, points: list[Params]) -> list[Shared]:
    """The points by the fit they share: equal but for nested settings, which take their
    largest value (None: no limit). Without nested settings every point is its own fit."""
    groups: dict[str, list[int]] = {}
    whole = [{**family.defaults, **p} for p in points]
    for i, p in enumerate(whole):
        form = {n: v for n, v in family.same(p).items() if n not in family.nested}
        groups.setdefault(to_json(form), []).append(i)
    out = []
    for at in groups.values():
        fit = dict(family.same(whole[at[0]]))
        for n in family.nested:
            values = [whole[i][n] for i in at]
            fit[n] = None if None in values else max(values)
        out.append(Shared(fit, at, [whole[i] for i in at]))
    return out


def shared_scores(family: Family, model: Model, encoded: DataFrame, settings: list[dict[str, Any]], keep: list[str]) -> DataFrame:
    """``keep..., at, score, pred`` of the models of all ``settings`` that ``model`` holds."""
    if isinstance(model, TREE_MODELS):
        sizes = [(p.get("n_estimators"), p["max_depth"] if "max_depth" in family.nested else None) for p in settings]
        return nested_scores(model, encoded, sizes, keep)
    if isinstance(model, NeighbourModel):
        return model.vote_scores(encoded, [(p["n_neighbors"], p["weights"]) for p in settings], keep)
    if len(settings) > 1:
        raise ValueError(f"one fit of {family.name} cannot serve {len(settings)} settings")
    return score_table(model, encoded, family.name, keep).withColumnRenamed("model", "at").withColumn("at", F.lit(0))


def fit_family(family: Family, params: Params, train: DataFrame, n: int) -> Model:
    """Fit on an encoded table (``features``, ``label``, ``row_id``) that stands for n rows;
    the rows of a sample count by their ``fit_weight``."""
    weight, sampled = "", FIT_WEIGHT in train.columns
    if {**family.defaults, **params}.get("class_weight") == "balanced":
        train, weight = balanced_weights(train, "label", WEIGHT, FIT_WEIGHT if sampled else None), WEIGHT
    elif sampled:
        weight = FIT_WEIGHT
    return family.estimator(params, n, weight).fit(train)


def score_column(predicted: DataFrame) -> Column:
    """Score of class 1: probability, else decision value, else missing."""
    columns = predicted.columns
    if "probability" in columns:
        return vector_to_array("probability")[1]
    if "rawPrediction" in columns:
        return vector_to_array("rawPrediction")[1]
    if "margin" in columns:
        return F.col("margin")
    return F.lit(None).cast("double")


def score_table(model: Model, encoded: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """``keep..., model, score, pred`` of one fitted model."""
    predicted = model.transform(encoded)
    return predicted.select(
        *keep, F.lit(name).alias("model"), score_column(predicted).alias("score"), F.col("prediction").cast("int").alias("pred")
    )


def last_stage(model: Model) -> Model:
    """The classifier inside (nested) pipelines."""
    while isinstance(model, PipelineModel):
        stages = [s for s in model.stages if hasattr(s, "featureImportances") or hasattr(s, "coefficients") or isinstance(s, PipelineModel)]
        if not stages:
            return model.stages[-1]
        model = stages[-1]
    return model
