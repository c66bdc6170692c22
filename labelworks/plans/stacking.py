"""Stacking and blending over a table of out-of-fold scores."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.operators.ensemble import weighted_blend
from labelworks.operators.evaluate import roc_auc
from labelworks.operators.select import label_join, union_rows
from labelworks.operators.split import fold_train_rows, fold_valid_rows, stratified_kfold
from labelworks.plans.families import FAMILIES, fit_family, score_table
from labelworks.operators.keep import keep
from labelworks.plans.training import FOLD, KEY, LABEL, run_all
from labelworks.sources.scores import read_oof, scan_oof
from labelworks.sources.tables import write_submission

META = "stacking"


@dataclass
class Stack:
    """Meta-model, its out-of-fold scores and the test scores."""

    model: Model
    oof: DataFrame
    test: DataFrame


def _meta(df: DataFrame, models: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(models), outputCol="features").transform(df)


def _labelled(scores: DataFrame, labels: DataFrame, models: Sequence[str]) -> DataFrame:
    return _meta(label_join(scan_oof(scores, models, "oof"), labels, KEY, LABEL), models).select(KEY, LABEL, "features")


def _fit(train: DataFrame, n: int) -> Model:
    return fit_family(FAMILIES["logistic_regression"], {"max_iter": 100}, train, n)


def stack_oof(scores: DataFrame, labels: DataFrame, models: Sequence[str], k: int = 5) -> DataFrame:
    """Out-of-fold scores of the meta-model: ``row_id, label, fold, model, score, pred``."""
    folded = keep(stratified_kfold(_labelled(scores, labels, models), LABEL, KEY, k))
    sizes = {r[FOLD]: r["n"] for r in folded.groupBy(FOLD).agg(F.count(F.lit(1)).alias("n")).collect()}  # k rows

    def one(fold: int) -> DataFrame:
        model = _fit(fold_train_rows(folded, fold), sum(sizes.values()) - sizes.get(fold, 0))
        return score_table(model, fold_valid_rows(folded, fold), META, [KEY, LABEL, FOLD])

    return union_rows(*run_all(scores.sparkSession, [lambda f=f: one(f) for f in range(k)]))


def stack_model(scores: DataFrame, labels: DataFrame, models: Sequence[str]) -> Model:
    """The logistic meta-model fitted on all labelled rows."""
    table = keep(_labelled(scores, labels, models))
    return _fit(table, table.count())


def stack_fit(scores: DataFrame, labels: DataFrame, models: Sequence[str], k: int = 5) -> Stack:
    """Logistic meta-model over the score columns, cross-validated, then fitted on all rows.

    ``scores`` is a table as made by ``make_oof``; ``labels`` has ``row_id, label``.
    """
    model = stack_model(scores, labels, models)
    return Stack(model, stack_oof(scores, labels, models, k), stack_predict(model, scores, models))


def stack_predict(model: Model, scores: DataFrame, models: Sequence[str]) -> DataFrame:
    """``row_id, score``: probability of class 1 for the test split."""
    return score_table(model, _meta(scan_oof(scores, models, "test"), models), META, [KEY]).select(KEY, "score")


def blend(
    scores: DataFrame, labels: DataFrame, models: Sequence[str], weights: Sequence[float] = (0.33, 0.33, 0.34)
) -> tuple[DataFrame, DataFrame]:
    """Weighted sum of the scores: AUC of the out-of-fold blend, and the test blend."""
    oof = weighted_blend(label_join(scan_oof(scores, models, "oof"), labels, KEY, LABEL), models, weights)
    test = weighted_blend(scan_oof(scores, models, "test"), models, weights)
    return roc_auc(oof.withColumn("model", F.lit("blend"))), test.select(KEY, "score")


def run_stacking(
    spark: SparkSession, scores_path: str, labels: DataFrame, models: Sequence[str], output: str, key: str, target: str, k: int = 5
) -> float | None:
    """Stack the saved scores, write the test probabilities, return the cross-validated AUC."""
    stack = stack_fit(read_oof(spark, scores_path, models), labels, models, k)
    write_submission(stack.test.withColumnRenamed(KEY, key), output, key, "score", target, as_int=False)
    return roc_auc(keep(stack.oof)).first()["roc_auc"]


def run_blend(
    spark: SparkSession,
    scores_path: str,
    labels: DataFrame,
    models: Sequence[str],
    output: str,
    key: str,
    target: str,
    weights: Sequence[float] = (0.33, 0.33, 0.34),
) -> float | None:
    """The same for the weighted sum of the scores."""
    area, test = blend(read_oof(spark, scores_path, models), labels, models, weights)
    write_submission(test.withColumnRenamed(KEY, key), output, key, "score", target, as_int=False)
    return area.first()["roc_auc"]
