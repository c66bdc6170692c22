"""Batch prediction with one saved model or an ensemble of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.operators.ensemble import ensemble, ensemble_details, normalize_weights, prediction_frame
from labelworks.operators.select import union_rows
from labelworks.plans.families import score_table
from labelworks.operators.keep import keep
from labelworks.sources.models import load_discovered, load_model, load_models
from labelworks.sources.tables import require_columns, submission, write_details, write_submission

KEY = "row_id"


def predict_batch(model: PipelineModel, table: DataFrame, key: str, target: str) -> DataFrame:
    """Key and 0/1 prediction of every row."""
    require_columns(table, [key])
    scored = score_table(model, table.withColumnRenamed(key, KEY), "model", [KEY])
    return submission(scored.withColumnRenamed(KEY, key), key, "pred", target)


def predict_file(spark: SparkSession, model_path: str, table: DataFrame, output: str, key: str, target: str) -> DataFrame:
    out = predict_batch(load_model(spark, model_path), table, key, target)
    write_submission(out, output, key, target, target)
    return out


def score_models(models: Mapping[str, PipelineModel], table: DataFrame, key: str) -> DataFrame:
    """Probability-like score and decision of each model, long."""
    require_columns(table, [key])
    rows = table.withColumnRenamed(key, KEY)
    return prediction_frame(union_rows(*[score_table(m, rows, name, [KEY]) for name, m in models.items()]))


def predict_ensemble(
    models: Mapping[str, PipelineModel],
    table: DataFrame,
    key: str,
    kind: str = "soft_vote",
    weights: Sequence[float] | None = None,
    at: float = 0.5,
) -> tuple[DataFrame, DataFrame]:
    """Votes per row, and the wide table of every model's part in them."""
    names, given = list(models), None
    if weights is not None and kind.startswith("weighted"):
        if len(weights) != len(names):
            raise ValueError(f"{len(names)} models, but weights for {len(weights)}")
        given = table.sparkSession.createDataFrame([(n, float(w)) for n, w in zip(names, weights)], "model string, weight double")
        given = normalize_weights(given, given)
    scored = keep(score_models(models, table, key))
    votes = ensemble(scored, kind, given, at, KEY)
    details = ensemble_details(scored, votes, names, KEY)
    return tuple(t.withColumnRenamed(KEY, key) for t in (votes, details))


def ensemble_files(
    spark: SparkSession,
    table: DataFrame,
    output: str,
    key: str,
    target: str,
    models_dir: str | None = None,
    model_paths: Sequence[str] | None = None,
    **options: Any,
) -> DataFrame:
    """Load or discover the models, vote, write the submission and the details."""
    require_columns(table, [key])
    models = load_models(spark, model_paths) if model_paths else load_discovered(spark, models_dir)
    votes, details = predict_ensemble(models, table, key, **options)
    write_submission(votes, output, key, "ensemble_pred", target)
    write_details(details, output)
    return votes.select(key, F.col("ensemble_pred").alias(target))
