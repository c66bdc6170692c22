"""Saved models and their catalogue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.sources.tables import path_exists, require_inputs

FAMILY_PATTERN = "^family_search_.*_final$"
BEST = "best_family_search_final"


def model_name(model_type: str, fold: int | None = None) -> str:
    return f"{model_type}_final" if fold is None else f"{model_type}_fold_{fold}"


def save_model(model: PipelineModel, models_dir: str, model_type: str = "random_forest", fold: int | None = None) -> str:
    """Write the fitted pipeline and add it to the catalogue; returns its path."""
    spark = SparkSession.getActiveSession()
    name = model_name(model_type, fold)
    path = f"{models_dir}/{name}"
    model.write().overwrite().save(path)
    row = spark.createDataFrame([(name, path)], "model string, model_path string").withColumn("saved_at", F.current_timestamp())
    row.write.mode("append").parquet(f"{models_dir}/catalogue")
    return path


def catalogue(spark: SparkSession, models_dir: str) -> DataFrame:
    """``model, model_path``: latest entry of each saved model."""
    require_inputs(spark, [f"{models_dir}/catalogue"])
    rows = spark.read.parquet(f"{models_dir}/catalogue")
    return rows.groupBy("model").agg(F.max_by("model_path", "saved_at").alias("model_path"))


def discover_models(models: DataFrame) -> DataFrame:
    """Family models in name order; the best model alone where there are none."""
    family = F.col("model").rlike(FAMILY_PATTERN)
    families = models.agg(F.count_if(family)).scalar()
    marked = models.withColumn("_families", families)
    chosen = marked.where(family | ((F.col("model") == BEST) & (F.col("_families") == 0)))
    return chosen.drop("_families").orderBy("model")


def load_model(spark: SparkSession, path: str) -> PipelineModel:
    if not path_exists(spark, path):
        raise FileNotFoundError(f"saved model not found: {path}")
    return PipelineModel.load(path)


def load_models(spark: SparkSession, paths: Sequence[str]) -> dict[str, PipelineModel]:
    """Load in order; the first absent path fails."""
    return {p.rstrip("/").rsplit("/", 1)[-1]: load_model(spark, p) for p in paths}


def load_discovered(spark: SparkSession, models_dir: str) -> dict[str, PipelineModel]:
    found = [r["model_path"] for r in discover_models(catalogue(spark, models_dir)).collect()]
    if not found:
        raise FileNotFoundError(f"no saved ensemble candidates in {models_dir}; train and save models first")
    return load_models(spark, found)
