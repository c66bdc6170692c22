"""Tables of out-of-fold and test scores, partitioned by split and model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.sources.tables import path_exists


def write_oof(scores: DataFrame, path: str) -> None:
    scores.write.mode("overwrite").partitionBy("split", "model").parquet(path)


def read_oof(spark: SparkSession, path: str, models: Sequence[str]) -> DataFrame:
    """Score table at ``path``; fails with the list of all absent score files."""
    wanted = [f"split={s}/model={m}" for m in models for s in ("oof", "test")]
    absent = [w for w in wanted if not path_exists(spark, f"{path}/{w}")]
    if absent:
        raise FileNotFoundError(f"missing score tables: {absent}; make them with make_oof and write_oof")
    return spark.read.parquet(path)


def scan_oof(scores: DataFrame, models: Sequence[str], split: str = "oof") -> DataFrame:
    """One row per ``row_id``, one score column per model; rows need every score.

    Both filters are on partition columns, so other splits and models are not read.
    """
    kept = scores.where((F.col("split") == split) & F.col("model").isin(list(models)))
    picks = [F.max(F.when(F.col("model") == m, F.col("score"))).alias(m) for m in models]
    return kept.groupBy("row_id").agg(*picks).dropna(subset=list(models))
