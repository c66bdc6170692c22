"""Run log kept as parquet: runs, scalar metrics, tables with chart axes, artifacts.

Every call appends; nothing is read back to write. Settings are logged as JSON text,
and never any credential.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.functions.scalar import to_json
from labelworks.operators.evaluate import auc_trapezoid, confusion_matrix, roc_auc, roc_curve
from labelworks.operators.keep import keep
from labelworks.operators.select import top_k
from labelworks.sources.tables import path_exists

TOP = 20
# The keys of the log below a stage, with the chart each table stands
# for: name -> (key, chart, x, y, order of the rows or measure of the top ones).
TABLES = {
    "params": ("config", "table", None, None, None),
    "folds": ("cv_folds", "line", "fold", "f1", "fold"),
    "confusion": ("confusion_matrix", "confusion", "label", "pred", None),
    "roc": ("roc_curve", "line", "fpr", "tpr", "fpr tpr"),
    "search": ("search_results_table", "table", None, None, "rank_test_score"),
    "ranking": ("search_ranking", "line", "rank_test_score", "mean_test_score", "rank_test_score"),
    "importance": ("feature_importance", "bar", "feature", "importance", "importance"),
    "permutation": ("permutation_importance", "bar", "feature", "importance_mean", "importance_mean"),
    "permutation_encoded": ("permutation_importance_transformed", "bar", "feature", "importance_mean", "importance_mean"),
    "shapley": ("shap", "bar", "feature", "mean_abs_shap", "mean_abs_shap"),
    "nodes": ("tree/nodes", "table", None, None, "node"),
    "summary": ("summary_table", "table", None, None, None),
    "by_holdout_f1": ("holdout_f1_bar", "bar", "model", "holdout_f1", None),
    "by_holdout_accuracy": ("holdout_accuracy_bar", "bar", "model", "holdout_accuracy", None),
    "by_cv_f1": ("cv_f1_mean_bar", "bar", "model", "cv_f1_mean", None),
    "by_search_f1": ("best_cv_f1_bar", "bar", "model", "best_cv_f1", None),
}
SECRET_WORDS = ("key", "token", "secret", "password")


def parameter_rows(spark: SparkSession, context: str, params: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """``context, model, parameter, value``: one row for each setting, by name, values as JSON text."""
    names = [(m, p) for m in params for p in sorted(params[m])]
    rows = [(context, m, p, to_json(params[m][p])) for m, p in names]
    return spark.createDataFrame(rows, "context string, model string, parameter string, value string")


def public_settings(settings: Mapping[str, Any]) -> dict[str, Any]:
    return {k: v for k, v in settings.items() if not any(w in k.lower() for w in SECRET_WORDS)}


class RunLog:
    def __init__(self, spark: SparkSession, root: str, run_id: str) -> None:
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id

    # --- runs ---

    @classmethod
    def start_run(cls, spark: SparkSession, root: str | None, run_id: str, models: Mapping[str, Mapping[str, Any]], **settings: Any) -> "RunLog | None":
        """Open a run with any settings and the settings of its models; None (and no
        logging) where no root is configured."""
        if not root:
            return None
        log = cls(spark, root, run_id)
        log.update_config({"models": list(models), **public_settings(settings)}, "started")
        log.log_tables("metadata", {"model_configs": parameter_rows(spark, "benchmark", models)})
        return log

    def update_config(self, config: Mapping[str, Any], state: str = "config") -> None:
        row = [(self.run_id, state, to_json(dict(config)))]
        out = self.spark.createDataFrame(row, "run_id string, state string, config string")
        out.withColumn("at", F.current_timestamp()).write.mode("append").parquet(f"{self.root}/runs")

    def finish_run(self) -> None:
        self.update_config({}, "finished")

    # --- scalars and tables ---

    def log_metrics(self, key: str, values: Mapping[str, float | None], step: int | None = None) -> None:
        """Append scalars under ``key/metric``; missing ones are skipped."""
        rows = [(self.run_id, f"{key}/{m}", float(v), step) for m, v in values.items() if v is not None]
        out = self.spark.createDataFrame(rows, "run_id string, key string, value double, step int")
        out.write.mode("append").partitionBy("run_id").parquet(f"{self.root}/metrics")

    def table_path(self, key: str) -> str:
        return f"{self.root}/tables/{key.replace('/', '.')}"

    def log_tables(self, stage: str, tables: Mapping[str, DataFrame | None]) -> None:
        """Append tables of a stage; absent ones are skipped.

        A name of :data:`TABLES` gets its key, order and chart from there; any other
        name is a plain table. The charts of one call are one file.
        """
        charts = []
        for name, table in tables.items():
            if table is None:
                continue
            suffix, chart, x, y, order = TABLES.get(name, (name, "table", None, None, None))
            key = f"{stage}/{suffix}"
            if chart == "bar" and order:
                table = top_k(table, order, x, TOP)
            elif order:
                table = table.orderBy(*order.split())
            table.withColumn("run_id", F.lit(self.run_id)).write.mode("append").partitionBy("run_id").parquet(self.table_path(key))
            charts.append((self.run_id, key, chart, x, y))
        if charts:
            out = self.spark.createDataFrame(charts, "run_id string, key string, chart string, x string, y string")
            out.write.mode("append").parquet(f"{self.root}/charts")

    def log_stage(
        self,
        stage: str,
        metrics: Mapping[str, Any] | None = None,
        params: tuple[str, Mapping[str, Any]] | None = None,
        held: DataFrame | None = None,
        **tables: DataFrame | None,
    ) -> None:
        """Everything a stage leaves behind: numbers, settings, what its predictions show, tables."""
        numbers = {m: v for m, v in (metrics or {}).items() if v is None or isinstance(v, (int, float))}
        if params is not None:
            tables["params"] = parameter_rows(self.spark, stage.split("/")[0], dict([params]))
        if held is not None:
            scored = keep(held.where(F.col("score").isNotNull()))
            tables |= {"confusion": confusion_matrix(held), "roc": roc_curve(scored)}
            areas = auc_trapezoid(scored).join(roc_auc(scored), "model").first()
            if areas is not None:
                numbers |= {"roc_auc": areas["auc"], "roc_auc_score": areas["roc_auc"]}
        if numbers:
            self.log_metrics(stage, numbers)
        self.log_tables(stage, tables)

    # --- artifacts ---

    def register_model(
        self, path: str, name: str, metadata: Mapping[str, Any] | None = None, aliases: Sequence[str] | None = None
    ) -> bool:
        """Record a saved model; nothing happens when the path is absent."""
        if not path_exists(self.spark, path):
            return False
        row = [(self.run_id, name, "model", path, to_json(dict(metadata or {})), list(aliases or ["latest"]))]
        schema = "run_id string, name string, type string, path string, metadata string, aliases array<string>"
        self.spark.createDataFrame(row, schema).write.mode("append").parquet(f"{self.root}/artifacts")
        return True
