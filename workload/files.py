"""Files written and read back: CSV, submissions, saved models, the run log."""

from __future__ import annotations

from uuid import uuid4

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelworks.operators import evaluate as L
from labelworks.operators import select as O
from labelworks.operators.keep import shared_folder
from labelworks.plans.classifiers import RidgeClassifier
from labelworks.plans.training import PipelineModel
from labelworks.sources import models as K
from labelworks.sources import tables as A
from labelworks.sources.runlog import RunLog
from workload.registry import query
from workload.scoring import COUNTS_SQL
from workload.tables import SCORES_SQL, WIDE_SQL, read, scores, six, wide


def _place(spark) -> str:
    return f"{shared_folder(spark)}/files/{uuid4().hex}"


ORDER_FIELDS = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType())])


@query("scan_csv", "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice FROM orders")
def scan_csv(spark, sf):
    """Orders written as CSV, with one status as an empty cell, and scanned back."""
    place, status = f"{_place(spark)}/orders.csv", F.col("o_orderstatus")
    A.write_csv(read(spark, sf, "orders").select("o_orderkey", F.when(status != "P", status).alias("o_orderstatus"), "o_totalprice"), place)
    return A.scan_csv(spark, place, ORDER_FIELDS)


TABLES = ("orders", "lineitem", "customer")


@query("require_inputs", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES))
def require_inputs(spark, sf):
    """Row counts of inputs that must all be there."""
    A.require_inputs(spark, [f"{sf}/{t}.parquet" for t in TABLES])
    counts = [read(spark, sf, t).agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n")) for t in TABLES]
    return counts[0].union(counts[1]).union(counts[2])


@query("require_columns", "SELECT o_orderkey, o_orderpriority FROM orders")
def require_columns(spark, sf):
    return A.require_columns(read(spark, sf, "orders"), ["o_orderkey", "o_orderpriority"]).select("o_orderkey", "o_orderpriority")


@query("write_submission", "SELECT o_orderkey, CASE WHEN o_totalprice >= 100000 THEN 1 ELSE 0 END AS large FROM orders")
def write_submission(spark, sf):
    place = f"{_place(spark)}/submission.csv"
    said = read(spark, sf, "orders").withColumn("pred", (F.col("o_totalprice") >= 100000).cast("double"))
    A.write_submission(said, place, "o_orderkey", "pred", "large")
    return A.scan_csv(spark, place, T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("large", T.IntegerType())]))


# The closed form of a ridge on one column.
RIDGE_SQL = f"""WITH {WIDE_SQL}, s AS (SELECT avg(value) AS mx, avg(2 * label - 1) AS my, count(*) AS n FROM wide),
b AS (SELECT sum((value - mx) * (2 * label - 1 - my)) / (sum((value - mx) * (value - mx)) + 1000000) AS slope FROM wide, s)
SELECT row_id, round(my + slope * (value - mx), 4) AS margin FROM wide, s, b"""


def _saved_ridge(spark, sf) -> str:
    table, stage = wide(spark, sf), VectorAssembler(inputCols=["value"], outputCol="features")
    model = RidgeClassifier(alpha=1000000.0).fit(stage.transform(table))
    return K.save_model(PipelineModel([stage, model]), _place(spark), "ridge")


@query("save_model", RIDGE_SQL)
def save_model(spark, sf):
    """Decision values of a model found through the catalogue it was saved with."""
    path = _saved_ridge(spark, sf)
    found = K.catalogue(spark, path.rsplit("/", 1)[0]).where("model = 'ridge_final'").first()["model_path"]
    return K.load_model(spark, found).transform(wide(spark, sf)).select("row_id", F.round("margin", 4).alias("margin"))


@query("load_models", RIDGE_SQL.replace("SELECT row_id,", "SELECT 'ridge_final' AS model, row_id,"))
def load_models(spark, sf):
    loaded = K.load_models(spark, [_saved_ridge(spark, sf)])
    parts = [m.transform(wide(spark, sf)).select(F.lit(n).alias("model"), "row_id", F.round("margin", 4).alias("margin")) for n, m in loaded.items()]
    return parts[0]


def _log(spark, **settings) -> RunLog:
    return RunLog.start_run(spark, _place(spark), "run", {"m1": {"at": 0.5}, "m2": {"at": 0.5, "scale": 25}}, **settings)


@query(
    "log_metrics",
    f"""WITH {SCORES_SQL}, {COUNTS_SQL}
SELECT concat('holdout/', model, '/accuracy') AS key, round((tp + tn) / n, 6) AS value FROM counts UNION ALL
SELECT concat('holdout/', model, '/f1'), round(2 * tp / (2 * tp + fp + fn), 6) FROM counts""",
)
def log_metrics(spark, sf):
    log = _log(spark)
    for row in L.score_metrics(scores(spark, sf)).collect():
        log.log_metrics(f"holdout/{row['model']}", {"f1": row["f1"], "accuracy": row["accuracy"], "absent": None})
    return spark.read.parquet(f"{log.root}/metrics").select("key", six("value"))


@query(
    "log_table",
    f"""WITH {SCORES_SQL}, {COUNTS_SQL}, cells AS (SELECT model, 0 AS label, 0 AS pred, tn AS n FROM counts UNION ALL SELECT model, 0, 1, fp FROM counts UNION ALL
SELECT model, 1, 0, fn FROM counts UNION ALL SELECT model, 1, 1, tp FROM counts)
SELECT 'holdout/confusion_matrix' AS key, 'confusion' AS chart, model, label, pred, n FROM cells""",
)
def log_table(spark, sf):
    """A logged table beside the entry of the chart it stands for."""
    log = _log(spark)
    log.log_tables("holdout", {"confusion": L.confusion_matrix(scores(spark, sf)), "nodes": None})
    chart = spark.read.parquet(f"{log.root}/charts").where("key LIKE 'holdout/%'").select(F.struct("key", "chart").alias("c")).scalar()
    table = spark.read.parquet(log.table_path("holdout/confusion_matrix"))
    return table.withColumn("_c", chart).select("_c.key", "_c.chart", "model", "label", "pred", "n")


@query(
    "start_run",
    """SELECT 'run' AS run_id, state, CASE WHEN state = 'started' THEN (SELECT count(*) FROM events) END AS n_rows,
  CASE WHEN state = 'started' THEN 'm2' END AS last_model FROM (VALUES ('started'), ('finished')) t(state)""",
)
def start_run(spark, sf):
    """Opening and closing entry of a run; a secret among its settings is not kept."""
    log = _log(spark, n_rows=read(spark, sf, "events").count(), api_key="hidden")
    log.finish_run()
    runs = spark.read.parquet(f"{log.root}/runs").where(~F.col("config").contains("hidden"))
    said = lambda path: F.get_json_object("config", path)
    return runs.select("run_id", "state", said("$.n_rows").cast("long").alias("n_rows"), said("$.models[1]").alias("last_model"))


@query("register_model", "SELECT 'ridge' AS name, 'model' AS type, 'latest,best' AS aliases, (SELECT count(*) FROM events) AS n_rows")
def register_model(spark, sf):
    log = _log(spark)
    log.register_model(_saved_ridge(spark, sf), "ridge", {"n_rows": read(spark, sf, "events").count()}, ["latest", "best"])
    log.register_model(f"{log.root}/absent", "absent")
    rows = spark.read.parquet(f"{log.root}/artifacts")
    return rows.select("name", "type", F.array_join("aliases", ",").alias("aliases"), F.get_json_object("metadata", "$.n_rows").cast("long").alias("n_rows"))


@query(
    "select_by_type",
    "SELECT unnest(['o_orderkey', 'o_custkey', 'o_totalprice']) AS column, 'number' AS kind, (SELECT count(*) FROM orders) AS n UNION ALL SELECT unnest(['o_orderstatus', 'o_orderpriority']), 'text', (SELECT count(*) FROM orders)",
)
def select_by_type(spark, sf) -> DataFrame:
    """Names of the columns of each kind, with the rows they were found over."""
    orders = read(spark, sf, "orders")
    numbers, texts = O.select_by_type(orders)
    kinds = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind")) for k, names in (("number", numbers), ("text", texts)) for c in names]
    return orders.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(*kinds)).alias("_k"), "n").select("_k.*", "n")
