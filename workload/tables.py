"""Input tables of the queries, and the SQL that derives the same ones.

Spark functions and SQL snippets stand side by side. Each reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.operators.select import stack_scores

MODELS = ("m1", "m2", "m3")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def six(c: str) -> Column:
    """Six places, the precision the results are compared at."""
    return F.round(F.col(c), 6).alias(c)


# Customers as people with titles: a name, a value that is missing for some, a
# code that is empty or missing for some.
PEOPLE_SQL = """people AS (
  SELECT c_custkey, c_nationkey, c_mktsegment,
         concat(c_mktsegment, ', ', n_name, '. ', c_name) AS full_name,
         CASE WHEN c_acctbal < 0 OR n_name = 'NATION_3' THEN NULL ELSE c_acctbal END AS balance,
         CASE WHEN c_nationkey = 7 THEN '' WHEN c_nationkey > 20 THEN NULL ELSE concat(c_mktsegment, c_nationkey) END AS code
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    lost = (F.col("c_acctbal") < 0) | (F.col("n_name") == "NATION_3")
    code = F.concat("c_mktsegment", F.col("c_nationkey").cast("string"))
    return joined.select(
        "c_custkey",
        "c_nationkey",
        "c_mktsegment",
        F.concat("c_mktsegment", F.lit(", "), "n_name", F.lit(". "), "c_name").alias("full_name"),
        F.when(~lost, F.col("c_acctbal")).alias("balance"),
        F.when(F.col("c_nationkey") == 7, "").when(F.col("c_nationkey") <= 20, code).alias("code"),
    )


TITLE_SQL = "trim(split_part(split_part(full_name, ',', 2), '.', 1))"

# Events as a labelled table with three models: two give probabilities, one a margin.
WIDE_SQL = """wide AS (
  SELECT event_id AS row_id, user_id, value,
         CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label,
         value / (1 + value) AS m1,
         1 / (1 + exp(-(value - 50) / 25)) AS m2,
         (value - 50) / 25 AS m3
  FROM events)"""
LONG_SQL = (
    WIDE_SQL
    + """, raw_scores AS (
  SELECT row_id, label, 'm1' AS model, m1 AS score FROM wide UNION ALL
  SELECT row_id, label, 'm2', m2 FROM wide UNION ALL
  SELECT row_id, label, 'm3', m3 FROM wide)"""
)
SCORES_SQL = (
    LONG_SQL
    + """, kinds AS (SELECT model, bool_and(score BETWEEN 0 AND 1) AS inside FROM raw_scores GROUP BY model),
likely AS (
  SELECT row_id, label, model,
         CASE WHEN inside THEN score ELSE 1 / (1 + exp(-greatest(-50, least(50, score)))) END AS score
  FROM raw_scores JOIN kinds USING (model)),
scores AS (SELECT *, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS pred FROM likely)"""
)


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"),
        "user_id",
        "value",
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"),
        (v / (1 + v)).alias("m1"),
        (1 / (1 + F.exp(-(v - 50) / 25))).alias("m2"),
        ((v - 50) / 25).alias("m3"),
    )


def raw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = wide(spark, sf_dir).select("row_id", "label", *MODELS)
    return stack_scores(table, ["row_id", "label"], MODELS)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from labelworks.operators.ensemble import prediction_frame

    return prediction_frame(raw_scores(spark, sf_dir))


# Folds and holdout parts of the events, in md5 order within each class.
PARTS_SQL = """class_counts AS (SELECT label, count(*) AS n FROM wide GROUP BY label),
quota0 AS (
  SELECT label, n, n * train / total AS share, floor(n * train / total) AS base, train
  FROM class_counts, (SELECT sum(n) AS total, sum(n) - ceil(0.2 * sum(n)) AS train FROM class_counts)),
quota AS (
  SELECT label, n - base - CASE WHEN row_number() OVER (ORDER BY share - base DESC, label)
         <= train - sum(base) OVER () THEN 1 ELSE 0 END AS test_rows
  FROM quota0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(concat('42|', row_id)), row_id) AS class_rank FROM wide),
parts AS (
  SELECT ranked.*, CASE WHEN class_rank <= test_rows THEN 'test' ELSE 'train' END AS part
  FROM ranked JOIN quota USING (label))"""


def folds_sql(k: int) -> str:
    return f"""class_counts AS (SELECT label, count(*) AS n FROM wide GROUP BY label),
offsets AS (SELECT label, coalesce(sum(n) OVER (ORDER BY label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM class_counts),
folded AS (
  SELECT wide.*, CAST((row_number() OVER (PARTITION BY label ORDER BY md5(concat('42|', row_id)), row_id) - 1 + off) % {k} AS INTEGER) AS fold
  FROM wide JOIN offsets USING (label))"""
