"""Boosted trees that are grown in one task: Spark's own trees, order, large tables, saving."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from labelworks.plans import trees as T
from labelworks.plans.boosting import BoostedModel, BoostedTrees
from labelworks.plans.families import FAMILIES, fit_family
from tests.test_models import numeric_table


def margins(model, df):
    return {r.row_id: r.m for r in model.transform(df).select("row_id", vector_to_array("rawPrediction")[1].alias("m")).collect()}


@pytest.mark.parametrize("weighted", [False, True])
def test_without_draws_the_model_is_that_of_spark(spark, weighted):
    df, _, _ = numeric_table(spark, 300, 3, seed=4)
    df = df.withColumn("few", F.col("row_id") % 3).withColumn("hot", (F.col("row_id") % 5 == 0).cast("int")).withColumn("w", 1.0 + F.col("row_id") % 2)
    df = VectorAssembler(inputCols=["features", "few", "hot"], outputCol="all").transform(df).drop("features").withColumnRenamed("all", "features")
    sizes = {"maxIter": 5, "stepSize": 0.3, "maxDepth": 4, "minInstancesPerNode": 3, "maxBins": 16, "seed": 1}
    theirs = GBTClassifier(**sizes, **({"weightCol": "w"} if weighted else {})).fit(df)
    mine = BoostedTrees(**sizes, weightCol="w" if weighted else "").fit(df)
    want, got = margins(theirs, df), margins(mine, df)
    assert len(got) == 300 and max(abs(got[k] - want[k]) for k in want) < 1e-9
    np.testing.assert_allclose(mine.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)


def test_the_order_of_the_rows_does_not_matter(spark):
    df, _, _ = numeric_table(spark, 300, 3, seed=5)
    fit = BoostedTrees(maxIter=4, maxDepth=3, featureShare=0.6, subsamplingRate=0.7)
    assert margins(fit.fit(df.repartition(5)), df) == margins(fit.fit(df.coalesce(1)), df)


def test_more_rows_than_a_task_may_hold_are_fitted_by_all(spark):
    df, _, _ = numeric_table(spark, 120, 3, seed=5)
    kinds = [type(BoostedTrees(maxIter=2, maxDepth=2, rowsPerTask=n).fit(df)) for n in (119, 120)]
    assert kinds == [GBTClassificationModel, BoostedModel]


def test_a_fit_starts_few_jobs_whatever_the_rounds(spark):
    df, _, _ = numeric_table(spark, 200, 3, seed=6)
    context = spark.sparkContext
    df.count()  # the table is kept from here on

    def jobs(rounds):
        context.setJobGroup(f"boosting-{rounds}", "")
        fit_family(FAMILIES["boosted_trees"], {"n_estimators": rounds}, df, 200)
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(f"boosting-{rounds}"))

    assert 0 < jobs(40) == jobs(4) < 10


def test_repeated_and_missing_keys_and_odd_labels(spark):
    df, _, y = numeric_table(spark, 200, 3, seed=7)
    same = df.withColumn("row_id", F.lit(None).cast("int"))
    model = BoostedTrees(maxIter=5, subsamplingRate=0.5).fit(same)
    right = model.transform(df).where(F.col("prediction") == F.col("label")).count()
    assert right > 160 and len(y) == 200
    for wrong in (df.withColumn("label", F.lit(2)), df.withColumn("label", F.when(F.col("row_id") > 3, F.col("label"))), df.where("row_id < 0")):
        with pytest.raises(ValueError, match="label 0 or 1"):
            BoostedTrees().fit(wrong)
    flat = BoostedTrees(maxIter=2).fit(df.withColumn("label", F.lit(1)))
    assert {len(t.left) for t in T.trees_of(spark, flat).trees} == {1} and flat.transform(df).where("prediction = 1").count() == 200


def test_a_saved_model_is_the_model(spark, tmp_path):
    df, _, _ = numeric_table(spark, 150, 3, seed=8)
    model = fit_family(FAMILIES["boosted_trees"], {"n_estimators": 3}, df, 150)
    PipelineModel([model]).write().save(f"{tmp_path}/m")
    back = PipelineModel.load(f"{tmp_path}/m").stages[0]
    assert margins(back, df) == margins(model, df) and back.treeWeights == model.treeWeights == [1.0, 0.05, 0.05]
    model.write().save(f"{tmp_path}/n")
    nodes = T.node_table(spark, f"{tmp_path}/n", 3).collect()
    assert len(nodes) == sum(len(t.left) for t in T.trees_of(spark, model).trees) and {r.tree for r in nodes} == {0, 1, 2}
