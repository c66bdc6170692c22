"""Forests grown in tasks: Spark's own trees, draws by tree, order of rows, few jobs, saving, what Spark fits itself."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from labelworks.plans import trees as T
from labelworks.plans.explain import gain_shares
from labelworks.plans.families import FAMILIES, fit_family
from labelworks.plans.forests import Forest, ForestModel, GrownForest
from tests.test_models import numeric_table


def votes(model, df):
    return {r.row_id: r.s for r in model.transform(df).select("row_id", vector_to_array("probability")[1].alias("s")).collect()}


def mixed(spark, n=300, seed=4):
    df, _, _ = numeric_table(spark, n, 3, seed=seed)
    df = df.withColumn("few", F.col("row_id") % 3).withColumn("hot", (F.col("row_id") % 5 == 0).cast("int")).withColumn("w", 1.0 + F.col("row_id") % 2)
    return VectorAssembler(inputCols=["features", "few", "hot"], outputCol="all").transform(df).drop("features").withColumnRenamed("all", "features")


@pytest.mark.parametrize("weighted", [False, True])
def test_without_draws_a_tree_is_that_of_spark(spark, weighted):
    df = mixed(spark)
    sizes = {"numTrees": 2, "maxDepth": 6, "minInstancesPerNode": 3, "maxBins": 16, "seed": 1, "bootstrap": False, "featureSubsetStrategy": "all"}
    sizes |= {"weightCol": "w"} if weighted else {}
    theirs, mine = RandomForestClassifier(**sizes).fit(df), Forest(**sizes).fit(df)
    want, got = votes(theirs, df), votes(mine, df)
    assert isinstance(mine, GrownForest) and len(got) == 300 and max(abs(got[k] - want[k]) for k in want) < 1e-9
    assert mine.totalNumNodes == theirs.totalNumNodes
    np.testing.assert_allclose(mine.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-9)


def test_the_first_trees_are_the_forest_of_fewer_and_order_does_not_matter(spark):
    df = mixed(spark, seed=5)
    fits = [fit_family(FAMILIES["random_forest"], {"n_estimators": n}, rows, 300) for n, rows in ((9, df.repartition(5)), (4, df.coalesce(1)))]
    some = T.nested_scores(fits[0], df, [(4, None), (9, 2)], ["row_id"]).collect()
    want = votes(fits[1], df)
    assert max(abs(r.score - want[r.row_id]) for r in some if r["at"] == 0) < 1e-9 and len(some) == 600
    trees, x = T.trees_of(spark, fits[0]).trees, np.array([r.features.toArray() for r in df.orderBy("row_id").collect()])
    cut = np.mean([t.values_at(2)[T._leaves(t.walk(), x)] for t in trees], axis=0)
    got = {r.row_id: r.score for r in some if r["at"] == 1}
    np.testing.assert_allclose([got[k] for k in sorted(got)], cut, atol=1e-9)
    np.testing.assert_allclose(gain_shares(T.trees_of(spark, fits[0]), 5), fits[0].featureImportances.toArray(), atol=1e-9)


def test_a_fit_starts_few_jobs_whatever_the_trees_and_their_depth(spark):
    df, context = mixed(spark, 200, seed=6), spark.sparkContext
    df.count()

    def jobs(trees, depth):
        context.setJobGroup(f"forest-{trees}-{depth}", "")
        fit_family(FAMILIES["extra_trees"], {"n_estimators": trees, "max_depth": depth}, df, 200)
        context.setLocalProperty("spark.jobGroup.id", None)
        return len(context.statusTracker().getJobIdsForGroup(f"forest-{trees}-{depth}"))

    assert 0 < jobs(40, None) == jobs(2, 1) < 12


def test_a_saved_forest_is_read_by_spark(spark, tmp_path):
    df = mixed(spark, 150, seed=8)
    model = fit_family(FAMILIES["random_forest"], {"n_estimators": 3}, df, 150)
    model.write().save(f"{tmp_path}/m")
    back = RandomForestClassificationModel.load(f"{tmp_path}/m")
    want, got = votes(model, df), votes(back, df)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-12 and back.getNumTrees == model.getNumTrees == 3 and back.numFeatures == model.numFeatures == 5


def test_odd_rows(spark):
    df = mixed(spark, 200, seed=7)
    same = df.withColumn("row_id", F.lit(None).cast("int"))
    model = Forest(numTrees=8, seed=1).fit(same.unionByName(same))
    assert model.transform(same).where(F.col("prediction") == F.col("label")).count() > 160
    flat = Forest(numTrees=2).fit(df.withColumn("label", F.lit(1)))
    assert {len(t.left) for t in T.trees_of(spark, flat).trees} == {1} and flat.transform(df).where("prediction = 1").count() == 200
    three = Forest(numTrees=2, maxDepth=2).fit(df.withColumn("label", F.col("row_id") % 3))
    assert type(three) is ForestModel and three.numClasses == 3
