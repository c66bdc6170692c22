import pytest
from pyspark.sql import functions as F

from labelworks.operators import split as P
from labelworks.plans.families import FAMILIES, balanced_weights
from labelworks.plans.training import settings


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(891).select(F.col("id").alias("k"), (F.col("id") % 13 < 5).cast("int").alias("y")).persist()


def test_split_sizes_and_strata(table):
    parts = P.stratified_split(table, "y", "k").groupBy("part", "y").count().toPandas()
    assert parts[parts["part"] == "test"]["count"].sum() == 179  # ceil(0.2 * 891)
    for _, rows in parts.groupby("y"):
        share = rows[rows["part"] == "test"]["count"].sum() / rows["count"].sum()
        assert abs(share - 0.2) < 0.005


def test_folds_are_disjoint_complete_and_even(table):
    folded = P.stratified_kfold(table, "y", "k", 5).toPandas()
    assert sorted(folded["k"]) == list(range(891))
    assert folded.groupby("fold").size().agg(["min", "max"]).diff().iloc[-1] <= 1
    for _, rows in folded.groupby("y"):
        sizes = rows.groupby("fold").size()
        assert sizes.max() - sizes.min() <= 1
    again = P.stratified_kfold(table.repartition(7), "y", "k", 5).toPandas()
    assert dict(zip(folded["k"], folded["fold"])) == dict(zip(again["k"], again["fold"]))


def test_train_and_valid_rows_complement(table):
    folded = P.stratified_kfold(table, "y", "k", 3).persist()
    assert P.fold_train_rows(folded, 1).count() + P.fold_valid_rows(folded, 1).count() == 891


def test_hashed_folds_cover(table):
    assert {r[0] for r in P.hashed_kfold(table, "k", 4).select("fold").distinct().collect()} == {0, 1, 2, 3}


def test_sample_is_bounded(table):
    assert P.bounded_sample(table, "k", 200).count() == 200
    assert P.bounded_sample(table.limit(7), "k", 200).count() == 7


def test_shuffle_keeps_the_multiset(spark, table):
    out = P.shuffle_column(table.withColumn("v", F.col("k") * 2), "k", "v", 3).toPandas()
    for _, part in out.groupby("repeat"):
        assert sorted(part["v"]) == [2 * i for i in range(891)]
        assert (part["v"] != 2 * part["k"]).mean() > 0.9
        assert sorted(part["k"]) == list(range(891))


def test_grid_sizes(spark):
    sizes = {
        "random_forest": 432,
        "extra_trees": 432,
        "boosted_trees": 1296,
        "logistic_regression": 8,
        "ridge_classifier": 6,
        "knn": 16,
        "svc": 12,
        "linear_svc": 6,
        "decision_tree": 48,
    }
    assert {n: P.parameter_grid(spark, f.space).distinct().count() for n, f in FAMILIES.items()} == sizes


def test_settings_are_distinct_points(spark):
    forest = FAMILIES["random_forest"]
    drawn = settings(spark, forest.space, forest.draws)
    assert len(drawn) == 15 and len({str(s) for s in drawn}) == 15
    assert all(s[n] in forest.space[n] for s in drawn for n in s)
    assert settings(spark, {"a": [1, None]}, None) == [{"a": 1}, {"a": None}]


def test_balanced_weights_sum_to_rows(table):
    row = balanced_weights(table, "y").agg(F.sum("weight"), F.sum(F.col("weight") * F.col("y"))).first()
    assert row[0] == pytest.approx(891) and row[1] == pytest.approx(891 / 2)
