"""A bounded fitting sample keeps class shares by weight."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelworks.operators.split import fitting_sample
from labelworks.plans import training as M
from labelworks.plans.families import FAMILIES, FIT_WEIGHT, balanced_weights, fit_family
from labelworks.plans.ridge import ridge_path
from tests.test_models import numeric_table


def sizes(df):
    return {r.label: (r.n, r.w) for r in df.groupBy("label").agg(F.count("*").alias("n"), F.sum(FIT_WEIGHT).alias("w")).collect()}


def test_size_and_shares(spark):
    df = spark.range(20000).select(F.col("id").alias("row_id"), F.when(F.col("id") % 100 == 0, 1).when(F.col("id") % 101 == 0, None).otherwise(0).alias("label"), F.lit("x").alias("_n0"))
    whole = {r.label: r.n for r in df.where("label is not null").groupBy("label").agg(F.count("*").alias("n")).collect()}
    got = sizes(fitting_sample(df, "label", "row_id", 1000))
    assert sum(n for n, _ in got.values()) in (999, 1000) and got[1][0] == 200
    assert all(got[c][1] == pytest.approx(whole[c]) for c in whole)
    again = fitting_sample(df.repartition(7), "label", "row_id", 1000).orderBy("row_id").collect()
    assert again == fitting_sample(df, "label", "row_id", 1000).orderBy("row_id").collect()
    small = fitting_sample(df, "label", "row_id", 50000)
    assert sizes(small) == {c: (n, float(n)) for c, n in whole.items()}
    # a larger sample holds the smaller one of each class: rows come in one order
    rows = [{r.row_id for r in fitting_sample(df.where("label = 0"), "label", "row_id", n).collect()} for n in (100, 300)]
    assert rows[0] < rows[1] and len(rows[0]) == 100
    assert fitting_sample(df.limit(0), "label", "row_id", 10).count() == 0


def test_fits_on_a_sample_weigh_their_rows(spark):
    """Rows drawn alike many times over: the sample's fit is that of all rows."""
    df, x, y = numeric_table(spark, 200, 3, seed=4)
    n = len(y)
    weighted = df.withColumn(FIT_WEIGHT, F.when(F.col("label") == 1, 3.0).otherwise(2.0))
    copies = df.withColumn("c", F.explode(F.when(F.col("label") == 1, F.array(*map(F.lit, range(3)))).otherwise(F.array(*map(F.lit, range(2))))))
    copies = copies.withColumn("row_id", F.col("row_id") * 10 + F.col("c")).drop("c")
    total = copies.count()
    for params in ({}, {"class_weight": "balanced"}):
        for name in ("logistic_regression", "ridge_classifier"):
            fits = [fit_family(FAMILIES[name], params, t, total) for t in (weighted, copies)]
            got, want = (m.coefficients.toArray() if name != "ridge_classifier" else m.stages[0].coefficients.toArray() for m in fits)
            np.testing.assert_allclose(got, want, atol=1e-5)
        settings = [{"alpha": 1.0, **params}]
        (one,), (other,) = ridge_path([weighted, copies], settings)
        np.testing.assert_allclose(one[1], other[1], atol=1e-9)
    shares = balanced_weights(weighted, "label", "w", FIT_WEIGHT).groupBy("label").agg(F.sum("w").alias("w")).collect()
    assert shares[0].w == pytest.approx(shares[1].w) and shares[0].w == pytest.approx(total / 2)


def test_every_family_fits_on_a_sample(spark):
    table = numeric_table(spark, 240, 3, seed=5)[0].drop("features")
    split = M.prepare(table.where("row_id % 4 <> 0"), table.where("row_id % 4 = 0"), fit_rows=60)
    assert split.n == 180 and split.train.count() <= 60 and FIT_WEIGHT in split.train.columns
    small = {"random_forest": {"n_estimators": 3}, "extra_trees": {"n_estimators": 3}, "boosted_trees": {"n_estimators": 2}}
    for name, family in FAMILIES.items():
        model = fit_family(family, small.get(name, {}), split.train, split.n)
        assert M.predictions({name: model}, split.valid).count() == 60
    nodes = max(t.numNodes for t in fit_family(FAMILIES["random_forest"], {"n_estimators": 3}, split.train, split.n).trees)
    assert nodes < 2 * 60
