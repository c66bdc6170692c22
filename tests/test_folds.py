"""Preparation for all left-out folds at once equals a fit for each of them."""

import numpy as np
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from labelworks.operators.split import fold_train_rows, fold_valid_rows
from labelworks.plans import training as M
from labelworks.plans.folds import fit_without_each_fold, without_each_fold
from labelworks.plans.stages import TabularEncoder, TitleFeatures


def folded(passengers, k):
    table = passengers.withColumnsRenamed({"PassengerId": "row_id", "Survived": "label"}).withColumn("fold", (F.col("row_id") % k).cast("int"))
    only = F.when((F.col("fold") == 1) & (F.col("row_id") % 2 == 0), "rare").otherwise(F.when(F.col("row_id") % 5 == 0, None).otherwise("common"))
    lone = F.when(F.col("fold") == 0, F.col("Fare"))  # a column whose values are all in one fold
    return table.withColumns({"only": only, "lone": lone, "none": F.lit(None).cast("string")})


def vectors(df):
    return {r.row_id: np.array(r.features.toArray()) for r in df.collect()}


def test_encoded_folds_are_those_of_single_fits(passengers):
    k = 3
    table = M.keep(folded(passengers, k))
    made = M.prepare_folds(table, k, [TitleFeatures()])
    for fold, got in enumerate(made):
        want = M.prepare(fold_train_rows(table, fold), fold_valid_rows(table, fold), [TitleFeatures()])
        for a, b in ((got.train, want.train), (got.valid, want.valid)):
            mine, other = vectors(a), vectors(b)
            assert mine.keys() == other.keys() and all(np.allclose(mine[r], other[r], atol=1e-12) for r in mine)
            assert a.schema["features"].metadata == b.schema["features"].metadata
        assert got.n == want.n == got.train.count()


def test_each_fold_is_left_out_once(passengers):
    rows = without_each_fold(folded(passengers, 3), 3).groupBy("fold", "_left").count().collect()
    assert {(r.fold, r._left) for r in rows} == {(a, b) for a in range(3) for b in range(3) if a != b}


def test_other_stages_and_many_categories_are_fitted_by_fold(passengers):
    table = folded(passengers, 2)
    other = SQLTransformer(statement="SELECT *, Fare * 2 AS twice FROM __THIS__")
    assert fit_without_each_fold(table, 2, [other], TabularEncoder(excludeCols=M.NO_FEATURES)) is None
    narrow = TabularEncoder(excludeCols=M.NO_FEATURES, maxCategories=2, hashTo=4)
    assert fit_without_each_fold(table.select("row_id", "fold", "Cabin"), 2, [], narrow) is None
    made = M.prepare_folds(table.drop("Name", "Ticket", "Cabin"), 2, [other])
    assert len(made) == 2 and made[0].train.count() + made[1].train.count() == 180


def test_saved_encoders_read_back(passengers, tmp_path):
    table = folded(passengers, 2)
    model = fit_without_each_fold(table, 2, [TitleFeatures()], TabularEncoder(excludeCols=M.NO_FEATURES))[0]
    model.write().save(str(tmp_path / "m"))
    again = M.PipelineModel.load(str(tmp_path / "m"))
    mine, other = vectors(model.transform(table)), vectors(again.transform(table))
    assert all(np.array_equal(mine[r], other[r]) for r in mine)
