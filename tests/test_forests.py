"""Forests that do not wrap their trees one by one, and node tables with categories."""

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler

from labelworks.plans import trees as T
from labelworks.plans.families import FAMILIES, fit_family


def _points(spark):
    rows = [(i, float(i % 3 == 0), float(i % 7), float(i % 2)) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, label double, a double, b double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


def test_a_fit_makes_no_python_object_of_a_tree(spark, monkeypatch, tmp_path):
    made = []
    plain = RandomForestClassificationModel.trees.func
    monkeypatch.setattr(RandomForestClassificationModel.trees, "func", lambda self: made.append(1) or plain(self))
    df = _points(spark)
    for name in ("random_forest", "extra_trees"):
        model = fit_family(FAMILIES[name], {"n_estimators": 4, "max_depth": 3}, df, 120)
        assert not made and model.getNumTrees == 4
        assert model.transform(df).count() == 120 and not made
        assert len(T.trees_of(spark, model).trees) == 4 and not made
        assert len(model.trees) == 4 and made
        made.clear()
    model.write().save(f"{tmp_path}/m")
    again = type(model).load(f"{tmp_path}/m")
    assert isinstance(again, RandomForestClassificationModel) and again.toDebugString.split("\n", 1)[1] == model.toDebugString.split("\n", 1)[1]


def test_rows_go_down_by_threshold_or_by_any_category():
    nodes = pa.table({
        "tree": [0, 0, 0, 1, 1, 1, 2], "left": [1, -1, -1, 1, -1, -1, -1], "right": [2, -1, -1, 2, -1, -1, -1],
        "feature": [0, None, None, 1, None, None, None], "threshold": [0.5, None, None, None, None, None, None],
        "left_categories": pa.array([None, None, None, [0.0, 3.0, 4.0], None, None, None], pa.list_(pa.float64())),
        "value": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7], "n_rows": [2, 1, 1, 2, 1, 1, 1], "gain": [1.0, 0, 0, 1.0, 0, 0, 0],
    })
    trees = T._trees(nodes, 3)
    x = np.array([[0.0, 0.0], [1.0, 1.0], [0.5, 3.0], [np.nan, 4.0], [9.0, np.nan]])
    assert [T._leaves(t.walk(), x).tolist() for t in trees] == [[1, 2, 1, 2, 2], [1, 2, 1, 1, 2], [0] * 5]
    assert [t.categories(0).tolist() for t in trees] == [[], [0.0, 3.0, 4.0], []]
