"""Exact tree values against all feature orders."""

from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelworks.plans import explain as X
from labelworks.plans import shapley as V
from labelworks.plans import trees as T
from labelworks.plans.families import FAMILIES, fit_family
from tests.test_models import numeric_table


def walked(trees, x):
    total = 0.0
    for tree, weight in zip(trees.trees, trees.weights):
        node = 0
        while tree.left[node] >= 0:
            node = tree.left[node] if x[tree.feature[node]] <= tree.threshold[node] else tree.right[node]
        total += weight * tree.value[node]
    return total if trees.boosted else total / len(trees.trees)


def by_orders(trees, x, others):
    """Mean over all feature orders and background rows of what each feature adds."""
    out, orders = np.zeros(len(x)), list(permutations(range(len(x))))
    for z in others:
        known = {}
        for order in orders:
            now, last = z.copy(), walked(trees, z)
            for f in order:
                now[f] = x[f]
                key = tuple(now)
                if key not in known:
                    known[key] = walked(trees, now)
                out[f] += known[key] - last
                last = known[key]
    return out / len(orders) / len(others)


@pytest.mark.parametrize(("name", "params"), [("random_forest", {"n_estimators": 3, "max_depth": 5}), ("boosted_trees", {"n_estimators": 4, "max_depth": 3}), ("decision_tree", {})])
def test_values_are_those_of_all_orders(spark, name, params):
    df, x, _ = numeric_table(spark, 150, 6, seed=9)
    model = fit_family(FAMILIES[name], params, df, 150)
    trees, names = T.trees_of(spark, model), [f"f{i}" for i in range(6)]
    rows, background = df.where("row_id < 4"), df.where("row_id >= 140")
    got = {}
    for r in V.tree_shapley(trees, rows, background, names, "row_id").collect():
        got.setdefault(r.row_id, {})[r.feature] = r.value
    assert len(got) == 4
    for row, values in got.items():
        want = by_orders(trees, x[row], x[140:])
        np.testing.assert_allclose([values[n] for n in names], want, atol=1e-12)
        mean = np.mean([walked(trees, z) for z in x[140:]])
        assert abs(sum(values.values()) - (walked(trees, x[row]) - mean)) < 1e-12


def test_summary_of_a_tree_is_exact(spark):
    df, _, _ = numeric_table(spark, 120, 3, seed=2)
    model = fit_family(FAMILIES["decision_tree"], {"max_depth": 3}, df, 120)
    names = ["a", "b", "c"]
    rows = X.shapley_summary("t", model, df, df, names, rows=50).collect()
    background = X.bounded_sample(df.select("row_id", "features"), "row_id", 50)
    values = V.tree_shapley(T.trees_of(spark, model), background, background, names, "row_id")
    want = {r.feature: r.m for r in values.groupBy("feature").agg(F.avg(F.abs("value")).alias("m")).collect()}
    assert {r.feature: pytest.approx(r.mean_abs_shap) for r in rows} == want


def test_a_background_has_a_bound(spark, monkeypatch):
    df, _, _ = numeric_table(spark, 60, 3, seed=2)
    trees = T.trees_of(spark, fit_family(FAMILIES["decision_tree"], {"max_depth": 2}, df, 60))
    monkeypatch.setattr(V, "MOST_BACKGROUND", 59)
    with pytest.raises(ValueError, match="sample"):
        V.tree_shapley(trees, df, df, ["a", "b", "c"], "row_id")
    assert V.tree_shapley(trees, df.limit(0), df.limit(5), ["a", "b", "c"], "row_id").count() == 0
