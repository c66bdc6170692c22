"""What keeps time and memory of neighbours, forests and projections in proportion to the rows."""

import numpy as np
import pandas as pd
import pytest

from labelworks.operators import neighbours as D
from labelworks.plans import classifiers as C
from labelworks.plans import shapley as V
from labelworks.plans import trees as T
from labelworks.plans.families import FAMILIES, fit_family
from tests.test_models import numeric_table


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("cells", [False, True])
def test_closest_rows_without_all_differences(monkeypatch, p, cells):
    """Far from the origin, with copies, ties and missing numbers: the rows of the plain way, which is not gone."""
    rng = np.random.default_rng(8)
    t = np.round(rng.normal(size=(300, 4)), 1) + 1e4
    t[::3], t[7] = t[0], np.nan
    q = np.vstack([t[:5], np.round(rng.normal(size=(20, 4)), 1) + 1e4])
    # as in the join, copies of a point lie in one cell
    own, keys = np.nan_to_num(t[:, 0] * 10).astype(int) % 12, rng.permutation(len(t))
    lists = [np.array([0, 5]) if cells else np.arange(12) for _ in q]
    want = []
    for i, x in enumerate(q):
        gap = x - t
        d = np.round(np.abs(gap).sum(axis=1) if p == 1 else np.sqrt((gap * gap).sum(axis=1)), D.RANKED)
        some = np.flatnonzero(np.isin(own, lists[i]))
        want += [(i, keys[j], d[j]) for j in some[np.lexsort((keys[some], d[some]))[:6]]]
    monkeypatch.setattr(D, "_distances", None)
    asked = pd.DataFrame({"_qk": range(len(q)), "point": list(q), "_cells": lists})
    got = D.closest_rows(6, p)(asked, pd.DataFrame({"_tk": keys, "point": list(t), "_cell": own}))
    np.testing.assert_array_equal(got[["_qk", "_tk", "distance"]].to_numpy(float), np.array(want, float))


def test_near_cells_share_a_bin(monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ROWS", 100)
    bins = D._bins(np.arange(20.0)[:, None], np.array([30] * 19 + [250]))
    assert np.bincount(bins).tolist() == [3, 3, 3, 3, 3, 3, 1, 1]


def test_forests_keep_the_node_of_a_row(spark):
    for name in ("random_forest", "extra_trees"):
        assert FAMILIES[name].estimator({}, 10).getCacheNodeIds()


def test_node_table_is_no_list_of_rows(spark, monkeypatch):
    df, _, _ = numeric_table(spark, 80, 3, seed=4)
    model = fit_family(FAMILIES["random_forest"], {"n_estimators": 3}, df, 80)
    monkeypatch.setattr(type(df), "collect", None)
    trees = T.trees_of(spark, model)
    assert [len(t.left) for t in trees.trees] == [t.numNodes for t in model.trees]


def test_rows_go_down_a_tree_together(spark):
    df, x, _ = numeric_table(spark, 80, 4, seed=5)
    trees = T.trees_of(spark, fit_family(FAMILIES["decision_tree"], {"max_depth": 4}, df, 80))
    weights, tree = V._weights(4), trees.trees[0]
    together = V.pair_values(tree, x[:9], x[40:], weights)
    np.testing.assert_allclose(together, np.concatenate([V.pair_values(tree, x[i : i + 1], x[40:], weights) for i in range(9)]), atol=1e-12)


def test_projection_in_slices(monkeypatch):
    monkeypatch.setattr(C, "PROJECTED_CELLS", 20)
    sizes = []
    rows = pd.Series([np.array([float(i), 1.0]) for i in range(23)])
    out = C._in_slices(rows, 4, lambda x: sizes.append(len(x)) or x * 2)
    assert max(sizes) == 5 and isinstance(out[0], np.ndarray)
    np.testing.assert_array_equal(np.stack(list(out)), np.stack(list(rows)) * 2)
