"""Searches: settings that share a fit, the ledger, ridge paths, node tables."""

from threading import Barrier

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from labelworks.operators.keep import keep
from labelworks.operators.moments import cross_products
from labelworks.plans import classifiers
from labelworks.plans import training as M
from labelworks.plans import trees as T
from labelworks.plans.classifiers import NeighbourClassifier
from labelworks.plans.explain import gain_shares
from labelworks.plans.families import FAMILIES, fit_family, score_table, shared_fits, shared_scores
from labelworks.plans.ridge import margins, ridge_path
from labelworks.sources.ledger import Ledger
from tests.test_models import numeric_table

SMALL = {"random_forest": {"n_estimators": 12, "max_depth": 6}, "boosted_trees": {"n_estimators": 6}, "decision_tree": {}}


@pytest.fixture(scope="module")
def points(spark):
    return numeric_table(spark, 240, 4, seed=3)[0]


def scores(frame, *columns):
    return {tuple(r[c] for c in columns): (r["score"], r["pred"]) for r in frame.collect()}


@pytest.mark.parametrize("name", SMALL)
def test_the_node_table_is_the_model(points, name):
    model = fit_family(FAMILIES[name], SMALL[name], points, 240)
    trees = T.trees_of(points.sparkSession, model)
    told = {r.row_id: r.score for r in T.table_scores(trees, points, ["row_id"]).collect()}
    own = scores(score_table(model, points, name, ["row_id"]), "row_id")
    assert all(abs(told[k[0]] - v[0]) < 1e-9 for k, v in own.items()) and len(told) == 240
    np.testing.assert_allclose(gain_shares(trees, 4), model.featureImportances.toArray(), atol=1e-12)
    whole = scores(T.nested_scores(model, points, [(None, None)], ["row_id"]), "row_id")
    assert all(abs(whole[k][0] - v[0]) < 1e-9 and whole[k][1] == v[1] for k, v in own.items())


def test_first_rounds_are_the_smaller_model(points):
    large, small = (fit_family(FAMILIES["boosted_trees"], {"n_estimators": n}, points, 240) for n in (6, 3))
    inside = scores(T.nested_scores(large, points, [(6, None), (3, None)], ["row_id"]).where("at = 1"), "row_id")
    alone = scores(score_table(small, points, "b", ["row_id"]), "row_id")
    assert all(abs(inside[k][0] - alone[k][0]) < 1e-9 and inside[k][1] == alone[k][1] for k in alone)


def test_nested_scores_are_made_in_tasks_and_nodes_keep_their_ancestors(points):
    model = fit_family(FAMILIES["random_forest"], SMALL["random_forest"], points, 240)
    plan = T.nested_scores(model, points, [(5, 2), (12, None)], ["row_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan  # the nodes are no literal that every row carries
    for tree in T.trees_of(points.sparkSession, model).trees:
        for i in np.flatnonzero(tree.left >= 0):
            for child in (tree.left[i], tree.right[i]):
                assert tree.parent[child] == i and tree.depth[child] == tree.depth[i] + 1
        at = int(np.argmax(tree.depth))
        while tree.depth[at] > 1:
            at = tree.parent[at]
        assert tree.values_at(1)[np.argmax(tree.depth)] == tree.value[at] and tree.parent[0] == -1


def test_a_cut_tree_decides_as_the_shallow_one(points):
    deep, shallow = (fit_family(FAMILIES["decision_tree"], {"max_depth": d}, points, 240) for d in (None, 3))
    inside = scores(T.nested_scores(deep, points, [(None, 3)], ["row_id"]), "row_id")
    alone = scores(score_table(shallow, points, "t", ["row_id"]), "row_id")
    assert {k: v[1] for k, v in inside.items()} == {k: v[1] for k, v in alone.items()}


def test_first_trees_of_a_forest(points):
    model = fit_family(FAMILIES["random_forest"], SMALL["random_forest"], points, 240)
    inside = scores(T.nested_scores(model, points, [(5, 2)], ["row_id"]), "row_id")
    trees = T.trees_of(points.sparkSession, model)
    rows = {r.row_id: r.features.toArray() for r in points.collect()}
    for row, x in rows.items():
        total = 0.0
        for tree in trees.trees[:5]:
            node = 0
            while tree.left[node] >= 0 and tree.depth[node] < 2:
                node = tree.left[node] if x[tree.feature[node]] <= tree.threshold[node] else tree.right[node]
            total += tree.value[node]
        assert abs(inside[(row,)][0] - total / 5) < 1e-12


def test_neighbours_of_one_join_serve_all_ballots(points):
    ballots = [(3, "uniform"), (5, "uniform"), (5, "distance"), (1, "distance")]
    model = NeighbourClassifier(k=5, p=1).fit(points)
    found = scores(model.vote_scores(points, ballots, ["row_id"]), "at", "row_id")
    for at, (k, votes) in enumerate(ballots):
        own = scores(score_table(NeighbourClassifier(k=k, p=1, votes=votes).fit(points), points, "n", ["row_id"]), "row_id")
        assert all(abs(found[at, *key][0] - v[0]) < 1e-12 and found[at, *key][1] == v[1] for key, v in own.items())


def test_rows_without_a_key_stay_without_a_score(points):
    model = NeighbourClassifier(k=3).fit(points)
    some = points.withColumn("row_id", F.when(F.col("row_id") % 40 != 0, F.col("row_id")))
    rows = model.transform(some).collect()
    assert len(rows) == 240 and {r.prediction is None for r in rows if r.row_id is None} == {True}


def test_cross_products(spark, points):
    both = points.unionByName(points.where("row_id < 50")).repartition(5)
    found = cross_products(both, ["label"])
    for label, matrix in found.items():
        x = np.array([r.features.toArray() for r in both.where(F.col("label") == label[0]).collect()])
        x = np.column_stack([np.ones(len(x)), x])
        np.testing.assert_allclose(matrix, x.T @ x, rtol=1e-12, atol=1e-9)
    assert cross_products(points.limit(0), ["label"]) == {}


def test_ridge_path_equals_single_fits(points):
    settings = [{"alpha": a, "class_weight": w} for a in (0.1, 1.0, 10.0) for w in (None, "balanced")]
    tables = [points.where("row_id % 3 <> 0"), points.where("row_id % 3 <> 1 and (label = 1 or row_id % 2 = 0)")]
    for table, fitted in zip(tables, ridge_path(tables, settings)):
        found = scores(margins(points, fitted, ["row_id"]), "at", "row_id")
        for i, (params, (intercept, slopes)) in enumerate(zip(settings, fitted)):
            model = fit_family(FAMILIES["ridge_classifier"], params, table, table.count())
            np.testing.assert_allclose(slopes, model.stages[0].coefficients.toArray(), atol=1e-9)
            assert abs(intercept - model.stages[0].intercept) < 1e-9
            own = scores(score_table(model, points, "r", ["row_id"]), "row_id")
            assert all(abs(found[i, *k][0] - v[0]) < 1e-8 for k, v in own.items())


def test_shared_fits_cover_every_point(spark):
    for family in FAMILIES.values():
        whole = M.settings(spark, family.space, family.draws)
        groups = shared_fits(family, whole)
        assert sorted(i for g in groups for i in g.points) == list(range(len(whole)))
        for g in groups:
            for p in g.settings:
                assert {n: v for n, v in family.same(p).items() if n not in family.nested} == {n: v for n, v in g.fit.items() if n not in family.nested}
                assert all(g.fit[n] is None or (p[n] is not None and p[n] <= g.fit[n]) for n in family.nested)
    assert len(shared_fits(FAMILIES["decision_tree"], M.settings(spark, FAMILIES["decision_tree"].space, None))) == 8


def fold_tables(spark, points, k=3):
    """Folds of points that need no preparation."""
    table = points.withColumn("fold", (F.col("row_id") % k).cast("int")).select("row_id", "label", "fold", "features").persist()
    digests = M.fold_digests(table, k)
    parts = [(table.where(F.col("fold") != f), table.where(F.col("fold") == f)) for f in range(k)]
    folds = [M.Prepared(None, train, valid, train.count(), d) for (train, valid), d in zip(parts, digests)]
    return folds, M.Prepared(None, table.where("row_id < 180"), table.where("row_id >= 180"), 180)


def test_a_stopped_search_goes_on(spark, points, monkeypatch, tmp_path):
    folds, split = fold_tables(spark, points, 2)
    family, space = FAMILIES["logistic_regression"], {"C": [0.01, 1.0], "class_weight": [None, "balanced"]}
    whole = M.search(folds, split, family, space)
    fit, done = M.fit_family, []

    def counted(*arguments):
        if len(done) == limit[0]:
            raise InterruptedError("stopped")
        done.append((arguments[1]["C"], arguments[1]["class_weight"], id(arguments[2])))
        return fit(*arguments)

    monkeypatch.setattr(M, "fit_family", counted)
    monkeypatch.setattr(M, "PARALLEL_FITS", 1)
    monkeypatch.setattr(M, "run_all", lambda spark, tasks, width=1: [t() for t in tasks])
    limit, ledger = [3], Ledger(spark, str(tmp_path / "ledger"))
    with pytest.raises(InterruptedError):
        M.search(folds, split, family, space, ledger=ledger)
    assert ledger.table().count() == 3 == len(done)
    limit[0] = 10**6
    again = M.search(folds, split, family, space, ledger=ledger)
    fits = done[:-1]  # the last is the refit of the best
    assert len(fits) == len(set(fits)) == 4 * 2 and ledger.table().count() == 8
    assert (again.best, again.best_cv_f1) == (whole.best, whole.best_cv_f1)
    key = lambda s: sorted(map(tuple, s.results.select("point", "mean_test_score", "mean_train_score", "rank_test_score").collect()))
    assert key(again) == key(whole)
    # the same rows prepared again are known, other rows are not
    assert [f.rows for f in fold_tables(spark, points, 2)[0]] == [f.rows for f in folds]
    assert not {f.rows for f in fold_tables(spark, points.where("row_id <> 17"), 2)[0]} & {f.rows for f in folds}


def test_a_ledger_needs_digests(spark, points):
    folds, split = fold_tables(spark, points)
    folds[0].rows = None
    with pytest.raises(ValueError, match="digest"):
        M.search(folds, split, FAMILIES["ridge_classifier"], ledger=Ledger(spark, "/nowhere"))


def test_search_by_shared_fits_equals_single_ones(spark, points):
    """Rounds inside a boosted model and ridge paths rank as their own fits do."""
    folds, split = fold_tables(spark, points, 2)
    for name, space in (("boosted_trees", {"n_estimators": [2, 4], "max_depth": [2]}), ("ridge_classifier", None), ("decision_tree", {"max_depth": [None, 2, 4], "class_weight": [None, "balanced"]})):
        family = FAMILIES[name]
        found = M.search(folds, split, family, space)
        names = M.settings(spark, space or family.space, None)
        want = []
        for params in names:
            f1 = []
            for fold in folds:
                model = fit_family(family, params, fold.train, fold.n)
                scored = score_table(model, fold.valid, name, ["label"])
                f1.append(scored.agg(M.f1_binary("label", "pred")).first()[0])
            want.append(sum(f1) / len(f1))
        got = [r["mean_test_score"] for r in found.results.orderBy("point").collect()]
        np.testing.assert_allclose(got, want, atol=1e-12)


def test_scores_of_one_setting(points):
    model = fit_family(FAMILIES["logistic_regression"], {}, points, 240)
    one = shared_scores(FAMILIES["logistic_regression"], model, points, [{}], ["row_id"])
    assert one.columns == ["row_id", "at", "score", "pred"] and one.count() == 240
    with pytest.raises(ValueError, match="cannot serve"):
        shared_scores(FAMILIES["logistic_regression"], model, points, [{}, {}], ["row_id"])


def test_fits_on_all_rows_and_without_a_fold_run_side_by_side(points, monkeypatch):
    meet = Barrier(2, timeout=60)

    def beside(run):
        def met(*args):
            meet.wait()  # broken where one of the two waits for the other's end
            return run(*args)

        return met

    monkeypatch.setattr(M, "fit_all", beside(M.fit_all))
    monkeypatch.setattr(M, "cross_validate", beside(M.cross_validate))
    table = points.select("row_id", "label", vector_to_array("features")[0].alias("x"))
    bench = M.benchmark_models(table, table, M.defaults(["ridge_classifier", "decision_tree"]), k=2)
    assert list(bench.models) == ["ridge_classifier", "decision_tree"] and bench.oof.count() == bench.held.count() == 480


def test_the_longest_fits_come_first():
    assert M.longest_first(M.defaults(FAMILIES))[:3] == ["boosted_trees", "extra_trees", "random_forest"]


def test_the_package_is_sent_before_a_function_that_needs_it(points, monkeypatch):
    """A function takes along the files sent before it is called."""
    model, order = classifiers.FourierFeatures(dims=4).fit(points), []
    sent, called = classifiers.on_executors, classifiers.vector_to_array
    monkeypatch.setattr(classifiers, "on_executors", lambda df: order.append("sent") or sent(df))
    monkeypatch.setattr(classifiers, "vector_to_array", lambda c: order.append("called") or called(c))
    assert model.transform(points).count() == 240 and order == ["sent", "called"]


def test_the_tasks_of_a_fit_do_not_grow_with_the_files(spark, points, monkeypatch):
    table = keep(points.select("row_id", "label", vector_to_array("features")[0].alias("x")).repartition(40))
    split = M.prepare(table, table)
    assert split.n == 240 and split.train.count() == 240 and split.train.rdd.getNumPartitions() == 1
    monkeypatch.setattr(M, "ROWS_A_TASK", 1)
    assert M.in_few_tasks(spark.range(0, 240, 1, 40), 240).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert M.in_few_tasks(spark.range(0, 240, 1, 40), 3).rdd.getNumPartitions() == 3
