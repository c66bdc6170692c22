import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from labelworks.operators import neighbours as D
from labelworks.operators.evaluate import roc_auc
from labelworks.operators.select import select_by_type
from labelworks.plans import explain as X
from labelworks.plans import stacking as S
from labelworks.plans import training as M
from labelworks.plans.classifiers import FourierFeatures, KernelSVC, LandmarkFeatures, RidgeClassifier, gaussian_kernel, kernel_error
from labelworks.plans.families import FAMILIES, fit_family, last_stage
from labelworks.plans.stages import MedianImputer, ModeImputer, PopulationScaler, TabularEncoder, TitleFeatures, feature_names


def numeric_table(spark, n=600, d=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = (x[:, 0] - 0.5 * x[:, 1] + rng.normal(scale=0.7, size=n) > 0).astype(int)
    names = [f"x{j}" for j in range(d)]
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(n)]
    df = spark.createDataFrame(rows, ["row_id", "label", *names])
    return VectorAssembler(inputCols=names, outputCol="features").transform(df).persist(), x, y


# --- stages ---


def test_title_stage(spark):
    train = spark.createDataFrame(
        [(1, "A, Mr. X", 10.0, "C1"), (2, "B, Mr. Y", 20.0, ""), (3, "C, Dr. Z", None, None), (4, "D, Miss. W", 60.0, "B2")],
        "row_id int, Name string, Age double, Cabin string",
    )
    model = TitleFeatures().fit(train)
    new = spark.createDataFrame(
        [(1, "A, Mr. X", None, "C1"), (2, "B, Dr. Y", None, ""), (3, "C, Rev. Z", None, None), (4, "D, Mr. W", 5.0, "B2")],
        "row_id int, Name string, Age double, Cabin string",
    )
    got = {r["row_id"]: (r["Age"], r["title"], r["cabin_name"]) for r in model.transform(new).collect()}
    # Dr was seen only without values and Rev not at all: both take the overall median.
    assert got == {1: (15.0, "Mr", "C"), 2: (20.0, "Dr", None), 3: (20.0, "Rev", None), 4: (5.0, "Mr", "B")}
    assert "Name" not in model.transform(new).columns


def test_imputers_and_scaler(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, None), (4.0, "b"), (None, "a")], "x double, s string")
    empty = df.withColumn("e", F.lit(None).cast("double"))
    filled = MedianImputer(inputCols=["x", "e"]).fit(empty).transform(empty)
    assert sorted(r["x"] for r in filled.collect()) == [1.0, 2.0, 2.5, 3.0, 4.0] and {r["e"] for r in filled.collect()} == {0.0}
    assert [r["s"] for r in ModeImputer(inputCols=["s"]).fit(df).transform(df).collect()].count("a") == 3
    scaled = PopulationScaler(inputCols=["x"]).fit(df.dropna()).transform(df.dropna()).toPandas()["num__x"]
    assert scaled.mean() == pytest.approx(0) and scaled.std(ddof=0) == pytest.approx(1)
    constant = df.select(F.lit(5.0).alias("x"))
    assert PopulationScaler(inputCols=["x"]).fit(constant).transform(constant).first()["num__x"] == 0.0


def test_encoder_names_and_unseen(spark):
    train = spark.createDataFrame([(1, 0, 1.0, "b"), (2, 1, 2.0, "a"), (3, 1, None, None)], "row_id int, label int, x double, s string")
    encoder = TabularEncoder(excludeCols=["row_id", "label"]).fit(train)
    new = spark.createDataFrame([(9, 0, 1.5, "zz")], "row_id int, label int, x double, s string")
    out = encoder.transform(new)
    assert feature_names(out) == ["num__x", "cat__s_a", "cat__s_b"]
    assert list(out.first()["features"].toArray()) == [0.0, 0.0, 0.0]
    assert select_by_type(train) == (["row_id", "label", "x"], ["s"])


# --- models against definitions ---


def test_logistic_solves_the_penalised_objective(spark):
    df, x, y = numeric_table(spark)
    c = 0.5
    model = fit_family(FAMILIES["logistic_regression"], {"C": c}, df, len(y))
    w, b = np.zeros(x.shape[1]), 0.0
    a = np.hstack([x, np.ones((len(y), 1))])
    theta, penalty = np.append(w, b), np.diag([1.0] * x.shape[1] + [0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ theta))
        gradient = c * a.T @ (p - y) + penalty @ theta
        hessian = c * (a * (p * (1 - p))[:, None]).T @ a + penalty
        theta = theta - np.linalg.solve(hessian, gradient)
    np.testing.assert_allclose(model.coefficients.toArray(), theta[:-1], atol=1e-5)


@pytest.mark.parametrize("balanced", [False, True])
def test_ridge_solves_the_normal_equations(spark, balanced):
    df, x, y = numeric_table(spark)
    df = df.where((F.col("label") == 1) | (F.col("row_id") % 3 == 0))
    keep = (y == 1) | (np.arange(len(y)) % 3 == 0)
    x, y = x[keep], y[keep]
    params = {"alpha": 3.0, "class_weight": "balanced" if balanced else None}
    model = fit_family(FAMILIES["ridge_classifier"], params, df, len(y)).stages[0]
    weight = len(y) / (2 * np.where(y == 1, (y == 1).sum(), (y == 0).sum())) if balanced else np.ones(len(y))
    signed = 2.0 * y - 1
    mx, my = np.average(x, axis=0, weights=weight), np.average(signed, weights=weight)
    xc, yc = x - mx, signed - my
    want = np.linalg.solve((xc * weight[:, None]).T @ xc + 3.0 * np.eye(3), (xc * weight[:, None]).T @ yc)
    np.testing.assert_allclose(model.coefficients.toArray(), want, atol=1e-6)


@pytest.mark.parametrize("p,k", [(1, 3), (2, 5)])
def test_neighbours_match_brute_force(spark, monkeypatch, p, k):
    """Small blocks force many block pairs; a third of the points coincide."""
    monkeypatch.setattr(D, "BLOCK_ROWS", 16)
    monkeypatch.setattr(D, "PIVOTS", 7)
    rng = np.random.default_rng(5)
    t = np.round(rng.normal(size=(200, 2)), 1)
    t[:70] = [0.5, 0.5]
    q = np.round(rng.normal(size=(60, 2)), 1)
    train = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(t)], "t long, v array<double>")
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "q long, v array<double>")
    got = D.neighbour_join(asked, train, "q", "t", "v", k, p).toPandas().sort_values(["q", "place"])
    gap = np.abs(q[:, None] - t[None])
    d = np.round(gap.sum(2) if p == 1 else np.sqrt((gap**2).sum(2)), 12)
    want = np.argsort(d, axis=1, kind="stable")[:, :k]
    np.testing.assert_array_equal(got["t"].to_numpy().reshape(-1, k), want)


def test_neighbours_when_there_are_fewer_than_k(spark):
    train = spark.createDataFrame([(1, [0.0]), (2, [3.0])], "t long, v array<double>")
    asked = spark.createDataFrame([("a", [1.0])], "q string, v array<double>")
    assert D.neighbour_join(asked, train, "q", "t", "v", 5).count() == 2


def test_neighbour_votes(spark):
    near = spark.createDataFrame([(1, 10, 0.0), (1, 11, 1.0), (2, 10, 1.0), (2, 11, 3.0)], "q int, t int, distance double")
    labels = spark.createDataFrame([(10, 1), (11, 0)], "t int, label int")

    def vote(weights):
        return {r["q"]: (r["score"], r["pred"]) for r in D.neighbour_vote(near, labels, "q", "t", "label", weights).collect()}

    assert vote("uniform") == {1: (0.5, 0), 2: (0.5, 0)}  # ties give the smaller class
    assert vote("distance") == {1: (1.0, 1), 2: (0.75, 1)}


def test_fourier_features_approximate_the_kernel(spark):
    df, x, _ = numeric_table(spark, 100)
    model = FourierFeatures(dims=4000).fit(df)
    gamma = model.getOrDefault(model.gamma)
    assert gamma == pytest.approx(1 / (3 * x.var()))
    z = np.array([r[0].toArray() for r in model.transform(df).orderBy("row_id").select("fourier").collect()])
    kernel = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(z @ z.T - kernel).max() < 0.1


@pytest.mark.parametrize("name", sorted(FAMILIES))
def test_every_family_learns(spark, name):
    df, _, y = numeric_table(spark)
    small = {"n_estimators": 10} if "n_estimators" in FAMILIES[name].defaults else {}
    model = fit_family(FAMILIES[name], small, df, len(y))
    held = numeric_table(spark, 200, seed=1)[0]
    scores = M.predictions({name: model}, held).toPandas()
    assert len(scores) == 200 and (scores["pred"] == scores["label"]).mean() > 0.7
    assert scores["score"].notna().all()


# --- selection ---


@pytest.fixture(scope="module")
def selection(passengers):
    train, test = M.holdout(M.labelled(passengers, "PassengerId", "Survived"))
    candidates = M.defaults(["logistic_regression", "decision_tree"], {"decision_tree": {"max_depth": 4}})
    spaces = {"logistic_regression": {"C": [0.1, 1.0]}, "decision_tree": {"max_depth": [2, 4]}}
    return M.select_and_tune(train, test, candidates, [TitleFeatures()], 3, 2, spaces)


def test_selection(selection):
    bench = selection.benchmark
    assert {r["model"] for r in bench.results.collect()} == {"logistic_regression", "decision_tree"}
    assert bench.oof.count() == 2 * 144 and bench.held.count() == 2 * 36
    assert bench.oof.groupBy("model", "row_id").count().where("count > 1").count() == 0
    rows = selection.results.collect()
    assert list(selection.searches)[0] == bench.results.first()["model"]
    assert rows[0]["holdout_f1"] >= rows[1]["holdout_f1"] and {r["cv_rank"] for r in rows} <= {1, 2}
    found = selection.searches["decision_tree"]
    assert found.results.count() == 2 and found.best in ({"max_depth": 2}, {"max_depth": 4})
    top = found.results.orderBy("rank_test_score", "point").first()
    assert top["rank_test_score"] == 1 and top["mean_test_score"] == pytest.approx(found.best_cv_f1)


def test_stacking_over_made_scores(spark, selection):
    bench = selection.benchmark
    scores = M.make_oof(bench)
    labels = bench.split.train.select("row_id", "label")
    stack = S.stack_fit(scores, labels, ["logistic_regression", "decision_tree"], 3)
    assert stack.oof.count() == 144 and stack.test.count() == 36
    assert 0.5 < roc_auc(stack.oof).first()["roc_auc"] <= 1
    area, blended = S.blend(scores, labels, ["logistic_regression", "decision_tree"], [0.5, 0.5])
    assert 0.5 < area.first()["roc_auc"] <= 1 and blended.count() == 36


# --- explanation ---


def test_importances(spark, selection):
    split, models = selection.benchmark.split, selection.benchmark.models
    names = feature_names(split.train)
    tree = X.feature_importance(spark, "t", models["decision_tree"], names).toPandas()
    assert tree["importance"].sum() == pytest.approx(1) and tree["importance"].is_monotonic_decreasing
    logistic = X.feature_importance(spark, "l", models["logistic_regression"], names).toPandas().set_index("feature")
    np.testing.assert_allclose(logistic["importance"][names], np.abs(models["logistic_regression"].coefficients.toArray()))
    df, _, y = numeric_table(spark)
    assert X.feature_importance(spark, "s", fit_family(FAMILIES["svc"], {}, df, len(y)), ["a"] * 3) is None
    assert X.feature_importance(spark, "r", fit_family(FAMILIES["ridge_classifier"], {}, df, len(y)), list("abc")).count() == 3


def test_permutation_of_an_unused_column_costs_nothing(spark):
    df, _, _ = numeric_table(spark)

    def rule(t):
        return t.withColumn("pred", (F.col("x0") > 0).cast("int"))

    got = X.permutation_importance("rule", rule, df, ["x0", "x1", "x2"], 3).toPandas().set_index("feature")
    assert got["importance_mean"]["x0"] > 0.1
    assert (got.loc[["x1", "x2"], ["importance_mean", "importance_std"]] == 0).all().all()


def test_encoded_permutation(spark, selection):
    split, model = selection.benchmark.split, selection.benchmark.models["decision_tree"]
    names = feature_names(split.train)
    got = X.permutation_importance_encoded("t", X.model_predict(model), split.valid, names, 2).toPandas().set_index("feature")
    used = X.permutation_importance_encoded("t", X.model_predict(model), split.valid, names, 2, used=X.used_features(model, names))
    assert used.toPandas().set_index("feature").sort_index().equals(got.sort_index())
    unused = [n for n, v in zip(names, last_stage(model).featureImportances.toArray()) if v == 0]
    assert len(got) == len(names) and unused and (got.loc[unused, "importance_mean"] == 0).all()


def test_shapley_values_add_up(spark):
    df, x, y = numeric_table(spark, 120)
    model = fit_family(FAMILIES["ridge_classifier"], {}, df, len(y))
    coefficients = dict(zip(["x0", "x1", "x2"], model.stages[0].coefficients.toArray()))
    exact = X.linear_shapley(df, df, coefficients).toPandas().pivot(index="row_id", columns="feature", values="value")
    margin = x @ np.array(list(coefficients.values()))
    np.testing.assert_allclose(exact.sum(axis=1).to_numpy(), margin - margin.mean(), atol=1e-9)

    def score(t):
        return model.transform(t).withColumn("score", F.col("margin"))

    sampled = X.sampled_shapley(score, df, df, ["x0", "x1", "x2"], draws=200).toPandas()
    near = sampled.pivot(index="row_id", columns="feature", values="value")
    assert np.abs(near - exact).max().max() < 0.5 * np.abs(exact).max().max()
    assert np.corrcoef(near.to_numpy().ravel(), exact.to_numpy().ravel())[0, 1] > 0.98


def test_tree_nodes(spark, tmp_path):
    df, _, y = numeric_table(spark)
    for name, params in (("decision_tree", {"max_depth": 6}), ("random_forest", {"n_estimators": 3}), ("boosted_trees", {"n_estimators": 2})):
        model = fit_family(FAMILIES[name], params, df, len(y))
        model.write().overwrite().save(f"{tmp_path}/{name}")
        nodes = X.tree_nodes(spark, f"{tmp_path}/{name}", ["a", "b", "c"]).toPandas().set_index("node")
        assert nodes["depth"].max() == 3 and nodes.index.is_unique
        inner = nodes[nodes["left"].notna() & (nodes["depth"] < 3)]
        assert inner["feature"].isin(["a", "b", "c"]).all()
        for _, row in inner.iterrows():
            both = nodes.loc[[int(row["left"]), int(row["right"])]]
            assert (both["depth"] == row["depth"] + 1).all()
            assert both["n_rows"].sum() == row["n_rows"]


def test_kernel_width_and_iterations_are_parameters(spark):
    df, x, _ = numeric_table(spark, 120)
    widths = {w: FourierFeatures(width=w).fit(df).getOrDefault("gamma") for w in ("scale", "auto", "0.25")}
    assert widths["auto"] == pytest.approx(1 / 3) and widths["0.25"] == 0.25
    assert widths["scale"] == pytest.approx(1 / (3 * x.var()), rel=1e-6)
    model = KernelSVC(gamma="0.5", dims=16, maxIter=3, tol=0.1).fit(df)
    assert model.stages[0].getOrDefault("gamma") == 0.5 and model.transform(df).first()["fourier"].size == 16
    family = FAMILIES["svc"]
    assert family.estimator({"gamma": 2.0, "dims": 8}, 120).getOrDefault("gamma") == "2.0"


def test_rows_without_label_or_key_stay(spark):
    from labelworks.operators import split as P

    df = spark.createDataFrame([(i if i else None, None if i % 5 == 4 else i % 2) for i in range(50)], "k int, y int")
    for out, name in ((P.stratified_split(df, "y", "k"), "part"), (P.stratified_kfold(df, "y", "k", 4), "fold")):
        rows = out.collect()
        assert len(rows) == 50 and all((r["y"] is None) == (r[name] is None) for r in rows)


def test_many_categories_fail_or_are_hashed(spark):
    df = spark.createDataFrame([(i, i % 2, f"c{i}" if i % 10 else None) for i in range(300)], "row_id int, label int, s string")
    with pytest.raises(ValueError, match="categories"):
        TabularEncoder(excludeCols=["row_id", "label"], maxCategories=50).fit(df)
    encoder = TabularEncoder(excludeCols=["row_id", "label"], maxCategories=50, hashTo=8).fit(df)
    out = encoder.transform(df)
    assert out.first()["features"].size == 8 and all(n.startswith("cat__s_h") for n in feature_names(out))


def test_probes_bound_the_cells_of_a_query(spark):
    rng = np.random.default_rng(4)
    points = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(400)]
    train = spark.createDataFrame(points, "t int, v array<double>")
    asked = train.where("t < 40").withColumnRenamed("t", "q")
    exact, near = (D.neighbour_join(asked, train, "q", "t", "v", 3, probes=n).toPandas() for n in (None, 4))
    both = exact.merge(near, on=["q", "t"])
    assert len(near) == len(exact) == 120 and len(both) >= 0.5 * len(exact)
    assert (near[near.place == 1].sort_values("q")["distance"] == 0).all()  # a point's own cell is its nearest


def test_landmarks_come_closer_to_the_kernel_than_random_features(spark, tmp_path):
    df, x, _ = numeric_table(spark, 500, 4, seed=8)
    sample = df.where("row_id < 150")
    landmarks, waves = LandmarkFeatures(dims=128).fit(df), FourierFeatures(dims=128).fit(df)
    errors = [kernel_error(m, sample) for m in (landmarks, waves)]
    assert errors[0] < 0.02 < errors[1]
    # with every point a landmark the kernel is exact
    whole = LandmarkFeatures(dims=200).fit(sample)
    assert kernel_error(whole, sample) < 1e-6
    gamma = 1 / (4 * x[:150].var())
    made = np.array([r[0].toArray() for r in whole.transform(sample).orderBy("row_id").select("landmarks").collect()])
    np.testing.assert_allclose(made @ made.T, gaussian_kernel(x[:150], x[:150], gamma), atol=1e-5)
    whole.write().save(str(tmp_path / "w"))
    assert kernel_error(type(whole).load(str(tmp_path / "w")), sample) < 1e-6
    # repeated points are one landmark
    copies = df.where("row_id < 3").unionByName(df.where("row_id < 3").withColumn("row_id", F.col("row_id") + 1000))
    assert len(LandmarkFeatures(dims=50).fit(copies).getOrDefault("points")) == 3


def test_svc_on_landmarks(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    y = ((x**2).sum(axis=1) < 1.2).astype(int)
    rows = [(i, int(y[i]), *map(float, x[i])) for i in range(300)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "row_id long, label int, a double, b double"))
    model = fit_family(FAMILIES["svc"], {"approximation": "landmarks", "C": 10.0}, df, 300)
    right = model.transform(df).where("prediction = label").count()
    assert right > 270
    with pytest.raises(ValueError, match="approximation"):
        KernelSVC(approximation="none").fit(df)
