import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelworks.operators.ensemble import ensemble, prediction_frame
from labelworks.plans import prediction as R
from labelworks.plans import training as M
from labelworks.plans.stages import TitleFeatures
from labelworks.sources import models as K
from labelworks.sources import scores as O
from labelworks.sources import tables as A
from labelworks.sources.runlog import RunLog, parameter_rows

SCHEMA = T.StructType(
    [T.StructField("PassengerId", T.LongType()), T.StructField("Name", T.StringType()), T.StructField("Age", T.DoubleType())]
)


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_quirks(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'PassengerId,Name,Age\n1,"O""Hara, Mr. X",NA\n2,"B, Mrs. Y",\n3,NA,NaN\n4,"C, Dr. Z",7.5\n')
    rows = [tuple(r) for r in A.scan_csv(spark, path, SCHEMA).orderBy("PassengerId").collect()]
    assert rows == [(1, 'O"Hara, Mr. X', None), (2, "B, Mrs. Y", None), (3, None, None), (4, "C, Dr. Z", 7.5)]


def test_cells_with_line_breaks(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'PassengerId,Name,Age\n1,"Two\nlines, Mr. X",3\n2,"B, Mrs. Y",4\n')
    rows = [tuple(r) for r in A.scan_csv(spark, path, SCHEMA, multi_line=True).orderBy("PassengerId").collect()]
    assert rows == [(1, "Two\nlines, Mr. X", 3.0), (2, "B, Mrs. Y", 4.0)]
    with pytest.raises(Exception):
        A.scan_csv(spark, path, SCHEMA).collect()


def test_bad_csv_fails(spark, tmp_path):
    with pytest.raises(Exception):
        A.scan_csv(spark, write(tmp_path / "b.csv", "PassengerId,Name,Age\nx,y,z\n"), SCHEMA).collect()


def test_requirements(spark, tmp_path):
    here = write(tmp_path / "c.csv", "a\n1\n")
    A.require_inputs(spark, [here])
    with pytest.raises(FileNotFoundError, match="gone1.*gone2"):
        A.require_inputs(spark, [here, f"{tmp_path}/gone1", f"{tmp_path}/gone2"])
    with pytest.raises(ValueError, match="PassengerId"):
        A.require_columns(spark.range(1), ["PassengerId"])


def test_submission_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.0, 0.7), (2, 0.0, 0.2)], "k long, pred double, score double")
    A.write_submission(df, f"{tmp_path}/deep/er/sub.csv", "k", "pred", "Survived")
    back = spark.read.option("header", True).csv(f"{tmp_path}/deep/er/sub.csv").orderBy("k")
    assert back.columns == ["k", "Survived"] and [tuple(r) for r in back.collect()] == [("1", "1"), ("2", "0")]
    A.write_submission(df, f"{tmp_path}/p.csv", "k", "score", "label", as_int=False)
    assert {r["label"] for r in spark.read.option("header", True).csv(f"{tmp_path}/p.csv").collect()} == {"0.7", "0.2"}
    assert A.details_path("x/y.csv") == "x/y_details.csv" and A.details_path("x.d/y") == "x.d/y_details"


def test_score_tables(spark, tmp_path):
    rows = [(i, s, m, 0.1 * i) for i in range(4) for s in ("oof", "test") for m in ("a", "b")]
    table = spark.createDataFrame(rows, "row_id long, split string, model string, score double")
    O.write_oof(table, f"{tmp_path}/oof")
    back = O.read_oof(spark, f"{tmp_path}/oof", ["a", "b"])
    wide = O.scan_oof(back, ["a", "b"], "test")
    assert wide.columns == ["row_id", "a", "b"] and wide.count() == 4
    with pytest.raises(FileNotFoundError, match="model=c"):
        O.read_oof(spark, f"{tmp_path}/oof", ["a", "c"])
    plan = wide._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


@pytest.fixture(scope="module")
def saved(spark, passengers, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("models"))
    train, test = M.holdout(M.labelled(passengers, "PassengerId", "Survived"))
    split = M.prepare(train, test, [TitleFeatures()])
    candidates = M.defaults(
        ["logistic_regression", "ridge_classifier", "knn", "svc", "decision_tree"], {"decision_tree": {"max_depth": 4}}
    )
    models = M.fit_all(split, candidates)
    pipelines = {n: M.PipelineModel([split.encoder, m]) for n, m in models.items()}
    paths = {n: K.save_model(p, folder, f"family_search_{n}") for n, p in pipelines.items()}
    K.save_model(pipelines["decision_tree"], folder, "best_family_search")
    K.save_model(pipelines["decision_tree"], folder, "decision_tree", fold=1)
    return folder, paths, pipelines, test


def test_models_survive_saving(spark, saved):
    folder, paths, pipelines, test = saved
    for name, path in paths.items():
        loaded = K.load_model(spark, path)
        ours, again = (M.predictions({name: p}, test).toPandas().set_index("row_id").sort_index() for p in (pipelines[name], loaded))
        assert (ours["pred"] == again["pred"]).all()
        assert (ours["score"] - again["score"]).abs().max() < 1e-9
    with pytest.raises(FileNotFoundError):
        K.load_models(spark, [paths["knn"], f"{folder}/absent"])


def test_discovery(spark, saved):
    folder, paths, _, _ = saved
    found = K.discover_models(K.catalogue(spark, folder)).collect()
    assert [r["model"] for r in found] == sorted(f"family_search_{n}_final" for n in paths)
    only_best = spark.createDataFrame([("best_family_search_final", "p"), ("x_fold_1", "q")], "model string, model_path string")
    assert [r["model"] for r in K.discover_models(only_best).collect()] == ["best_family_search_final"]
    assert K.discover_models(only_best.where("model = 'x_fold_1'")).count() == 0


def test_prediction_files(spark, saved, passengers, tmp_path):
    folder, paths, _, _ = saved
    table = passengers.drop("Survived")
    out = R.predict_file(spark, paths["decision_tree"], table, f"{tmp_path}/one.csv", "PassengerId", "Survived")
    assert out.columns == ["PassengerId", "Survived"] and out.count() == 180
    votes = R.ensemble_files(spark, table, f"{tmp_path}/all.csv", "PassengerId", "Survived", models_dir=folder, kind="soft_vote")
    assert votes.count() == 180 and {r["Survived"] for r in votes.collect()} <= {0, 1}
    details = spark.read.option("header", True).csv(f"{tmp_path}/all_details.csv")
    assert {"family_search_knn_final_score", "family_search_svc_final_pred", "ensemble_score", "ensemble_pred"} <= set(details.columns)
    with pytest.raises(ValueError, match="weights"):
        R.ensemble_files(spark, table, f"{tmp_path}/x.csv", "PassengerId", "Survived", models_dir=folder, kind="weighted_soft_vote", weights=[1.0])


def test_run_log(spark, tmp_path):
    assert RunLog.start_run(spark, None, "r", {}) is None
    log = RunLog.start_run(spark, f"{tmp_path}/log", "r1", {"m": {"b": 1, "a": None}}, target="y", project="p", api_key="hidden")
    log.log_metrics("baseline", {"f1": 0.5, "auc": None})
    rows = [(i, "m", i % 2, 0.1 * i, int(i > 4)) for i in range(10)]
    held = prediction_frame(spark.createDataFrame(rows, "row_id int, model string, label int, score double, pred int"))
    folds = spark.createDataFrame([("m", 1, 0.4), ("m", 2, 0.6)], "model string, fold int, f1 double")
    log.log_stage("baseline", {"model": "m", "cv_f1_mean": 0.5}, held=held, folds=folds)
    importance = spark.createDataFrame([("m", f"f{i}", float(i)) for i in range(30)], "model string, feature string, importance double")
    log.log_stage("family_search/m", {"best_cv_f1": 0.5, "search_type": "grid"}, ("m", {"C": 1}), held, importance=importance, nodes=None)
    summary = spark.createDataFrame([("m", 0.5)], "model string, holdout_f1 double")
    log.log_tables("benchmark", {"summary": summary, "by_holdout_f1": summary})
    log.finish_run()
    config = spark.read.parquet(f"{tmp_path}/log/runs")
    assert {r["state"] for r in config.collect()} == {"started", "finished"}
    assert not config.where(F.col("config").contains("hidden")).count()
    metrics = {r["key"]: r["value"] for r in spark.read.parquet(f"{tmp_path}/log/metrics").collect()}
    assert metrics["baseline/f1"] == 0.5 and metrics["baseline/cv_f1_mean"] == pytest.approx(0.5)
    assert metrics["baseline/roc_auc"] == pytest.approx(metrics["baseline/roc_auc_score"])
    top = spark.read.parquet(log.table_path("family_search/m/feature_importance"))
    assert top.count() == 20 and top.agg(F.min("importance")).first()[0] == 10.0
    charts = {r["key"]: r["chart"] for r in spark.read.parquet(f"{tmp_path}/log/charts").collect()}
    assert charts["baseline/cv_folds"] == "line" and charts["benchmark/holdout_f1_bar"] == "bar" and "family_search/m/tree/nodes" not in charts
    assert not log.register_model(f"{tmp_path}/absent", "x")
    assert log.register_model(f"{tmp_path}/log", "x", {"n": 1}, ["latest", "best"])
    artifact = spark.read.parquet(f"{tmp_path}/log/artifacts").first()
    assert artifact["aliases"] == ["latest", "best"] and artifact["metadata"] == '{"n": 1}'
    assert [(r["parameter"], r["value"]) for r in parameter_rows(spark, "c", {"m": {"b": 1, "a": None}}).collect()] == [("a", "null"), ("b", "1")]


def test_ensemble_needs_only_the_long_table(spark):
    df = spark.createDataFrame([(1, "a", 0.2), (1, "b", 0.9)], "row_id int, model string, score double")
    assert ensemble(prediction_frame(df), "soft_vote").first()["ensemble_score"] == pytest.approx(0.55)
