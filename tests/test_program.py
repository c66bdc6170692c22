from labelworks.plans import training as M
from labelworks.plans.program import run_training
from labelworks.plans.stacking import run_blend, run_stacking
from labelworks.plans.stages import TitleFeatures
from labelworks.sources.models import catalogue, discover_models
from labelworks.sources.scores import write_oof


def test_whole_run(spark, passengers, tmp_path):
    done = run_training(
        passengers,
        "PassengerId",
        "Survived",
        f"{tmp_path}/models",
        f"{tmp_path}/log",
        feature_stages=[TitleFeatures()],
        candidates=M.defaults(["decision_tree"], {"decision_tree": {"max_depth": 3}}),
        spaces={"decision_tree": {"max_depth": [2, 3]}},
        tuning=({"n_estimators": [3, 5], "max_depth": [3]}, 2),
        baseline_params={"n_estimators": 3, "max_depth": 4},
        k=2,
        search_k=2,
    )
    names = [r["model"] for r in discover_models(catalogue(spark, f"{tmp_path}/models")).collect()]
    assert names == ["family_search_decision_tree_final"]
    assert done.selection.best in done.paths
    metrics = {r["key"] for r in spark.read.parquet(f"{tmp_path}/log/metrics").collect()}
    assert {"baseline/holdout_f1", "tuning/best_cv_f1", "benchmark/decision_tree/cv_f1_mean", "family_search/decision_tree/best_cv_f1"} <= metrics
    artifacts = spark.read.parquet(f"{tmp_path}/log/artifacts")
    assert artifacts.count() == 2
    charts = {r["key"] for r in spark.read.parquet(f"{tmp_path}/log/charts").collect()}
    assert {"family_search/decision_tree/tree/nodes", "tuning/shap", "baseline/roc_curve", "benchmark/summary_table"} <= charts

    bench = done.selection.benchmark
    models = ["decision_tree"]
    write_oof(M.make_oof(bench), f"{tmp_path}/oof")
    labels = bench.split.train.select("row_id", "label")
    stacked = run_stacking(spark, f"{tmp_path}/oof", labels, models, f"{tmp_path}/stacked.csv", "Id", "Survived", 2)
    blended = run_blend(spark, f"{tmp_path}/oof", labels, models, f"{tmp_path}/blend.csv", "Id", "Survived", [1.0])
    assert 0 <= stacked <= 1 and 0 <= blended <= 1
    assert spark.read.option("header", True).csv(f"{tmp_path}/stacked.csv").columns == ["Id", "Survived"]
