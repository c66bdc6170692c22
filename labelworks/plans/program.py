"""The whole training run: baseline, tuning, benchmark, family search, saved models, run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.functions.metrics import f1_binary
from labelworks.operators.evaluate import score_metrics
from labelworks.operators.split import SEED
from labelworks.plans import explain
from labelworks.plans.families import BASELINE_DRAWS, BASELINE_SPACE, FAMILIES, Family, Params, last_stage, score_table
from labelworks.plans.stages import feature_names
from labelworks.plans.training import (
    FOLD,
    KEY,
    LABEL,
    NO_FEATURES,
    PipelineModel,
    Prepared,
    Search,
    Selection,
    baseline,
    defaults,
    holdout,
    labelled,
    search,
    select_and_tune,
)
from labelworks.sources.ledger import Ledger
from labelworks.sources.models import save_model
from labelworks.sources.runlog import TABLES, RunLog

REPEATS = 5
# Aliases every registered model carries.
ALIASES = ["latest"]


def _fold_scores(oof: DataFrame) -> DataFrame:
    """F1 of each model and fold, folds counted from 1."""
    return oof.groupBy("model", (F.col(FOLD) + 1).alias(FOLD)).agg(f1_binary(LABEL, "pred").alias("f1"))


@dataclass
class Explained:
    """Importances of one model on the holdout; entries a family lacks are None."""

    importance: DataFrame | None
    permutation: DataFrame
    permutation_encoded: DataFrame | None
    shapley: DataFrame | None
    nodes: DataFrame | None


def explain_model(
    name: str, model: Model, split: Prepared, test: DataFrame, encoded: bool = True, shapley: bool = False, path: str | None = None
) -> Explained:
    """Importance tables of a fitted model; ``path`` is where its pipeline was saved."""
    spark = test.sparkSession
    names = feature_names(split.train)
    raw = [c for c in test.columns if c not in NO_FEATURES]
    whole = explain.model_predict(PipelineModel([split.encoder, model]))
    nodes = None
    if path is not None and hasattr(last_stage(model), "featureImportances"):
        nodes = explain.tree_nodes(spark, path, names)
    return Explained(
        explain.feature_importance(spark, name, model, names),
        explain.permutation_importance(name, whole, test, raw, REPEATS),
        explain.permutation_importance_encoded(name, explain.model_predict(model), split.valid, names, REPEATS, used=explain.used_features(model, names)) if encoded else None,
        explain.shapley_summary(name, model, split.train, split.valid, names) if shapley else None,
        nodes,
    )


@dataclass
class Training:
    selection: Selection
    tuned: Search
    paths: dict[str, str]
    best_path: str


def run_training(
    table: DataFrame,
    key: str,
    target: str,
    models_dir: str,
    log_root: str | None = None,
    run_id: str = "training",
    feature_stages: Sequence[Any] = (),
    candidates: Mapping[str, tuple[Family, Params]] | None = None,
    spaces: Mapping[str, Mapping[str, Sequence[Any]]] | None = None,
    draws: Mapping[str, int] | None = None,
    tuning: tuple[Mapping[str, Sequence[Any]], int] = (BASELINE_SPACE, BASELINE_DRAWS),
    baseline_params: Params | None = None,
    k: int = 5,
    search_k: int = 3,
    fit_rows: int | None = None,
) -> Training:
    """Run every step on one labelled table and save the results.

    ``fit_rows`` bounds the rows of every fit. What the searches measure is kept in
    ``search_ledger`` below ``models_dir``: a run that is started again on the same rows
    goes on where it stopped.

    Family models are saved as ``family_search_<name>_final`` and the best of
    them once more as ``best_family_search_final``.
    """
    spark = table.sparkSession
    candidates = candidates or defaults(FAMILIES)
    train, test = holdout(labelled(table, key, target))
    configs = {n: {**f.defaults, **p} for n, (f, p) in candidates.items()}
    forest = {**FAMILIES["random_forest"].defaults, **(baseline_params or {})}
    models = {"baseline_random_forest": forest, **configs}
    log = RunLog.start_run(spark, log_root, run_id, models, target=target, random_state=SEED, n_splits=k)

    first = baseline(train, test, feature_stages, k, baseline_params, fit_rows)
    ledger = Ledger(spark, f"{models_dir}/search_ledger")
    tuned = search(first.folds, first.split, FAMILIES["random_forest"], *tuning, ledger)
    if log is not None:
        log.log_stage("baseline", first.results.first().asDict(), held=first.held, folds=_fold_scores(first.oof))
        held = score_table(tuned.model, first.split.valid, "random_forest_tuned", [KEY, LABEL])
        path = save_model(tuned.pipeline(first.split), models_dir, "random_forest_tuned")
        found = explain_model("random_forest_tuned", tuned.model, first.split, test, shapley=True, path=path)
        log.update_config({"search_space": tuning[0], "random_search_best_params": tuned.best, "random_search_best_score": tuned.best_cv_f1})
        numbers = {"best_cv_f1": tuned.best_cv_f1} | {f"holdout_{m}": v for m, v in score_metrics(held).first().asDict().items()}
        ranking = tuned.results.select("rank_test_score", "mean_test_score")
        log.log_stage("tuning", numbers, ("random_forest_tuned", tuned.best), held, search=tuned.results, ranking=ranking, **vars(found))

    chosen = select_and_tune(train, test, candidates, feature_stages, k, search_k, spaces, draws, ledger=ledger, fit_rows=fit_rows)
    bench = chosen.benchmark
    pipelines = {n: s.pipeline(bench.split) for n, s in chosen.searches.items()}
    paths = {n: save_model(p, models_dir, f"family_search_{n}") for n, p in pipelines.items()}
    best_path = save_model(pipelines[chosen.best], models_dir, "best_family_search")
    if log is not None:
        _log_selection(log, chosen, candidates, test, paths, best_path, models_dir)
        log.finish_run()
    return Training(chosen, tuned, paths, best_path)


def _log_selection(
    log: RunLog,
    chosen: Selection,
    candidates: Mapping[str, tuple[Family, Params]],
    test: DataFrame,
    paths: Mapping[str, str],
    best_path: str,
    models_dir: str,
) -> None:
    bench = chosen.benchmark
    scores = _fold_scores(bench.oof)
    for row in bench.results.collect():
        name, mine = row["model"], F.col("model") == row["model"]
        family, params = candidates[name]
        saved = save_model(bench.pipelines[name], models_dir, f"benchmark_{name}")
        found = explain_model(name, bench.models[name], bench.split, test, encoded=False, path=saved)
        settings = (name, {**family.defaults, **params})
        log.log_stage(f"benchmark/{name}", row.asDict(), settings, bench.held.where(mine), folds=scores.where(mine), **vars(found))
    results = {row["model"]: row.asDict() for row in chosen.results.collect()}
    best_benchmark = next(iter(chosen.searches))
    for name, done in chosen.searches.items():
        held = score_table(done.model, bench.split.valid, name, [KEY, LABEL])
        found = explain_model(name, done.model, bench.split, test, shapley=name == best_benchmark, path=paths[name])
        log.log_stage(f"family_search/{name}", results[name], (name, done.best), held, **vars(found))
        # The metadata keys and artifact names of registered models.
        metadata = {"model_family": name, "result": results[name], "best_params": done.best}
        log.register_model(paths[name], f"family-search-{name}-model", metadata, [*ALIASES, "family-search", name])
    for stage, table, cv in (("benchmark", bench.results, "by_cv_f1"), ("family_search", chosen.results, "by_search_f1")):
        bars = {bar: table.select("model", TABLES[bar][3]) for bar in ("by_holdout_f1", "by_holdout_accuracy", cv)}
        log.log_tables(stage, {"summary": table, **bars})
    best = {"selected_model_family": chosen.best, "result": results[chosen.best], "best_params": chosen.searches[chosen.best].best}
    log.register_model(best_path, "best-family-search-model", best, [*ALIASES, "best", chosen.best])
