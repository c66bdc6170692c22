"""Cross-validation, search and benchmark over the model families.

The preparation stages are fitted once for each fold and shared by all models of
that fold; settings that one fit holds share that fit. Independent fits are submitted
from a small pool of driver threads; the work itself runs as Spark jobs.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.functions.metrics import accuracy, f1_binary
from labelworks.functions.scalar import to_json
from labelworks.operators.evaluate import result_row, search_results
from labelworks.operators.select import leaderboard, split_target, union_rows
from labelworks.operators.split import (
    SEED,
    fitting_sample,
    fold_train_rows,
    fold_valid_rows,
    parameter_grid,
    parameter_sample,
    stratified_kfold,
    stratified_split,
)
from labelworks.operators.keep import keep
from labelworks.plans.families import FAMILIES, FIT_WEIGHT, Family, Params, Shared, fit_family, score_table, shared_fits, shared_scores
from labelworks.plans.folds import fit_without_each_fold
from labelworks.plans.ridge import margins, ridge_path
from labelworks.plans.stages import TabularEncoder
from labelworks.sources.ledger import Ledger

KEY, LABEL, FOLD = "row_id", "label", "fold"
NO_FEATURES = [KEY, LABEL, FOLD, "part", FIT_WEIGHT]
PARALLEL_FITS = 8
#: Rows below which a step of a fit is sooner done than a further task started.
ROWS_A_TASK = 20_000


def run_all(spark: SparkSession, tasks: Sequence[Callable[[], Any]], width: int | None = None) -> list[Any]:
    """Run independent driver calls in a few threads, results in order; as many as there are
    cores, for the fits of a small table are one task each."""
    if len(tasks) < 2:
        return [t() for t in tasks]
    width = width or max(PARALLEL_FITS, spark.sparkContext.defaultParallelism)
    with ThreadPool(min(width, len(tasks))) as pool:
        return pool.map(inheritable_thread_target(spark)(lambda t: t()), tasks, chunksize=1)


@dataclass
class Prepared:
    """Encoded training and evaluation rows of one split, kept, with the encoder.

    ``train`` may be a weighted sample; ``n`` counts the rows it stands for.
    """

    encoder: PipelineModel
    train: DataFrame
    valid: DataFrame
    n: int
    #: Digest of the rows and stages both tables come from, where it was asked for.
    rows: str | None = None


def prepare(train: DataFrame, valid: DataFrame, feature_stages: Sequence[Any] = (), fit_rows: int | None = None) -> Prepared:
    """Fit the preparation on ``train`` only and encode both tables."""
    encoder = Pipeline(stages=[*[s.copy() for s in feature_stages], TabularEncoder(excludeCols=NO_FEATURES)]).fit(train)
    return encoded_parts(encoder, train, valid, fit_rows)


def encoded_parts(encoder: PipelineModel, train: DataFrame, valid: DataFrame, fit_rows: int | None = None) -> Prepared:
    """Both tables as a fitted preparation encodes them.

    ``fit_rows`` bounds the rows that models are fitted on: a sample by class in hash order,
    weighted so that class shares and penalties stay those of all rows (neighbours vote
    unweighted). What a tree model holds on the driver is then bounded by twice the sample's
    rows a tree. None, the default, fits on all rows; the preparation always does.
    """

    def encode(df: DataFrame) -> DataFrame:
        return keep(encoder.transform(df).select(*[c for c in NO_FEATURES if c in df.columns], "features"))

    if fit_rows is None:
        fitted = encode(train)
        n = fitted.count()
        return Prepared(encoder, in_few_tasks(fitted, n), encode(valid), n)
    sample = encode(fitting_sample(train, LABEL, KEY, fit_rows, name=FIT_WEIGHT))
    return Prepared(encoder, in_few_tasks(sample, fit_rows), encode(valid), train.where(F.col(LABEL).isNotNull()).count())


def in_few_tasks(table: DataFrame, rows: int) -> DataFrame:
    """The table in at most as many parts as there are cores, one for each ``ROWS_A_TASK`` rows.

    A fit by iterations is hundreds of passes, and every task of every pass sends its result and
    its measures to the driver: the parts must not grow with the table's files.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.coalesce(max(1, min(cores, -(-rows // ROWS_A_TASK))))


def fold_digests(df: DataFrame, k: int, feature_stages: Sequence[Any] = (), fit_rows: int | None = None) -> list[str]:
    """A digest for each left-out fold: of all rows, which of them are left out, the stages and the sample."""
    values = [F.to_json(F.struct(*[F.col(c) for c in sorted(df.columns)]))]
    line = F.conv(F.substring(F.md5(F.concat(*values)), 1, 15), 16, 10).cast("decimal(38,0)")
    sums = {r[FOLD]: (r["n"], r["sum"]) for r in df.groupBy(FOLD).agg(F.count(F.lit(1)).alias("n"), F.sum(line).alias("sum")).collect()}
    stages = [(type(s).__name__, sorted((p.name, str(v)) for p, v in s.extractParamMap().items())) for s in feature_stages]
    whole = repr((sorted((str(f), v) for f, v in sums.items()), stages, fit_rows))
    return [hashlib.md5(f"{whole}|{f}".encode()).hexdigest() for f in range(k)]


def prepare_folds(df: DataFrame, k: int, feature_stages: Sequence[Any] = (), fit_rows: int | None = None) -> list[Prepared]:
    """One :class:`Prepared` for each value of ``fold``, fitted without its rows; one pass of
    statistics serves all folds where the stages allow it."""
    encoders = fit_without_each_fold(df, k, feature_stages, TabularEncoder(excludeCols=NO_FEATURES))

    def one(fold: int) -> Callable[[], Prepared]:
        train, valid = fold_train_rows(df, fold), fold_valid_rows(df, fold)
        return lambda: prepare(train, valid, feature_stages, fit_rows) if encoders is None else encoded_parts(encoders[fold], train, valid, fit_rows)

    made = run_all(df.sparkSession, [one(f) for f in range(k)])
    return [replace(p, rows=d) for p, d in zip(made, fold_digests(df, k, feature_stages, fit_rows), strict=True)]


def labelled(df: DataFrame, key: str, target: str) -> DataFrame:
    return split_target(df, target).withColumnRenamed(key, KEY)


def holdout(df: DataFrame, test_size: float = 0.2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Training part and test part, stratified by label."""
    parts = keep(stratified_split(df, LABEL, KEY, test_size, seed))
    return tuple(parts.where(F.col("part") == p).drop("part") for p in ("train", "test"))


def cross_validate(folds: Sequence[Prepared], candidates: Mapping[str, tuple[Family, Params]]) -> DataFrame:
    """Out-of-fold predictions ``row_id, label, fold, model, score, pred`` of every candidate."""
    spark = folds[0].train.sparkSession

    def one(fold: Prepared, name: str, family: Family, params: Params) -> Callable[[], DataFrame]:
        # Kept one by one: in a single job over all of them every task would be sent every model.
        return lambda: keep(score_table(fit_family(family, params, fold.train, fold.n), fold.valid, name, [KEY, LABEL, FOLD]))

    tasks = [one(f, name, *candidates[name]) for name in longest_first(candidates) for f in folds]
    return union_rows(*run_all(spark, tasks))


def longest_first(candidates: Mapping[str, tuple[Family, Params]]) -> list[str]:
    """Names by falling number of trees, rounds before trees that grow side by side, so that the
    longest fits do not run last and alone."""
    whole = {n: {**family.defaults, **params} for n, (family, params) in candidates.items()}
    return sorted(whole, key=lambda n: (-(whole[n].get("n_estimators") or 0), "learning_rate" not in whole[n]))


def fit_all(split: Prepared, candidates: Mapping[str, tuple[Family, Params]]) -> dict[str, Model]:
    spark = split.train.sparkSession
    order = longest_first(candidates)
    fitted = dict(zip(order, run_all(spark, [lambda c=candidates[n]: fit_family(*c, split.train, split.n) for n in order])))
    return {n: fitted[n] for n in candidates}


def predictions(models: Mapping[str, Model], encoded: DataFrame, keep: Iterable[str] = (KEY, LABEL)) -> DataFrame:
    """One long table with the scores of every model."""
    return union_rows(*[score_table(m, encoded, name, list(keep)) for name, m in models.items()])


def defaults(names: Iterable[str], overrides: Mapping[str, Params] | None = None) -> dict[str, tuple[Family, Params]]:
    return {n: (FAMILIES[n], (overrides or {}).get(n, {})) for n in names}


@dataclass
class Benchmark:
    """Result of comparing families: leaderboard, predictions, models and splits."""

    results: DataFrame
    oof: DataFrame
    held: DataFrame
    models: dict[str, Model]
    split: Prepared
    folds: list[Prepared]

    @property
    def pipelines(self) -> dict[str, PipelineModel]:
        return {n: PipelineModel([self.split.encoder, m]) for n, m in self.models.items()}


def benchmark_models(
    train: DataFrame,
    test: DataFrame,
    candidates: Mapping[str, tuple[Family, Params]],
    feature_stages: Sequence[Any] = (),
    k: int = 5,
    fit_rows: int | None = None,
) -> Benchmark:
    """Cross-validate, refit and measure on the holdout every candidate, each fit on at most
    ``fit_rows`` rows (see :func:`encoded_parts`)."""
    made = keep(stratified_kfold(train, LABEL, KEY, k))
    folds, split = run_all(train.sparkSession, [lambda: prepare_folds(made, k, feature_stages, fit_rows), lambda: prepare(train, test, feature_stages, fit_rows)])
    # The fits on all rows and those without a fold are independent: neither waits for the other's longest.
    models, scored = run_all(train.sparkSession, [lambda: fit_all(split, candidates), lambda: cross_validate(folds, candidates)])
    # Narrow tables that several measures read: predict once, not once per measure.
    oof = keep(scored)
    held = keep(predictions(models, split.valid))
    scores = oof.groupBy("model", FOLD).agg(f1_binary(LABEL, "pred").alias("f1"))
    return Benchmark(leaderboard(result_row(scores, held)), oof, held, models, split, folds)


def baseline(train: DataFrame, test: DataFrame, feature_stages: Sequence[Any] = (), k: int = 5, params: Params | None = None, fit_rows: int | None = None) -> Benchmark:
    """Default forest: fit, holdout report, cross-validation."""
    return benchmark_models(train, test, {"random_forest": (FAMILIES["random_forest"], params or {})}, feature_stages, k, fit_rows)


@dataclass
class Search:
    """Scores of every setting, the best setting and its refitted model."""

    family: Family
    results: DataFrame
    best: dict[str, Any]
    best_cv_f1: float
    model: Model

    def pipeline(self, split: Prepared) -> PipelineModel:
        return PipelineModel([split.encoder, self.model])


def settings(spark: SparkSession, space: Mapping[str, Sequence[Any]], draws: int | None, seed: int = SEED) -> list[dict[str, Any]]:
    """Points of a search space, all of them or ``draws`` distinct ones, in point order."""
    points = parameter_grid(spark, space)
    if draws is not None:
        points = parameter_sample(points, draws, seed)
    rows = points.orderBy("point").collect()
    return [{n: json.loads(r[n]) for n in space} for r in rows]


def both_parts(fold: Prepared) -> DataFrame:
    """Training and test rows of a fold in one table, told apart by ``_part``."""
    parts = [p.select(KEY, LABEL, "features", F.lit(n).alias("_part")) for n, p in (("test", fold.valid), ("train", fold.train))]
    return parts[0].unionByName(parts[1])


def _f1_by_part(scored: DataFrame) -> dict[int, tuple[float, float]]:
    """Test and train F1 of each ``at``."""
    rows = scored.groupBy("at", "_part").agg(f1_binary(LABEL, "pred").alias("f1")).collect()
    f1 = {(r["at"], r["_part"]): r["f1"] for r in rows}
    return {at: (f1[at, "test"], f1[at, "train"]) for at, _ in f1}


def search(
    folds: Sequence[Prepared],
    split: Prepared,
    family: Family,
    space: Mapping[str, Sequence[Any]] | None = None,
    draws: int | None = None,
    ledger: Ledger | None = None,
) -> Search:
    """Try settings on every fold, rank by mean F1 and refit the best on all training rows.

    Settings that one fit holds share it: the trees and depths inside a forest, the rounds
    inside a boosted model, the neighbours of one join; ridge settings need no fit but one
    scan of all folds. Each setting and fold yields two numbers, test and train F1, which a
    ``ledger`` keeps as soon as they are there: a search that is started again, on the same
    rows and stages, fits only what is missing.
    """
    spark = split.train.sparkSession
    space = family.space if space is None else space
    points = settings(spark, space, draws)
    names = [to_json({**family.defaults, **p}) for p in points]
    if ledger is not None and any(f.rows is None for f in folds):
        raise ValueError("a ledger needs folds with a digest of their rows")
    known = ledger.read(family.name) if ledger is not None else {}
    scores = {(i, j): known[n, f.rows] for i, n in enumerate(names) for j, f in enumerate(folds) if (n, f.rows) in known}

    def found(f1: Mapping[tuple[int, int], tuple[float, float]]) -> None:
        scores.update(f1)
        if ledger is not None:
            ledger.add([(family.name, names[i], folds[j].rows, *both) for (i, j), both in f1.items()])

    def one(shared: Shared, j: int) -> Callable[[], None]:
        def run() -> None:
            model = fit_family(family, shared.fit, folds[j].train, folds[j].n)
            f1 = _f1_by_part(shared_scores(family, model, both_parts(folds[j]), shared.settings, [LABEL, "_part"]))
            found({(shared.points[at], j): both for at, both in f1.items()})

        return run

    if family.name == "ridge_classifier":
        left = sorted({j for i in range(len(points)) for j in range(len(folds)) if (i, j) not in scores})
        whole = [{**family.defaults, **p} for p in points]
        for j, fitted in zip(left, ridge_path([folds[j].train for j in left], whole) if left else [], strict=True):
            found({(i, j): both for i, both in _f1_by_part(margins(both_parts(folds[j]), fitted, [LABEL, "_part"])).items()})
    else:
        missing = [(s, j) for s in shared_fits(family, points) for j in range(len(folds)) if any((i, j) not in scores for i in s.points)]
        # the longest fits first, so that the last of them do not run alone
        run_all(spark, [one(s, j) for s, j in sorted(missing, key=lambda m: -(m[0].fit.get("n_estimators") or 0))])

    rows = [(i, j, *both) for (i, j), both in sorted(scores.items())]
    table = spark.createDataFrame(rows, "point int, fold int, test_f1 double, train_f1 double")
    ranked = search_results(table, ["point"])
    top = ranked.orderBy("rank_test_score", "point").first()
    texts = F.array(*[F.lit(to_json(p)) for p in points])
    results = ranked.withColumn("params", F.get(texts, F.col("point"))).withColumn("model", F.lit(family.name))
    best = points[top["point"]]
    return Search(family, results, best, top["mean_test_score"], fit_family(family, best, split.train, split.n))


def family_result(found: Search, split: Prepared, kind: str) -> DataFrame:
    """Row ``model, search_type, best_cv_f1, holdout_*`` of a finished search."""
    from labelworks.operators.evaluate import roc_auc

    held = score_table(found.model, split.valid, found.family.name, [KEY, LABEL])
    row = held.groupBy("model").agg(
        F.lit(kind).alias("search_type"),
        F.lit(found.best_cv_f1).alias("best_cv_f1"),
        f1_binary(LABEL, "pred").alias("holdout_f1"),
        accuracy(LABEL, "pred").alias("holdout_accuracy"),
    )
    return row.join(roc_auc(held).withColumnRenamed("roc_auc", "holdout_roc_auc"), "model", "left")


@dataclass
class Selection:
    """Families searched best first, their comparison and the best model of all."""

    benchmark: Benchmark
    searches: dict[str, Search]
    results: DataFrame
    best: str


def select_and_tune(
    train: DataFrame,
    test: DataFrame,
    candidates: Mapping[str, tuple[Family, Params]],
    feature_stages: Sequence[Any] = (),
    k: int = 5,
    search_k: int = 3,
    spaces: Mapping[str, Mapping[str, Sequence[Any]]] | None = None,
    draws: Mapping[str, int] | None = None,
    bench: Benchmark | None = None,
    ledger: Ledger | None = None,
    fit_rows: int | None = None,
) -> Selection:
    """Benchmark, search the best family first and the others after, compare.

    A benchmark of these (and perhaps further) candidates on the same parts can be given.

    The final choice goes by holdout F1, which is optimistic; ``cv_rank`` shows
    the order that cross-validation alone would give.
    """
    from pyspark.sql.window import Window

    bench = bench or benchmark_models(train, test, candidates, feature_stages, k, fit_rows)
    first = bench.results.where(F.col("model").isin(*candidates)).first()["model"]
    order = [first, *[n for n in candidates if n != first]]
    folds = prepare_folds(keep(stratified_kfold(train, LABEL, KEY, search_k)), search_k, feature_stages, fit_rows)
    searches = {}
    for name in order:
        family = candidates[name][0]
        space = (spaces or {}).get(name, family.space)
        searches[name] = search(folds, bench.split, family, space, (draws or {}).get(name, family.draws), ledger)
    # One row per family, measured once: the ranking window is as small as the family list.
    rows = union_rows(*[family_result(s, bench.split, s.family.search) for s in searches.values()])
    table = train.sparkSession.createDataFrame(rows.collect(), rows.schema)
    cv = F.rank().over(Window.partitionBy(F.lit(1)).orderBy(F.round("best_cv_f1", 12).desc()))
    results = leaderboard(table.withColumn("cv_rank", cv), "holdout_f1", "best_cv_f1")
    return Selection(bench, searches, results, results.first()["model"])


def make_oof(bench: Benchmark, unlabelled: DataFrame | None = None) -> DataFrame:
    """Score table ``row_id, split, model, fold, score`` for stacking.

    Split ``oof`` holds the out-of-fold scores of the training rows, split
    ``test`` the full-fit scores of the holdout (or of another table).
    """
    oof = bench.oof.select(KEY, F.lit("oof").alias("split"), "model", FOLD, "score")
    if unlabelled is None:
        scored = bench.held
    else:
        scored = predictions(bench.models, bench.split.encoder.transform(unlabelled), [KEY])
    test = scored.select(KEY, F.lit("test").alias("split"), "model", F.lit(None).cast("int").alias(FOLD), "score")
    return oof.unionByName(test)
