"""Evaluation of long score tables ``(row_id, model, label, score, pred)``.

Every function measures all models of the table in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelworks.functions.metrics import accuracy, f1_binary, metric
from labelworks.operators.order import ordered_runs
from labelworks.streaming.guard import require_batch

CLASSES = (0, 1)


def score_metrics(long: DataFrame, by: Sequence[str] = ("model",), names: Sequence[str] = ("f1", "accuracy")) -> DataFrame:
    """Registered metrics for each group, one aggregate."""
    return long.groupBy(*by).agg(*[metric(n).alias(n) for n in names])


def confusion_matrix(long: DataFrame, by: Sequence[str] = ("model",), classes: Sequence[int] = CLASSES) -> DataFrame:
    """Rows ``by, label, pred, n`` for every class pair, absent cells 0."""
    cells = [(t, p) for t in classes for p in classes]
    names = [f"_{t}_{p}" for t, p in cells]
    counts = long.groupBy(*by).agg(
        *[F.count_if((F.col("label") == t) & (F.col("pred") == p)).alias(n) for (t, p), n in zip(cells, names)]
    )
    rows = F.array(
        *[F.struct(F.lit(t).alias("label"), F.lit(p).alias("pred"), F.col(n).alias("n")) for (t, p), n in zip(cells, names)]
    )
    return counts.select(*by, F.explode(rows).alias("_r")).select(*by, "_r.*")


def _harmonic(p: Column, r: Column) -> Column:
    return F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))


def classification_report(long: DataFrame, by: Sequence[str] = ("model",), classes: Sequence[int] = CLASSES) -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy and averages.

    The confusion counts are one aggregate; everything after it is arithmetic on
    one row for each group.
    """
    hit = {c: F.count_if((F.col("label") == c) & (F.col("pred") == c)) for c in classes}
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in classes:
        aggs += [
            hit[c].alias(f"_tp_{c}"),
            F.count_if(F.col("pred") == c).alias(f"_said_{c}"),
            F.count_if(F.col("label") == c).alias(f"_true_{c}"),
        ]
    counts = long.groupBy(*by).agg(*aggs)

    def share(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part, whole), F.lit(0.0))

    per = {}
    for c in classes:
        p = share(F.col(f"_tp_{c}"), F.col(f"_said_{c}"))
        r = share(F.col(f"_tp_{c}"), F.col(f"_true_{c}"))
        per[c] = (p, r, _harmonic(p, r), F.col(f"_true_{c}"))

    def total(columns: Sequence[Column]) -> Column:
        out = columns[0]
        for c in columns[1:]:
            out = out + c
        return out

    def entry(name: str, p: Column, r: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("entry"), p.alias("precision"), r.alias("recall"), f1.alias("f1"), support.alias("support")
        )

    n = F.col("_n")
    acc = share(total([F.col(f"_tp_{c}") for c in classes]), n)
    macro = [total([per[c][i] for c in classes]) / len(classes) for i in range(3)]
    weighted = [share(total([per[c][i] * per[c][3] for c in classes]), n) for i in range(3)]
    rows = [entry(str(c), *per[c]) for c in classes]
    rows += [entry("accuracy", acc, acc, acc, n), entry("macro avg", *macro, n), entry("weighted avg", *weighted, n)]
    return counts.select(*by, F.explode(F.array(*rows)).alias("_r")).select(*by, "_r.*")


def cumulative_hits(long: DataFrame, by: Sequence[str] = ("model",), following: bool = False) -> DataFrame:
    """True and false positives at each distinct score, from the highest score down."""
    require_batch(long, "a curve over the scores")
    hit = F.sum(F.col("label").cast("long"))
    miss = F.sum(F.lit(1) - F.col("label").cast("long"))
    return ordered_runs(long, "score", {"p": hit, "n": miss}, by, descending=True, following=following)


def roc_curve(long: DataFrame, by: Sequence[str] = ("model",), drop_collinear: bool = True) -> DataFrame:
    """Points ``by, threshold, fpr, tpr``, starting at (0, 0) with an infinite threshold.

    A point is dropped when the steps before and after it are equal, first and
    last points excepted.
    """
    runs = cumulative_hits(long, by, following=drop_collinear)
    if drop_collinear:
        first = (F.col("p_before") == 0) & (F.col("n_before") == 0)
        bend = (F.col("next.p") != F.col("p")) | (F.col("next.n") != F.col("n"))
        runs = runs.where(first | F.col("next").isNull() | bend)
    fpr = F.try_divide(F.col("n_before") + F.col("n"), F.col("n_total"))
    tpr = F.try_divide(F.col("p_before") + F.col("p"), F.col("p_total"))
    points = runs.select(*by, F.col("score").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr"))
    groups = long.where(F.col("score").isNotNull()).select(*by).distinct()
    start = groups.select(*by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(start)


def auc_trapezoid(long: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Area below the curve, summed as trapezoids between neighbouring scores."""
    runs = cumulative_hits(long, by)
    before, after = F.col("p_before"), F.col("p_before") + F.col("p")
    area = F.sum((F.col("n") / F.col("n_total")) * (before / F.col("p_total") + after / F.col("p_total")) / 2)
    return runs.where((F.col("n_total") > 0) & (F.col("p_total") > 0)).groupBy(*by).agg(area.alias("auc"))


def roc_auc(long: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Area under the ROC curve from pair counts; missing when only one class is present.

    Counts stay whole numbers until the last division, and groups without any
    score do not appear.
    """
    runs = cumulative_hits(long, by)
    # 2 x (pairs won) = n * (2 * positives above + positives level)
    won = F.col("n").cast("decimal(20,0)") * (2 * F.col("p_before") + F.col("p")).cast("decimal(18,0)")
    pairs = F.max("n_total").cast("double") * F.max("p_total").cast("double")
    area = F.try_divide(F.sum(won).cast("double") / 2, pairs)
    return runs.groupBy(*by).agg(area.alias("roc_auc"))


def fold_scores(long: DataFrame, by: Sequence[str] = ("model", "fold"), name: str = "f1") -> DataFrame:
    """Metric of each fold from one out-of-fold prediction table."""
    return long.groupBy(*by).agg(metric(name).alias(name))


def result_row(folds: DataFrame, holdout: DataFrame) -> DataFrame:
    """Leaderboard rows: CV mean and deviation beside holdout F1, accuracy and AUC.

    ``folds`` is ``(model, fold, f1)``, ``holdout`` a long score table; models
    without scores have a missing AUC.
    """
    cv = folds.groupBy("model").agg(F.avg("f1").alias("cv_f1_mean"), F.stddev_pop("f1").alias("cv_f1_std"))
    held = holdout.groupBy("model").agg(f1_binary().alias("holdout_f1"), accuracy().alias("holdout_accuracy"))
    areas = roc_auc(holdout).withColumnRenamed("roc_auc", "holdout_roc_auc")
    return cv.join(held, "model").join(areas, "model", "left")


def search_results(folds: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rank, mean and deviation of each setting from ``(by, fold, test_f1, train_f1)``.

    Settings are bounded by the search space, so the ranking window is small.
    """
    from pyspark.sql.window import Window

    means = folds.groupBy(*by).agg(
        F.avg("test_f1").alias("mean_test_score"),
        F.stddev_pop("test_f1").alias("std_test_score"),
        F.avg("train_f1").alias("mean_train_score"),
    )
    # Fold order changes the last digits of a mean; ties are decided on 12 places.
    place = F.rank().over(Window.partitionBy(F.lit(1)).orderBy(F.round("mean_test_score", 12).desc()))
    return means.withColumn("rank_test_score", place)
