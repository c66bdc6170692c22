"""Splits, evaluation and ensembles over the scored events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelworks.functions.metrics import metric
from labelworks.operators import ensemble as N
from labelworks.operators import evaluate as L
from labelworks.operators import select as O
from labelworks.operators import split as P
from workload.registry import query
from workload.tables import (
    LONG_SQL,
    MODELS,
    PARTS_SQL,
    SCORES_SQL,
    WIDE_SQL,
    folds_sql,
    raw_scores,
    read,
    scores,
    six,
    wide,
)

# --- splits and samples ---


@query("stratified_split", f"WITH {WIDE_SQL}, {PARTS_SQL} SELECT row_id, label, part FROM parts")
def stratified_split(spark, sf):
    return P.stratified_split(wide(spark, sf).select("row_id", "label"), "label", "row_id")


def folded(spark, sf, k: int = 5) -> DataFrame:
    return P.stratified_kfold(wide(spark, sf), "label", "row_id", k)


@query("stratified_kfold", f"WITH {WIDE_SQL}, {folds_sql(5)} SELECT row_id, label, fold FROM folded")
def stratified_kfold(spark, sf):
    return folded(spark, sf).select("row_id", "label", "fold")


@query(
    "hashed_kfold",
    f"WITH {WIDE_SQL} SELECT row_id, label, CAST(CAST(concat('0x', substring(md5(concat('42|', row_id)), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold FROM wide",
)
def hashed_kfold(spark, sf):
    return P.hashed_kfold(wide(spark, sf).select("row_id", "label"), "row_id")


@query("fold_train_rows", f"WITH {WIDE_SQL}, {folds_sql(3)} SELECT row_id, value FROM folded WHERE fold <> 1")
def fold_train_rows(spark, sf):
    return P.fold_train_rows(folded(spark, sf, 3), 1).select("row_id", "value")


@query("fold_valid_rows", f"WITH {WIDE_SQL}, {folds_sql(3)} SELECT row_id, value FROM folded WHERE fold = 1")
def fold_valid_rows(spark, sf):
    return P.fold_valid_rows(folded(spark, sf, 3), 1).select("row_id", "value")


@query("bounded_sample", "SELECT event_id, value FROM events ORDER BY md5(concat('42|', event_id)), event_id LIMIT 200")
def bounded_sample(spark, sf):
    return P.bounded_sample(read(spark, sf, "events").select("event_id", "value"), "event_id", 200)


def _seats(table: str, key: str, repeats: int, columns: str) -> str:
    """Position of each row in the two numberings that make one permutation a repeat."""

    def numbered(side: str, picked: str) -> str:
        seat = f"concat(r, '|', {key})"
        return f"""SELECT r AS repeat, {picked}, row_number() OVER (PARTITION BY r
    ORDER BY md5(concat('42|{side}|', {seat})), {seat}) AS position FROM {table}, range(1, {repeats + 1}) t(r)"""

    return f"""here AS ({numbered('row', '*')}), there AS ({numbered('donor', columns)})"""


@query(
    "shuffle_column",
    f"""WITH ev AS (SELECT event_id, user_id, value FROM events), {_seats('ev', 'event_id', 2, 'value AS value_there')}
SELECT repeat, event_id, user_id, value_there AS value FROM here JOIN there USING (repeat, position)""",
)
def shuffle_column(spark, sf):
    return P.shuffle_column(read(spark, sf, "events").select("event_id", "user_id", "value"), "event_id", "value", 2)


# --- metrics ---

COUNTS_SQL = """counts AS (SELECT model, count(*) AS n, count(*) FILTER (label = 1 AND pred = 1) AS tp,
  count(*) FILTER (label = 0 AND pred = 1) AS fp, count(*) FILTER (label = 1 AND pred = 0) AS fn,
  count(*) FILTER (label = 0 AND pred = 0) AS tn FROM scores GROUP BY model)"""


@query("accuracy", f"WITH {SCORES_SQL}, {COUNTS_SQL} SELECT model, round((tp + tn) / n, 6) AS accuracy FROM counts")
def accuracy(spark, sf):
    return L.score_metrics(scores(spark, sf), names=["accuracy"]).select("model", six("accuracy"))


@query(
    "f1_binary",
    f"WITH {SCORES_SQL}, {COUNTS_SQL} SELECT model, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM counts",
)
def f1_binary(spark, sf):
    return L.score_metrics(scores(spark, sf), names=["f1"]).select("model", six("f1"))


@query(
    "confusion_matrix",
    f"""WITH {SCORES_SQL}, {COUNTS_SQL}
SELECT model, 0 AS label, 0 AS pred, tn AS n FROM counts UNION ALL SELECT model, 0, 1, fp FROM counts UNION ALL
SELECT model, 1, 0, fn FROM counts UNION ALL SELECT model, 1, 1, tp FROM counts""",
)
def confusion_matrix(spark, sf):
    return L.confusion_matrix(scores(spark, sf))


@query(
    "classification_report",
    f"""WITH {SCORES_SQL}, {COUNTS_SQL}, sides AS (
  SELECT model, n, '0' AS entry, tn / (tn + fn) AS p, tn / (tn + fp) AS r, 2 * tn / (2 * tn + fn + fp) AS f, tn + fp AS s FROM counts
  UNION ALL SELECT model, n, '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fn + fp), tp + fn FROM counts),
entries AS (
  SELECT model, entry, p, r, f, s FROM sides
  UNION ALL SELECT model, 'accuracy', (tp + tn) / n, (tp + tn) / n, (tp + tn) / n, n FROM counts
  UNION ALL SELECT model, 'macro avg', avg(p), avg(r), avg(f), any_value(n) FROM sides GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum(p * s) / any_value(n), sum(r * s) / any_value(n), sum(f * s) / any_value(n), any_value(n)
  FROM sides GROUP BY model)
SELECT model, entry, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s AS support FROM entries""",
)
def classification_report(spark, sf):
    out = L.classification_report(scores(spark, sf))
    return out.select("model", "entry", six("precision"), six("recall"), six("f1"), "support")


RUNS_SQL = """levels AS (SELECT model, score, sum(label) AS p, sum(1 - label) AS n FROM raw_scores GROUP BY 1, 2),
runs AS (SELECT model, score, p, n, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER (PARTITION BY model) AS pp,
  sum(n) OVER (PARTITION BY model) AS nn, lead(p) OVER o AS p_next, lead(n) OVER o AS n_next, row_number() OVER o AS place
  FROM levels WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  o AS (PARTITION BY model ORDER BY score DESC))"""


@query(
    "cumulative_hits",
    f"""WITH {LONG_SQL}, {RUNS_SQL} SELECT model, round(score, 6) AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp
FROM runs""",
)
def cumulative_hits(spark, sf):
    runs = L.cumulative_hits(raw_scores(spark, sf))
    tp, fp = F.col("p_before") + F.col("p"), F.col("n_before") + F.col("n")
    return runs.select("model", six("score"), tp.alias("tp"), fp.alias("fp"))


@query(
    "roc_curve",
    f"""WITH {LONG_SQL}, {RUNS_SQL}
SELECT model, round(fp / nn, 6) AS fpr, round(tp / pp, 6) AS tpr FROM runs
WHERE place = 1 OR p_next IS NULL OR p_next <> p OR n_next <> n
UNION ALL SELECT DISTINCT model, 0.0, 0.0 FROM runs""",
)
def roc_curve(spark, sf):
    return L.roc_curve(raw_scores(spark, sf)).select("model", six("fpr"), six("tpr"))


@query(
    "auc_trapezoid",
    f"""WITH {LONG_SQL}, {RUNS_SQL}, points AS (
  SELECT model, fp / nn AS x, tp / pp AS y FROM runs UNION ALL SELECT DISTINCT model, 0.0, 0.0 FROM runs),
steps AS (SELECT model, x - lag(x) OVER o AS dx, (y + lag(y) OVER o) / 2 AS my FROM points WINDOW o AS (PARTITION BY model ORDER BY x, y))
SELECT model, round(sum(dx * my), 6) AS auc FROM steps GROUP BY model""",
)
def auc_trapezoid(spark, sf):
    return L.auc_trapezoid(raw_scores(spark, sf)).select("model", six("auc"))


# The Mann-Whitney form: mean rank of the positives.
AUC_SQL = """ranked_scores AS (SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
  + (count(*) OVER (PARTITION BY model, score) - 1) / 2 AS r FROM {table}),
areas AS (SELECT model, (sum(r) FILTER (label = 1) - sum(label) * (sum(label) + 1) / 2) / (sum(label) * sum(1 - label)) AS auc
  FROM ranked_scores GROUP BY model)"""


@query("roc_auc", f"WITH {LONG_SQL}, {AUC_SQL.format(table='raw_scores')} SELECT model, round(auc, 6) AS roc_auc FROM areas")
def roc_auc(spark, sf):
    return L.roc_auc(raw_scores(spark, sf)).select("model", six("roc_auc"))


FOLD_SCORES_SQL = f"""{SCORES_SQL}, {folds_sql(5)},
fold_f1 AS (SELECT model, fold, 2 * count(*) FILTER (s.label = 1 AND pred = 1)
  / (count(*) FILTER (s.label = 1) + count(*) FILTER (pred = 1)) AS f1
  FROM scores s JOIN folded USING (row_id) GROUP BY 1, 2)"""


def fold_f1(spark, sf) -> DataFrame:
    folds = folded(spark, sf).select("row_id", "fold")
    return L.fold_scores(scores(spark, sf).join(folds, "row_id"))


@query("fold_scores", f"WITH {FOLD_SCORES_SQL} SELECT model, fold, round(f1, 6) AS f1 FROM fold_f1")
def fold_scores(spark, sf):
    return fold_f1(spark, sf).select("model", "fold", six("f1"))


RESULT_SQL = f"""{FOLD_SCORES_SQL}, {PARTS_SQL.replace('class_counts', 'part_counts')},
held AS (SELECT s.* FROM scores s JOIN parts USING (row_id) WHERE part = 'test'), {AUC_SQL.format(table='held')},
held_counts AS (SELECT model, 2 * count(*) FILTER (label = 1 AND pred = 1) / (count(*) FILTER (label = 1) + count(*) FILTER (pred = 1)) AS f1,
  avg(CASE WHEN label = pred THEN 1 ELSE 0 END) AS acc FROM held GROUP BY model),
results AS (
  SELECT model, round(avg(fold_f1.f1), 6) AS cv_f1_mean, round(stddev_pop(fold_f1.f1), 6) AS cv_f1_std,
    round(any_value(held_counts.f1), 6) AS holdout_f1, round(any_value(acc), 6) AS holdout_accuracy,
    round(any_value(auc), 6) AS holdout_roc_auc
  FROM fold_f1 JOIN held_counts USING (model) JOIN areas USING (model) GROUP BY model)"""


def results(spark, sf) -> DataFrame:
    parts = P.stratified_split(wide(spark, sf).select("row_id", "label"), "label", "row_id")
    held = scores(spark, sf).join(parts.where(F.col("part") == "test").select("row_id"), "row_id")
    out = L.result_row(fold_f1(spark, sf), held)
    return out.select("model", *[six(c) for c in out.columns[1:]])


@query("result_row", f"WITH {RESULT_SQL} SELECT * FROM results")
def result_row(spark, sf):
    return results(spark, sf)


@query("leaderboard", f"WITH {RESULT_SQL} SELECT * FROM results ORDER BY holdout_f1 DESC, cv_f1_mean DESC, model")
def leaderboard(spark, sf):
    return O.leaderboard(results(spark, sf))


@query("best_model", f"WITH {RESULT_SQL} SELECT * FROM results ORDER BY holdout_f1 DESC, cv_f1_mean DESC, model LIMIT 1")
def best_model(spark, sf):
    return O.best_model(results(spark, sf))


# A search over cut-offs of one score: every setting is a rule model.
CUTS = (10.0, 20.0, 30.0, 40.0, 60.0, 80.0)


def cut_scores(spark, sf) -> DataFrame:
    """``cut, fold, test_f1, train_f1`` from one aggregate of conditional sums per fold."""
    table = folded(spark, sf, 3)
    sums: list[Column] = [F.sum("label").alias("pos")]
    for i, cut in enumerate(CUTS):
        said = F.col("value") >= cut
        sums += [F.sum(F.when(said, F.col("label")).otherwise(0)).alias(f"tp{i}"), F.count_if(said).alias(f"said{i}")]
    per_fold = table.groupBy("fold").agg(*sums)
    rows = F.array(
        *[F.struct(F.lit(c).alias("cut"), F.col(f"tp{i}").alias("tp"), F.col(f"said{i}").alias("said")) for i, c in enumerate(CUTS)]
    )
    counts = per_fold.select("fold", "pos", F.explode(rows).alias("_r")).select("fold", "pos", "_r.*")
    whole = counts.groupBy("cut").agg(*[F.sum(c).alias(f"all_{c}") for c in ("tp", "said", "pos")])
    test = 2 * F.col("tp") / (F.col("said") + F.col("pos"))
    train = 2 * (F.col("all_tp") - F.col("tp")) / (F.col("all_said") - F.col("said") + F.col("all_pos") - F.col("pos"))
    return counts.join(whole, "cut").select("cut", "fold", test.alias("test_f1"), train.alias("train_f1"))


CUT_SQL = f"""{WIDE_SQL}, {folds_sql(3)}, settings AS (SELECT unnest({list(CUTS)}) AS cut),
cut_scores AS (SELECT CAST(cut AS DOUBLE) AS cut, k AS fold,
  2 * sum(label) FILTER (fold = k AND value >= cut) / (count(*) FILTER (fold = k AND value >= cut) + sum(label) FILTER (fold = k)) AS test_f1,
  2 * sum(label) FILTER (fold <> k AND value >= cut) / (count(*) FILTER (fold <> k AND value >= cut) + sum(label) FILTER (fold <> k)) AS train_f1
  FROM folded, settings, range(3) t(k) GROUP BY 1, 2)"""


@query(
    "search_results",
    f"""WITH {CUT_SQL}, means AS (SELECT cut, avg(test_f1) AS m, stddev_pop(test_f1) AS s, avg(train_f1) AS t FROM cut_scores GROUP BY cut)
SELECT cut, round(m, 6) AS mean_test_score, round(s, 6) AS std_test_score, round(t, 6) AS mean_train_score,
rank() OVER (ORDER BY round(m, 12) DESC) AS rank_test_score FROM means ORDER BY rank_test_score""",
)
def search_results(spark, sf):
    out = L.search_results(cut_scores(spark, sf), ["cut"])
    measures = [six(c) for c in ("mean_test_score", "std_test_score", "mean_train_score")]
    return out.select("cut", *measures, F.col("rank_test_score").cast("long").alias("rank_test_score")).orderBy("rank_test_score")


@query(
    "balanced_weights",
    f"""WITH {WIDE_SQL}, c AS (SELECT label, count(*) AS n FROM wide GROUP BY label)
SELECT row_id, label, round((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 6) AS weight FROM wide JOIN c USING (label)""",
)
def balanced_weights(spark, sf):
    from labelworks.plans.families import balanced_weights as weigh

    return weigh(wide(spark, sf).select("row_id", "label"), "label").select("row_id", "label", six("weight"))


# --- ensembles ---


@query(
    "probability_like",
    f"WITH {SCORES_SQL} SELECT row_id, model, round(score, 6) AS score FROM likely",
)
def probability_like(spark, sf):
    return N.probability_like(raw_scores(spark, sf)).select("row_id", "model", six("score"))


@query("prediction_frame", f"WITH {SCORES_SQL} SELECT row_id, model, round(score, 6) AS score, pred FROM scores")
def prediction_frame(spark, sf):
    return scores(spark, sf).select("row_id", "model", six("score"), "pred")


WIDEN_SQL = ", ".join(
    f"round(max(score) FILTER (model = '{m}'), 6) AS {m}_score, max(pred) FILTER (model = '{m}') AS {m}_pred" for m in MODELS
)


@query("widen_scores", f"WITH {SCORES_SQL} SELECT row_id, {WIDEN_SQL} FROM scores GROUP BY row_id")
def widen_scores(spark, sf):
    out = O.widen_scores(scores(spark, sf), "row_id", MODELS)
    return out.select("row_id", *[six(c) if c.endswith("score") else c for c in out.columns[1:]])


# Weights in proportion to the mean score of each model: they come from the table.
MODEL_WEIGHTS_SQL = """given AS (SELECT model, round(avg(score), 6) AS weight FROM likely GROUP BY model),
weights AS (SELECT model, weight / (SELECT sum(weight) FROM given) AS weight FROM given)"""


def model_weights(spark, sf) -> DataFrame:
    long = N.probability_like(raw_scores(spark, sf))
    given = long.groupBy("model").agg(F.round(F.avg("score"), 6).alias("weight"))
    return N.normalize_weights(long.select("model"), given)


@query("normalize_weights", f"WITH {SCORES_SQL}, {MODEL_WEIGHTS_SQL} SELECT model, round(weight, 6) AS weight FROM weights")
def normalize_weights(spark, sf):
    return model_weights(spark, sf).select("model", six("weight"))


@query(
    "equal_weights",
    f"WITH {LONG_SQL} SELECT model, round(1 / (SELECT count(DISTINCT model) FROM raw_scores), 6) AS weight FROM raw_scores GROUP BY model",
)
def equal_weights(spark, sf):
    return N.normalize_weights(raw_scores(spark, sf).select("model")).select("model", six("weight"))


RANKED_SQL = """(SELECT *, (rank() OVER (PARTITION BY model ORDER BY score) + (count(*) OVER (PARTITION BY model, score) - 1) / 2)
  / count(*) OVER (PARTITION BY model) AS rp FROM scores)"""
VOTES = {
    "hard_vote": ("avg(pred)", "scores"),
    "weighted_hard_vote": ("sum(weight * pred) / sum(weight)", "scores JOIN weights USING (model)"),
    "soft_vote": ("avg(score)", "scores"),
    "weighted_soft_vote": ("sum(weight * score) / sum(weight)", "scores JOIN weights USING (model)"),
    "median_soft_vote": ("median(score)", "scores"),
    "rank_average": ("avg(rp)", RANKED_SQL),
}


def _vote_sql(kind: str) -> str:
    score, source = VOTES[kind]
    return f"""WITH {SCORES_SQL}, {MODEL_WEIGHTS_SQL}, votes AS (SELECT row_id, round({score}, 12) AS v FROM {source} GROUP BY row_id)
SELECT row_id, round(v, 6) AS ensemble_score, CASE WHEN v >= 0.5 THEN 1 ELSE 0 END AS ensemble_pred FROM votes"""


def _register_vote(kind: str) -> None:
    @query(kind, _vote_sql(kind))
    def vote(spark, sf):
        weights = model_weights(spark, sf) if kind.startswith("weighted") else None
        return N.ensemble(scores(spark, sf), kind, weights).select("row_id", six("ensemble_score"), "ensemble_pred")


for _kind in VOTES:
    _register_vote(_kind)


@query(
    "ensemble",
    f"""WITH {SCORES_SQL}, votes AS (SELECT row_id, round(avg(score), 12) AS v FROM scores GROUP BY row_id)
SELECT row_id, round(v, 6) AS ensemble_score, CASE WHEN v >= 0.7 THEN 1 ELSE 0 END AS ensemble_pred FROM votes""",
)
def ensemble(spark, sf):
    return N.ensemble(scores(spark, sf), "soft_vote", at=0.7).select("row_id", six("ensemble_score"), "ensemble_pred")


@query(
    "ensemble_details",
    f"""WITH {SCORES_SQL}, votes AS (SELECT row_id, round(avg(score), 12) AS v FROM scores GROUP BY row_id)
SELECT row_id, {WIDEN_SQL}, round(any_value(v), 6) AS ensemble_score, CASE WHEN any_value(v) >= 0.5 THEN 1 ELSE 0 END AS ensemble_pred
FROM scores JOIN votes USING (row_id) GROUP BY row_id""",
)
def ensemble_details(spark, sf):
    long = scores(spark, sf)
    out = N.ensemble_details(long, N.ensemble(long), MODELS)
    return out.select("row_id", *[six(c) if c.endswith("score") else c for c in out.columns[1:]])


@query(
    "weighted_blend",
    f"WITH {WIDE_SQL} SELECT row_id, label, round(0.33 * m1 + 0.33 * m2 + 0.34 * m3, 6) AS score FROM wide",
)
def weighted_blend(spark, sf):
    return N.weighted_blend(wide(spark, sf), MODELS).select("row_id", "label", six("score"))


@query(
    "weighted_blend_auc",
    f"""WITH {WIDE_SQL}, blended AS (SELECT 'blend' AS model, label, round(0.33 * m1 + 0.33 * m2 + 0.34 * m3, 9) AS score FROM wide),
{AUC_SQL.format(table='blended')} SELECT model, round(auc, 6) AS roc_auc FROM areas""",
)
def weighted_blend_auc(spark, sf):
    blended = N.weighted_blend(wide(spark, sf), MODELS).select(
        F.lit("blend").alias("model"), "label", F.round("score", 9).alias("score")
    )
    return L.roc_auc(blended).select("model", six("roc_auc"))
