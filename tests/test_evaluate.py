import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelworks.operators import ensemble as N
from labelworks.operators import evaluate as L

QUICK = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def long(spark, model, labels, scores):
    pdf = pd.DataFrame({"row_id": range(len(labels)), "model": model, "label": labels, "score": scores})
    return spark.createDataFrame(pdf).withColumn("pred", (F.col("score") >= 0.5).cast("int"))


def pairs_won(labels, scores):
    """AUC by its definition: share of pairs won, ties half."""
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


@QUICK
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.2, 0.5, 0.8, 1.0])), min_size=4, max_size=40))
def test_auc_forms_agree(spark, rows):
    labels, scores = [1, 0] + [y for y, _ in rows], [0.6, 0.6] + [s for _, s in rows]
    table = long(spark, "m", labels, scores)
    want = pairs_won(labels, scores)
    assert L.roc_auc(table).first()["roc_auc"] == pytest.approx(want)
    assert L.auc_trapezoid(table).first()["auc"] == pytest.approx(want)


def test_auc_with_a_hot_score(spark):
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 2, 3000)
    scores = np.round(rng.random(3000), 3)
    scores[:1000] = 0.25
    got = L.roc_auc(long(spark, "m", labels, scores)).first()["roc_auc"]
    assert got == pytest.approx(pairs_won(labels, scores))


def test_one_class_has_no_auc(spark):
    assert L.roc_auc(long(spark, "m", [1, 1], [0.2, 0.8])).first()["roc_auc"] is None
    assert L.auc_trapezoid(long(spark, "m", [1, 1], [0.2, 0.8])).count() == 0


def test_roc_curve_drops_collinear_points(spark):
    table = long(spark, "m", [1, 1, 1, 0, 0, 0], [0.9, 0.8, 0.7, 0.6, 0.5, 0.4])
    full = L.roc_curve(table, drop_collinear=False).orderBy("fpr", "tpr").toPandas()
    bent = L.roc_curve(table).orderBy("fpr", "tpr").toPandas()
    assert len(full) == 7
    third = 1 / 3
    assert [tuple(r) for r in bent[["fpr", "tpr"]].round(6).to_numpy()] == [
        (0, 0),
        (0, round(third, 6)),
        (0, 1),
        (1, 1),
    ]
    assert (full["fpr"].diff().dropna() >= 0).all() and (full["tpr"].diff().dropna() >= 0).all()


def test_metrics_by_hand(spark):
    table = long(spark, "m", [1, 1, 1, 0, 0], [0.9, 0.8, 0.1, 0.7, 0.2])
    row = L.score_metrics(table, names=["f1", "accuracy", "precision", "recall"]).first()
    assert (row["f1"], row["accuracy"]) == (pytest.approx(2 / 3), pytest.approx(0.6))
    assert (row["precision"], row["recall"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    none = long(spark, "m", [0, 0], [0.1, 0.2])
    assert L.score_metrics(none).first()["f1"] == 0.0
    cells = {(r["label"], r["pred"]): r["n"] for r in L.confusion_matrix(none).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 0}
    with pytest.raises(ValueError):
        L.score_metrics(table, names=["nonsense"])


def test_report_has_all_entries(spark):
    table = long(spark, "m", [1, 1, 1, 0, 0], [0.9, 0.8, 0.1, 0.7, 0.2])
    rows = {r["entry"]: r for r in L.classification_report(table).collect()}
    assert set(rows) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert rows["weighted avg"]["recall"] == pytest.approx(0.6) and rows["1"]["support"] == 3


def scores(spark):
    rows = [(i, m, s) for i in range(4) for m, s in (("a", [0.5, 0.2, 0.9, 0.4][i]), ("b", [0.1, 0.6, 0.8, 0.4][i]))]
    return N.prediction_frame(spark.createDataFrame(rows, "row_id int, model string, score double"))


def votes(spark, kind, **options):
    return {r["row_id"]: (r["ensemble_score"], r["ensemble_pred"]) for r in N.ensemble(scores(spark), kind, **options).collect()}


def test_votes(spark):
    # A tie of two hard votes reaches 0.5 and counts as 1.
    assert votes(spark, "hard_vote") == {0: (0.5, 1), 1: (0.5, 1), 2: (1.0, 1), 3: (0.0, 0)}
    assert votes(spark, "soft_vote")[1] == (0.4, 0)
    equal = {"a": 1.0, "b": 1.0}
    assert votes(spark, "weighted_soft_vote", weights=equal) == votes(spark, "soft_vote")
    assert votes(spark, "weighted_hard_vote", weights={"a": 3.0, "b": 1.0})[1] == (0.25, 0)
    assert votes(spark, "median_soft_vote") == votes(spark, "soft_vote")
    assert votes(spark, "rank_average")[2] == (1.0, 1)
    # Hard votes were taken at 0.5; the threshold applies to their mean.
    assert votes(spark, "hard_vote", at=0.6)[0] == (0.5, 0)
    with pytest.raises(ValueError, match="unsupported"):
        votes(spark, "majority")


def test_votes_of_one_model_agree(spark):
    single = scores(spark).where("model = 'a'")
    for kind in ("hard_vote", "soft_vote", "median_soft_vote", "weighted_soft_vote"):
        got = {r["row_id"]: r["ensemble_pred"] for r in N.ensemble(single, kind).collect()}
        assert got == {0: 1, 1: 0, 2: 1, 3: 0}


def test_probability_like(spark):
    rows = [(1, "p", 0.2, 0), (1, "m", -3.0, 0), (2, "m", 0.5, 1), (1, "n", None, 1), (1, "x", float("nan"), 1)]
    df = spark.createDataFrame(rows, "row_id int, model string, score double, pred int")
    got = {(r["row_id"], r["model"]): r["score"] for r in N.probability_like(df).collect()}
    assert got[1, "p"] == 0.2 and got[1, "n"] == 1.0
    assert got[2, "m"] == pytest.approx(1 / (1 + np.exp(-0.5)))
    kept = {r["model"]: r["score"] for r in N.probability_like(df.where("model = 'm'"), "probability").collect()}
    assert kept["m"] in (-3.0, 0.5)


def test_weights(spark):
    votes = spark.createDataFrame([(1, "a", 0.2, 0), (1, "b", 0.9, 1)], "row_id int, model string, score double, pred int")
    one = spark.createDataFrame([("a", 1.0)], "model string, weight double")
    for kind in ("weighted_soft_vote", "weighted_hard_vote"):
        for weights in ({"a": 1.0}, one):
            with pytest.raises(Exception, match="no weight for model b"):
                N.ensemble(votes, kind, weights).collect()
    models = spark.createDataFrame([("a",), ("b",)], "model string")

    def given(*rows):
        return N.normalize_weights(models, spark.createDataFrame(rows, "model string, weight double"))

    assert {r[0]: r[1] for r in given(("a", 1.0), ("b", 3.0)).collect()} == {"a": 0.25, "b": 0.75}
    for rows in ([("a", 1.0)], [("a", 1.0), ("b", -1.0)], [("a", 0.0), ("b", 0.0)], [("a", 1.0), ("b", 1.0), ("c", 1.0)]):
        with pytest.raises(Exception, match="weight"):
            given(*rows).collect()


def test_streams_are_refused(spark):
    stream = spark.readStream.format("rate").load().selectExpr("value AS row_id", "'m' AS model", "0.5D AS score", "1 AS pred")
    for call in (N.probability_like, lambda s: N.ensemble(s, "rank_average"), lambda s: L.roc_auc(s.withColumn("label", F.lit(1)))):
        with pytest.raises(ValueError, match="stream"):
            call(stream)
