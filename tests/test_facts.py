"""The facts that queries return of fitted models fail for constant and shuffled predictors."""

import pytest
from pyspark.sql import functions as F

from labelworks.plans import trees as T
from labelworks.plans.families import FAMILIES, fit_family, score_table
from tests.test_models import numeric_table
from workload import modelling as W


@pytest.fixture(scope="module")
def fitted(spark):
    df, _, _ = numeric_table(spark, 240, 4, seed=3)
    model = fit_family(FAMILIES["decision_tree"], {"max_depth": 4}, df, 240)
    return df, model, score_table(model, df, "decision_tree", ["row_id", "label"]).persist()


def swapped(scored):
    constant = scored.withColumn("score", F.lit(0.7)).withColumn("pred", F.lit(1))
    order = scored.select(F.pmod(F.xxhash64("row_id"), F.lit(1 << 30)).alias("h"), "score", "pred").orderBy("h").collect()
    rows = scored.select("row_id", "label").orderBy("row_id").collect()
    shuffled = scored.sparkSession.createDataFrame([(r.row_id, r.label, "decision_tree", o.score, o.pred) for r, o in zip(rows, order)], "row_id long, label long, model string, score double, pred int")
    return constant, shuffled


def test_scores_must_order_the_labels(fitted):
    _, _, scored = fitted
    assert W.beats_chance(scored)
    facts = W.sound(scored, "row_id", "label")
    assert W.orderly(facts, scored).where("not sound").count() == 0
    for other in swapped(scored):
        assert not W.beats_chance(other)
        # the range and the decision are right, and still no row is sound
        assert W.orderly(W.sound(other, "row_id", "label"), other).where("sound").count() == 0


def test_the_node_table_must_give_the_scores(fitted, monkeypatch):
    df, model, scored = fitted
    assert W.table_agrees(model, df)
    for other in swapped(scored):
        monkeypatch.setattr(W, "score_table", lambda *_, other=other: other)
        assert not W.table_agrees(model, df)
        monkeypatch.undo()
    pruned = T.trees_of(df.sparkSession, fit_family(FAMILIES["decision_tree"], {"max_depth": 2}, df, 240))
    monkeypatch.setattr(W.T, "trees_of", lambda *_: pruned)
    assert not W.table_agrees(model, df)
