"""Combining models: long score tables in, one score and decision per row out.

The long table ``(row_id, model, score[, pred])`` needs one shuffle on ``row_id``
for any vote, whatever the number of models.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelworks.functions.scalar import sigmoid_clipped, threshold
from labelworks.operators.keep import keep
from labelworks.operators.order import rank_pct_average
from labelworks.operators.select import widen_scores
from labelworks.streaming.guard import require_batch

# The names of the options.
KINDS = ("hard_vote", "soft_vote", "weighted_soft_vote", "weighted_hard_vote", "rank_average", "median_soft_vote")


def probability_like(long: DataFrame, kind: str = "auto") -> DataFrame:
    """Bring scores to [0, 1].

    ``auto`` keeps the scores of a model when all of them lie in [0, 1] and passes
    all of them through the clipped sigmoid otherwise, so the result depends on
    the batch; ``probability`` and ``margin`` say which it is. Where a score is
    missing, the 0/1 prediction stands in if the table has one.
    """
    if kind not in ("auto", "probability", "margin"):
        raise ValueError(f"unknown kind {kind!r}")
    score = F.col("score").cast("double")
    given = long.withColumn("score", score)
    if kind == "margin":
        given = given.withColumn("score", sigmoid_clipped("score"))
    elif kind == "auto":
        require_batch(long, "probability_like")
        inside = F.coalesce(F.bool_and((F.col("score") >= 0) & (F.col("score") <= 1)), F.lit(True))
        kinds = keep(given.where(F.col("score").isNotNull()).groupBy("model").agg(inside.alias("_inside")))
        kept = F.when(F.coalesce("_inside", F.lit(True)), F.col("score")).otherwise(sigmoid_clipped("score"))
        given = given.join(kinds, "model", "left").withColumn("score", kept)
    if "pred" in long.columns:
        given = given.withColumn("score", F.coalesce("score", F.col("pred").cast("double")))
    return given.select(*long.columns)


def prediction_frame(long: DataFrame, kind: str = "auto") -> DataFrame:
    """Probability-like score of each model and its own decision at 0.5."""
    return probability_like(long, kind).withColumn("pred", threshold("score", 0.5))


def normalize_weights(models: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """``model, weight`` with weights divided by their total; equal when none are given.

    Fails unless every model has exactly one weight, none is negative and the
    total is not zero.
    """
    names = models.select("model").distinct()
    if weights is None:
        n = names.agg(F.count(F.lit(1))).scalar()
        return names.withColumn("weight", F.lit(1.0) / n)
    given = names.join(weights.select("model", F.col("weight").cast("double")), "model", "left")
    extra = weights.join(names, "model", "left_anti").agg(F.count(F.lit(1))).scalar()
    checks = given.agg(
        F.struct(
            F.sum("weight").alias("total"),
            F.count_if(F.col("weight").isNull()).alias("absent"),
            F.count_if(F.col("weight") < 0).alias("negative"),
            (F.count(F.lit(1)) - F.count_distinct("model")).alias("repeated"),
        ).alias("checks")
    ).scalar()
    checked = given.withColumn("_c", checks).withColumn("_extra", extra)
    c = F.col("_c")
    weight = (
        F.when((c["absent"] > 0) | (c["repeated"] > 0) | (F.col("_extra") > 0), F.raise_error(F.lit("expected one weight per model")).cast("double"))
        .when(c["negative"] > 0, F.raise_error(F.lit("weights must be non-negative")).cast("double"))
        .when(c["total"] == 0, F.raise_error(F.lit("weights must not sum to zero")).cast("double"))
        .otherwise(F.col("weight") / c["total"])
    )
    return checked.select("model", weight.alias("weight"))


def _weighted(long: DataFrame, weights: Mapping[str, float] | DataFrame | None) -> tuple[DataFrame, Column]:
    """The table with each row's weight; a model without one fails the query."""
    if weights is None:
        return long, F.lit(1.0)
    if isinstance(weights, DataFrame):
        long = long.join(keep(weights.select("model", F.col("weight").alias("_w"))), "model", "left")
    else:
        table = F.create_map(*[x for m, w in weights.items() for x in (F.lit(m), F.lit(float(w)))])
        long = long.withColumn("_w", table[F.col("model")])
    lost = F.raise_error(F.concat(F.lit("no weight for model "), F.coalesce("model", F.lit("<missing>")))).cast("double")
    return long, F.when(F.col("_w").isNull(), lost).otherwise(F.col("_w"))


def ensemble(
    long: DataFrame,
    kind: str = "soft_vote",
    weights: Mapping[str, float] | DataFrame | None = None,
    at: float = 0.5,
    key: str = "row_id",
) -> DataFrame:
    """One row per ``key`` with ``ensemble_score`` and ``ensemble_pred``.

    Expects the output of :func:`prediction_frame`. Hard votes count decisions
    that each model took at 0.5, whatever ``at`` says. Weights matter only for
    the weighted kinds. ``rank_average`` depends on the whole batch.
    """
    if kind not in KINDS:
        raise ValueError(f"unsupported ensemble type {kind!r}; known: {KINDS}")
    require_batch(long, kind) if kind == "rank_average" else None
    w = F.lit(1.0)
    if kind.startswith("weighted"):
        long, w = _weighted(long, weights)
    if kind == "rank_average":
        long = rank_pct_average(long, "score", ["model"], "_rank")
    score = {
        "hard_vote": F.avg("pred"),
        "weighted_hard_vote": F.sum(w * F.col("pred")) / F.sum(w),
        "soft_vote": F.avg("score"),
        "weighted_soft_vote": F.sum(w * F.col("score")) / F.sum(w),
        "median_soft_vote": F.median("score"),
        "rank_average": F.avg("_rank") if kind == "rank_average" else None,
    }[kind]
    # Sums of binary fractions may fall just below a tie; 12 places restore it.
    votes = long.groupBy(key).agg(F.round(score, 12).alias("ensemble_score"))
    return votes.withColumn("ensemble_pred", threshold("ensemble_score", at))


def ensemble_details(long: DataFrame, votes: DataFrame, models: Sequence[str], key: str = "row_id") -> DataFrame:
    """Wide table: each model's score and decision beside the ensemble's."""
    return widen_scores(long, key, models).join(votes, key)


def weighted_blend(wide: DataFrame, models: Sequence[str], weights: Sequence[float] = (0.33, 0.33, 0.34)) -> DataFrame:
    """Add ``score``: the plain weighted sum of the model columns."""
    from labelworks.functions.scalar import weighted_sum

    return wide.withColumn("score", weighted_sum(models, weights))
