"""Preparation for every left-out fold from one pass of statistics.

Each row goes to the k - 1 fits that do not leave it out, map-side, and every statistic is
an aggregate by left-out fold: jobs and scans are as many as for one fit, and what is
shuffled are partial sketches, moments and category counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.operators.quantiles import exact_quantiles
from labelworks.operators.select import select_by_type
from labelworks.plans.stages import NO_VALUE, FillModel, PopulationScalerModel, TabularEncoder, TitleFeatures

LEFT = "_left"


def without_each_fold(df: DataFrame, k: int, fold: str = "fold") -> DataFrame:
    """Every row once for each fold it is not in, named by ``_left``; rows without a fold go nowhere."""
    others = F.filter(F.array(*[F.lit(f) for f in range(k)]), lambda f: f != F.col(fold))
    return df.select("*", F.explode(others).alias(LEFT))


def _lookup(values: dict[int, float]) -> Any:
    return F.create_map(*[F.lit(x) for f, v in values.items() for x in (f, v)])[F.col(LEFT)]


def _numeric(rows: DataFrame, columns: list[str], k: int) -> list[list[Any]]:
    """Imputation by the median, then scaling, as fitted on the rows of each left-out fold."""
    found = {(r[LEFT], r["column"]): r["value"] for r in exact_quantiles(rows, columns, [0.5], [LEFT]).collect()}
    fills = {c: {f: found.get((f, c), 0.0) for f in range(k)} for c in columns}
    moments = []
    for i, c in enumerate(columns):
        filled = F.coalesce(F.col(c), _lookup(fills[c]))
        moments += [F.avg(filled).alias(f"m_{i}"), F.stddev_pop(filled).alias(f"s_{i}")]
    stats = {r[LEFT]: r for r in rows.groupBy(LEFT).agg(*moments).collect()}
    out = []
    for f in range(k):
        fill = FillModel()._set(inputCols=columns, fills={c: fills[c][f] for c in columns})
        means = {c: stats[f][f"m_{i}"] or 0.0 for i, c in enumerate(columns)}
        deviations = {c: stats[f][f"s_{i}"] or 1.0 for i, c in enumerate(columns)}
        out.append([fill, PopulationScalerModel()._set(inputCols=columns, means=means, deviations=deviations)])
    return out


def _text(rows: DataFrame, columns: list[str], k: int) -> list[list[Any]]:
    """Imputation by the mode, then indexing in order, from the category counts of each fold."""
    long = rows.select(LEFT, F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in columns])).alias("_s"))
    counts = long.where(F.col("_s.v").isNotNull()).groupBy(LEFT, "_s.c", "_s.v").agg(F.count(F.lit(1)).alias("n")).collect()
    seen: dict[tuple[int, str], list[tuple[int, str]]] = {}
    for r in counts:
        seen.setdefault((r[LEFT], r["c"]), []).append((-r["n"], r["v"]))
    out = []
    for f in range(k):
        modes = {c: min(seen[f, c])[1] if (f, c) in seen else NO_VALUE for c in columns}
        labels = {c: sorted({v for _, v in seen.get((f, c), [])} | {modes[c]}) for c in columns}
        index = [StringIndexerModel.from_labels(labels[c], inputCol=c, outputCol=f"_at_{c}", handleInvalid="keep") for c in columns]
        out.append([FillModel()._set(inputCols=columns, fills=modes), *index])
    return out


def fit_without_each_fold(df: DataFrame, k: int, feature_stages: Sequence[Any], encoder: TabularEncoder, fold: str = "fold") -> list[PipelineModel] | None:
    """Feature stages and encoder as fitted on all rows but those of fold 0, 1, ..., k - 1.

    None where that needs a fit of its own for each fold: a stage that cannot learn by
    group, or a column with more categories than the encoder takes unhashed.
    """
    rows, heads = without_each_fold(df, k, fold), [[] for _ in range(k)]
    for stage in feature_stages:
        if not isinstance(stage, TitleFeatures):
            return None
        models, rows = stage.fit_groups(rows, LEFT, list(range(k)))
        for head, model in zip(heads, models, strict=True):
            head.append(model)
    numeric, text = select_by_type(rows.drop(LEFT, *encoder.getOrDefault(encoder.excludeCols)))
    if text:
        counts = rows.groupBy(LEFT).agg(*[F.approx_count_distinct(c).alias(c) for c in text]).collect()
        if any(r[c] > encoder.getOrDefault(encoder.maxCategories) for r in counts for c in text):
            return None
    stages = [[] for _ in range(k)]
    if numeric:
        stages = [s + n for s, n in zip(stages, _numeric(rows, numeric, k), strict=True)]
    if text:
        stages = [s + t for s, t in zip(stages, _text(rows, text, k), strict=True)]
    blocks = [f"num__{c}" for c in numeric] + [f"cat__{c}" for c in text]
    out = []
    for f in range(k):
        if text:
            # the indexer's output says how many categories there are: no job
            hot = OneHotEncoder(inputCols=[f"_at_{c}" for c in text], outputCols=[f"cat__{c}" for c in text], dropLast=True)
            stages[f].append(hot.fit(PipelineModel(stages[f]).transform(rows.drop(LEFT))))
        stages[f].append(VectorAssembler(inputCols=blocks, outputCol="features"))
        out.append(PipelineModel([*heads[f], PipelineModel(stages[f])]))
    return out
