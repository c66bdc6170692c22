"""Ridge classifiers of many settings from one pass over the rows of all folds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.operators.moments import cross_products

#: Rows that a row of a fitting sample stands for.
FIT_WEIGHT = "fit_weight"


def ridge_coefficients(products: Mapping[int, np.ndarray], alpha: float, balanced: bool = False) -> tuple[float, np.ndarray]:
    """Intercept and coefficients of least squares on labels -1 and 1 with penalty alpha.

    ``products`` has the cross products of (1, features) for each class; with ``balanced``
    a class counts n / (classes x its rows).
    """
    total = sum(m[0, 0] for m in products.values())
    weight = {c: total / (len(products) * m[0, 0]) if balanced else 1.0 for c, m in products.items()}
    whole = sum(weight[c] * m for c, m in products.items())
    signed = sum(weight[c] * (1.0 if c == 1 else -1.0) * m[0] for c, m in products.items())
    n, means, mean = whole[0, 0], whole[0, 1:] / whole[0, 0], signed[0] / whole[0, 0]
    inner = whole[1:, 1:] - n * np.outer(means, means)
    slopes = np.linalg.solve(inner + alpha * np.eye(len(means)), signed[1:] - n * mean * means)
    return float(mean - means @ slopes), slopes


def ridge_path(trains: Sequence[DataFrame], settings: Sequence[Mapping[str, Any]]) -> list[list[tuple[float, np.ndarray]]]:
    """For each table and each setting (``alpha``, ``class_weight``) the fitted intercept and
    coefficients: one scan of all tables, then a solve at the size of the features each."""
    # The rows of a sample weigh alike within a class, so the weight is part of the group.
    each = [F.col(FIT_WEIGHT) if FIT_WEIGHT in t.columns else F.lit(1.0) for t in trains]
    tagged = [t.select(F.lit(i).alias("_table"), F.col("label").cast("int").alias("label"), w.alias("_w"), "features") for i, (t, w) in enumerate(zip(trains, each, strict=True))]
    every = tagged[0]
    for other in tagged[1:]:
        every = every.unionByName(other)
    found = cross_products(every, ["_table", "label", "_w"])
    out = []
    for i in range(len(trains)):
        products = {}
        for (table, label, weight), m in found.items():
            if table == i:
                products[label] = products.get(label, 0) + weight * m
        out.append([ridge_coefficients(products, p["alpha"], p.get("class_weight") == "balanced") for p in settings])
    return out


def margins(encoded: DataFrame, fitted: Sequence[tuple[float, np.ndarray]], columns: Sequence[str]) -> DataFrame:
    """``columns..., at, score, pred``: the margins of several linear models, one pass."""
    rows = [(i, b, w.tolist()) for i, (b, w) in enumerate(fitted)]
    models = encoded.sparkSession.createDataFrame([(rows,)], "m array<struct<at: int, b: double, w: array<double>>>").scalar()
    x = vector_to_array("features")
    score = F.aggregate(F.zip_with("_m.w", "_x", lambda a, b: a * b), F.col("_m.b"), lambda t, v: t + v)
    long = encoded.select(*columns, x.alias("_x"), F.explode(models).alias("_m")).select(*columns, F.col("_m.at").alias("at"), score.alias("score"))
    return long.withColumn("pred", (F.col("score") > 0).cast("int"))
