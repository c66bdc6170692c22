"""Classification metrics as aggregate columns, so any grouping can use them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _hits(label: str, pred: str, y: int, p: int) -> Column:
    return F.count_if((F.col(label) == y) & (F.col(pred) == p)).cast("double")


def accuracy(label: str = "label", pred: str = "pred") -> Column:
    return F.avg((F.col(label) == F.col(pred)).cast("double"))


def precision(label: str = "label", pred: str = "pred") -> Column:
    tp, fp = _hits(label, pred, 1, 1), _hits(label, pred, 0, 1)
    return F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))


def recall(label: str = "label", pred: str = "pred") -> Column:
    tp, fn = _hits(label, pred, 1, 1), _hits(label, pred, 1, 0)
    return F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))


def f1_binary(label: str = "label", pred: str = "pred") -> Column:
    """F1 of class 1; 0 when neither labels nor predictions contain it."""
    tp = _hits(label, pred, 1, 1)
    wrong = _hits(label, pred, 0, 1) + _hits(label, pred, 1, 0)
    return F.coalesce(F.try_divide(2 * tp, 2 * tp + wrong), F.lit(0.0))


METRICS = {"f1": f1_binary, "accuracy": accuracy, "precision": precision, "recall": recall}


def metric(name: str, label: str = "label", pred: str = "pred") -> Column:
    """Aggregate column of a registered metric; users add theirs to ``METRICS``."""
    if name not in METRICS:
        raise ValueError(f"unknown metric {name!r}; known: {sorted(METRICS)}")
    return METRICS[name](label, pred)
