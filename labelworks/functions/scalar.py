"""Scalar column expressions. All are built-ins, so they stay inside codegen."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLANKS = " \t\n\r\x0b\x0c"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_title(name: Column | str, on_error: str = "fail") -> Column:
    """Text between the first comma and the next full stop of ``Last, Title. First``.

    A name without a comma fails the query (``on_error="fail"``) or gives null.
    """
    c = _col(name)
    after_comma = F.get(F.split(c, ","), F.lit(1))
    title = F.btrim(F.get(F.split(after_comma, r"\."), F.lit(0)), F.lit(_BLANKS))
    if on_error == "null":
        return title
    message = F.concat(F.lit("no title in name: "), F.coalesce(c, F.lit("<missing>")))
    return F.when(after_comma.isNull(), F.raise_error(message).cast("string")).otherwise(title)


def first_char(c: Column | str) -> Column:
    """First character; missing for a missing or empty string."""
    return F.nullif(F.substring(_col(c), 1, 1), F.lit(""))


def deck_or_unknown(c: Column | str, unknown: str = "Unknown") -> Column:
    return F.coalesce(first_char(c), F.lit(unknown))


def regex_prefix(c: Column | str, pattern: str = r"^([^0-9]*)") -> Column:
    """First group of ``pattern``; the default is everything before the first digit."""
    return F.regexp_extract(_col(c), pattern, 1)


def bin_fixed(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed bin ``(edges[i], edges[i+1]]``; missing outside."""
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label fewer than edges")
    c = _col(c)
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges[:-1], edges[1:], labels))):
        out = F.when((c > low) & (c <= high), F.lit(label)).otherwise(out)
    return out


def coalesce_fill(*candidates: Column | str) -> Column:
    """First candidate that is present, e.g. value, group median, global median."""
    return F.coalesce(*[_col(c) for c in candidates])


def null_if_nan(c: Column | str) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def sigmoid_clipped(c: Column | str, limit: float = 50.0) -> Column:
    clipped = F.greatest(F.lit(-limit), F.least(F.lit(limit), _col(c)))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clipped))


def threshold(score: Column | str, at: float = 0.5) -> Column:
    """1 when the score reaches ``at`` (inclusive), else 0."""
    return (_col(score) >= F.lit(at)).cast("int")


def weighted_sum(scores: Sequence[Column | str], weights: Sequence[float]) -> Column:
    """Plain weighted sum; the weights are used as given, not renormalised."""
    if len(scores) != len(weights):
        raise ValueError(f"expected {len(scores)} weights, got {len(weights)}")
    total = F.lit(0.0)
    for score, weight in zip(scores, weights):
        total = total + F.lit(float(weight)) * _col(score)
    return total


def abs_mean(c: Column | str) -> Column:
    return F.avg(F.abs(_col(c)))


def ratio(part: Column | str, whole: Column | str) -> Column:
    return F.try_divide(_col(part), _col(whole))


def metric_key(key: Column | str, metric: Column | str) -> Column:
    return F.concat_ws("/", _col(key), _col(metric))


def cast_int(c: Column | str) -> Column:
    return _col(c).cast("int")


def cast_float(c: Column | str) -> Column:
    return _col(c).cast("double")


def hash_order(key: Column | str, seed: object) -> Column:
    """Reproducible pseudo-random sort key; the same text in any engine with md5."""
    return F.md5(F.concat(F.lit(f"{seed}|"), _col(key).cast("string")))


def _beyond_json(value: object) -> object:
    """What the JSON writer cannot hold itself: numbers of array libraries, sets, anything else as text."""
    if callable(number := getattr(value, "tolist", None)):
        return number()
    return sorted(value, key=repr) if isinstance(value, (set, frozenset)) else str(value)


def to_json(value: object) -> str:
    """A setting as JSON text, keys in order, the same for equal settings."""
    return json.dumps(value, default=_beyond_json, sort_keys=True)


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
