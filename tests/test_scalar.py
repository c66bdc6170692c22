import json

import pytest
from pyspark.sql import functions as F

from labelworks.functions import scalar as S


def values(spark, column, rows, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, c {kind}")
    return [r[0] for r in df.select("i", column.alias("out")).orderBy("i").select("out").collect()]


def test_title(spark):
    names = ["Braund, Mr. Owen", "O'Hara,  the Countess. of X", "A, B", None, "no comma"]
    assert values(spark, S.extract_title("c", "null"), names) == ["Mr", "the Countess", "B", None, None]
    assert values(spark, S.extract_title("c"), names[:3]) == ["Mr", "the Countess", "B"]
    for bad in ("no comma", None):
        with pytest.raises(Exception, match="no title in name"):
            values(spark, S.extract_title("c"), [bad, "A, B. C"])


def test_first_char_and_deck(spark):
    assert values(spark, S.first_char("c"), ["C85", "", None]) == ["C", None, None]
    assert values(spark, S.deck_or_unknown("c"), ["C85", "", None]) == ["C", "Unknown", "Unknown"]


def test_prefix(spark):
    assert values(spark, S.regex_prefix("c"), ["A/5 21171", "113803", None]) == ["A/", "", None]


def test_bins_are_right_closed(spark):
    # The edges and names of the fare bins.
    labels = ["low", "medium-low", "medium-high", "high"]
    got = values(spark, S.bin_fixed("c", [0, 7.91, 14.45, 31, 512.33], labels), [0.0, 7.91, 7.92, 31.0, 512.33, 600.0, None], "double")
    assert got == [None, "low", "medium-low", "medium-high", "high", None, None]


def test_sigmoid_is_clipped(spark):
    low, mid, high = values(spark, S.sigmoid_clipped("c"), [-1000.0, 0.0, 1000.0], "double")
    assert mid == 0.5 and 0 < low < 1e-20 and 1 - high < 1e-20


def test_threshold_includes_its_edge(spark):
    assert values(spark, S.threshold("c", 0.5), [0.5, 0.4999], "double") == [1, 0]


def test_ratio_by_zero_is_missing(spark):
    assert values(spark, S.ratio("c", F.lit(0)), [1.0], "double") == [None]


def test_nan_becomes_missing(spark):
    assert values(spark, S.null_if_nan("c"), [float("nan"), 1.0, None], "double") == [None, 1.0, None]


def test_plain_values():
    import numpy as np

    class Thing:
        def __str__(self):
            return "thing"

    assert json.loads(S.to_json({"d": np.float32(2.5), "e": np.arange(2), "a": (1, {2}), "b": Thing(), "c": None})) == {"d": 2.5, "e": [0, 1], "a": [1, [2]], "b": "thing", "c": None}


def test_weighted_sum_needs_one_weight_each():
    with pytest.raises(ValueError):
        S.weighted_sum(["a", "b"], [1.0])
