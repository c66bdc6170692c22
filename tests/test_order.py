"""Ordering operators against pandas, on tied, skewed and grouped data."""

from functools import partial

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from labelworks.operators import order as W
from labelworks.operators import profile as E
from labelworks.operators import quantiles as Q

QUICK = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def skewed(rows=6000, seed=1):
    """A third of the rows share one value and one group; some values are missing."""
    rng = np.random.default_rng(seed)
    value = np.round(rng.normal(50, 20, rows), 2)
    value[: rows // 3] = 50.0
    value[-50:] = np.nan
    group = np.where(np.arange(rows) < rows // 2, "big", rng.choice(["a", "b", "c"], rows))
    return pd.DataFrame({"id": np.arange(rows), "g": group, "v": value})


def to_spark(spark, pdf):
    return spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))


def test_rank_pct_average(spark):
    pdf = skewed()
    got = W.rank_pct_average(to_spark(spark, pdf), "v", ["g"]).toPandas().sort_values("id")["rank_pct"].to_numpy()
    want = pdf.groupby("g")["v"].rank(method="average", pct=True).to_numpy()
    np.testing.assert_allclose(got.astype(float), want, atol=1e-12)


def test_rank_min_and_numbering(spark):
    pdf = skewed()
    df = to_spark(spark, pdf)
    got = W.rank_min(df, "v").toPandas().sort_values("id")["rank"].to_numpy(dtype=float)
    np.testing.assert_array_equal(got, pdf["v"].rank(method="min", ascending=False).to_numpy())
    numbered = W.sequence_number(df.select("id"), "id", "n", 0).toPandas()
    assert (numbered["id"] == numbered["n"]).all()


@pytest.mark.parametrize("ranges", [256, 7])
def test_exact_quantiles(spark, monkeypatch, ranges):
    monkeypatch.setattr(Q, "RANGES", ranges)
    monkeypatch.setattr(Q, "ACCURACY", 10000 if ranges == 256 else 200)
    if ranges != 256:
        monkeypatch.setattr(Q, "MARGINS", [0.02, 0.2])
    pdf = skewed()
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = Q.exact_quantiles(to_spark(spark, pdf), ["v"], probs, ["g"]).toPandas().set_index(["g", "prob"])["value"]
    for g, part in pdf.groupby("g"):
        for p in probs:
            assert got[(g, p)] == pytest.approx(part["v"].quantile(p), abs=1e-9)


def test_quantiles_of_several_columns(spark):
    pdf = skewed()
    df = to_spark(spark, pdf).withColumn("w", F.col("v") * 2).withColumn("none", F.lit(None).cast("double"))
    got = Q.exact_quantiles(df, ["v", "w", "none"], [0.5]).toPandas().set_index("column")["value"]
    assert got["w"] == pytest.approx(2 * pdf["v"].median()) and "none" not in got


def test_group_medians(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", 4.0), ("y", None), (None, 9.0)], "g string, v double")
    assert {r[0]: r[1] for r in Q.group_median(df, "g", "v").collect()} == {"x": 2.5, "y": None}
    assert Q.global_median(df, "v").first()[0] == 4.0
    filled = Q.fill_group_median(spark.createDataFrame([(1, "x", None), (2, "x", 3.0), (3, "y", None)], "i int, g string, v double"), "g", "v")
    assert {r["i"]: r["v"] for r in filled.collect()} == {1: 3.0, 2: 3.0, 3: None}


def test_hash_rank_is_a_numbering(spark):
    df = spark.range(5000).withColumn("g", (F.col("id") < 4000).cast("int"))
    got = W.hash_rank(df, "id", "s", ["g"], total="n").toPandas()
    for g, part in got.groupby("g"):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1))
        assert (part["n"] == len(part)).all()


def test_mode_ties_go_to_the_smallest(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "x"), ("a", "y")], "c string, d string")
    assert {r["column"]: r["mode"] for r in E.mode_value(df, ["c", "d"]).collect()} == {"c": "a", "d": "x"}


def test_describe_matches_pandas(spark):
    pdf = skewed()
    got = E.describe_numeric(to_spark(spark, pdf), ["v"]).first()
    want = pdf["v"].describe()
    for ours, theirs in zip(("n", "mean", "std", "min", "q25", "q50", "q75", "max"), want):
        assert got[ours] == pytest.approx(theirs)


def test_constant_column_histogram(spark):
    df = spark.createDataFrame([(1.0, "a")] * 5, "v double, h string")
    assert [tuple(r) for r in E.histogram_hue(df, "v", "h", 30).collect()] == [("a", 0, 5)]


def test_density_integrates_to_one(spark):
    pdf = skewed().dropna()
    got = E.density_grid(to_spark(spark, pdf), "v", "g", 200, cut=4).toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("x")
        assert np.trapezoid(part["density"], part["x"]) == pytest.approx(1, abs=1e-3)


def test_box_stats(spark):
    pdf = pd.DataFrame({"g": "a", "v": [1.0, 2, 3, 4, 5, 100]})
    got = E.box_stats(spark.createDataFrame(pdf), "g", "v").first()
    assert (got["whisker_low"], got["whisker_high"], got["n_outliers"]) == (1.0, 5.0, 1)


@QUICK
@given(st.lists(st.sampled_from([0.0, 0.25, 0.5, 1.0, 2.0, -3.0]), min_size=1, max_size=30))
def test_rank_property(spark, values):
    pdf = pd.DataFrame({"id": range(len(values)), "v": values})
    got = W.rank_pct_average(spark.createDataFrame(pdf), "v").toPandas().sort_values("id")["rank_pct"]
    np.testing.assert_allclose(got, pdf["v"].rank(pct=True), atol=1e-12)


@pytest.mark.parametrize("hot", [W.HOT, 100])
def test_ranks_of_a_value_in_half_the_rows_and_missing_keys(spark, monkeypatch, hot):
    monkeypatch.setattr(W, "HOT", hot)
    monkeypatch.setattr(W, "join_values", partial(W.join_values, hot=hot))
    monkeypatch.setattr(W, "ROWS", 20)
    rng = np.random.default_rng(5)
    rows = 3000
    value = np.where(rng.random(rows) < 0.5, 7.0, np.round(rng.normal(7, 30, rows), 1))
    value[rng.random(rows) < 0.2] = np.nan
    pdf = pd.DataFrame({"id": np.arange(rows), "g": np.where(rng.random(rows) < 0.5, "a", None), "v": value})
    df = to_spark(spark, pdf)
    for got, want in (
        (W.rank_min(df, "v"), pdf["v"].rank(method="min", ascending=False)),
        (W.rank_pct_average(df, "v", ["g"]), pdf.groupby("g")["v"].rank(pct=True)),
    ):
        column = got.columns[-1]
        found = got.toPandas().sort_values("id")[column].to_numpy(dtype=float)
        np.testing.assert_allclose(found, want.reindex(pdf.index).to_numpy(), atol=1e-12)
    numbered = W.sequence_number(df.select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("id")), "id", "number").toPandas()
    assert len(numbered) == rows and sorted(numbered.iloc[:, -1].dropna()) == list(range(1, rows // 2 + 1))
    ranked = W.hash_rank(df.select(F.when(F.col("id") > 2, F.col("id")).alias("id")), "id", 1).collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, rows + 1))


def test_quantiles_of_small_and_constant_groups(spark):
    rows = [("one", 5.0)] + [("two", x) for x in (1.0, 2.0)] + [("same", 3.0)] * 5000 + [("none", None)] + [(None, 1.0)] + [("many", float(i)) for i in range(30000)]
    df = spark.createDataFrame(rows, "g string, v double")
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    got = Q.exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0], ["g"]).collect()
    assert len(got) == 16
    for r in got:
        assert r["value"] == pytest.approx(pdf[pdf.g == r["g"]]["v"].quantile(r["prob"]), abs=1e-9)


def test_ranges_rise_with_group_and_value(spark):
    pdf = skewed()
    rows = W.with_range_bucket(to_spark(spark, pdf).where("v IS NOT NULL"), "v", ["g"], 37)
    assert all(not kind.startswith("array") for _, kind in rows.dtypes)
    got = rows.toPandas().sort_values(["g", "v"])
    assert got[W.BUCKET].is_monotonic_increasing and got[W.BUCKET].nunique() > 20
    assert (got.groupby(["g", "v"])[W.BUCKET].nunique() == 1).all()
    assert W.range_count(10**12) == -(-(10**12) // W.ROWS) and W.range_count(0) == 16
