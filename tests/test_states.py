"""Profiles of parts merge into the profile of the whole."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelworks.operators import states as P
from labelworks.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"x": np.round(rng.normal(1e6, 30, 9000), 2), "y": rng.integers(0, 50, 9000).astype(float), "part": rng.integers(0, 3, 9000)})
    pdf.loc[pdf.index % 7 == 0, "y"] = np.nan
    return spark.createDataFrame(pdf).withColumn("y", F.nanvl("y", F.lit(None).cast("double"))).withColumn("none", F.lit(None).cast("double")).repartition(4).persist(), pdf


COLUMNS = ["x", "y", "none"]


def rows(summary):
    return {r["column"]: r for r in summary.collect()}


def test_merged_profile_is_that_of_the_whole(table):
    df, pdf = table
    parts = [P.profile_state(df.where(F.col("part") == i), COLUMNS) for i in range(3)]
    empty = P.profile_state(df.limit(0), COLUMNS)
    merged, whole = rows(P.state_summary(P.merge_states(*parts, empty))), rows(P.state_summary(P.profile_state(df, COLUMNS)))
    assert set(merged) == set(whole) == set(COLUMNS)
    for c in COLUMNS:
        a, b = merged[c].asDict(), whole[c].asDict()
        assert all(a[k] == b[k] for k in ("n_rows", "n_missing", "n", "min", "max"))
        if c == "none":
            continue
        assert a["mean"] == pytest.approx(b["mean"], rel=1e-12) and a["std"] == pytest.approx(b["std"], rel=1e-9)
        assert a["approx_distinct"] == pytest.approx(b["approx_distinct"], rel=0.05)
        for q, p in zip(a["approx_quantiles"], (0.25, 0.5, 0.75)):
            assert (pdf[c].dropna() <= q).mean() > p - 0.01 and (pdf[c].dropna() < q).mean() < p + 0.01
        assert a["std"] == pytest.approx(pdf[c].std(), rel=1e-9) and abs(a["approx_distinct"] / pdf[c].nunique() - 1) < 0.06
    assert merged["none"]["n"] == 0 and merged["none"]["mean"] is None and merged["none"]["approx_quantiles"] is None


def test_kept_states_give_exact_quartiles(spark, table, tmp_path):
    df, pdf = table
    path = str(tmp_path / "states")
    for i in range(3):
        P.append_state(df.where(F.col("part") == i), COLUMNS, path)
    state = P.kept_state(spark, path)
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    want = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, COLUMNS, probs).collect()}
    got = {(r["column"], r["prob"]): r["value"] for r in P.quantiles_from_state(df, state, COLUMNS, probs).collect()}
    assert got == want and len(got) == 10
    with pytest.raises(Exception, match="counts differ"):
        P.quantiles_from_state(df.where("part = 1"), state, COLUMNS, probs).collect()
    with pytest.raises(ValueError):
        exact_quantiles(df, ["x"], [0.5], ["part"], brackets=[(1, [(0.0, 1.0)])])
