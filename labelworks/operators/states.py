"""Profiles that can be merged: small states of parts of a table, kept and added up.

A state has one row a column: counts, mean and squared deviations, extremes, and sketches of
the quantiles and of the distinct values. States of two parts merge into that of both, so
when data is added only the new files are read. Exact quartiles still need the values, but
the merged sketch already says between which values they lie: one scan counts what is below
and keeps what is inside.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelworks.operators.quantiles import exact_quantiles

# Size of the quantile sketch, and the share of the rows by which a bracket is widened on
# each side: several times the sketch's rank error at this size.
SKETCH = 4096
MARGIN = 0.005
STATE = "column string, n_rows long, n long, mean double, m2 double, low double, high double, quantiles binary, distinct_values binary"


def profile_state(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row for each numeric column: ``column, n_rows, n, mean, m2, low, high, quantiles,
    distinct_values``. One scan; missing values count in n_rows alone. A column without
    values, or an empty table, has missing moments and no sketch."""
    wide = df.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    cells = []
    for i, c in enumerate(columns):
        x, n = F.col(f"_{i}"), F.count(f"_{i}")
        # a double itself has no distinct sketch, its hash has
        hashed = F.when(x.isNotNull(), F.xxhash64(x))
        sketches = [F.when(n > 0, made) for made in (F.kll_sketch_agg_double(x, SKETCH), F.hll_sketch_agg(hashed))]
        moments = [F.count(F.lit(1)).alias("n_rows"), n.alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * n).alias("m2"), F.min(x).alias("low"), F.max(x).alias("high")]
        cells.append(F.struct(F.lit(c).alias("column"), *moments, sketches[0].alias("quantiles"), sketches[1].alias("distinct_values")))
    return wide.agg(F.array(*cells).alias("_s")).select(F.explode("_s").alias("_s")).select("_s.*")


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all parts together; one row of a state may itself be split over several."""
    rows = reduce(DataFrame.unionByName, states)
    whole = Window.partitionBy("column")
    # A part's mean against the mean of all: few rows, one for each part and column.
    centred = rows.withColumn("_mean", F.sum(F.col("mean") * F.col("n")).over(whole) / F.sum("n").over(whole))
    apart = F.coalesce(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("_mean"), F.lit(2.0)), F.lit(0.0))
    merged = centred.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n").alias("n"),
        F.max("_mean").alias("mean"),
        F.sum(apart).alias("_m2"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("quantiles", SKETCH).alias("_quantiles"),
        F.hll_union_agg("distinct_values").alias("_distinct"),
    )
    some = F.col("n") > 0
    return merged.select(
        "column", "n_rows", "n", "mean", F.when(some, F.col("_m2")).alias("m2"), "low", "high", F.when(some, F.col("_quantiles")).alias("quantiles"), F.when(some, F.col("_distinct")).alias("distinct_values")
    )


def append_state(df: DataFrame, columns: Sequence[str], path: str) -> None:
    """Add the state of new rows to those kept in a folder."""
    profile_state(df, columns).coalesce(1).write.mode("append").parquet(path)


def kept_state(spark: SparkSession, path: str) -> DataFrame:
    """The merged state of everything that was added to the folder."""
    return merge_states(spark.read.schema(STATE).parquet(path))


def state_summary(state: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``column, n_rows, n_missing, n, mean, std, min, max, approx_distinct, approx_quantiles``
    from a state alone; std is that of a sample."""
    n, some = F.col("n"), F.col("n") > 0
    quantiles = F.array(*[F.kll_sketch_get_quantile_double("quantiles", F.lit(float(p))) for p in probs])
    return state.select(
        "column",
        "n_rows",
        (F.col("n_rows") - n).alias("n_missing"),
        "n",
        "mean",
        F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("std"),
        F.col("low").alias("min"),
        F.col("high").alias("max"),
        F.when(some, F.hll_sketch_estimate("distinct_values")).otherwise(0).alias("approx_distinct"),
        F.when(some, quantiles).alias("approx_quantiles"),
    )


def quantiles_from_state(df: DataFrame, state: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact ``column, prob, value`` of a table whose state is known, without a pass for the
    brackets. A state of other rows is noticed: a quantile outside its bracket fails, as does
    a count that differs."""
    edges = [F.kll_sketch_get_quantile_double("quantiles", F.lit(min(1.0, max(0.0, p + side * MARGIN)))) for p in probs for side in (-1, 1)]
    known = {r["column"]: r for r in state.where(F.col("column").isin(*columns)).select("column", "n", F.when(F.col("n") > 0, F.array(*edges)).alias("edges")).collect()}
    brackets = []
    for c in columns:
        n, at = (known[c]["n"], known[c]["edges"]) if c in known else (0, None)
        pairs = []
        for j, p in enumerate(probs):
            low = at[2 * j] if at is not None and p - MARGIN > 0 else float("-inf")
            high = at[2 * j + 1] if at is not None and p + MARGIN < 1 else float("inf")
            pairs.append((low, high))
        brackets.append((n, pairs))
    return exact_quantiles(df, columns, probs, brackets=brackets)
