"""Projections, filters, joins by key, ordering and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from labelworks.functions.scalar import NUMERIC


def drop_columns(df: DataFrame, columns: Sequence[str] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """Remove the columns, or everything that is not in ``keep``."""
    return df.drop(*columns) if keep is None else df.select(*[c for c in df.columns if c in keep])


def split_target(df: DataFrame, target: str) -> DataFrame:
    """Label and features stay in one table; the target is renamed ``label``."""
    return df.withColumnRenamed(target, "label")


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def filter_missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def constant_column(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def select_by_type(df: DataFrame) -> tuple[list[str], list[str]]:
    """Names of the numeric and of the string columns."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return numeric, text


def distinct_values(df: DataFrame, column: str, key: str, n: int | None = None) -> DataFrame:
    """Distinct values in order of first appearance along ``key``, missing included."""
    found = df.groupBy(column).agg(F.min(key).alias("first_key")).orderBy("first_key")
    return found if n is None else found.limit(n)


def exclude_named(df: DataFrame, column: str, best: object, best_first: bool = False) -> DataFrame:
    """All rows but the named one, or all with the named one first."""
    if best_first:
        return df.orderBy(F.when(F.col(column) == F.lit(best), 0).otherwise(1), column)
    return df.where(F.col(column) != F.lit(best))


def list_columns(df: DataFrame) -> DataFrame:
    """Name, type and non-missing count of every column, in one scan."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = counts.unpivot([], df.columns, "column", "non_null")
    place = F.create_map(*[x for i, c in enumerate(df.columns) for x in (F.lit(c), F.lit(i + 1))])
    kind = F.create_map(*[x for f in df.schema.fields for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    return rows.select("column", place[F.col("column")].alias("position"), kind[F.col("column")].alias("type"), "non_null")


def preview(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(key).limit(n)


def lookup_join(df: DataFrame, lookup: DataFrame, on: str) -> DataFrame:
    """Left outer equi join; keys without an entry give missing values.

    No broadcast hint: AQE broadcasts the lookup when its measured size allows.
    """
    return df.join(lookup, on, "left")


def align_scores(frames: Mapping[str, DataFrame], key: str, value: str) -> DataFrame:
    """Put one column of several tables side by side, matched on the key."""
    out: DataFrame | None = None
    for name, frame in frames.items():
        part = frame.select(key, F.col(value).alias(name))
        out = part if out is None else out.join(part, key)
    if out is None:
        raise ValueError("no tables to align")
    return out


def label_join(scores: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    return scores.join(labels.select(key, label), key)


def missing_names(expected: DataFrame, present: DataFrame, column: str) -> DataFrame:
    return expected.join(present, column, "left_anti")


def sort_desc(df: DataFrame, value: str, tie: str) -> DataFrame:
    return df.orderBy(F.col(value).desc(), tie)


def sort_by_name(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*columns)


def leaderboard(df: DataFrame, first: str = "holdout_f1", second: str = "cv_f1_mean", name: str = "model") -> DataFrame:
    return df.orderBy(F.col(first).desc(), F.col(second).desc(), name)


def best_model(df: DataFrame, first: str = "holdout_f1", second: str = "cv_f1_mean", name: str = "model") -> DataFrame:
    """Top row of the leaderboard as one aggregate; ties go to the first name."""
    order = F.struct(-F.col(first), -F.col(second), F.col(name))
    return df.agg(F.min_by(F.struct(*df.columns), order).alias("best")).select("best.*")


def top_k(df: DataFrame, value: str, tie: str, k: int, by: Sequence[str] = ()) -> DataFrame:
    """k largest rows, or the k largest of each group (partial limits before the shuffle)."""
    order = [F.col(value).desc(), F.col(tie)]
    if not by:
        return df.orderBy(*order).limit(k)
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def union_rows(*frames: DataFrame) -> DataFrame:
    """Rows of all tables; columns a table lacks become missing."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def stack_scores(df: DataFrame, key: str | Sequence[str], models: Sequence[str]) -> DataFrame:
    """Wide score columns to rows ``key, model, score``."""
    return df.unpivot([key] if isinstance(key, str) else list(key), list(models), "model", "score")


def widen_scores(long: DataFrame, key: str, models: Sequence[str]) -> DataFrame:
    """Rows ``key, model, score, pred`` to ``<model>_score`` and ``<model>_pred`` columns."""
    picks: list[Column] = []
    for m in models:
        mine = F.col("model") == m
        picks += [F.max(F.when(mine, F.col(c))).alias(f"{m}_{c}") for c in ("score", "pred")]
    return long.groupBy(key).agg(*picks)


def dict_to_rows(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Map column to ``parameter, value`` rows with text values."""
    pair = F.explode(F.array_sort(F.map_entries(column)))
    return df.select(*keep, pair.alias("_e")).select(
        *keep, F.col("_e.key").alias("parameter"), F.col("_e.value").cast("string").alias("value")
    )
