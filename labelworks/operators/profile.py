"""Counts, cross-tabs, quartiles, histograms and densities of a table."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelworks.functions.scalar import ratio
from labelworks.operators.keep import keep
from labelworks.operators.quantiles import exact_quantiles
from labelworks.operators.select import union_rows

QUARTILES = {0.25: "q25", 0.5: "q50", 0.75: "q75"}


def mode_value(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent present value of each string column; ties go to the smallest."""
    rows = _text_rows(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("column").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"))


def _text_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return wide.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())


def nunique_all(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct count of every column, missing values excluded.

    Exact counts read each column by itself, so a row is never copied for each column;
    ``approximate`` counts all columns of a wide table in one pass with sketches.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column", "n_unique")
    counts = [df.select(c).where(F.col(c).isNotNull()).distinct().agg(F.lit(c).alias("column"), F.count(F.lit(1)).alias("n_unique")) for c in df.columns]
    return union_rows(*counts)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), column)


def grouped_value_counts(df: DataFrame, group: str, target: str) -> DataFrame:
    counts = count_by_hue(df, group, target)
    return counts.orderBy(group, F.col("n").desc(), target)


def count_by_hue(df: DataFrame, x: str, hue: str) -> DataFrame:
    kept = df.where(F.col(x).isNotNull() & F.col(hue).isNotNull())
    return kept.groupBy(x, hue).agg(F.count(F.lit(1)).alias("n"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[object]) -> DataFrame:
    """Counts of ``row`` by ``column``, absent cells 0; one conditional count per value."""
    kept = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    return kept.groupBy(row).agg(*[F.count_if(F.col(column) == F.lit(v)).alias(f"n_{v}") for v in values])


def crosstab_rate(df: DataFrame, row: str, column: str, values: Sequence[object]) -> DataFrame:
    """Cross-tab divided by its row sums."""
    counts = crosstab(df, row, column, values)
    whole: Column = F.lit(0)
    for v in values:
        whole = whole + F.col(f"n_{v}")
    return counts.select(row, *[ratio(F.col(f"n_{v}"), whole).alias(f"rate_{v}") for v in values])


def describe_numeric(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of each column."""
    group, names = [*by, "column"], ["n", "mean", "std", "min", "max"]
    present = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
    for key in by:
        present = present.where(F.col(key).isNotNull())
    measures = (F.count, F.avg, F.stddev_samp, F.min, F.max)
    cells = [F.struct(F.lit(c).alias("column"), *[m(c).alias(n) for m, n in zip(measures, names)]) for c in columns]
    wide = present.groupBy(*by).agg(F.array(*cells).alias("_s"))
    basic = wide.select(*by, F.explode("_s").alias("_s")).select(*by, "_s.*").where(F.col("n") > 0)
    quartiles = quartile_columns(exact_quantiles(df, columns, list(QUARTILES), by), group)
    return basic.join(quartiles, group)


def quartile_columns(quantiles: DataFrame, group: Sequence[str]) -> DataFrame:
    picks = [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in QUARTILES.items()]
    return quantiles.groupBy(*group).agg(*picks)


def describe_grouped(df: DataFrame, group: str, column: str) -> DataFrame:
    return describe_numeric(df, [column], [group])


def null_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "n_missing")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def mean_pop_std(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def _equal_width_bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin; the top edge belongs to the last bin, a single value to the first."""
    at = F.floor(F.try_divide((x - low) * F.lit(bins), high - low))
    return F.least(F.coalesce(at, F.lit(0).cast("long")), F.lit(bins - 1).cast("long")).cast("int")


def _extremes(df: DataFrame, columns: Sequence[str]) -> Column:
    """One struct with the smallest and largest value of each column, as a scalar subquery."""
    fields = [f(c).cast("double").alias(f"{c}_{n}") for c in columns for f, n in ((F.min, "low"), (F.max, "high"))]
    return df.agg(F.struct(*fields).alias("extremes")).scalar()


def histogram_hue(df: DataFrame, column: str, hue: str, bins: int = 30) -> DataFrame:
    """Counts in equal-width bins over the whole range, for each hue."""
    edges = F.col("_edges")
    kept = df.select(hue, F.col(column).cast("double").alias(column)).where(F.col(column).isNotNull())
    binned = kept.withColumn("_edges", _extremes(kept, [column])).withColumn(
        "bin", _equal_width_bin(F.col(column), edges[f"{column}_low"], edges[f"{column}_high"], bins)
    )
    return binned.where(F.col(hue).isNotNull()).groupBy(hue, "bin").agg(F.count(F.lit(1)).alias("n"))


def density_grid(df: DataFrame, column: str, hue: str, points: int = 50, cut: float = 0.0) -> DataFrame:
    """Exact Gaussian kernel density of each hue on a grid of ``points`` values.

    Bandwidth is sample deviation times n^(-1/5). The grid spans the values of the
    hue, widened by ``cut`` bandwidths (0 under a histogram, 2 for a violin
    outline). Equal values are counted first; each distinct value then adds its
    weighted kernel to every grid point inside the map-side aggregate, so only hues x
    points sums are shuffled. A hue whose values do not vary has one row without point.
    """
    x = F.col(column).cast("double")
    kept = df.select(hue, x.alias("_x")).where(F.col("_x").isNotNull() & F.col(hue).isNotNull())
    stats = kept.groupBy(hue).agg(
        F.count("_x").alias("_n"), F.stddev_samp("_x").alias("_std"), F.min("_x").alias("_low"), F.max("_x").alias("_high")
    )
    width = F.col("_std") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))
    grids = stats.where(F.col("_std") > 0).select(
        hue,
        "_n",
        width.alias("_h"),
        (F.col("_low") - F.lit(cut) * width).alias("_from"),
        ((F.col("_high") - F.col("_low") + F.lit(2 * cut) * width) / (points - 1)).alias("_step"),
    )
    weighted = kept.groupBy(hue, "_x").agg(F.count(F.lit(1)).alias("_w"))
    spread = weighted.join(keep(grids), hue).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    at = F.col("_from") + F.col("point") * F.col("_step")
    away = (at - F.col("_x")) / F.col("_h")
    kernel = F.exp(F.lit(-0.5) * away * away)
    scale = F.first("_n") * F.first("_h") * F.sqrt(F.lit(2.0) * F.pi())
    curves = spread.groupBy(hue, "point").agg(F.first(at).alias("x"), (F.sum(F.col("_w") * kernel) / scale).alias("density"))
    flat = stats.where(F.col("_std").isNull() | (F.col("_std") == 0))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("point", "int"), ("x", "double"), ("density", "double"))]
    return curves.unionByName(flat.select(hue, *nothing))


def box_stats(df: DataFrame, group: str, column: str) -> DataFrame:
    """Quartiles, whisker ends within 1.5 interquartile ranges, and outlier count."""
    quartiles = keep(quartile_columns(exact_quantiles(df, [column], list(QUARTILES), [group]), [group]))
    reach = F.lit(1.5) * (F.col("q75") - F.col("q25"))
    x = F.col(column).cast("double")
    joined = df.select(group, x.alias("_x")).where(F.col("_x").isNotNull()).join(quartiles, group)
    inside = (F.col("_x") >= F.col("q25") - reach) & (F.col("_x") <= F.col("q75") + reach)
    return joined.groupBy(group, *QUARTILES.values()).agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"),
    )


def pair_matrix(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Binned counts of every column pair (a column with itself is its histogram).

    One scan: each row names its cell in every pair and the map side counts cells.
    """
    kept = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    kept = kept.withColumn("_edges", _extremes(kept, columns))
    edges = F.col("_edges")
    cells = {c: _equal_width_bin(F.col(c), edges[f"{c}_low"], edges[f"{c}_high"], bins) for c in columns}
    binned = kept.select(*[F.when(F.col(c).isNotNull(), cells[c]).alias(c) for c in columns])
    pairs = [
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(a).alias("x_bin"), F.col(b).alias("y_bin"))
        for a, b in combinations_with_replacement(columns, 2)
    ]
    rows = binned.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")
    rows = rows.where(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
    return rows.groupBy("x", "y", "x_bin", "y_bin").agg(F.count(F.lit(1)).alias("n"))
