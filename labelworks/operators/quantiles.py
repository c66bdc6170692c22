"""Exact quantiles whose groups never meet in one task.

``percentile`` and ``median`` buffer every distinct value of a group in one
place. Here a first narrow scan brackets each wanted rank with a mergeable
sketch; a second one counts the rows below each bracket, and a third keeps only
the values inside it. Those are cut into ranges by a second sketch, and only the
ranges that hold a wanted rank are sorted: a few millionths of the group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelworks.operators.keep import keep

# Sketch accuracy. A bracket spans a share of the rows on each side of the wanted
# rank: the smallest of MARGINS that is at least RANKS rows, everything in a group
# too small for any of them.
ACCURACY = 10000
MARGINS = [4.0 / ACCURACY * 10**i for i in range(4)]
RANKS = 4
# Ranges that the values inside a bracket are cut into.
RANGES = 256


def _brackets(column: str, probs: Sequence[float]) -> Column:
    """Struct of ``n`` and, for each prob, ``low, high`` that surely enclose the ranks next to it."""
    shares = sorted({min(1.0, max(0.0, p + side * m)) for p in probs for m in MARGINS for side in (-1, 1)})
    found, n = F.percentile_approx(column, shares, ACCURACY), F.count(column)

    def edge(p: float, side: int) -> Column:
        out = F.lit(side * float("inf"))
        for m in reversed(MARGINS):
            share = p + side * m
            if 0 < share < 1:
                out = F.when(n * m >= RANKS, found[shares.index(share)]).otherwise(out)
            else:
                out = F.when(n * m >= RANKS, F.lit(side * float("inf"))).otherwise(out)
        return out

    pairs = [F.struct(edge(p, -1).alias("low"), edge(p, 1).alias("high")) for p in probs]
    return F.struct(n.alias("n"), F.array(*pairs).alias("at"))


def _known(brackets: Sequence[tuple[int, Sequence[tuple[float, float]]]]) -> Column:
    """Brackets that a kept profile gives: for each column its count and (low, high) for each prob."""

    def one(n: int, pairs: Sequence[tuple[float, float]]) -> Column:
        return F.struct(F.lit(n).cast("long").alias("n"), F.array(*[F.struct(F.lit(a).alias("low"), F.lit(b).alias("high")) for a, b in pairs]).alias("at"))

    return F.struct(*[one(*b).alias(f"b{i}") for i, b in enumerate(brackets)])


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    brackets: Sequence[tuple[int, Sequence[tuple[float, float]]]] | None = None,
) -> DataFrame:
    """Rows ``by, column, prob, value``: linear interpolation between the two nearest ranks.

    Missing values do not count, and missing group keys form no group. Where ``brackets``
    are known, for an ungrouped table, the pass that finds them is left out.
    """
    by, columns = list(by), list(columns)
    rows = df.select(*by, *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(columns)])
    for key in by:
        rows = rows.where(F.col(key).isNotNull())
    found = F.struct(*[_brackets(f"_c{i}", probs).alias(f"b{i}") for i in range(len(columns))])
    if brackets is not None:
        if by:
            raise ValueError("known brackets are those of a whole table")
        rows = rows.withColumn("_b", _known(brackets))
    elif by:
        rows = rows.join(keep(rows.groupBy(*by).agg(found.alias("_b"))), by)
    else:
        rows = rows.withColumn("_b", rows.agg(found).scalar())
    cells = [(i, j, F.col(f"_c{i}"), F.col(f"_b.b{i}")) for i in range(len(columns)) for j in range(len(probs))]
    # Two aggregates without a copy of a row for each column: what lies below, and what lies inside.
    counts = [F.struct(F.lit(i).alias("_i"), F.lit(j).alias("_j"), F.max(b["n"]).alias("_total"), F.count(c).alias("_n"), F.count_if(c < b["at"][j]["low"]).alias("_below")) for i, j, c, b in cells]
    keys = [*by, "_i", "_j"]
    wanted = rows.groupBy(*by).agg(F.array(*counts).alias("_s")).select(*by, F.explode("_s").alias("_s")).select(*by, "_s.*").where(F.col("_total") > 0)
    at = F.get(F.array(*map(F.lit, probs)), F.col("_j")) * (F.col("_total") - 1)
    other = F.raise_error(F.lit("brackets of other rows: the counts differ")).cast("long")
    wanted = wanted.withColumn("_below", F.when(F.col("_n") == F.col("_total"), F.col("_below")).otherwise(other))
    wanted = wanted.select(*keys, (F.floor(at) - F.col("_below")).alias("_lo"), (F.ceil(at) - F.col("_below")).alias("_hi"), (at - F.floor(at)).alias("_share"))
    near = [F.when((c >= b["at"][j]["low"]) & (c <= b["at"][j]["high"]), F.struct(F.lit(i).alias("_i"), F.lit(j).alias("_j"), c.alias("value"))) for i, j, c, b in cells]
    inside = rows.select(*by, F.explode(F.array_compact(F.array(*near))).alias("_v")).groupBy(*by, "_v._i", "_v._j", "_v.value").agg(F.count(F.lit(1)).alias("_n"))
    inside = keep(inside)  # read several times below
    # The bracket again, in ranges: one row for each, then the values of one or two of them.
    bounds = inside.groupBy(*keys).agg(F.percentile_approx("value", [k / RANGES for k in range(1, RANGES)], 8 * RANGES).alias("_bounds"))
    ranged = inside.join(bounds, keys).withColumn("_r", F.size(F.filter("_bounds", lambda x: x <= F.col("value")))).drop("_bounds")
    through = Window.partitionBy(*keys).orderBy("_r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranged.groupBy(*keys, "_r").agg(F.sum("_n").alias("_rows")).withColumn("_through", F.sum("_rows").over(through))
    holds = lambda p: (F.col("_through") > F.col(p)) & (F.col("_through") - F.col("_rows") <= F.col(p))
    chosen = ranges.join(wanted, keys).where(holds("_lo") | holds("_hi"))
    order = Window.partitionBy(*keys, "_r").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranged.join(chosen, [*keys, "_r"]).withColumn("_last", F.col("_through") - F.col("_rows") + F.sum("_n").over(order))

    def pick(position: str) -> Column:
        covers = (F.col("_last") > F.col(position)) & (F.col("_last") - F.col("_n") <= F.col(position))
        return F.max(F.when(covers, F.col("value")))

    low, high, share = pick("_lo"), pick("_hi"), F.max("_share")
    outside = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    value = F.when(low.isNull() | high.isNull(), outside).otherwise(low + (high - low) * share)
    found = placed.groupBy(*keys).agg(value.alias("value"))
    column, prob = F.get(F.array(*map(F.lit, columns)), F.col("_i")), F.get(F.array(*[F.lit(float(p)) for p in probs]), F.col("_j"))
    return found.select(*by, column.alias("column"), prob.alias("prob"), "value")


def group_median(df: DataFrame, group: str, column: str, name: str = "median") -> DataFrame:
    """Median of the present values for each group; a group of missing values gives missing."""
    medians = exact_quantiles(df, [column], [0.5], [group]).select(group, F.col("value").alias(name))
    groups = df.where(F.col(group).isNotNull()).select(group).distinct()
    return groups.join(medians, group, "left")


def global_median(df: DataFrame, column: str, name: str = "median") -> DataFrame:
    found = exact_quantiles(df, [column], [0.5])
    return found.agg(F.max("value").alias(name))


def fill_group_median(df: DataFrame, group: str, column: str) -> DataFrame:
    """Fill missing values with the median of their group, by a lookup join."""
    medians = keep(exact_quantiles(df, [column], [0.5], [group]).select(group, F.col("value").alias("_fill")))
    filled = df.join(medians, group, "left").withColumn(column, F.coalesce(F.col(column).cast("double"), F.col("_fill")))
    return filled.select(*df.columns)
