"""Global order without a global sort in one task.

Running totals, ranks and numberings over a whole table are usually written as
an unpartitioned window, which sends every row to one task. Here the order is
cut into value ranges (or hash prefixes) first. Each range is sorted on its own
and shifted by the totals of the ranges before it; there are as many ranges as the
number of distinct values asks for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelworks.functions.scalar import hash_order
from labelworks.operators.keep import keep

# Distinct values in a range, and copies of one value that a join may bring to one key.
ROWS = 1 << 22
HOT = 1 << 22
BUCKET = "_bucket"
HASH = "_hash"


def range_count(rows: int) -> int:
    """Ranges that a table of so many distinct values is cut into."""
    return max(16, -(-rows // ROWS))


def with_range_bucket(df: DataFrame, value: str, by: Sequence[str] = (), ranges: int = 16) -> DataFrame:
    """Add ``_bucket``, a value range that rises in the order of ``by`` and ``value``.

    One range partitioning of the whole table by group and value: a large group has many
    ranges, many small ones share one, and equal values always do. The bucket is the number
    of the partition, written with the row, so nothing about the boundaries travels with
    the rows and a task that runs again finds the buckets as they were.
    """
    parted = df.repartitionByRange(ranges, *by, value)
    return keep(parted.withColumn(BUCKET, F.spark_partition_id()))


def join_values(df: DataFrame, found: DataFrame, keys: Sequence[str], n: str, columns: Sequence[str], hot: int = HOT) -> DataFrame:
    """Left join of ``columns`` of ``found``, one row for each combination of ``keys``.

    ``n`` counts the rows of ``df`` that a combination has. One with more than ``hot``
    rows is spread over as many keys as that takes, and rows with a missing key do not
    meet at all.
    """
    keys, missing = list(keys), F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    parts = F.ceil(F.col(n) / F.lit(hot)).cast("int")
    common = keep(found.where(F.col(n) > hot).select(*keys, parts.alias("_parts")))
    salt = F.pmod(F.xxhash64(*df.columns), F.coalesce("_parts", F.lit(1))).cast("int")
    rows = df.where(~missing).join(common, keys, "left").withColumn("_salt", salt).drop("_parts")
    spread = found.select(*keys, *columns, F.explode(F.sequence(F.lit(0), parts - 1)).alias("_salt"))
    joined = rows.join(spread, [*keys, "_salt"], "left").select(*df.columns, *columns)
    types = dict(found.dtypes)
    return joined.unionByName(df.where(missing).select(*df.columns, *[F.lit(None).cast(types[c]).alias(c) for c in columns]))


def ordered_runs(
    df: DataFrame,
    value: str,
    measures: Mapping[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
    following: bool = False,
) -> DataFrame:
    """One row for each distinct value, with running totals of the measures.

    Output: ``by``, ``value``, each measure ``m``, ``m_before`` (sum over values
    earlier in the order) and ``m_total`` (sum over the group). With
    ``following``, a struct ``next`` holds the measures of the next value.
    Rows with a missing value are left out, as are missing group keys.
    """
    by, names = list(by), list(measures)
    present = df.where(F.col(value).isNotNull())
    for key in by:
        present = present.where(F.col(key).isNotNull())
    # Read three times below (boundaries, range totals, running totals): aggregate once.
    distinct = keep(present.groupBy(*by, value).agg(*[m.alias(n) for n, m in measures.items()]))
    ranged = with_range_bucket(distinct, value, by, range_count(distinct.count()))

    def order(c: str) -> Column:
        return F.col(c).desc() if descending else F.col(c).asc()

    first = F.max_by if descending else F.min_by
    ranges = ranged.groupBy(*by, BUCKET).agg(
        *[F.sum(n).alias(f"_sum_{n}") for n in names],
        first(F.struct(*names), F.col(value)).alias("_first"),
    )
    across = Window.partitionBy(*by).orderBy(order(BUCKET))
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    shifts = ranges.select(
        *by,
        BUCKET,
        *[F.coalesce(F.sum(f"_sum_{n}").over(earlier), F.lit(0)).alias(f"_shift_{n}") for n in names],
        *[F.sum(f"_sum_{n}").over(Window.partitionBy(*by)).alias(f"{n}_total") for n in names],
        *([F.lead("_first").over(across).alias("_next_range")] if following else []),
    )
    inside = Window.partitionBy(*by, BUCKET).orderBy(order(value))
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.join(shifts, [*by, BUCKET]).select(
        *by,
        value,
        *names,
        *[(F.col(f"_shift_{n}") + F.sum(n).over(so_far) - F.col(n)).alias(f"{n}_before") for n in names],
        *[f"{n}_total" for n in names],
        *(
            [F.coalesce(F.lead(F.struct(*names)).over(inside), F.col("_next_range")).alias("next")]
            if following
            else []
        ),
    )


def hash_rank(
    df: DataFrame, key: str, seed: object, by: Sequence[str] = (), rank: str = "rank", total: str | None = None
) -> DataFrame:
    """Number the rows 1..n (for each ``by`` group) in the order md5(seed|key), key.

    ``key`` must be unique; rows without a key come first. Rows are sorted inside hash prefixes, which stay
    balanced whatever the group sizes are; at most 65,536 prefix counts per group
    are accumulated to shift them.
    """
    by = list(by)
    hashed = df.withColumn(HASH, F.coalesce(hash_order(key, seed), F.lit(""))).withColumn(BUCKET, F.substring(HASH, 1, 4))
    counts = hashed.groupBy(*by, BUCKET).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        *by,
        BUCKET,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"),
        *([F.sum("_rows").over(Window.partitionBy(*by)).alias(total)] if total else []),
    )
    inside = Window.partitionBy(*by, BUCKET).orderBy(HASH, key)
    numbered = hashed.join(shifts, [*by, BUCKET])
    return numbered.withColumn(rank, F.col("_shift") + F.row_number().over(inside)).drop(HASH, BUCKET, "_shift")


def sequence_number(df: DataFrame, key: str, name: str = "id", start: int = 1) -> DataFrame:
    """Number the rows in ``key`` order (numeric, unique) without a one-task window; rows
    without a key get no number."""
    runs = ordered_runs(df.select(key), key, {"n": F.count(F.lit(1))})
    return join_values(df, runs.select(key, F.col("n").alias("_count"), (F.col("n_before") + F.lit(start)).alias(name)), [key], "_count", [name])


def rank_pct_average(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "rank_pct") -> DataFrame:
    """Average rank of ties as a share of the present values; missing stays missing."""
    runs = ordered_runs(df, value, {"n": F.count(F.lit(1))}, by)
    share = (F.col("n_before") + (F.col("n") + 1) / 2) / F.col("n_total")
    return join_values(df, runs.select(*by, value, F.col("n").alias("_count"), share.alias(name)), [*by, value], "_count", [name])


def rank_min(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "rank", descending: bool = True) -> DataFrame:
    """Rank where ties share the lowest number; missing values stay unranked."""
    runs = ordered_runs(df, value, {"n": F.count(F.lit(1))}, by, descending=descending)
    return join_values(df, runs.select(*by, value, F.col("n").alias("_count"), (F.col("n_before") + 1).alias(name)), [*by, value], "_count", [name])
