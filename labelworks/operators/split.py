"""Deterministic splits, folds, samples and shuffles in the order md5(seed|key).

Sizes and strata are exact; which rows are drawn depends only on seed and key,
so a lost executor or a different cluster gives the same parts again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelworks.functions.scalar import hash_order, to_json
from labelworks.operators.keep import keep
from labelworks.operators.order import hash_rank

SEED = 42
MOST_VALUES = 1000


def _class_quota(df: DataFrame, label: str, test_size: float) -> DataFrame:
    """Test rows for each class: ceil(test_size * n) in all, train shares by largest remainder."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy(F.lit(1))
    rows = F.sum("_n").over(everything)
    train = rows - F.ceil(F.lit(test_size) * rows)
    share = F.col("_n") * train / rows
    base = counts.select(label, "_n", train.alias("_train"), share.alias("_share"), F.floor(share).alias("_base"))
    left = F.col("_train") - F.sum("_base").over(everything)
    turn = F.row_number().over(everything.orderBy((F.col("_share") - F.col("_base")).desc(), label))
    quota = F.col("_base") + F.when(turn <= left, 1).otherwise(0)
    return base.select(label, (F.col("_n") - quota).alias("_test"))


def stratified_split(
    df: DataFrame, label: str, key: str, test_size: float = 0.2, seed: object = SEED, name: str = "part"
) -> DataFrame:
    """Add ``part`` = ``test`` or ``train``, keeping the class shares; rows without a label
    belong to neither and have a missing part."""
    ranked = hash_rank(df.where(F.col(label).isNotNull()), key, seed, [label], rank="_rank")
    side = F.when(F.col("_rank") <= F.col("_test"), "test").otherwise("train")
    placed = ranked.join(keep(_class_quota(df, label, test_size)), label).withColumn(name, side).select(*df.columns, name)
    return placed.unionByName(_unlabelled(df, label, name, "string"))


def _unlabelled(df: DataFrame, label: str, name: str, kind: str) -> DataFrame:
    return df.where(F.col(label).isNull()).withColumn(name, F.lit(None).cast(kind))


def stratified_kfold(
    df: DataFrame, label: str, key: str, k: int = 5, seed: object = SEED, name: str = "fold"
) -> DataFrame:
    """Add ``fold`` in 0..k-1; fold sizes differ by at most one, within classes and in all.
    Rows without a label belong to no fold and have a missing one."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(F.lit(1)).orderBy(label).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(label, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    offsets = keep(offsets)
    ranked = hash_rank(df.where(F.col(label).isNotNull()), key, seed, [label], rank="_rank")
    fold = F.pmod(F.col("_rank") - 1 + F.col("_offset"), F.lit(k)).cast("int")
    folded = ranked.join(offsets, label).withColumn(name, fold).select(*df.columns, name)
    return folded.unionByName(_unlabelled(df, label, name, "int"))


def fitting_sample(df: DataFrame, label: str, key: str, rows: int, seed: object = SEED, name: str = "fit_weight") -> DataFrame:
    """At most ``rows`` rows in md5 order, with the weight that restores the share of their class.

    Half of the sample is dealt to the classes alike (a small one goes whole), the rest by
    their size; a row counts as many rows of its class as there are for each drawn one. A
    table that is no larger goes whole, every weight 1. Rows without a label are left out.

    Counts of 65,536 hash prefixes for each class show where the sample ends; only rows up
    to there are kept and ranked, so the table is read twice and never sorted.
    """
    known = df.where(F.col(label).isNotNull()).withColumn("_prefix", F.substring(F.coalesce(hash_order(key, seed), F.lit("")), 1, 4))
    counts = keep(known.groupBy(label, "_prefix").agg(F.count(F.lit(1)).alias("_rows")))
    everything = Window.partitionBy(F.lit(1))
    classes = counts.groupBy(label).agg(F.sum("_rows").alias("_n")).withColumn("_k", F.count(F.lit(1)).over(everything))
    alike = F.least(F.col("_n"), F.floor(F.lit(rows) / (2 * F.col("_k"))))
    left, free = F.lit(rows) - F.sum("_alike").over(everything), F.sum(F.col("_n") - F.col("_alike")).over(everything)
    more = F.least(F.col("_n") - F.col("_alike"), F.floor(F.coalesce(F.try_divide((F.col("_n") - F.col("_alike")) * left, free), F.lit(0.0))))
    takes = keep(classes.withColumn("_alike", alike).withColumn("_take", (F.col("_alike") + more).cast("long")).select(label, "_n", "_take"))
    before = Window.partitionBy(label).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    reached = counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).join(takes, label)
    last = keep(reached.where(F.col("_before") < F.col("_take")).groupBy(label, "_n", "_take").agg(F.max("_prefix").alias("_last")))
    near = known.join(last, label).where(F.col("_prefix") <= F.col("_last"))
    drawn = hash_rank(near, key, seed, [label], rank="_rank").where(F.col("_rank") <= F.col("_take"))
    return drawn.select(*df.columns, (F.col("_n") / F.col("_take")).alias(name))


def hashed_kfold(df: DataFrame, key: str, k: int = 5, seed: int = SEED, name: str = "fold") -> DataFrame:
    """Folds without any shuffle, from the first eight digits of md5(seed|key); balanced
    in expectation only. Rows without a key have a missing fold."""
    digits = F.conv(F.substring(hash_order(key, seed), 1, 8), 16, 10).cast("long")
    return df.withColumn(name, F.pmod(digits, F.lit(k)).cast("int"))


def fold_train_rows(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return df.where(F.col(name) != fold)


def fold_valid_rows(df: DataFrame, fold: int, name: str = "fold") -> DataFrame:
    return df.where(F.col(name) == fold)


def bounded_sample(df: DataFrame, key: str, n: int = 200, seed: object = SEED) -> DataFrame:
    """min(n, rows) rows without replacement; a distributed top-n, not a sort."""
    return df.orderBy(hash_order(key, seed), key).limit(n)


def donor_rows(df: DataFrame, key: str, columns: Sequence[str], repeats: int, seed: object = SEED) -> DataFrame:
    """For each repeat, pair every row with the row that a random permutation puts there.

    Output: the columns of ``df``, ``repeat`` (1..repeats) and a struct ``donor``
    with the ``columns`` of the partner. Two independent hash numberings are
    joined on the position, so the values of a column keep their multiset.
    """
    each = F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("repeat")

    def numbered(side: str, *columns_: Column) -> DataFrame:
        rows = df.select(each, *columns_).withColumn("_seat", F.concat_ws("|", F.col("repeat"), F.col("_id")))
        return hash_rank(rows, "_seat", f"{seed}|{side}", ["repeat"], rank="_position").drop("_seat", "_id")

    here = numbered("row", *[F.col(c) for c in df.columns], F.col(key).alias("_id"))
    there = numbered("donor", F.col(key).alias("_id"), F.struct(*columns).alias("donor"))
    return here.join(there, ["repeat", "_position"]).drop("_position")


def shuffle_column(df: DataFrame, key: str, column: str, repeats: int = 1, seed: object = SEED) -> DataFrame:
    """Permute one column against the rest, once for each repeat."""
    paired = donor_rows(df, key, [column], repeats, seed)
    others = [F.col("donor")[column].alias(c) if c == column else F.col(c) for c in df.columns]
    return paired.select("repeat", *others)


def distinct_lists(df: DataFrame, columns: Sequence[str], most: int = MOST_VALUES) -> dict[str, list[object]]:
    """The present values of each column in order, for use as a search space.

    A search space is small; a column with more than ``most`` values fails.
    """
    out = {}
    for c in columns:
        rows = df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c).limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{c} has more than {most} values")
        out[c] = [r[0] for r in rows]
    return out


def param_cross(df: DataFrame, lists: Mapping[str, Sequence[object]]) -> DataFrame:
    """Each row with every combination of the lists, one explode a list: rows never meet."""
    for name, values in lists.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def parameter_grid(spark: SparkSession, space: Mapping[str, Sequence[object]]) -> DataFrame:
    """All points of a search space, values as text (JSON form), numbered from 0."""
    size = prod(len(v) for v in space.values())
    names, stride = list(space), size
    out = []
    for name in names:
        values = F.array(*[F.lit(to_json(v)) for v in space[name]])
        stride //= len(space[name])
        out.append(F.get(values, F.floor(F.col("id") / stride).cast("int") % len(space[name])).alias(name))
    return spark.range(size).select(F.col("id").alias("point"), *out)


def parameter_sample(points: DataFrame, n: int, seed: object = SEED) -> DataFrame:
    """n distinct grid points (all of them when there are fewer)."""
    return bounded_sample(points, "point", n, seed)
