"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelworks.operators.keep import keep


def _mark(links: DataFrame):
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _least(rows: DataFrame) -> DataFrame:
    return keep(rows.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")))


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (two integer columns): root is the
    smallest node reachable. Links to oneself and repeated links change nothing; a link
    with a null end is no link. No links, no rows.

    Alternating stars: every node links its larger neighbours, then its smaller ones, to
    the smallest it knows, until nothing changes; the number of rounds grows with the
    logarithm of the longest chain. Each round is written to the shared folder. Minima
    are partial aggregates, and joins on a hub's key can be split.
    """
    x, y = (F.col(c) for c in links.columns)
    links = links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).where((x != y) & x.isNotNull() & y.isNotNull())
    links = keep(links.distinct())
    before = _mark(links)
    while before[0]:
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = F.least("node", "least")
        large = both.join(_least(both), F.col("a") == F.col("node")).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), best.alias("b"))
        large = keep(large.where("a != b").distinct())
        small = large.join(_least(large), F.col("a") == F.col("node"))
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").union(_least(large).toDF("a", "b"))
        links = keep(small.distinct())
        after = _mark(links)
        if after == before:
            break
        before = after
    star = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return keep(star.union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
