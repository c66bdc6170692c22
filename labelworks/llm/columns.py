"""Tables of any columns, for operators that add columns of their own on the way."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def under_numbers(df: DataFrame, keep: Sequence[str]) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """The table with every column but ``keep`` under a number, so that no name can clash with
    those an operator adds, and a function that gives a result its names back: the columns as
    they were, then any further ones."""
    other = {c: f"c{i}" for i, c in enumerate(df.columns) if c not in keep}

    def back(result: DataFrame, *more: Column | str) -> DataFrame:
        return result.select(*[F.col(f"`{other.get(c, c)}`").alias(c) for c in df.columns], *more)

    return df.select(*[F.col(f"`{c}`").alias(other.get(c, c)) for c in df.columns]), back
