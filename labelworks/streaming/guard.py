"""Some results depend on the whole batch (ranks, score ranges); they refuse streams."""

from __future__ import annotations

from pyspark.sql import DataFrame


def require_batch(df: DataFrame, what: str) -> DataFrame:
    if df.isStreaming:
        raise ValueError(f"{what} depends on the whole batch and cannot read a stream")
    return df
