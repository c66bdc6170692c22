"""Registration of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
#: Nine families over five folds, or a hundred fits and more: minutes each, so they come last.
SLOW = {"benchmark_models", "boosted_trees", "cross_validate", "make_oof", "predict_ensemble", "random_search", "score_column", "select_and_tune", "family_search_random_forest", "family_search_extra_trees", "family_search_boosted_trees"}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register
