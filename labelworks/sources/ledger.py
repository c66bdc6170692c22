"""What a search has measured, kept in a shared folder so that a stopped one goes on."""

from __future__ import annotations

from collections.abc import Iterable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelworks.sources.tables import path_exists

Entry = tuple[str, str, str, float, float]
_FIELDS = "family string, setting string, rows string, test_f1 double, train_f1 double"


class Ledger:
    """Rows ``family, setting, rows, test_f1, train_f1``: the whole setting as text and the digest of
    the rows it was fitted and measured on.

    Every finished fit writes a folder of its own, which Spark commits whole or not at all,
    so fits may end side by side and a stop leaves no half entry. Entries are as many as
    settings x folds.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def table(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], _FIELDS)
        return self.spark.read.schema(_FIELDS).json(f"{self.path}/*")

    def read(self, family: str) -> dict[tuple[str, str], tuple[float, float]]:
        """Scores of (setting, rows)."""
        mine = self.table().where(F.col("family") == family)
        return {(r["setting"], r["rows"]): (r["test_f1"], r["train_f1"]) for r in mine.collect()}

    def add(self, entries: Iterable[Entry]) -> None:
        self.spark.createDataFrame(list(entries), _FIELDS).coalesce(1).write.json(f"{self.path}/{uuid4().hex}")
