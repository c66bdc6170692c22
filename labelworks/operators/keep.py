"""Keeping an intermediate table for reuse."""

from __future__ import annotations

from collections import Counter
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: ``spark.checkpoint.dir``, or
    the warehouse where that is unset. Never a folder of one machine's own choosing.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return named.rstrip("/")


def keep(df: DataFrame) -> DataFrame:
    """Write the table to the shared folder and go on from the written one.

    Later jobs scan files instead of carrying the whole lineage, and a lost
    executor costs nothing that was written. The planner then knows the real size
    of the table: joined to a large one it is broadcast when it is small and
    shuffled when it is not, without a hint, where the estimate for an aggregate
    (as large as its input) would first shuffle the large side.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}/{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_released: Counter[str] = Counter()


def releases(spark: SparkSession) -> int:
    """How often this session's kept tables were deleted: what rests on them is gone when it changes."""
    return _released[spark.sparkContext.applicationId]


def release(spark: SparkSession) -> None:
    """Delete every table this session has kept; its results must have been used by then."""
    context = spark.sparkContext
    _released[context.applicationId] += 1
    path = context._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/tables/{context.applicationId}")
    path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
