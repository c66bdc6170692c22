"""CSV input and output, and the checks made before anything runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelworks.functions.scalar import cast_int, null_if_nan

# The passenger table the feature stage is made for.
PASSENGERS = T.StructType(
    [
        T.StructField("PassengerId", T.LongType()),
        T.StructField("Survived", T.IntegerType()),
        T.StructField("Pclass", T.IntegerType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Sex", T.StringType()),
        T.StructField("Age", T.DoubleType()),
        T.StructField("SibSp", T.IntegerType()),
        T.StructField("Parch", T.IntegerType()),
        T.StructField("Ticket", T.StringType()),
        T.StructField("Fare", T.DoubleType()),
        T.StructField("Cabin", T.StringType()),
        T.StructField("Embarked", T.StringType()),
    ]
)


def normalise_missing(df: DataFrame) -> DataFrame:
    """Not-a-number becomes missing, so there is one kind of missing value."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: null_if_nan(c) for c in floats}) if floats else df


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header and a declared schema; a bad value or header fails the query.

    ``NA`` and empty cells are missing, and doubled quotes inside a quoted cell
    stand for one quote. With ``multi_line`` a quoted cell may hold line breaks; each
    file is then read by one task, so large tables should come in many files.
    """
    reader = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
    reader = reader.option("escape", '"').option("nullValue", "NA").option("emptyValue", "").option("multiLine", multi_line)
    return normalise_missing(reader.csv(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists on its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def require_inputs(spark: SparkSession, paths: Sequence[str]) -> None:
    """Fail with the list of all paths that are absent."""
    absent = [p for p in paths if not path_exists(spark, p)]
    if absent:
        raise FileNotFoundError(f"missing inputs: {absent}")


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"the table must include {absent}; it has {df.columns}")
    return df


def submission(predicted: DataFrame, key: str, value: str, target: str, as_int: bool = True) -> DataFrame:
    """Two columns: the key and the prediction (0/1, or the score as it is)."""
    out = cast_int(value) if as_int else F.col(value)
    return predicted.select(key, out.alias(target))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV parts with a header each, written by the executors; parent folders are made."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_submission(predicted: DataFrame, path: str, key: str, value: str, target: str, as_int: bool = True) -> None:
    write_csv(submission(predicted, key, value, target, as_int), path)


def details_path(path: str) -> str:
    """``x.csv`` -> ``x_details.csv``."""
    stem, dot, suffix = path.rpartition(".")
    return f"{stem}_details.{suffix}" if dot and "/" not in suffix else f"{path}_details"


def write_details(details: DataFrame, path: str) -> None:
    write_csv(details, details_path(path))
