"""Sessions for tests and benchmarks on one machine, and this package on the executors."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

from labelworks.operators.keep import shared_folder

_shipped: set[str] = set()
_shipping = Lock()


def local_session(app: str, cores: int | str = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def on_executors(df: DataFrame) -> DataFrame:
    """The same table, for Python functions of this package.

    Tasks import those functions, so the package has to be on the executors. Where the
    driver runs it from a folder, its files are sent along as a zip, once for each
    application; where it came with the job (``--py-files``), it is there already.
    """
    spark = df.sparkSession
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    # Several driver threads may come here at once; a file written twice would not match its first copy.
    with _shipping:
        if context.applicationId in _shipped or not package.is_dir():
            return df
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        target = context._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/code/{context.applicationId}/{package.name}.zip")
        stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target)
        stream.write(bytearray(data.getvalue()))
        stream.close()
        context.addPyFile(target.toString())
        _shipped.add(context.applicationId)
    return df
