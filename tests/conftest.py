import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    folder = os.environ.get("TEST_CHECKPOINTS") or tempfile.mkdtemp(prefix="checkpoints-")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.sql.codegen.wholeStage", "false")  # tiny tables: compiling takes longer than running
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", folder)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from labelworks.operators.keep import release

    release(session)
    session.stop()


@pytest.fixture(scope="session")
def passengers(spark):
    """Small passenger table: survival depends on title and fare; some cells are missing."""
    rows = []
    for i in range(1, 181):
        title = ("Mr", "Mrs", "Miss", "Dr")[i % 4]
        sex = "male" if title in ("Mr", "Dr") else "female"
        fare = float((i * 37) % 90) + 0.5
        lives = int((sex == "female") != (i % 11 == 0)) if fare > 20 else int(i % 5 == 0)
        age = None if i % 6 == 0 or title == "Dr" else float(18 + (i * 7) % 50)
        cabin = None if i % 3 else f"{'ABC'[i % 9 // 3]}{i}"
        port = None if i == 50 else "SCQ"[i % 3]
        rows.append((i, lives, 1 + i % 3, f"Last{i}, {title}. First", sex, age, i % 2, i % 4, f"PC {i}", fare, cabin, port))
    from labelworks.sources.tables import PASSENGERS

    return spark.createDataFrame(rows, PASSENGERS).repartition(3).persist()
