import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


# Made on import, as columns can only be built while there is a session.
SPARK = (
    SparkSession.builder.master("local[8]")
    .appName("winnow-tests")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .config("spark.sql.shuffle.partitions", "8")
    .config("spark.driver.memory", "6g")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="winnow-shared-"))
    .getOrCreate()
)
SPARK.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SPARK


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of an expression over one row per input tuple, in input order."""

    def run(rows, schema, expr):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
        return [r.out for r in df.select("i", expr.alias("out")).orderBy("i").collect()]

    return run
