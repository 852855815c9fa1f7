import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("resultlake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stage")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from resultlake.session import configure

    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def evaluate(spark, function, values):
    """Apply a function of columns to Python values (or tuples), keeping their order."""
    rows = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    names = [f"c{n}" for n in range(1, len(rows[0]))]
    schema = "i int, " + ", ".join(f"{n} string" for n in names)
    out = function(*(F.col(n) for n in names))
    df = spark.createDataFrame(rows, schema).select("i", out.alias("out"))
    return [r["out"] for r in sorted(df.collect(), key=lambda r: r["i"])]
