import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[n]) for n in (1, 0)]
from given import DATA  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("silverline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="silverline-tests-"))
        .config("spark.ui.enabled", "false").config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def table(spark):
    return lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")
