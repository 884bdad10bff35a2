import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("barloom-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.maxMetadataStringLength", "5000")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barloom-checkpoint-"))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


@pytest.fixture
def bars(spark):
    """Bars from (symbol, time, close[, volume]) tuples."""

    def make(*rows):
        full = [(r[0], r[1], r[2], r[2], r[2], r[2], r[3] if len(r) > 3 else 1.0) for r in rows]
        return spark.createDataFrame(
            full,
            "symbol string, open_time long, open double, high double, low double, close double, volume double",
        )

    return make
