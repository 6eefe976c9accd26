import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = os.environ.get("TESTDATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    with tempfile.TemporaryDirectory(prefix="scrubline-tests-") as scratch:
        session = (
            SparkSession.builder.master("local[8]")
            .appName("scrubline-tests")
            .config("spark.ui.enabled", "false")
            .config("spark.ui.showConsoleProgress", "false")
            .config("spark.sql.shuffle.partitions", "8")
            .config("spark.driver.memory", "8g")
            .config("spark.sql.session.timeZone", "UTC")
            .config("spark.checkpoint.dir", scratch)
            .getOrCreate()
        )
        session.sparkContext.setLogLevel("ERROR")
        yield session
        session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{TESTDATA}/{os.environ.get('TEST_SF', 'sf0.001')}"
