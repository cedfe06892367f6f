import os
import sys

import pytest
from pyspark.sql import SparkSession

HERE = os.path.dirname(os.path.abspath(__file__))
for folder in (os.path.dirname(HERE), HERE):
    sys.path.insert(0, folder)

from tidewatch.session import configure  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidewatch-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def records(spark):
    """Build broker records from values of one partition."""
    from tidewatch.schemas import RECORD

    def build(values, topic="alerts", partition=0, first=0):
        rows = [
            (topic, partition, first + i, None, None,
             bytearray(v.encode() if isinstance(v, str) else v) if v is not None else None)
            for i, v in enumerate(values)
        ]
        return spark.createDataFrame(rows, RECORD)

    return build
