import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def tiny_groups(spark):
    """Makes every group of the test tables count as too large for one task."""
    from skeinlog.operators.slices import MAX_GROUP_ROWS, SLICE_ROWS

    def switch(on: bool) -> None:
        if on:
            spark.conf.set(MAX_GROUP_ROWS, "20")
            spark.conf.set(SLICE_ROWS, "150")
        else:
            spark.conf.unset(MAX_GROUP_ROWS)
            spark.conf.unset(SLICE_ROWS)

    yield switch
    switch(False)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
