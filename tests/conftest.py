import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from grantlens.session import tune  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("grantlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def small_tables():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return SMALL


@pytest.fixture
def one(spark):
    """Value of an expression over one text."""

    def evaluate(build, text):
        df = spark.createDataFrame([(text,)], "t string")
        return df.select(build(df["t"]).alias("v")).first()["v"]

    return evaluate
