import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wordbond import Workspace, spark_settings  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("wordbond-tests")
        .config(map=spark_settings(shuffle_partitions=8))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("stages")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark):
    return Workspace(spark)


@pytest.fixture
def lines(spark):
    """Build a one-column table of n-gram lines."""
    return lambda *rows: spark.createDataFrame([(row,) for row in rows], "value string")


@pytest.fixture
def plan_of():
    """The physical plan as text."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return plan
