import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from opsframe import get_spark  # noqa: E402

TEST_DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = get_spark(
        "tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(root / "scratch"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.log.level": "OFF",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    def load(name):
        return spark.read.parquet(f"{TEST_DATA}/{name}.parquet")

    return load


@pytest.fixture(scope="session")
def plan_of():
    """The executed plan of a query as text."""

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text
