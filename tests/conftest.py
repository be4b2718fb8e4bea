import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from wiremere import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session.build(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def frame(spark):
    """frame("a string, b int", rows) -> DataFrame"""
    return lambda ddl, rows: spark.createDataFrame(rows, ddl)
