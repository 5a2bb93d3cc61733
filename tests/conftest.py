import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def place(spark, tmp_path):
    """Makes a destination and its state store in a fresh folder."""
    from rowferry.plans.state import StateStore
    from rowferry.sources.table import DestTable

    def make(spec, name="t"):
        return DestTable(spark, str(tmp_path / name / "dest"), spec), StateStore(spark, str(tmp_path / name / "state"))

    return make
