import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("tabkit-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "4g")
         .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tabkit-test-ckpt-"))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    from tabkit.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="session")
def sf_dir():
    return SF0001


@pytest.fixture(scope="session")
def housing(spark):
    """The 4-row housing fixture of the reference's transformer tests."""
    rows = [
        (150000.0, 3.5, 20, 800.0, 200.0, 500.0, 180.0, 37.88, -122.23, "NEAR BAY"),
        (250000.0, 5.0, 35, 1200.0, None, 900.0, 280.0, 34.05, -118.24, "<1H OCEAN"),
        (500001.0, 7.2, 52, 600.0, 150.0, 400.0, 140.0, 32.72, -117.16, "INLAND"),
        (350000.0, 4.1, 15, 900.0, 225.0, 600.0, 200.0, 38.58, -121.49, "INLAND"),
    ]
    schema = ("median_house_value double, median_income double, housing_median_age int, total_rooms double, "
              "total_bedrooms double, population double, households double, latitude double, longitude double, "
              "ocean_proximity string")
    return spark.createDataFrame(rows, schema)
