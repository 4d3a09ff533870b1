import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from assurspark.session import configure
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from assurspark.sources import driver_fixtures
    con = duckdb.connect()
    for n in driver_fixtures.DRIVER_TABLES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{SF_SMALL}/{n}.parquet'")
    return con


@pytest.fixture(scope="session")
def tables(spark):
    from assurspark.sources.catalog import Tables
    return Tables.from_driver_data(spark, SF_SMALL)
