import datetime as dt

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("waybill-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def ts():
    """`ts("2020-01-31 10:00")` as a datetime; None stays None."""

    def parse(text):
        return None if text is None else dt.datetime.fromisoformat(text)

    return parse


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate column expressions over one row of named values."""

    def evaluate(schema, values, *columns):
        row = spark.createDataFrame([values], schema).select(*columns).first()
        return row[0] if len(columns) == 1 else tuple(row)

    return evaluate
