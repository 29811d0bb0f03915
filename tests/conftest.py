import datetime as dt
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tmp_path_factory.mktemp("shared").as_uri())
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def month_start(index, year=2020):
    return dt.date(year + index // 12, index % 12 + 1, 1)


def series_rows(values, location="a", latitude=10.0, longitude=20.0, first=0):
    return [
        (location, latitude, longitude, month_start(first + i), v)
        for i, v in enumerate(values)
    ]


SERIES = "location_id string, latitude double, longitude double, date date, ndvi_raw double"


@pytest.fixture(scope="session")
def make_series(spark):
    def make(*series, column="ndvi_raw"):
        rows = [r for n, s in enumerate(series) for r in series_rows(s, f"loc{n}")]
        return spark.createDataFrame(rows, SERIES.replace("ndvi_raw", column))

    return make


def column(df, name, *order):
    return [r[name] for r in df.orderBy(*(order or ("location_id", "date"))).collect()]
