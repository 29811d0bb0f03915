import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from phenospark.functions import values
from phenospark.operators import clean
from phenospark.schema import MissingColumnsError, require_columns
from .conftest import column

RAW = "latitude double, longitude double, date string, ndvi_raw double"


def test_clean_three_places(spark):
    rows = [(40.0, -74.0, "2020-01-01", 0.5), (40.1, -74.1, "2020-02-01", 0.6),
            (40.2, -74.2, "2020-03-01", 0.7)]
    out = clean.clean(spark.createDataFrame(rows, RAW))
    assert out.schema["date"].dataType.simpleString() == "date"
    assert out.select("location_id").distinct().count() == 3
    assert column(out, "ndvi_raw", "date") == [0.5, 0.6, 0.7]


def test_clip_keeps_missing(spark):
    df = spark.createDataFrame([(-3.0,), (-1.0,), (0.4,), (2.0,), (None,)], "ndvi_raw double")
    assert [r[0] for r in clean.clip_values(df).collect()] == [-1.0, -1.0, 0.4, 1.0, None]


@pytest.mark.parametrize("mode, given, expected", [
    ("auto", [5000.0, 200.0], [0.5, 0.02]),
    ("auto", [0.9, 0.2], [0.9, 0.2]),
    ("always", [5000.0, 200.0], [0.5, 0.02]),
    ("never", [5000.0, 200.0], [5000.0, 200.0]),
])
def test_scale(spark, mode, given, expected):
    df = spark.createDataFrame([(v,) for v in given], "ndvi_raw double")
    assert [r[0] for r in clean.scale_values(df, mode).collect()] == pytest.approx(expected)


@pytest.mark.parametrize("style, expected", [
    ("canonical", "40.0000_-74.1235"), ("compact", "40.0_-74.1234"),
])
def test_location_key(spark, style, expected):
    df = spark.createDataFrame([(40.0, -74.12345)], "latitude double, longitude double")
    assert clean.with_location_key(df, style).first()["location_id"] == expected


def test_compact_key_prints_small_values_plainly(spark):
    df = spark.createDataFrame([(0.0005, -0.00012)], "latitude double, longitude double")
    assert clean.with_location_key(df, "compact").first()["location_id"] == "0.0005_-0.0001"


def test_canonical_key_equals_formatting(spark):
    given = [0.0, -0.0, -0.00001, 0.00005, -74.12345, 179.99995, -90.0, 12.3456789, 99999.99999]
    df = spark.createDataFrame([(x,) for x in given], "x double")
    key = values.location_key(F.col("x"), F.col("x"))
    assert df.where(key != F.format_string("%.4f_%.4f", "x", "x")).count() == 0


def test_missing_coordinate_has_no_key(spark):
    df = spark.createDataFrame([(None, 1.0)], "latitude double, longitude double")
    assert clean.with_location_key(df).first()["location_id"] is None


def test_dates(spark):
    df = spark.createDataFrame([("2020-02-30",), ("2020-02-03",), ("no",)], "date string")
    assert [r[0] for r in clean.parse_dates(df, "lenient").collect()] == [dt.date(2020, 2, 3)]
    with pytest.raises(PySparkException):
        clean.parse_dates(df).collect()


def test_incomplete_rows_are_counted_and_dropped(spark):
    rows = [(1.0, 2.0, "2020-01-01", 0.5), (None, 2.0, "2020-01-01", 0.5),
            (1.0, 2.0, "2020-01-01", float("nan"))]
    df = spark.createDataFrame(rows, RAW)
    assert clean.clean(df).count() == 1
    marked = df.withColumn("ndvi_raw", values.null_if_nan(F.col("ndvi_raw")))
    assert clean.count_incomplete(marked).first().asDict() == {"rows": 3, "removed": 2}


def test_cloud_mask_and_flag(spark):
    rows = [(0.05, 3), (0.5, 1), (0.5, 3), (None, 3), (0.5, None)]
    df = spark.createDataFrame(rows, "ndvi_raw double, q int")
    mask = [r[0] for r in clean.mask_clouds(df, "q").collect()]
    assert mask == [None, None, 0.5, None, 0.5]
    assert [r["is_cloud"] for r in clean.flag_clouds(df, "q").collect()] == [
        True, True, False, False, False]


def test_missing_columns_raise_before_any_job(spark):
    with pytest.raises(MissingColumnsError, match="ndvi_raw"):
        require_columns(spark.range(1), ["id", "ndvi_raw"])


def test_coordinates_off_the_globe_are_split_off(spark):
    rows = [(91.0, 0.0), (0.0, 181.0), (None, 0.0), (-90.0, 180.0)]
    good, bad = clean.split_by_coordinates(
        spark.createDataFrame(rows, "latitude double, longitude double"))
    assert (good.count(), bad.count()) == (1, 3)
