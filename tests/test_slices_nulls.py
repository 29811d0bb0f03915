"""Rows without a date or place go through the sliced way as they do through the plain one."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from phenospark.operators.consistency import consistency_filter
from phenospark.operators.outliers import flag_global_outliers, flag_seasonal_outliers
from phenospark.operators.slices import with_slices

SLICED = {"min_rows": 5, "share": 0.0}


@pytest.fixture(scope="module")
def rows(spark):
    day = dt.date(2020, 1, 1)
    found = [("a", day + dt.timedelta(days=3 * k), 0.2 + 0.01 * (k % 7) + (0.5 if k == 20 else 0)) for k in range(50)]
    found += [("a", None, 0.3), (None, day, 0.4), (None, None, 0.9)]
    return spark.createDataFrame(found, "location_id string, date date, ndvi_raw double")


@pytest.mark.parametrize("work", [
    lambda df, **hot: consistency_filter(df, drop=False, **hot), flag_global_outliers, flag_seasonal_outliers,
])
def test_sliced_equals_plain(rows, work):
    def plain(df):
        return sorted(map(str, df.select([F.col(c) for c in sorted(df.columns)]).collect()))

    sliced = work(rows, **SLICED)
    assert sliced.count() == 53
    assert plain(sliced) == plain(work(rows))


@pytest.mark.parametrize("day_rows", ["text", "equal", "extreme"])
def test_crowded_day_is_cut_by_rank(spark, day_rows):
    day, found = dt.date(2020, 1, 1), []
    for k in range(400):
        value = {"text": (k * 37 % 100) / 100, "equal": 0.5, "extreme": 1e9 if k == 7 else k * 37 % 100 / 100}[day_rows]
        found.append(("a", day, f"tag {k * 7919 % 401:03}", value))
    df = spark.createDataFrame(found, "location_id string, date date, tag string, ndvi_raw double")
    sizes = with_slices(df, ["tag", "ndvi_raw"], min_rows=50, share=0.0).groupBy("slice_part").count()
    assert sizes.agg(F.max("count")).first()[0] <= 100
    work = {"tie_break": ("tag",), "drop": False, "window": 3}
    plain = sorted(map(str, consistency_filter(df, **work).collect()))
    assert sorted(map(str, consistency_filter(df, **work, min_rows=50, share=0.0).collect())) == plain
