import datetime as dt

import pytest
from pyspark.sql import functions as F

from phenospark.sources import summaries
from phenospark.sources.writers import summarise

SCHEMA = "location_id string, date date, ndvi_smoothed double"


def row(year, place, value):
    return (place, None if year is None else dt.date(year, 3, 1), value)


def shown(spark, path):
    names = ("part", "year", "records", "locations", "lowest", "highest", "mean", "locations_estimate")
    return sorted((tuple(r) for r in summaries.read_summary(spark, path).select(*names).collect()), key=repr)


def test_years_are_replaced_and_merged(spark, tmp_path):
    path = str(tmp_path / "s")
    first = [row(2019, "a", 1.0), row(2019, "a", 3.0), row(2020, "a", 5.0), row(2020, "b", None),
             row(None, "c", float("nan")), row(2020, None, 2.0)]
    for _ in range(2):  # a re-run doubles nothing
        summaries.publish_summary(spark.createDataFrame(first, SCHEMA), path)
    assert shown(spark, path) == sorted([
        ("all", None, 6, 3, 1.0, 5.0, 2.75, 3), ("year", 2019, 2, 1, 1.0, 3.0, 2.0, 1),
        ("year", 2020, 3, 2, 2.0, 5.0, 3.5, 2), ("year", None, 1, 1, None, None, None, 1)], key=repr)
    summaries.publish_summary(spark.createDataFrame([row(2020, "d", 7.0)], SCHEMA), path, covers=(2019, 2020))
    assert shown(spark, path) == sorted([
        ("all", None, 2, 2, 7.0, 7.0, 7.0, 2), ("year", 2020, 1, 1, 7.0, 7.0, 7.0, 1),
        ("year", None, 1, 1, None, None, None, 1)], key=repr)


def test_an_empty_table_has_a_summary(spark, tmp_path):
    path = str(tmp_path / "s")
    summaries.publish_summary(spark.createDataFrame([], SCHEMA), path)
    assert shown(spark, path) == [("all", None, 0, 0, None, None, None, 0)]
    assert summaries.estimated_locations(spark, path, 2000, 2030).first()[0] == 0


def test_estimates_of_many_places(spark, tmp_path):
    path = str(tmp_path / "s")
    table = spark.range(300_000).select(
        F.concat(F.lit("p"), F.col("id") % 120_000).alias("location_id"),
        F.make_date(2000 + (F.col("id") % 7).cast("int"), F.lit(1), F.lit(1)).alias("date"),
        (F.col("id") % 100 / 100).alias("ndvi_smoothed"))
    summaries.publish_summary(table, path)
    rows = summaries.read_summary(spark, path).collect()
    assert len(rows) == 8 and all(abs(r["estimate_error"]) < 0.02 for r in rows)
    whole, = [r for r in rows if r["part"] == "all"]
    plain = summarise(table).first()
    for name in ("records", "locations", "first_date", "last_date", "lowest", "highest"):
        assert whole[name] == plain[name]
    assert whole["mean"] == pytest.approx(plain["mean"])
    some = table.where(F.year("date").between(2001, 2003)).select("location_id").distinct().count()
    guess = summaries.estimated_locations(spark, path, 2001, 2003).first()[0]
    assert abs(guess - some) < 0.02 * some


def test_the_merge_reads_no_row_of_the_table(spark, tmp_path):
    path = str(tmp_path / "s")
    summaries.publish_summary(spark.createDataFrame([row(2019, "a", 1.0)], SCHEMA), path)
    files = summaries.estimated_locations(spark, path, 2019, 2019).inputFiles()
    assert files and all("/years/" in f for f in files)
