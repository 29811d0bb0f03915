import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from phenospark.operators import features
from phenospark.operators.resample import resample
from phenospark.operators.score import rule_scores
from phenospark.streaming import jobs

OBS = "location_id string, latitude double, longitude double, date date, ndvi_raw double"


class Feed:
    """A folder of Parquet files read as a stream, one batch per file."""

    def __init__(self, spark, folder):
        self.spark, self.path, self.rows = spark, str(folder / "in"), []
        self.folder = folder

    def add(self, rows):
        self.rows += rows
        self.spark.createDataFrame(rows, OBS).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        schema = self.spark.createDataFrame([], OBS).schema
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.path)

    def batch(self):
        return self.spark.createDataFrame(self.rows, OBS)

    def at(self, name):
        return str(self.folder / name)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def months(place, first, count, rng):
    """Two rows a month, some months empty."""
    out = []
    for m in range(first, first + count):
        if m % 7 == 5:
            continue
        for day in (3, 20):
            out.append((place, 1.0, 2.0, dt.date(2020 + m // 12, m % 12 + 1, day), rng.random()))
    return out


def test_scores_equal_the_batch_over_restarts(spark, feed):
    rng = random.Random(0)
    for first in (0, 12):
        feed.add(months("1.0000_2.0000", first, 12, rng))
        stream = jobs.score_stream(feed.stream())
        jobs.write_stream(stream, feed.at("out"), feed.at("state")).awaitTermination()
    columns = ["date", "bloom_probability", "bloom_predicted", "ndvi"]
    got = spark.read.parquet(feed.at("out")).select(columns)
    assert sorted(got.collect()) == sorted(rule_scores(feed.batch()).select(columns).collect())


def test_monthly_updates_equal_the_batch(spark, feed):
    rng = random.Random(1)
    late = [("a", 1.0, 2.0, dt.date(2020, 12, 9), 0.9)]  # still within the bound
    for rows in (months("a", 0, 12, rng) + months("b", 0, 12, rng), late + months("a", 12, 2, rng)):
        feed.add(rows)
        stream = jobs.monthly_stream(feed.stream(), "62 days")
        jobs.write_updates(stream, feed.at("out"), feed.at("state")).awaitTermination()
    latest = jobs.latest_updates(spark.read.parquet(feed.at("out")), ("location_id", "month"))
    got = {(r["location_id"], r["month"].date()): (r["month_mean"], r["month_rows"])
           for r in latest.collect()}
    wanted = {(r["location_id"], r["m"]): (r["v"], r["n"]) for r in feed.batch().groupBy(
        "location_id", F.trunc("date", "month").alias("m")).agg(
        F.avg("ndvi_raw").alias("v"), F.count("*").alias("n")).collect()}
    assert set(got) == set(wanted)
    for key, (mean, n) in wanted.items():
        assert got[key] == (pytest.approx(mean), n)


def test_rows_beyond_the_bound_come_too_late(spark, feed):
    rng = random.Random(2)
    feed.add(months("a", 0, 12, rng))
    too_late = [("a", 1.0, 2.0, dt.date(2020, 1, 9), 0.9)]
    counts = []
    for extra in (None, months("a", 12, 3, rng), too_late):
        if extra:
            feed.add(extra)
        stream = jobs.monthly_stream(feed.stream(), "62 days")
        jobs.write_updates(stream, feed.at("out"), feed.at("state")).awaitTermination()
        latest = jobs.latest_updates(spark.read.parquet(feed.at("out")), ("location_id", "month"))
        january = latest.where("month = timestamp '2020-01-01'").first()
        counts.append(january["month_rows"])
    assert counts == [2, 2, 2]


def test_trailing_features_equal_the_batch_over_restarts(spark, feed):
    rng = random.Random(3)
    for first, count in ((0, 9), (9, 9), (18, 9)):
        feed.add(months("a", first, count, rng) + months("b", first, count, rng))
        closing = jobs.monthly_stream(feed.stream())
        jobs.write_stream(closing, feed.at("months"), feed.at("months-state")).awaitTermination()
        closed = spark.readStream.schema(jobs.MONTHS).parquet(feed.at("months"))
        jobs.write_stream(
            jobs.trailing_stream(closed), feed.at("out"), feed.at("state")).awaitTermination()
    got = spark.read.parquet(feed.at("out")).orderBy("location_id", "date").collect()
    batch = features.add_lags(resample(feed.batch()), "ndvi_raw")
    batch = features.add_differences(features.add_rolling(batch, "ndvi_raw"), "ndvi_raw")
    wanted = {(r["location_id"], r["date"]): r for r in batch.collect()}
    assert len(got) > 40 and len({(r["location_id"], r["date"]) for r in got}) == len(got)
    for row in got:
        full = wanted[row["location_id"], row["date"]]
        for name in jobs.TRAILING.names[3:]:
            expected = full[name]
            if expected is None:
                assert row[name] is None, name
            else:
                assert row[name] == pytest.approx(expected, abs=1e-9), name


def test_trailing_updates_reach_the_open_months(spark, feed):
    rng = random.Random(4)
    late = [("a", 1.0, 2.0, dt.date(2020, 8, 9), 0.9)]  # changes a month that was given before
    for rows in (months("a", 0, 9, rng) + months("b", 2, 7, rng), late + months("a", 9, 9, rng), months("b", 20, 3, rng)):
        feed.add(rows)
        jobs.write_updates(
            jobs.monthly_stream(feed.stream()), feed.at("months"), feed.at("months-state")).awaitTermination()
        changes = spark.readStream.schema(jobs.MONTH_UPDATES).parquet(feed.at("months"))
        jobs.write_updates(
            jobs.trailing_stream(changes, "update"), feed.at("out"), feed.at("state")).awaitTermination()
    table = jobs.latest_updates(spark.read.parquet(feed.at("out")), ("location_id", "date"))
    got = {(r["location_id"], r["date"]): r for r in table.collect()}
    batch = features.add_lags(resample(feed.batch()), "ndvi_raw")
    batch = features.add_differences(features.add_rolling(batch, "ndvi_raw"), "ndvi_raw")
    wanted = {(r["location_id"], r["date"]): r for r in batch.collect()}
    assert set(got) == set(wanted)
    for key, full in wanted.items():
        for name in jobs.TRAILING.names[3:]:
            assert got[key][name] == (None if full[name] is None else pytest.approx(full[name], abs=1e-9)), (key, name)
