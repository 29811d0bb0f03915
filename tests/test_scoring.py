import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from phenospark.functions import calendar, values
from phenospark.operators import score
from phenospark.operators.joins import salted_join
from phenospark.plans.scoring import prediction_export, request_features, requested_rows, score_requests
from .conftest import column


def test_rule_by_hand(spark):
    rows = [(dt.date(2020, 5, 1), 0.9), (dt.date(2020, 1, 1), 0.0), (dt.date(2020, 1, 1), 0.5),
            (dt.date(2020, 5, 1), None)]
    out = score.rule_scores(spark.createDataFrame(rows, "date date, ndvi_smoothed double"))
    got = [(r["bloom_probability"], r["bloom_predicted"]) for r in out.collect()]
    assert [g[0] for g in got] == pytest.approx([0.9, 0.1, 0.4, 0.1])
    assert [g[1] for g in got] == [True, False, False, False]


def test_first_existing_value_column_counts(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), 0.25)], "date date, ndvi_raw double")
    assert score.rule_scores(df).first()["bloom_probability"] == pytest.approx(0.2)
    assert score.rule_scores(df.drop("ndvi_raw")).first()["ndvi"] == 0.5


def test_onsets(spark):
    rows = [("a", dt.date(2021, 1, 1), 0.5, False, 46.0), ("a", dt.date(2021, 2, 1), 0.51, False, 1.0),
            ("a", dt.date(2021, 3, 1), 0.9, True, 1.0)]
    df = spark.createDataFrame(
        rows, "location_id string, date date, bloom_probability double, "
        "bloom_predicted boolean, predicted_onset_doy double")
    day = "predicted_onset_date"
    assert score.onset_by_probability(df).first()[day] == dt.date(2021, 2, 1)
    assert score.onset_by_flag(df).first()[day] == dt.date(2021, 3, 1)
    assert score.onset_by_day(df).first()[day] == dt.date(2021, 2, 1)
    assert score.confidence(df).first()["confidence"] == pytest.approx(1.91 / 3)
    assert score.confidence(df.drop("bloom_probability")).first()["confidence"] == 0.8


def test_bloom_events_and_peak(make_series):
    df = make_series([0.2, 0.7, 0.61, 0.9, 0.9, 0.1], [None, None])
    events = {r["location_id"]: r["bloom_events"] for r in score.bloom_events(df).collect()}
    assert events == {"loc0": 3, "loc1": 0}
    peak = score.location_peak(df, "ndvi_raw").orderBy("location_id").collect()
    assert (peak[0]["peak_ndvi"], peak[0]["peak_index"]) == (0.9, 3)
    assert peak[1]["peak_ndvi"] is None


def test_first_locations(make_series):
    df = make_series([1.0], [1.0], [1.0])
    assert column(score.first_locations(df, 2), "location_id", "location_id") == ["loc0", "loc1"]


REQUESTS = ("request_id long, latitude double, longitude double, start_date date, end_date date")


@pytest.fixture(scope="module")
def asked(spark):
    """Two thirds of the requests want one place; one is off the globe."""
    rng = random.Random(1)
    rows = []
    for i in range(300):
        start = dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(400))
        place = 1.0 if i % 3 else float(rng.randrange(2, 9))
        rows.append((i, place, 2.0, start, start + dt.timedelta(120)))
    rows.append((300, 91.0, 2.0, dt.date(2020, 1, 1), dt.date(2021, 1, 1)))
    rows.append((301, 1.0, 2.0, dt.date(2021, 1, 1), dt.date(2020, 1, 1)))  # backwards
    return spark.createDataFrame(rows, REQUESTS)


@pytest.fixture(scope="module")
def stored_series(spark):
    rng = random.Random(2)
    rows = [(f"{p}.0000_2.0000", dt.date(2020 + m // 12, m % 12 + 1, 1), rng.random())
            for p in range(1, 8) for m in range(18)]
    return spark.createDataFrame(rows, "location_id string, date date, ndvi_smoothed double")


def by_hand(asked, series):
    held = {}
    for r in series.collect():
        held.setdefault(r["location_id"], []).append((r["date"], r["ndvi_smoothed"]))
    out = {}
    for r in asked.collect():
        if abs(r["latitude"]) > 90:
            continue
        rows = sorted(held.get(f"{r['latitude']:.4f}_{r['longitude']:.4f}", []))
        out[r["request_id"]] = [
            (d, v, min(0.9, max(0.1, v * 0.8 + (0.2 if d.month in (3, 4, 5, 6) else 0))))
            for d, v in rows if r["start_date"] <= d <= r["end_date"]]
    return out


def test_requests_against_loops(asked, stored_series):
    wanted = by_hand(asked, stored_series)
    answers = {r["request_id"]: r for r in score_requests(asked, stored_series).collect()}
    assert set(answers) == set(wanted)
    for key, rows in wanted.items():
        got = answers[key]
        assert [(p["date"], p["ndvi"]) for p in got["predictions"]] == [r[:2] for r in rows]
        assert [p["bloom_probability"] for p in got["predictions"]] == pytest.approx(
            [r[2] for r in rows])
        likely = [r[0] for r in rows if r[2] > 0.5]
        assert got["predicted_onset_date"] == (likely[0] if likely else None)
        if rows:
            assert got["confidence"] == pytest.approx(sum(r[2] for r in rows) / len(rows))
    flat = prediction_export(score_requests(asked, stored_series))
    assert flat.count() == sum(map(len, wanted.values()))


def test_row_form_of_requests_has_the_same_rows(asked, stored_series):
    wanted = by_hand(asked, stored_series)
    rows = requested_rows(asked, stored_series).collect()
    assert sorted((r["request_id"], r["date"]) for r in rows if r["date"]) == sorted(
        (k, x[0]) for k, v in wanted.items() for x in v)
    assert {r["request_id"] for r in rows} == set(wanted)


def test_hot_keys_join_the_same_in_parts(spark):
    left = spark.range(1000).select(
        F.when(F.col("id") % 3 != 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"),
        "id")
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2), ("0", 3), ("3", 4)], "k string, v int")
    for how in ("left", "inner"):
        plain = left.join(right, "k", how).select("k", "id", "v")
        cut = salted_join(left, right, "k", ["id"], how=how, min_rows=50, share=0.0)
        assert sorted(map(tuple, cut.collect()), key=str) == sorted(
            map(tuple, plain.collect()), key=str)


def test_days_of_year(spark):
    df = spark.createDataFrame([(2020, 366), (2019, 366), (2019, 1)], "y int, d int")
    out = df.select(calendar.date_of_day(F.col("y"), F.col("d")).alias("x")).collect()
    assert [r["x"] for r in out] == [dt.date(2020, 12, 31), None, dt.date(2019, 1, 1)]


def test_increase_quality(spark):
    df = spark.createDataFrame([(0.15,), (0.9,)], "x double")
    out = df.select(values.increase_quality(F.col("x")).alias("q")).collect()
    assert [r["q"] for r in out] == pytest.approx([0.5, 1.0])


def test_shared_trails_equal_a_window_per_request(spark, make_series):
    rng = random.Random(7)
    series = make_series(*[
        [None if rng.random() < 0.2 else rng.random() for _ in range(30)] for _ in range(3)
    ], [0.5]).withColumn("ndvi_smoothed", F.col("ndvi_raw") + 0.1)
    places = ["10.0000_20.0000", "10.0000_21.0000", "10.0000_22.0000", "10.0000_23.0000"]
    series = series.withColumn("location_id", F.element_at(
        F.array(*map(F.lit, places)), F.substring("location_id", 4, 1).cast("int") + 1))
    rows = []
    for i in range(120):
        start = dt.date(2019, 11, 1) + dt.timedelta(rng.randrange(1000))
        # ids repeat, one is missing more than once, some ranges are empty or run backwards
        rows.append((None if i % 40 == 7 else i % 100, 10.0, 20.0 + rng.randrange(5), start,
                     start + dt.timedelta(rng.choice([-5, 10, 180, 700]))))
    asked = spark.createDataFrame(rows, REQUESTS)
    for some in (asked, asked.where("request_id between 20 and 80")):
        plain = request_features(requested_rows(some, series))
        shared = request_features(requested_rows(some, series, trails=True))
        assert shared.schema.names == plain.schema.names

        def told(df):
            return sorted(
                tuple(f"{v:.9f}" if isinstance(v, float) else str(v) for v in r) for r in df.collect()
                if r["request_id"] is not None and (r["request_id"] >= 20)
            )

        assert told(shared) == told(plain) and shared.count() == plain.count()
    # nothing meets by request any more where no id repeats
    plan = shared._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(request_id" not in plan and "hashpartitioning(location_id" in plan
