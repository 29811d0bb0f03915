import math
import random

import numpy as np
import pytest

from phenospark.operators import features
from phenospark.operators.resample import resample
from phenospark.operators.smooth import apply_smoothing
from phenospark.schema import MissingColumnsError
from .conftest import column


def peak_places(values):
    """Positions that top their five neighbours and one half, by a plain loop."""
    found = set()
    for i in range(2, len(values) - 2):
        near = [v for v in values[i - 2:i + 3] if v is not None]
        if values[i] is not None and values[i] == max(near) and values[i] > 0.5:
            found.add(i)
    return found


def random_series(seed, n):
    rng = random.Random(seed)
    return [None if rng.random() < 0.2 else round(rng.random(), 1) for _ in range(n)]


def test_calendar(make_series):
    df = features.add_calendar(make_series([0.5] * 12))
    row = df.orderBy("date").collect()[2]
    assert (row["year"], row["month"], row["day_of_year"], row["week_of_year"]) == (2020, 3, 61, 9)
    assert row["month_sin"] == pytest.approx(1.0)
    assert row["doy_cos"] == pytest.approx(math.cos(2 * math.pi * 61 / 365.25))
    seasons = [sum(column(df, c)) for c in ("is_spring", "is_summer", "is_autumn", "is_winter")]
    assert seasons == [3, 3, 3, 3]


def test_rolling_by_hand(make_series):
    df = features.add_rolling(make_series([1.0, 2.0, 4.0], [1.0, None, 5.0]), "ndvi_raw", (3,))
    assert column(df, "ndvi_mean_3")[:3] == pytest.approx([1, 1.5, 7 / 3])
    assert column(df, "ndvi_std_3")[:3] == [None, pytest.approx(0.70711, abs=1e-5),
                                            pytest.approx(1.52753, abs=1e-5)]
    assert column(df, "ndvi_slope_3")[3:] == [None, None, pytest.approx(2.0)]


def test_slope_against_polyfit(make_series):
    series = [random_series(s, 25) for s in range(4)]
    out = column(features.add_rolling(make_series(*series), "ndvi_raw", (6,)), "ndvi_slope_6")
    wanted = []
    for s in series:
        for i in range(len(s)):
            window = s[max(0, i - 5):i + 1]
            seen = [(x, v) for x, v in enumerate(window) if v is not None]
            wanted.append(np.polyfit(*zip(*seen), 1)[0] if len(seen) > 1 else None)
    assert [v is None for v in out] == [v is None for v in wanted]
    assert [v for v in out if v is not None] == pytest.approx(
        [v for v in wanted if v is not None], abs=1e-9)


def test_lags_and_differences(make_series):
    df = features.add_differences(
        features.add_lags(make_series([1.0, 3.0, 6.0]), "ndvi_raw", (1, 2)), "ndvi_raw", (2,))
    assert column(df, "ndvi_lag_1") == [None, 1.0, 3.0]
    assert column(df, "ndvi_lag_2") == [None, None, 1.0]
    assert column(df, "ndvi_diff_2") == [None, None, 5.0]


def test_peaks_by_hand(make_series):
    df = features.add_peaks(make_series([0.1, 0.3, 0.9, 0.4, 0.2, 0.1, 0.1]), "ndvi_raw")
    assert column(df, "is_peak") == [None, None, 0, 0, 1, 0, 0]
    assert column(df, "days_since_peak") == [None] * 5 + [3, 4]


def test_peaks_against_loop(make_series):
    series = [random_series(s, 30) for s in range(10)]
    df = features.add_peaks(make_series(*series), "ndvi_raw")
    flags, since = [], []
    for s in series:
        for i in range(len(s)):
            five, twelve = s[max(0, i - 4):i + 1], s[max(0, i - 11):i + 1]
            seen5 = sum(v is not None for v in five)
            seen12 = sum(v is not None for v in twelve)
            flags.append(int(len(five) == 5 and 2 in peak_places(five)) if seen5 >= 3 else None)
            tops = peak_places(twelve)
            since.append(len(twelve) - 1 - max(tops) if tops and seen12 >= 6 else None)
    assert column(df, "is_peak") == flags
    assert column(df, "days_since_peak") == since


def test_climate(spark):
    df = spark.createDataFrame([(-23.4,), (23.5,), (-66.5,), (None,)], "latitude double")
    out = features.add_climate(df).collect()
    zones = [(r["is_tropical"], r["is_temperate"], r["is_polar"]) for r in out]
    assert zones == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0)]
    assert {r["elevation"] for r in out} == {0}


def test_interactions_need_their_inputs(make_series):
    df = features.add_calendar(make_series([0.5], column="ndvi_smoothed"))
    out = features.add_interactions(df)
    assert "mean_slope_interaction" not in out.columns
    row = out.first()
    assert (row["ndvi_month_interaction"], row["ndvi_lat_interaction"]) == (0.5, 5.0)


def test_all_features(make_series):
    df = apply_smoothing(make_series([0.2, 0.3, 0.6, 0.8, 0.5, 0.4] * 4))
    out = features.all_features(df)
    names = features.feature_names(out.columns)
    assert len(names) == 47
    assert names[:4] == ["year", "month", "day_of_year", "week_of_year"]
    rows = out.orderBy("date").collect()
    assert len(rows) == 24
    assert sum(rows[0][c] is None for c in names) == 19
    with pytest.raises(MissingColumnsError):
        features.all_features(df.drop("ndvi_smoothed"))


def test_sparse_rows_go(spark):
    df = spark.createDataFrame(
        [(1, None, None, 1), (1, 1, None, 1)], "a int, b int, c int, d int")
    assert features.drop_sparse(df, ["a", "b", "c", "d"]).count() == 1


def test_requested_windows_are_honoured(make_series):
    df = apply_smoothing(make_series([0.5] * 10))
    out = features.all_features(df, windows=(2,), lags=(4,), periods=())
    assert {"ndvi_mean_2", "ndvi_lag_4"} < set(out.columns)
    assert not {"ndvi_mean_3", "ndvi_lag_1", "ndvi_diff_1"} & set(out.columns)


def test_reduced_sets(make_series):
    df = apply_smoothing(make_series([0.5] * 10))
    assert len(features.feature_names(features.scoring_features(df).columns)) == 12 + 15 + 2
    raw = features.raw_features(make_series([0.5] * 10))
    assert len(features.feature_names(raw.columns)) == 11 + 6 + 3 + 3


def test_profile(make_series):
    df = features.add_lags(make_series([1.0, 2.0, 3.0]), "ndvi_raw", (1, 2))
    rows = {r["feature"]: (r["non_null"], r["total_rows"])
            for r in features.non_null_profile(df).collect()}
    assert rows == {"ndvi_lag_1": (2, 3), "ndvi_lag_2": (1, 3)}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_shuffle_and_one_sort_serve_every_window(make_series):
    df = make_series([0.5] * 10).withColumnRenamed("ndvi_raw", "ndvi_smoothed")
    plan = plan_of(features.all_features(df))
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("- Sort [") == 1
    assert "Python" not in plan


def test_smoothing_and_filter_shuffle_once(make_series):
    from phenospark.operators.consistency import consistency_filter
    df = make_series([0.5] * 10)
    assert plan_of(apply_smoothing(df)).count("Exchange hashpartitioning") == 1
    filtered = consistency_filter(df, one_row_per_date=True)
    assert plan_of(filtered).count("Exchange hashpartitioning") == 1


def test_resample_reduces_before_its_shuffle(make_series):
    plan = plan_of(resample(make_series([0.5] * 10)))
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_avg" in plan
