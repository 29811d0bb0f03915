import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from phenospark.operators import outliers
from phenospark.operators.consistency import consistency_filter
from phenospark.operators.gapfill import interpolate, spline_values
from phenospark.operators.resample import resample
from phenospark.operators.slices import needs_slices, with_slices
from phenospark.operators.smooth import apply_smoothing, smooth
from .conftest import SERIES, column

CUT = {"min_rows": 3, "share": 0.0}  # so small that every location and month is cut


def consistent(values, window=3, threshold=0.3):
    """The rule by hand, on one location's values in order."""
    out, half = list(values), window // 2
    if len(values) < 3:
        return out
    for i in range(1, len(values)):
        here, before = values[i], values[i - 1]
        if here is None or before is None or abs(here - before) <= threshold:
            continue
        near = [v for v in values[max(0, i - half):i + half + 1] if v is not None]
        if len(near) > 1 and abs(here - sum(near) / len(near)) > threshold:
            out[i] = None
    return out


def crowded(spark, rows=1500, seed=7):
    """A third of all rows at one place and day, another third at that place."""
    rng = random.Random(seed)
    data = []
    for n in range(rows):
        kind = n % 3
        place = "hot" if kind else f"p{rng.randrange(5)}"
        day = dt.date(2020, 3, 5) if kind == 1 else dt.date(2020, 1, 1) + dt.timedelta(
            rng.randrange(300))
        value = None if rng.random() < 0.1 else rng.random()
        data.append((place, day, n, value))
    return spark.createDataFrame(data, "location_id string, date date, seq int, ndvi_raw double")


def test_consistency_by_hand(make_series):
    df = make_series([0.2, 0.9, 0.2, 0.2], [0.1, 0.9])
    out = column(consistency_filter(df, drop=False), "ndvi_raw")
    assert out == [0.2, None, 0.2, 0.2, 0.1, 0.9]


@pytest.mark.parametrize("window", [1, 3, 5])
def test_consistency_against_loop(make_series, window):
    rng = random.Random(window)
    series = [[None if rng.random() < 0.15 else rng.random() for _ in range(n)]
              for n in (1, 2, 3, 10, 40)]
    out = consistency_filter(make_series(*series), window=window, threshold=0.25, drop=False)
    wanted = [v for s in series for v in (consistent(s, window, 0.25) if window > 1 else s)]
    assert column(out, "ndvi_raw") == wanted


@pytest.mark.parametrize("window", [3, 7])
@pytest.mark.parametrize("ties", [["seq"], []])
def test_slices_give_what_one_window_gives(spark, window, ties):
    df = crowded(spark)
    assert needs_slices(df, **CUT) and not needs_slices(df)
    plain = consistency_filter(df, window=window, tie_break=ties, drop=False)
    sliced = consistency_filter(df, window=window, tie_break=ties, drop=False, **CUT)
    assert column(sliced, "ndvi_raw", "seq") == column(plain, "ndvi_raw", "seq")
    assert plain.where("ndvi_raw is null").count() > df.where("ndvi_raw is null").count()


def test_no_slice_is_fuller_than_its_share(spark):
    sliced = with_slices(crowded(spark), "seq", min_rows=50, share=0.0)
    sizes = sliced.groupBy("location_id", "slice_month", "slice_day", "slice_part").count()
    assert sizes.agg(F.max("count")).first()[0] < 2 * 50
    assert sizes.agg(F.sum("count")).first()[0] == 1500


@pytest.mark.parametrize("flag, name", [
    (outliers.flag_global_outliers, "is_outlier"),
    (outliers.flag_seasonal_outliers, "is_seasonal_outlier"),
])
def test_outliers_in_slices(spark, flag, name):
    df = crowded(spark)
    plain, sliced = flag(df, threshold=1.5), flag(df, threshold=1.5, **CUT)
    assert column(sliced, name, "seq") == column(plain, name, "seq")
    assert plain.where(name).count() > 0


def test_global_outliers_by_hand(make_series):
    calm = [0.5, 0.52, 0.48] * 6
    df = make_series([*calm, 5.0], [0.1, 9.0], [0.3] * 5)
    flagged = outliers.flag_global_outliers(df).where("is_outlier")
    assert [(r["location_id"], r["ndvi_raw"]) for r in flagged.collect()] == [("loc0", 5.0)]


def test_resample_keeps_empty_months(spark):
    rows = [("a", 1.0, 2.0, dt.date(2020, 1, 15), 1.0), ("a", 1.0, 2.0, dt.date(2020, 4, 2), 2.0),
            ("b", 3.0, 4.0, dt.date(2020, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, SERIES)
    out = resample(df).orderBy("date").collect()
    assert [(r["date"].month, r["ndvi_raw"]) for r in out] == [
        (1, 1.0), (2, None), (3, None), (4, 2.0)]
    assert {r["location_id"] for r in out} == {"a"}
    assert resample(df, fill_empty=False).count() == 2
    assert resample(df, min_points=1).count() == 5


def test_resample_daily_year_to_months(spark):
    rng = random.Random(0)
    rows = [("a", 1.0, 2.0, dt.date(2020, 1, 1) + dt.timedelta(i), rng.uniform(0.1, 0.9))
            for i in range(366)]
    out = resample(spark.createDataFrame(rows, SERIES))
    assert out.count() <= 12
    assert out.columns == ["location_id", "latitude", "longitude", "date", "ndvi_raw"]


@pytest.mark.parametrize("frequency", ["day", "week", "month", "quarter"])
def test_resample_against_pandas(spark, frequency):
    rng = random.Random(3)
    rows = [("a", 1.0, 2.0, dt.date(2020, 1, 1) + dt.timedelta(rng.randrange(700)), rng.random())
            for _ in range(60)]
    code = {"day": "D", "week": "W-MON", "month": "MS", "quarter": "QS"}[frequency]
    pdf = pd.DataFrame(rows, columns=["l", "a", "o", "date", "v"])
    series = pdf.set_index(pd.to_datetime(pdf["date"]))["v"].sort_index()
    wanted = series.resample(code, label="left", closed="left").mean()
    got = resample(spark.createDataFrame(rows, SERIES), frequency).orderBy("date").collect()
    assert [r["date"] for r in got] == [d.date() for d in wanted.index]
    np.testing.assert_allclose(
        [np.nan if r["ndvi_raw"] is None else r["ndvi_raw"] for r in got], wanted.to_numpy())


@pytest.mark.parametrize("given, wanted", [
    ([None, 1.0, None, 3.0, None], [0.0, 1.0, 2.0, 3.0, 4.0]),
    ([None, 1.0, None], [None, 1.0, None]),
    ([0.1, None, 0.3, None, 0.5], [0.1, 0.2, 0.3, 0.4, 0.5]),
])
def test_interpolate_linear(make_series, given, wanted):
    assert column(interpolate(make_series(given)), "ndvi_raw") == pytest.approx(wanted)


def test_interpolate_nearest_prefers_the_earlier(make_series):
    df = make_series([None, 1.0, None, None, None, 5.0, None])
    assert column(interpolate(df, "nearest"), "ndvi_raw") == [1.0, 1.0, 1.0, 1.0, 5.0, 5.0, 5.0]


def test_interpolate_along_time(make_series):
    df = make_series([0.0, None, 60.0])  # 31 and 29 days apart
    assert column(interpolate(df, axis="time"), "ndvi_raw")[1] == pytest.approx(31.0)


def test_interpolate_linear_against_numpy(make_series):
    rng = random.Random(5)
    series = [[None if rng.random() < 0.4 else rng.random() for _ in range(30)] for _ in range(8)]
    wanted = []
    for s in series:
        x = np.array([i for i, v in enumerate(s) if v is not None], dtype=float)
        y = np.array([v for v in s if v is not None])
        for i, v in enumerate(s):
            k = int(np.clip(np.searchsorted(x, i) - 1, 0, len(x) - 2))
            line = y[k] + (y[k + 1] - y[k]) / (x[k + 1] - x[k]) * (i - x[k])
            wanted.append(v if v is not None else line)
    assert column(interpolate(make_series(*series)), "ndvi_raw") == pytest.approx(wanted)


def test_cubic_reproduces_a_cubic_and_leaves_short_series(make_series):
    curve = [0.001 * (x - 4) ** 3 - 0.02 * x * x + 0.3 for x in range(12)]
    holes = [v if i not in (0, 3, 7, 8, 11) else None for i, v in enumerate(curve)]
    df = make_series(holes, [1.0, None, 2.0, 3.0])
    out = column(interpolate(df, "cubic"), "ndvi_raw")
    assert out[:12] == pytest.approx(curve)
    assert out[12:] == [1.0, None, 2.0, 3.0]


@pytest.mark.parametrize("n", [4, 5, 9, 30])
def test_spline_solves_its_equations(n):
    rng = np.random.default_rng(n)
    x, y = np.cumsum(rng.uniform(0.5, 2.0, n)), rng.normal(size=n)
    # unknowns: four coefficients per piece in powers of the distance from the first knot
    pieces, rows, rhs = n - 1, [], []

    def condition(terms, value):
        row = np.zeros(4 * pieces)
        for piece, at, order, sign in terms:
            for p in range(order, 4):
                factor = np.prod([p - q for q in range(order)]) if order else 1.0
                row[4 * piece + p] += sign * factor * (at - x[0]) ** (p - order)
        rows.append(row)
        rhs.append(value)

    for i in range(pieces):
        condition([(i, x[i], 0, 1)], y[i])
        condition([(i, x[i + 1], 0, 1)], y[i + 1])
    for i in range(1, pieces):
        for order in (1, 2):
            condition([(i - 1, x[i], order, 1), (i, x[i], order, -1)], 0.0)
    condition([(0, x[1], 3, 1), (1, x[1], 3, -1)], 0.0)
    condition([(pieces - 2, x[-2], 3, 1), (pieces - 1, x[-2], 3, -1)], 0.0)
    coef = np.linalg.lstsq(np.array(rows), np.array(rhs), rcond=None)[0].reshape(pieces, 4)
    at = np.linspace(x[0] - 1, x[-1] + 1, 50)
    piece = np.clip(np.searchsorted(x, at, side="right") - 1, 0, pieces - 1)
    wanted = [np.polyval(coef[p][::-1], a - x[0]) for p, a in zip(piece, at)]
    np.testing.assert_allclose(spline_values(x, y, at), wanted, rtol=1e-5, atol=1e-5)


def test_smooth_reproduces_a_parabola(make_series):
    curve = [float(x * x) for x in range(7)]
    assert column(smooth(make_series(curve)), "ndvi_smoothed") == pytest.approx(curve)


def test_smooth_leaves_short_series_and_skips_gaps(make_series):
    short = [0.1, 0.9, None, 0.2, 0.4]
    gap = [0.0, 1.0, None, 4.0, 9.0, None, 16.0]
    out = column(smooth(make_series(short, gap)), "ndvi_smoothed")
    assert out[:5] == short
    assert out[5:] == pytest.approx(gap)


@pytest.mark.parametrize("window, order", [(5, 2), (4, 2), (7, 3), (3, 1), (3, 5)])
def test_smooth_against_fits(make_series, window, order):
    rng = np.random.default_rng(1)
    values = rng.random(20)
    span = window + 1 if window % 2 == 0 else window
    span = order + 2 if span <= order else span
    half = span // 2
    wanted = []
    for i in range(20):
        low = min(max(i - half, 0), 20 - span)
        fit = np.polyfit(np.arange(low, low + span), values[low:low + span], order)
        wanted.append(np.polyval(fit, i))
    out = smooth(make_series([float(v) for v in values]), window=window, polyorder=order)
    assert column(out, "ndvi_smoothed") == pytest.approx(wanted, rel=1e-6)


def test_smoothed_column_falls_back_and_stays_in_range(make_series):
    df = make_series([.1, .2, .3, .4, .5, .4, .3, .2, .1], [.1, .2, .3], [.4, .5, .6])
    out = column(apply_smoothing(df), "ndvi_smoothed")
    assert len(out) == 15 and all(0 <= v <= 1 for v in out)


def test_means_are_hashed_and_take_every_coordinate_of_a_place(spark):
    day = dt.date(2020, 1, 5)
    rows = [("a", 1.00001, 2.0, day, 0.2), ("a", 1.00002, 2.0, day, 0.4), ("a", 1.0, 2.0, dt.date(2020, 1, 9), 0.9),
            ("a", 1.0, 2.0, dt.date(2020, 2, 9), None), ("a", 1.0, 2.0, dt.date(2020, 3, 9), 0.1)]
    df = spark.createDataFrame(rows, "location_id string, latitude double, longitude double, date date, ndvi_raw double")
    out = resample(df)
    got = [(r["latitude"], r["date"].month, r["ndvi_raw"]) for r in out.orderBy("date").collect()]
    assert got == [(1.00001, 1, pytest.approx(0.5)), (1.00001, 2, None), (1.00001, 3, 0.1)]
    assert " HashAggregate" in out._jdf.queryExecution().sparkPlan().toString().replace("+-", "")
