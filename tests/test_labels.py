import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenospark.operators import dataset, labels
from phenospark.operators.changepoint import SegmentCost, detect, kernel_width
from phenospark.schema import PHENOLOGY_BANDS
from .conftest import column


def gram(x):
    gaps = np.array([(a - b) ** 2 for i, a in enumerate(x) for b in x[i + 1:]])
    median = np.median(gaps)
    gamma = 1 / median if median != 0 else 1.0
    full = np.exp(-np.clip(gamma * np.subtract.outer(x, x) ** 2, 1e-2, 1e2))
    np.fill_diagonal(full, 1.0)
    return full, gamma


def cost_of(full, start, end):
    return (end - start) - full[start:end, start:end].sum() / (end - start)


def best_partition(x, penalty, min_size=2, jump=5):
    """Every partition on the grid, by plain recursion over the last segment."""
    full, _ = gram(x)
    ends = [e for e in range(0, len(x), jump)] + [len(x)]
    best = {0: (0.0, [])}
    for end in ends[1:]:
        options = [
            (best[s][0] + cost_of(full, s, end) + penalty, best[s][1] + [s])
            for s in ends if s in best and end - s >= min_size and (s == 0 or s >= min_size)
        ]
        if options:
            best[end] = min(options, key=lambda o: o[0])
    return best[len(x)][1][1:] if len(x) in best else []


def wavy(seed, n):
    rng = np.random.default_rng(seed)
    return 0.5 + 0.2 * np.sin(np.arange(n) * 2 * np.pi / 12) + rng.normal(0, 0.05, n)


@pytest.mark.parametrize("n", [6, 7, 12, 31, 83])
def test_segment_costs_match_the_full_matrix(n):
    x = wavy(n, n)
    full, gamma = gram(x)
    cost = SegmentCost(x, 5)
    assert kernel_width(x) == pytest.approx(gamma, rel=1e-12)
    for a in range(len(cost.edges)):
        for b in range(a + 1, len(cost.edges)):
            wanted = cost_of(full, cost.edges[a], cost.edges[b])
            assert cost(a, b) == pytest.approx(wanted, abs=1e-8)


def test_large_series_in_blocks_of_rows(monkeypatch):
    x = wavy(0, 200)
    whole = SegmentCost(x, 5).total
    monkeypatch.setattr("phenospark.operators.changepoint._CELLS_AT_ONCE", 2000)
    np.testing.assert_allclose(SegmentCost(x, 5).total, whole)


@pytest.mark.parametrize("penalty", [0.5, 1.0, 3.0])
@pytest.mark.parametrize("n", [6, 11, 23, 48, 83])
def test_penalised_search_equals_the_best_partition(n, penalty):
    for seed in range(5):
        x = wavy(seed, n)
        assert detect(x, penalty=penalty) == best_partition(x, penalty)


@pytest.mark.parametrize("method", ["pelt", "binseg"])
def test_one_step_is_found_at_the_default_penalty(method):
    rng = np.random.default_rng(0)
    x = np.where(np.arange(83) < 40, 0.25, 0.6) + rng.normal(0, 0.02, 83)
    assert detect(x, method) == [40]
    assert detect(wavy(1, 83), method) == []


def test_sliding_window_finds_the_step():
    rng = np.random.default_rng(0)
    x = np.where(np.arange(83) < 40, 0.25, 0.6) + rng.normal(0, 0.02, 83)
    assert 40 in detect(x, "window", penalty=0.5)


def test_positions_skip_missing_rows():
    x = np.where(np.arange(60) < 30, 0.2, 0.7) + 0.001 * np.arange(60)
    holes = np.insert(x, 10, np.nan)
    assert detect(x) == [30]
    assert detect(holes) == [31]
    assert detect(np.array([1.0, 2, 3, 4, 5, np.nan])) == []


def test_constant_series_has_no_change_point():
    for method in ("pelt", "binseg", "window"):
        assert detect(np.full(30, 0.4), method) == []


def test_change_point_labels(make_series):
    rng = random.Random(0)
    step = [(0.25 if i < 40 else 0.6) + rng.gauss(0, 0.01) for i in range(83)]
    noise = [0.5 + rng.gauss(0, 0.05) for _ in range(83)]
    df = make_series(step, noise, [0.1, 0.5, 0.9], column="ndvi_smoothed")
    out = labels.change_point_labels(df).collect()
    assert len(out) == 1
    row = out[0]
    assert (row["location_id"], row["year"], row["onset_index"]) == ("loc0", 2023, 40)
    assert row["onset_date"] == dt.date(2023, 5, 1)
    assert row["pre_onset_ndvi"] == pytest.approx(np.mean(step[37:40]))
    assert row["post_onset_ndvi"] == pytest.approx(np.mean(step[40:44]))
    assert row["peak_ndvi"] == max(step) and row["peak_index"] == step.index(max(step))
    assert row["onset_ndvi"] == step[40]


def onset_by_hand(v, months, cands, increase=0.1):
    spring = [c for c in cands if months[c] in (3, 4, 5, 6)] or cands[:1]
    best, score = None, 0.0
    for c in spring:
        if c >= len(v) - 1:
            continue
        pre = [x for x in v[max(0, c - 2):c + 1] if x is not None]
        post = [x for x in v[c:c + 3] if x is not None]
        if not pre or not post:
            continue
        rise = sum(post) / len(post) - sum(pre) / len(pre)
        if rise >= increase and min(1.0, rise / 0.3) > score:
            best, score = c, min(1.0, rise / 0.3)
    return best


def test_onset_among_candidates_against_loop(spark, make_series):
    rng = random.Random(2)
    series = [[None if rng.random() < 0.1 else rng.random() for _ in range(30)]
              for _ in range(12)]
    arrays = labels.series_arrays(make_series(*series), "ndvi_raw")
    picks = {f"loc{i}": sorted(rng.sample(range(30), rng.randint(0, 6))) for i in range(12)}
    cands = spark.createDataFrame(list(picks.items()), "location_id string, candidates array<int>")
    got = {r["location_id"]: r["onset_index"] for r in labels.onsets_from_candidates(
        arrays.join(cands, "location_id")).collect()}
    months = [i % 12 + 1 for i in range(30)]
    wanted = {k: onset_by_hand(series[int(k[3:])], months, c) for k, c in picks.items()}
    assert got == {k: v for k, v in wanted.items() if v is not None}


def test_onset_score_by_hand(make_series):
    arrays = labels.series_arrays(make_series([0.2] * 5 + [0.6] * 5), "ndvi_raw")
    row = labels.onsets_from_candidates(arrays.withColumn("candidates", F.array(F.lit(5)))).first()
    assert row["label_quality_score"] == pytest.approx(0.8889, abs=1e-4)


def test_one_label_per_year(make_series):
    year = [0.2, 0.2, 0.2, 0.5, 0.6, 0.7, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2]
    arrays = labels.series_arrays(make_series(year * 3), "ndvi_raw")
    every = arrays.withColumn("candidates", F.sequence(F.lit(0), F.lit(35)))
    assert labels.onsets_from_candidates(every).count() == 1
    out = labels.onsets_from_candidates(every, per_year=True)
    assert column(out, "year", "year") == [2020, 2021, 2022]


def pheno(spark, *rows):
    names = ["latitude", "longitude", *PHENOLOGY_BANDS]
    schema = ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(
        [tuple([10.0, 20.0] + [r.get(b) for b in PHENOLOGY_BANDS]) for r in rows], schema)


def test_phenology(spark):
    df = pheno(
        spark,
        {"Greenup_1": 120.0, "Greenup_3": 0.0, "Greenup_4": 400.0, "Peak_1": 200.0, "Peak_2": 180.0},
        {"Peak_1": 100.0}, {"Greenup_2": float("nan")},
        {"Greenup_1": 200.9, "Greenup_2": 366.0},
    )
    out = labels.phenology_labels(df).orderBy("onset_doy").collect()
    assert [(r["onset_date"], r["onset_doy"], r["peak_doy"], r["label_quality_score"])
            for r in out] == [
        (dt.date(2020, 4, 29), 120, 180, 0.25), (dt.date(2020, 7, 18), 200, None, 0.5)]
    assert out[0]["location_id"] == "10.0000_20.0000" and out[0]["year"] == 2020


def test_phenology_of_a_given_year_and_in_epoch_days(spark):
    df = pheno(spark, {"Greenup_1": 120.0}, {"Greenup_1": 366.0})
    out = labels.phenology_labels(df.withColumn("year", F.lit(2019))).collect()
    assert [r["onset_date"] for r in out] == [dt.date(2019, 4, 30)]  # 2019 has no day 366
    days = float((dt.date(2018, 5, 1) - dt.date(1970, 1, 1)).days)
    row = labels.phenology_labels(pheno(spark, {"Greenup_1": days}), epoch_days=True).first()
    assert (row["year"], row["onset_date"], row["onset_doy"]) == (2018, dt.date(2018, 5, 1), 121)


def test_spring_jump(make_series):
    rising = [0.1, 0.1, 0.1, 0.2, 0.5, 0.6]
    flat = [0.3] * 12
    hole = [0.1, 0.1, 0.1, None, 0.5, 0.6]
    short = [0.1, 0.1, 0.1, 0.2, 0.5]
    out = labels.spring_jump_labels(make_series(rising, flat, hole, short)).collect()
    assert len(out) == 1
    row = out[0]
    assert (row["location_id"], row["onset_date"], row["onset_index"]) == (
        "loc0", dt.date(2020, 5, 1), 2)
    assert row["label_quality_score"] == pytest.approx(1.0)


LABEL = "location_id string, year int, onset_date date, label_quality_score double"


@pytest.fixture(scope="module")
def tables(spark):
    features = spark.createDataFrame(
        [("a", 2020, 1.0), ("a", 2021, 2.0), ("b", 2020, 3.0)],
        "location_id string, year int, ndvi_mean_3 double")
    found = spark.createDataFrame(
        [("a", 2020, dt.date(2020, 3, 1), 0.4), ("a", 2020, dt.date(2020, 4, 1), 0.9)], LABEL)
    return features, found


def test_classification_set(tables):
    features, found = tables
    both = dataset.classification_set(features, found)
    assert column(both, "bloom_label", "location_id", "year") == [1, 1, 0, 0]
    one = dataset.classification_set(features, found, one_label=True)
    assert column(one, "label_quality_score", "location_id", "year") == [0.9, None, None]
    assert dataset.class_balance(one).first().asDict() == {
        "samples": 3, "positives": 1, "positive_share": pytest.approx(1 / 3)}
    assert dataset.feature_columns(one.columns) == ["ndvi_mean_3"]


def test_regression_set(tables):
    features, found = tables
    out = dataset.regression_set(features, found)
    assert column(out, "onset_doy", "onset_doy") == [61, 92]
    assert dataset.target_range(out).first().asDict() == {
        "samples": 2, "lowest": 61, "highest": 92}
