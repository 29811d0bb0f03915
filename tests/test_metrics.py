import random

import numpy as np
import pytest

from phenospark.operators import metrics
from phenospark.plans.evaluation import evaluation_metrics
from .conftest import column


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, prediction int")


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, score double")


def test_classification_by_hand(small):
    row = metrics.classification_metrics(small).first()
    assert row.asDict() == {
        "accuracy": 0.75, "precision": 1.0, "recall": 0.5, "f1": pytest.approx(0.6667, abs=1e-4)}


def test_nothing_predicted_gives_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    row = metrics.classification_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert column(metrics.class_report(df), "class", "class") == [
        "0", "accuracy", "macro avg", "weighted avg"]


def test_class_report(small):
    rows = {r["class"]: r for r in metrics.class_report(small).collect()}
    assert rows["0"]["precision"] == pytest.approx(2 / 3) and rows["0"]["recall"] == 1.0
    assert rows["macro avg"]["recall"] == 0.75
    assert rows["weighted avg"]["precision"] == pytest.approx((2 * 2 / 3 + 2 * 1) / 4)
    assert rows["accuracy"]["support"] == 4


def test_confusion(small):
    cells = {(r["label"], r["prediction"]): r["rows"]
             for r in metrics.confusion_table(small).collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 1}


def test_auc_counts_ties_half(spark):
    df = scored(spark, [(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1)])
    assert metrics.curve_areas(df).first()["roc_auc"] == pytest.approx(0.875)


@pytest.mark.parametrize("per_range", [1_000_000, 7])
def test_nan_scores_count_as_missing(spark, per_range):
    rows = [(i % 2, i / 100) for i in range(100)]
    plain = metrics.score_steps(scored(spark, rows), rows_per_range=per_range).rows.collect()
    more = scored(spark, [*rows, (1, float("nan")), (0, None)])
    assert sorted(metrics.score_steps(more, rows_per_range=per_range).rows.collect()) == sorted(plain)


def test_one_class_has_no_area(spark):
    row = metrics.curve_areas(scored(spark, [(1, 0.9), (1, 0.4)])).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None


@pytest.mark.parametrize("per_range", [1_000_000, 7])
def test_curves_in_ranges_against_loops(spark, per_range, monkeypatch):
    """A third of all rows share one score, and scores crowd into a narrow band."""
    rng = random.Random(4)
    rows = [(int(rng.random() < 0.4), 0.5 if i % 3 == 0 else round(
        rng.choice([rng.random(), 0.3 + rng.random() * 1e-4]), 6)) for i in range(400)]
    steps = metrics.score_steps(scored(spark, rows), rows_per_range=per_range)
    got = {r["threshold"]: (r["tp"], r["fp"]) for r in steps.rows.collect()}
    for threshold, counts in got.items():
        above = [y for y, s in rows if s >= threshold]
        assert counts == (sum(above), len(above) - sum(above))
    assert len(got) == len({s for _, s in rows})
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert metrics.curve_areas(scored(spark, rows)).first()["roc_auc"] == pytest.approx(auc)


def test_curve_points_and_areas_agree(spark):
    rng = random.Random(9)
    df = scored(spark, [(int(rng.random() < 0.5), round(rng.random(), 2)) for _ in range(200)])
    roc = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_points(df).collect())
    pr = sorted((r["recall"], -(r["threshold"] or 2.0), r["precision"])
                for r in metrics.pr_points(df).collect())
    areas = metrics.curve_areas(df).first()
    x, y = zip(*roc)
    assert roc[0] == (0.0, 0.0) and roc[-1] == (1.0, 1.0)
    assert np.trapezoid(y, x) == pytest.approx(areas["roc_auc"])
    assert np.trapezoid([p[2] for p in pr], [p[0] for p in pr]) == pytest.approx(areas["pr_auc"])
    assert areas["pr_auc"] > 0


def test_regression(spark):
    df = spark.createDataFrame([(100, 110.0), (200, 180.0)], "label int, prediction double")
    row = metrics.regression_metrics(df).first()
    assert row["mape"] == pytest.approx(10.0)
    assert (row["mae"], row["mse"], row["r2"]) == (15.0, 250.0, pytest.approx(0.9))
    assert row["rmse"] == pytest.approx(250 ** 0.5)


def test_histogram(spark):
    values = [0.0, 0.1, 0.1, 2.9, 3.0, 1.5]
    df = spark.createDataFrame([(v,) for v in values], "residual double")
    out = column(metrics.residual_histogram(df, bins=30), "rows", "bin")
    wanted, edges = np.histogram(values, bins=30)
    assert out == wanted.tolist()
    assert column(metrics.residual_histogram(df), "bin_low", "bin") == pytest.approx(edges[:-1])


def test_histogram_of_equal_residuals(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "residual double")
    out = column(metrics.residual_histogram(df), "rows", "bin")
    assert out == np.histogram([2.0] * 5, bins=30)[0].tolist()


def test_evaluation_metrics_of_both_tasks(spark, small):
    from pyspark.sql import functions as F
    with_score = small.withColumn("score", F.col("prediction") * 0.5)
    names = set(column(evaluation_metrics(with_score, "classification"), "metric", "metric"))
    assert names == {"accuracy", "precision", "recall", "f1_score", "roc_auc"}
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.5)], "label double, prediction double")
    assert set(column(evaluation_metrics(df, "regression"), "metric", "metric")) == {
        "mae", "mse", "rmse", "r2"}
