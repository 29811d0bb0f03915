import datetime as dt
import random

import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from phenospark.catalog import queries as catalog
from phenospark.operators import train
from phenospark.plans.evaluation import evaluation_report, timeseries_report
from phenospark.plans.scoring import prediction_export, score_requests
from phenospark.sources import writers
from .conftest import column

CLASSES = {
    ("randomforest", "classification"): RandomForestClassifier,
    ("randomforest", "regression"): RandomForestRegressor,
    ("xgboost", "classification"): GBTClassifier,
    ("xgboost", "regression"): GBTRegressor,
}


@pytest.mark.parametrize("kind", list(CLASSES))
def test_pipeline_shape(spark, kind):
    stages = train.model_pipeline(*kind, ["a", "b"]).getStages()
    assert [type(s).__name__ for s in stages[:3]] == [
        "Imputer", "VectorAssembler", "StandardScaler"]
    assert isinstance(stages[3], CLASSES[kind]) and stages[3].getSeed() == 42


def test_unknown_model_raises(spark):
    with pytest.raises(ValueError):
        train.model_pipeline("svm", "classification", ["a"])


@pytest.mark.parametrize("model_type, size", [("randomforest", 36), ("xgboost", 81)])
def test_full_grids(spark, model_type, size):
    model = train.model_pipeline(model_type, "classification", ["a"]).getStages()[-1]
    assert len(train.param_grid(model, train.GRIDS[model_type])) == size


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(0)
    data = []
    for i in range(300):
        mean, month = rng.random(), i % 12 + 1
        data.append((
            f"p{i % 10}", 10.0, 20.0, dt.date(2015 + i // 60, month, 1 + i % 5), mean,
            2015 + i // 60, month, None if i % 7 == 0 else mean, None, int(mean > 0.5),
            60 + int(100 * mean), dt.date(2020, 1, 1)))
    return spark.createDataFrame(
        data,
        "location_id string, latitude double, longitude double, date date, "
        "ndvi_smoothed double, year int, month int, ndvi_mean_3 double, empty double, "
        "bloom_label int, onset_doy int, onset_date date").cache()


@pytest.fixture(scope="module")
def classifier(rows):
    return train.train_model(rows, numTrees=5)


@pytest.fixture(scope="module")
def regressor(rows):
    return train.train_model(rows, "xgboost", "regression", maxIter=3)


def test_features_without_values_and_targets_are_left_out(classifier):
    assert classifier.features == ["month", "ndvi_mean_3"]


def test_classification_metrics(classifier):
    m = classifier.metrics
    assert set(m) == {"accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"}
    assert all(0 <= v <= 1 for v in m.values()) and m["accuracy"] > 0.8


def test_regression_metrics(regressor):
    m = regressor.metrics
    assert {"mae", "r2", "rmse", "mape"} <= set(m)
    assert m["mae"] >= 0 and -1 <= m["r2"] <= 1


def test_search_records_its_choice(rows):
    model = train.train_model(
        rows, folds=2, grid={"numTrees": [2, 3], "maxDepth": [2]}, fold_by=("location_id",))
    assert set(model.best_params) == {"numTrees", "maxDepth"}
    assert 0 <= model.metrics["cv_score"] <= 1


def test_missing_features_score_as_zero(classifier, rows):
    out = train.predict(classifier, rows.drop("ndvi_mean_3"), ["location_id", "date", "month"])
    assert out.columns == ["location_id", "date", "month", "label", "prediction", "score"]
    zero = train.predict(classifier, rows.withColumn("ndvi_mean_3", F.lit(0.0)), ["date"])
    assert sorted(column(out, "score", "date")) == sorted(column(zero, "score", "date"))


def test_saved_model_scores_the_same(spark, classifier, rows, tmp_path):
    path = writers.save_model(spark, classifier, str(tmp_path))
    assert path.endswith("bloom_model_classification_randomforest")
    back = writers.load_model(spark, path)
    assert (back.features, back.task, back.metrics) == (
        classifier.features, classifier.task, classifier.metrics)
    key = ("location_id", "date")
    before, after = (train.predict(m, rows, key).orderBy(*key, "score").collect()
                     for m in (classifier, back))
    assert before == after


def test_importances_stop_at_the_top(classifier, rows):
    out = train.feature_importances(classifier, rows, top_n=1).collect()
    assert [r["feature"] for r in out] == ["ndvi_mean_3"]


def test_report_tables(classifier, regressor, rows):
    report = evaluation_report(classifier, rows)
    assert set(report) == {
        "metrics", "importances", "confusion", "class_report", "roc_points", "pr_points"}
    assert report["confusion"].agg(F.sum("rows")).first()[0] == 300
    report = evaluation_report(regressor, rows)
    assert report["residual_histogram"].agg(F.sum("rows")).first()[0] == 300


def test_timeseries_report_takes_the_first_places(classifier, rows):
    labels = rows.select("location_id", "onset_date").distinct()
    out = timeseries_report(classifier, rows, labels, n_locations=2)
    assert sorted({r["location_id"] for r in out.collect()}) == ["p0", "p1"]
    assert out.first()["actual_onsets"] == [dt.date(2020, 1, 1)]


def test_requests_are_scored_by_both_kinds_of_model(spark, classifier, regressor):
    series = spark.createDataFrame(
        [("10.0000_20.0000", dt.date(2020, m, 1), m / 12) for m in range(1, 13)],
        "location_id string, date date, ndvi_smoothed double")
    asked = spark.createDataFrame(
        [(1, 10.0, 20.0, dt.date(2020, 2, 1), dt.date(2020, 5, 1)),
         (2, 11.0, 20.0, dt.date(2020, 2, 1), dt.date(2020, 5, 1))],
        "request_id long, latitude double, longitude double, start_date date, end_date date")
    answers = score_requests(asked, series, classifier).orderBy("request_id").collect()
    assert [len(a["predictions"]) for a in answers] == [4, 0]
    assert answers[1]["confidence"] is None
    answers = score_requests(asked, series, regressor)
    one = answers.where("request_id = 1").first()
    target = one["predictions"][0]["predicted_onset_doy"]
    wanted = min(one["predictions"], key=lambda p: abs(p["date"].timetuple().tm_yday - target))
    assert one["predicted_onset_date"] == wanted["date"] and one["confidence"] == 0.8
    flat = prediction_export(answers).collect()
    assert len(flat) == 4
    assert {(r["bloom_probability"], r["bloom_predicted"]) for r in flat} == {(0.0, False)}


def test_registered_models_are_the_operators_whole_job(monkeypatch):
    calls = {}

    class Recorded(Exception):
        pass

    for name in ("model_rf_cls", "model_rf_reg", "model_gbt_cls", "model_gbt_reg", "importance_topk",
                 "model_overlay", "model_search"):
        def record(data, model_type, task, name=name, **params):
            calls[name] = (model_type, params)
            raise Recorded

        monkeypatch.setattr(train, "train_model", record)
        monkeypatch.setattr(catalog, "_training", lambda *a: None)
        monkeypatch.setattr(catalog, "stored", lambda *a: None)
        with pytest.raises(Recorded):
            getattr(catalog, name)(None, None)
    _, search = calls.pop("model_search")
    assert search["grid"] == train.GRIDS["randomforest"] and search["folds"] == 5
    for model_type, params in calls.values():
        sizes = train.GRIDS[model_type]["numTrees" if model_type == "randomforest" else "maxIter"]
        assert min(sizes) <= params["numTrees" if model_type == "randomforest" else "maxIter"] <= max(sizes)


def test_no_fold_is_empty_with_few_groups(spark):
    df = spark.createDataFrame([(k, i) for k in ("a", "b", "c", "d", "e", None) for i in range(3)], "location_id string, n int")
    got = train.with_folds(df, ("location_id",), 6).collect()
    assert len(got) == 18 and {r.fold for r in got} == set(range(6))
    assert len({(r.location_id, r.fold) for r in got}) == 6


def test_rows_are_prepared_once_and_the_model_stays_the_same(spark):
    rng = random.Random(9)
    rows = [(float(i % 2), rng.random() + i % 2 if i % 7 else None, rng.random()) for i in range(400)]
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(v):
        read.add(1)
        return v

    names = ["a", "b"]
    table = spark.createDataFrame(rows, "label double, a double, b double").withColumn("b", seen("b"))
    pipeline = train.model_pipeline("randomforest", "classification", names, numTrees=5)
    model = train.fit_prepared(pipeline, table)
    assert read.value <= 3 * len(rows)  # medians, scale, and the rows that the forest reads
    plain = pipeline.fit(table)
    assert model.stages[-1].toDebugString.split("\n")[1:] == plain.stages[-1].toDebugString.split("\n")[1:]
    assert len(model.stages) == len(plain.stages)
