"""The report's tables: one read of the scored rows, the same numbers as table by table."""

import random

import pytest
from pyspark.sql import functions as F

from phenospark.operators import metrics
from phenospark.plans.evaluation import evaluation_tables, report_rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def counted(spark):
    """A table that counts how many of its rows were read."""
    def make(rows, schema):
        seen = spark.sparkContext.accumulator(0)
        names = schema.split(", ")

        def count(batches):
            for batch in batches:
                seen.add(len(batch))
                yield batch

        return spark.createDataFrame(rows, schema).mapInPandas(count, ", ".join(names)), seen

    return make


def test_class_report_reads_the_scored_rows_once(spark, counted):
    rng = random.Random(3)
    rows = [(rng.randrange(2), rng.randrange(2), round(rng.random(), 2)) for _ in range(500)]
    rows += [(1, 0, None), (0, 1, float("nan")), (None, 1, 0.5), (1, None, 0.25)]
    schema = "label int, prediction int, score double"
    scored, seen = counted(rows, schema)
    tables = evaluation_tables(scored, "classification")
    got = {name: rows_of(df) for name, df in tables.items()}
    assert seen.value == len(rows)
    plain = spark.createDataFrame(rows, schema)
    assert got["confusion"] == rows_of(metrics.confusion_table(plain))
    assert got["class_report"] == rows_of(metrics.class_report(plain))
    assert got["roc_points"] == rows_of(metrics.roc_points(plain))
    assert got["pr_points"] == rows_of(metrics.pr_points(plain))
    values = dict(got["metrics"])
    assert values["roc_auc"] == metrics.curve_areas(plain).first()["roc_auc"]
    assert values["f1_score"] == metrics.classification_metrics(plain).first()["f1"]


def test_regression_report_reads_the_scored_rows_once(spark, counted):
    rows = [(float(i % 17), float(i % 13)) for i in range(200)] + [(None, 1.0)]
    schema = "label double, prediction double"
    scored, seen = counted(rows, schema)
    tables = evaluation_tables(scored, "regression")
    got = {name: rows_of(df) for name, df in tables.items()}
    assert seen.value == len(rows)
    plain = metrics.with_residuals(spark.createDataFrame(rows, schema))
    assert got["residuals"] == rows_of(plain)
    assert got["residual_histogram"] == rows_of(metrics.residual_histogram(plain))
    assert dict(got["metrics"])["mae"] == metrics.regression_metrics(plain).first()["mae"]


@pytest.mark.parametrize("task", ["classification", "regression"])
def test_report_of_nothing(spark, task):
    nothing = spark.createDataFrame([], "label int, prediction int, score double")
    long = report_rows(evaluation_tables(nothing, task))
    assert long.columns == ["part", "item", "threshold", "measure", "value"]
    found = {r["part"] for r in long.where(F.col("measure") == "rows").collect()}
    assert found == ({"confusion"} if task == "classification" else {"residual_histogram"})
