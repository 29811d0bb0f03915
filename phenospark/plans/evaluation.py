"""Evaluation of a scored table or a fitted model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.score import overlay_onsets
from ..operators.train import BloomModel, feature_importances, predict
from ..schema import DATE, LOCATION, SMOOTH_VALUE
from ..sources.shared import stored


def metric_rows(one_row: DataFrame) -> DataFrame:
    """(metric, value) rows of a one-row table of metrics."""
    pairs = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in one_row.columns
    ])
    return one_row.select(F.explode(pairs).alias("m")).select("m.*")


def _class_metrics(counts: DataFrame, steps: metrics.ScoreSteps) -> DataFrame:
    plain = metrics.classification_metrics(counts, weight="rows").withColumnRenamed("f1", "f1_score")
    areas = metrics.curve_areas(counts, steps=steps).select("roc_auc")
    return metric_rows(plain).unionByName(metric_rows(areas))


def _regression_rows(scored: DataFrame) -> DataFrame:
    return metric_rows(metrics.regression_metrics(scored).drop("mape"))


def evaluation_metrics(scored: DataFrame, task: str) -> DataFrame:
    """(metric, value) rows for ``label``, ``prediction`` and, for classes, ``score``."""
    if task == "regression":
        return _regression_rows(scored)
    counts = metrics.outcome_counts(scored)
    return _class_metrics(counts, metrics.score_steps(counts, weight="rows"))


def evaluation_tables(scored: DataFrame, task: str) -> dict[str, DataFrame]:
    """Every table of the report that scored rows give; they are read once.

    Classes: rows are counted per label, prediction and score, the counts per score summed
    up along the scores once, and all tables taken from these two.  Regression: the rows
    are stored with their residuals, as the report holds them.
    """
    if task == "regression":
        residuals = stored(metrics.with_residuals(scored), "residual-rows")
        return {
            "metrics": _regression_rows(residuals),
            "residuals": residuals,
            "residual_histogram": metrics.residual_histogram(residuals, store=False),
        }
    counts = metrics.outcome_counts(scored)
    found = metrics.score_steps(counts, weight="rows")
    steps = replace(found, rows=stored(found.rows, "running-counts"))
    return {
        "metrics": _class_metrics(counts, steps),
        "confusion": metrics.confusion_table(counts, weight="rows"),
        "class_report": metrics.class_report(counts, weight="rows"),
        "roc_points": metrics.roc_points(counts, steps=steps),
        "pr_points": metrics.pr_points(counts, steps=steps),
    }


# What names a row in each table of a report; thresholds have a column of their own.
_ITEMS = {
    "metrics": ("metric",), "confusion": ("label", "prediction"), "class_report": ("class",),
    "roc_points": (), "pr_points": (), "residual_histogram": ("bin",), "importances": ("feature",),
}


def report_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The tables of a report, but for the residual rows, as one long table:
    ``part``, ``item``, ``threshold``, ``measure``, ``value``."""
    long = []
    for part, table in tables.items():
        if part not in _ITEMS:
            continue
        keys = _ITEMS[part]
        item = F.concat_ws("/", *[F.col(k).cast("string") for k in keys]) if keys else F.lit(None).cast("string")
        threshold = F.col("threshold") if "threshold" in table.columns else F.lit(None).cast("double")
        cells = F.array(*[
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
            for c in table.columns if c not in (*keys, "threshold")
        ])
        long.append(table.select(
            F.lit(part).alias("part"), item.alias("item"), threshold.alias("threshold"), F.explode(cells).alias("c"),
        ).select("part", "item", "threshold", "c.*"))
    return reduce(DataFrame.unionByName, long)


def evaluation_report(
    model: BloomModel, dataset: DataFrame, scored: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every table of the report.  The rows are scored, or read from ``scored`` (a copy of
    ``predict(model, dataset)``), once."""
    scored = predict(model, dataset) if scored is None else scored
    return {
        **evaluation_tables(scored, model.task),
        "importances": feature_importances(model, dataset),
    }


def timeseries_report(
    model: BloomModel, features: DataFrame, labels: DataFrame, n_locations: int = 5,
    keep: Sequence[str] = (LOCATION, DATE, SMOOTH_VALUE),
) -> DataFrame:
    """Scored series of the first locations beside their actual onsets."""
    return overlay_onsets(predict(model, features, keep), labels, n_locations)
