"""Writes of each stage's table, and the one-pass summaries that go with them."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import non_null_profile
from ..operators.train import BloomModel
from ..schema import DATE, LABELS, LOCATION, SMOOTH_VALUE


def summarise(df: DataFrame, value: str = SMOOTH_VALUE, date: str = DATE) -> DataFrame:
    """Rows, locations, date range and value range in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("records"),
        F.countDistinct(LOCATION).alias("locations"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.min(value).alias("lowest"),
        F.max(value).alias("highest"),
        F.avg(value).alias("mean"),
    )


def summarise_labels(labels: DataFrame) -> DataFrame:
    """Labels, locations, years covered and mean quality in one pass."""
    return labels.agg(
        F.count(F.lit(1)).alias("labels"),
        F.countDistinct(LOCATION).alias("locations"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.avg("label_quality_score").alias("mean_quality"),
    )


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", by_year: bool = False,
    mode: str = "overwrite", order_by: Sequence[str] = (),
) -> None:
    """Write a stage's table; ``by_year`` lays it out for date-range pruning and
    ``order_by`` sorts the whole of it, which nothing downstream needs."""
    if by_year:
        # rows of one year come together, or every task would open every year; adaptive
        # execution then cuts a year into as many pieces of the advised size as it needs
        if "year" not in df.columns:
            df = df.withColumn("year", F.year(DATE))
        df = df.hint("rebalance", "year")
    if order_by:
        df = df.orderBy(*order_by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    (writer.partitionBy("year") if by_year else writer).save(path)


def save_processed(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write, then summarise what was written."""
    write_table(df, path, fmt)
    spark = df.sparkSession
    reader = spark.read.schema(df.schema)
    stored = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(
        fmt).load(path)
    return summarise(stored)


def save_features(df: DataFrame, path: str) -> DataFrame:
    """Write, then profile how many rows have each feature."""
    write_table(df, path)
    return non_null_profile(df.sparkSession.read.schema(df.schema).parquet(path))


def save_labels(
    labels: DataFrame | None, path: str, spark: SparkSession | None = None,
    fmt: str = "parquet",
) -> None:
    """Write labels in order; without any, an empty table with the label columns."""
    if labels is None:
        labels = spark.createDataFrame([], LABELS)
    write_table(labels, path, fmt, order_by=(LOCATION, "year"))


def save_metrics(one_row: DataFrame, path: str) -> None:
    one_row.coalesce(1).write.mode("overwrite").json(path)


def model_path(directory: str, task: str, model_type: str) -> str:
    return f"{directory}/bloom_model_{task}_{model_type}"


def save_model(spark: SparkSession, model: BloomModel, directory: str) -> str:
    """Write the pipeline and, beside it, its feature list and metrics."""
    path = model_path(directory, model.task, model.model_type)
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    about = {
        "features": model.features, "task": model.task, "model_type": model.model_type,
        "metrics": model.metrics, "best_params": model.best_params,
    }
    text = spark.createDataFrame([(json.dumps(about),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/metrics")
    return path


def load_model(spark: SparkSession, path: str) -> BloomModel:
    about = json.loads(spark.read.text(f"{path}/metrics").first()["value"])
    return BloomModel(pipeline=PipelineModel.load(f"{path}/pipeline"), **about)
