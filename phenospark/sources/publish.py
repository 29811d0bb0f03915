"""Stage tables by year that a re-run replaces year by year."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import DATE

YEAR = "year"
HELD = "published_row"  # false in the row that stands for a year without rows


class SchemaChangedError(ValueError):
    """A table was published anew with other columns."""


def published_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The columns of a published table, None where there is none."""
    try:
        text = spark.read.text(f"{path}/schema").first()
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if text is None else T.StructType.fromJson(json.loads(text["value"]))


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def publish(df: DataFrame, path: str, covers: tuple[int, int] | None = None) -> DataFrame:
    """Replace the years that ``df`` holds, leave the others, and read the table back.

    A re-run doubles nothing: Spark writes aside and swaps whole years in when the job
    commits, so a lost executor or a failed run leaves the former table.  ``covers`` names
    the first and last year that the run answers for; one of them without rows is emptied,
    which dynamic overwrite alone would not do.  The table keeps its columns beside its rows,
    so an empty one is typed, and publishing other columns is an error.  The year comes from
    the date where there is no such column; rows without one are a year of their own.  Rows
    of a year come together first, or every task would open every year; adaptive execution
    cuts a large year into pieces of the advised size.
    """
    spark = df.sparkSession
    if YEAR not in df.columns:
        df = df.withColumn(YEAR, F.year(DATE))
    df = df.withColumn(YEAR, F.col(YEAR).cast("int"))
    if HELD in df.columns:
        raise ValueError(f"{HELD} is a column of the published form")
    before = published_schema(spark, path)
    if before is None:
        text = spark.createDataFrame([(df.schema.json(),)], "value string")
        text.coalesce(1).write.mode("overwrite").text(f"{path}/schema")
    elif _shape(before) != _shape(df.schema):
        raise SchemaChangedError(f"{path} holds {before.simpleString()}")
    rows = df.withColumn(HELD, F.lit(True))
    if covers:
        years = spark.range(covers[0], covers[1] + 1).select(
            F.col("id").cast("int").alias(YEAR), F.lit(False).alias(HELD))
        rows = rows.unionByName(years, allowMissingColumns=True)
    (
        rows.hint("rebalance", YEAR).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(YEAR).parquet(f"{path}/rows")
    )
    return read_published(spark, path)


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a published table in the columns it was published with."""
    schema = published_schema(spark, path)
    if schema is None:
        raise FileNotFoundError(path)
    held = T.StructType([*schema.fields, T.StructField(HELD, T.BooleanType())])
    rows = spark.read.schema(held).parquet(f"{path}/rows").where(HELD)
    return rows.select(*[f"`{c}`" for c in schema.names])  # the year goes back to its place
