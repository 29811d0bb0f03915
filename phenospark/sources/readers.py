"""Typed reads of observations, series, features and labels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import SCALE_FACTOR
from ..schema import (
    LABELS, PROCESSED, PROCESSED_REQUIRED, RAW, RAW_REQUIRED, RAW_VALUE, require_columns,
)

# Column names of the extract service and what they are called here.
EXTRACT_NAMES = {
    "Latitude": "latitude", "Longitude": "longitude", "Date": "date", "NDVI": RAW_VALUE,
}


def _read(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, fmt: str
) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).option(
            "enforceSchema", False
        ).csv(paths)
    found = spark.read.format(fmt).load(paths)
    known = {f.name: f for f in schema}
    # a column of another kind fails here, before any job
    return found.to(T.StructType([known.get(f.name, f) for f in found.schema]))


def read_raw(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "csv",
    schema: T.StructType = RAW, row_number: bool = False,
) -> DataFrame:
    """Raw observations.  ``row_number`` (Parquet) adds ``obs_id``, which tells exact
    copies of a row apart and is the same whenever a file is read again."""
    df = require_columns(_read(spark, path, schema, fmt), RAW_REQUIRED)
    if row_number:
        df = df.withColumn("obs_id", F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    return df


def read_processed(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet"
) -> DataFrame:
    return require_columns(_read(spark, path, PROCESSED, fmt), PROCESSED_REQUIRED)


def read_labels(
    spark: SparkSession, path: str | None, fmt: str = "parquet"
) -> DataFrame | None:
    """Labels, or None when there is no path or nothing at it; a path may be a glob."""
    if path is None:
        return None
    try:
        return _read(spark, path, LABELS, fmt)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_training_tables(
    spark: SparkSession, features: str, labels: str | None = None, fmt: str = "parquet"
) -> tuple[DataFrame, DataFrame | None]:
    """(features, labels or None)."""
    return spark.read.format(fmt).load(features), read_labels(spark, labels, fmt)


def normalise_extract(df: DataFrame) -> DataFrame:
    """Service names to ours, values scaled from the stored integers."""
    out = df.withColumnsRenamed(EXTRACT_NAMES)
    if RAW_VALUE in out.columns:
        out = out.withColumn(RAW_VALUE, F.col(RAW_VALUE).cast("double") * SCALE_FACTOR)
    return out


def union_extracts(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of extracts whose columns may differ."""
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [normalise_extract(f) for f in frames],
    )


def read_extracts(
    spark: SparkSession, groups: Sequence[tuple[str | Sequence[str], T.StructType]]
) -> DataFrame:
    """Unpacked extract files, one (path or glob, schema) per layout."""
    return union_extracts([_read(spark, path, schema, "csv") for path, schema in groups])
