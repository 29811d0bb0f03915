"""Table layouts, column names and the checks made before any job starts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

LOCATION = "location_id"
DATE = "date"
RAW_VALUE = "ndvi_raw"
SMOOTH_VALUE = "ndvi_smoothed"

RAW = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("date", T.DateType()),
    T.StructField("ndvi_raw", T.DoubleType()),
])

SERIES = T.StructType([
    T.StructField("location_id", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("date", T.DateType()),
    T.StructField("ndvi_raw", T.DoubleType()),
])

PROCESSED = T.StructType([*SERIES.fields, T.StructField("ndvi_smoothed", T.DoubleType())])

LABELS = T.StructType([
    T.StructField("location_id", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("onset_date", T.DateType()),
    T.StructField("onset_index", T.IntegerType()),
    T.StructField("label_quality_score", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
])

PREDICTIONS = T.ArrayType(T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("bloom_probability", T.DoubleType()),
    T.StructField("bloom_predicted", T.BooleanType()),
    T.StructField("ndvi", T.DoubleType()),
]))

# The column sets each stage insists on.
RAW_REQUIRED = ("latitude", "longitude", "date", "ndvi_raw")
PROCESSED_REQUIRED = ("location_id", "date", "ndvi_smoothed", "latitude", "longitude")
SERIES_COLUMNS = ("location_id", "latitude", "longitude", "date", "ndvi_raw", "ndvi_smoothed")

# Phases and cycles of the annual phenology product.
PHENOLOGY_PHASES = (
    "Greenup", "Dormancy", "MidGreenup", "Peak", "Maturity", "Senescence", "MidGreendown",
)
PHENOLOGY_CYCLES = (1, 2, 3, 4)
PHENOLOGY_BANDS = tuple(f"{p}_{c}" for p in PHENOLOGY_PHASES for c in PHENOLOGY_CYCLES)


class MissingColumnsError(ValueError):
    """A stage was handed a table that lacks required columns."""


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise before any job runs."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"missing required columns: {missing}")
    return df
