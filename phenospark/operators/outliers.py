"""Outlier flags by z-score, per location or per location and calendar month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DATE, LOCATION, RAW_VALUE
from .joins import null_safe_join


def _with_stats(df: DataFrame, value: str, group: tuple[str, ...]) -> DataFrame:
    """Rows with the statistics of their group and the row count of their location.

    The statistics reduce map-side to one row per group and are joined back, nulls of the
    key included; adaptive execution may split a crowded location's rows in that join.
    """
    rows = df.withColumn("calendar_month", F.month(DATE))
    stats = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("group_rows"),
        F.count(value).alias("group_valid"),
        F.avg(value).alias("group_mean"),
        F.stddev_pop(value).alias("group_std"),
    ).withColumn("location_rows", F.sum("group_rows").over(Window.partitionBy(LOCATION)))
    return null_safe_join(rows, stats, group)


def _flag(
    df: DataFrame, value: str, group: tuple[str, ...], guard: Column, threshold: float,
    name: str,
) -> DataFrame:
    z = F.abs(F.try_divide(F.col(value) - F.col("group_mean"), F.col("group_std")))
    flag = F.coalesce(guard & (F.col("group_std") != 0) & (z > threshold), F.lit(False))
    return _with_stats(df, value, group).select(*df.columns, flag.alias(name))


def flag_global_outliers(
    df: DataFrame, value: str = RAW_VALUE, threshold: float = 3.0,
    name: str = "is_outlier", **hot,
) -> DataFrame:
    """|z| above the threshold within the location; fewer than 3 rows are never flagged.

    One plan serves every size; ``hot`` is taken for the sake of older calls and has no effect.
    """
    guard = F.col("location_rows") >= 3
    return _flag(df, value, (LOCATION,), guard, threshold, name)


def flag_seasonal_outliers(
    df: DataFrame, value: str = RAW_VALUE, threshold: float = 2.0,
    name: str = "is_seasonal_outlier", **hot,
) -> DataFrame:
    """|z| above the threshold among the location's values of the same calendar month.

    Needs 12 rows in the series and 3 rows, 3 of them valid, in the month.  ``hot`` as above.
    """
    guard = (
        (F.col("location_rows") >= 12)
        & (F.col("group_rows") >= 3)
        & (F.col("group_valid") >= 3)
    )
    return _flag(df, value, (LOCATION, "calendar_month"), guard, threshold, name)
