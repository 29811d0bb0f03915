"""Calendar resampling: period means on a complete grid of periods per location."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar
from ..schema import DATE, LOCATION, RAW_VALUE


def resample(
    df: DataFrame,
    frequency: str = "month",
    value: str = RAW_VALUE,
    min_points: int = 2,
    fill_empty: bool = True,
) -> DataFrame:
    """Mean per location and period, empty periods as NULL rows, dated at the period start.

    Locations with fewer than ``min_points`` rows are left out.  The coordinates are those
    of the location's first row, the least pair where several share its date.  The means reduce
    map-side, so a location holding most of the table costs one row per period; the
    window that finds the gaps then sees at most one row per location and period.
    """
    parts = df.groupBy(
        LOCATION, calendar.period_start(F.col(DATE), frequency).alias("period"), "latitude", "longitude"
    ).agg(
        F.sum(F.col(value).cast("double")).alias("total"), F.count(value).alias("valid"),
        F.count(F.lit(1)).alias("rows"), F.min(DATE).alias("first"),
    )
    cells = parts.groupBy(LOCATION, "period").agg(
        F.try_divide(F.sum("total"), F.sum("valid")).alias("period_mean"),
        F.sum("rows").alias("period_rows"),
        F.min(F.struct("first", "latitude", "longitude")).alias("period_place"),
    )
    whole = Window.partitionBy(LOCATION)
    w = whole.orderBy("period")
    seen = cells.withColumns({
        "latitude": F.first("period_place.latitude").over(w),
        "longitude": F.first("period_place.longitude").over(w),
        "next_period": F.lead("period").over(w),
        "location_rows": F.sum("period_rows").over(whole),
    }).where(F.col("location_rows") >= min_points)
    if fill_empty:
        # each period also emits the empty ones up to the next that has rows
        last = F.coalesce(F.date_sub("next_period", 1), F.col("period"))
        seen = seen.withColumn(
            DATE, F.explode(F.sequence("period", last, calendar.step(frequency)))
        )
    else:
        seen = seen.withColumn(DATE, F.col("period"))
    mean = F.when(F.col(DATE) == F.col("period"), F.col("period_mean"))
    return seen.select(LOCATION, "latitude", "longitude", DATE, mean.alias(value))
