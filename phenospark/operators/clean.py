"""From raw observations to keyed, scaled and clipped ones (row-local, no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar, values
from ..schema import DATE, LOCATION, RAW_REQUIRED, RAW_VALUE, require_columns


def parse_dates(df: DataFrame, mode: str = "strict", date: str = DATE) -> DataFrame:
    """``strict`` fails the job on a bad text; ``lenient`` drops the row."""
    if df.schema[date].dataType.simpleString() != "string":
        parsed = F.col(date).cast("date")
    elif mode == "strict":
        parsed = F.to_date(F.col(date))
    else:
        parsed = calendar.lenient_date(F.col(date))
    out = df.withColumn(date, parsed)
    return out if mode == "strict" else out.dropna(subset=[date])


def with_location_key(df: DataFrame, style: str = "canonical") -> DataFrame:
    key = values.location_key(F.col("latitude"), F.col("longitude"), style)
    return df.withColumn(LOCATION, key)


def scale_values(df: DataFrame, scale: str = "auto", value: str = RAW_VALUE) -> DataFrame:
    """Multiply by 0.0001 always, never, or when the table's maximum exceeds 1.

    ``auto`` reads the one value column a first time for a scalar subquery; name
    the scale where it is known to save that pass.
    """
    scaled: Column = F.col(value) * values.SCALE_FACTOR
    if scale == "never":
        return df
    if scale == "always":
        return df.withColumn(value, scaled)
    if scale != "auto":
        raise ValueError(f"unknown scale mode: {scale}")
    top = df.agg(F.max(value)).scalar()
    return df.withColumn(value, F.when(top > 1.0, scaled).otherwise(F.col(value)))


def clip_values(df: DataFrame, value: str = RAW_VALUE) -> DataFrame:
    return df.withColumn(value, values.clip(F.col(value)))


def _complete(required: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in required])


def drop_incomplete(df: DataFrame, required: Sequence[str] = RAW_REQUIRED) -> DataFrame:
    """Drop rows with a missing required value."""
    return df.where(_complete(required))


def count_incomplete(df: DataFrame, required: Sequence[str] = RAW_REQUIRED) -> DataFrame:
    """One row: how many rows there are and how many ``drop_incomplete`` removes.

    A narrow pass of its own: a session that has used an ``Observation`` can no longer
    ship a fitted forest to its tasks.
    """
    removed = F.count_if(~_complete(required))
    return df.agg(F.count(F.lit(1)).alias("rows"), removed.alias("removed"))


def clean(
    df: DataFrame,
    scale: str = "auto",
    key_style: str = "canonical",
    date_mode: str = "strict",
) -> DataFrame:
    """The whole cleaning stage: dates, missing marks, key, scale, clip, drop."""
    require_columns(df, RAW_REQUIRED)
    out = parse_dates(df, date_mode)
    out = out.withColumns({
        c: values.null_if_nan(F.col(c).cast("double"))
        for c in ("latitude", "longitude", RAW_VALUE)
    })
    out = with_location_key(out, key_style)
    out = scale_values(out, scale)
    out = clip_values(out)
    return drop_incomplete(out)


def mask_clouds(
    df: DataFrame, quality: str | None = None, threshold: float = values.CLOUD_THRESHOLD,
    value: str = RAW_VALUE,
) -> DataFrame:
    """NULL out values under the threshold or of poor quality."""
    q = F.col(quality) if quality else None
    return df.withColumn(value, values.cloud_mask(F.col(value), q, threshold))


def flag_clouds(
    df: DataFrame, reliability: str | None = None, value: str = RAW_VALUE
) -> DataFrame:
    """Add the boolean ``is_cloud``."""
    r = F.col(reliability) if reliability else None
    return df.withColumn("is_cloud", values.cloud_flag(F.col(value), r))


def coordinate_ok(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    ok = F.col(latitude).between(-90.0, 90.0) & F.col(longitude).between(-180.0, 180.0)
    return F.coalesce(ok, F.lit(False))


def split_by_coordinates(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with coordinates on the globe, rejected rows)."""
    return df.where(coordinate_ok()), df.where(~coordinate_ok())
