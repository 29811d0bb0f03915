"""Bloom-onset labels: from change points, from the phenology product, from spring jumps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar, values
from ..schema import (
    DATE, LOCATION, PHENOLOGY_CYCLES, PROCESSED_REQUIRED, RAW_VALUE, SMOOTH_VALUE,
    require_columns,
)
from .changepoint import MIN_SIZE, PENALTY, change_points

# What counts as an onset.
MIN_INCREASE = 0.1
MIN_ROWS = 6
REFERENCE_YEAR = 2020
PHENOLOGY_SOURCE = "MCD12Q2"


def series_arrays(df: DataFrame, value: str = SMOOTH_VALUE) -> DataFrame:
    """One row per location with its dates and values in date order.

    For series of one row per date: the calendar bounds the arrays.
    """
    step = F.struct(DATE, F.col(value).alias("v"), "latitude", "longitude")
    packed = df.groupBy(LOCATION).agg(F.sort_array(F.collect_list(step)).alias("s"))
    return packed.select(
        LOCATION,
        F.col(f"s.{DATE}").alias("dates"),
        F.col("s.v").alias("series"),
        F.col("s")[0]["latitude"].alias("latitude"),
        F.col("s")[0]["longitude"].alias("longitude"),
    )


def _mean_between(series: Column, first: Column, stop: Column) -> Column:
    """Mean of the valid values at positions [first, stop), clamped; NULL when none."""
    low = F.greatest(first, F.lit(0))
    length = F.greatest(F.least(stop, F.size(series)) - low, F.lit(0))
    valid = F.filter(F.slice(series, low + 1, length), lambda v: v.isNotNull())
    return F.try_divide(F.aggregate(valid, F.lit(0.0), lambda a, v: a + v), F.size(valid))


def onsets_from_candidates(
    arrays: DataFrame,
    candidates: str = "candidates",
    min_increase: float = MIN_INCREASE,
    per_year: bool = False,
) -> DataFrame:
    """Pick the onset among each location's candidate positions and describe it.

    Candidates in March to June count, or the first one when there is none.  The rise
    over a candidate must reach ``min_increase``; the best capped score wins, the
    earliest on ties.  One label per location, or with ``per_year`` one per year.
    """
    cands, dates, series = F.col(candidates), F.col("dates"), F.col("series")
    when_at = lambda c: F.get(dates, c)
    spring = lambda c: values.in_spring(F.month(when_at(c)))

    def rivals(c: Column, test) -> Column:
        same = (lambda d: F.year(when_at(d)) == F.year(when_at(c))) if per_year else (
            lambda d: F.lit(True))
        return F.exists(cands, lambda d: same(d) & test(d))

    pool = F.filter(cands, lambda c: spring(c) | (
        ~rivals(c, spring) & ~rivals(c, lambda d: d < c)
    ))
    at = F.col("onset_index")
    tested = (
        arrays.where(F.size(series) >= MIN_ROWS)
        .withColumn("onset_index", F.explode(pool))
        .where(at < F.size(series) - 1)
        .withColumn("rise", _mean_between(series, at, at + 3) - _mean_between(series, at - 2, at + 1))
        .where(F.col("rise") >= min_increase)
    )
    described = tested.select(
        LOCATION,
        F.year(when_at(at)).alias("year"),
        F.struct(
            values.increase_quality(F.col("rise")).alias("label_quality_score"),
            (-at).alias("earliest"),
            when_at(at).alias("onset_date"),
            "latitude", "longitude",
            _mean_between(series, at - 3, at).alias("pre_onset_ndvi"),
            _mean_between(series, at, at + 4).alias("post_onset_ndvi"),
            F.array_max(series).alias("peak_ndvi"),
            (F.array_position(series, F.array_max(series)) - 1).cast("int").alias("peak_index"),
            F.get(series, at).alias("onset_ndvi"),
        ).alias("label"),
    )
    group = [LOCATION, "year"] if per_year else [LOCATION]
    best = described.groupBy(*group).agg(F.max("label").alias("b"))
    return best.select(
        LOCATION,
        F.year("b.onset_date").alias("year"),
        "b.onset_date",
        (-F.col("b.earliest")).alias("onset_index"),
        "b.label_quality_score", "b.latitude", "b.longitude",
        "b.pre_onset_ndvi", "b.post_onset_ndvi",
        (F.col("b.post_onset_ndvi") - F.col("b.pre_onset_ndvi")).alias("ndvi_increase"),
        "b.peak_ndvi", "b.peak_index", "b.onset_ndvi",
    )


def change_point_labels(
    df: DataFrame,
    method: str = "pelt",
    min_increase: float = MIN_INCREASE,
    penalty: float = PENALTY,
    min_size: int = MIN_SIZE,
    per_year: bool = False,
    value: str = SMOOTH_VALUE,
) -> DataFrame:
    """Detect change points per location and label the best one as the onset."""
    require_columns(df, PROCESSED_REQUIRED)
    found = change_points(F.col("series"), method, min_size, penalty)
    arrays = series_arrays(df, value).withColumn("candidates", found)
    return onsets_from_candidates(arrays, "candidates", min_increase, per_year)


def _valid_days(df: DataFrame, phase: str, highest: int) -> Column:
    names = [f"{phase}_{c}" for c in PHENOLOGY_CYCLES if f"{phase}_{c}" in df.columns]
    days = F.array(*[
        values.null_if_nan(F.col(n).cast("double")).try_cast("int") for n in names
    ])
    return F.filter(days, lambda d: (d >= 1) & (d <= highest))


def phenology_labels(df: DataFrame, epoch_days: bool = False) -> DataFrame:
    """Earliest valid greenup as onset, earliest valid peak, quality by valid cycles.

    Bands hold days of the year (of column ``year`` when there is one, else 2020), or
    with ``epoch_days`` days since 1970.  Rows without a valid greenup are dropped.
    """
    highest = 32766 if epoch_days else 366  # 32767 marks "no value" in the product
    year = F.col("year").cast("int") if "year" in df.columns else F.lit(REFERENCE_YEAR)
    out = df.select(
        year.alias("year"), "latitude", "longitude",
        _valid_days(df, "Greenup", highest).alias("greenups"),
        _valid_days(df, "Peak", highest).alias("peaks"),
    ).where(F.size("greenups") > 0)
    first, peak = F.array_min("greenups"), F.array_min("peaks")
    if epoch_days:
        onset, peak_doy = F.date_from_unix_date(first), F.dayofyear(F.date_from_unix_date(peak))
    else:
        onset, peak_doy = calendar.date_of_day(F.col("year"), first), peak
    return out.withColumn("onset_date", onset).where(F.col("onset_date").isNotNull()).select(
        values.location_key(F.col("latitude"), F.col("longitude")).alias(LOCATION),
        (F.year("onset_date") if epoch_days else F.col("year")).alias("year"),
        "onset_date",
        F.dayofyear("onset_date").alias("onset_doy"),
        peak_doy.alias("peak_doy"),
        (F.size("greenups") / F.lit(4.0)).alias("label_quality_score"),
        "latitude", "longitude",
        F.lit(PHENOLOGY_SOURCE).alias("data_source"),
    )


def spring_jump_labels(df: DataFrame, value: str = RAW_VALUE) -> DataFrame:
    """Largest rise between consecutive March-to-June rows of each location and year.

    A year needs six rows, two of them in spring, none of those missing a value, and a
    rise above 0.1.  For series of one row per date.
    """
    whole = Window.partitionBy(LOCATION)
    yearly = Window.partitionBy(LOCATION, "year")
    w = yearly.orderBy(DATE)
    rows = df.withColumns({
        "year": F.year(DATE),
        "_lat": F.first("latitude").over(whole.orderBy(DATE)),
        "_lon": F.first("longitude").over(whole.orderBy(DATE)),
    }).withColumn("_year_rows", F.count(F.lit(1)).over(yearly))
    spring = rows.where(
        (F.col("_year_rows") >= MIN_ROWS) & values.in_spring(F.month(DATE))
    ).withColumns({
        "_jump": F.col(value) - F.lag(value).over(w),
        "_index": F.row_number().over(w) - 1,
    })
    best = spring.groupBy(LOCATION, "year").agg(
        F.max(F.when(F.col("_jump").isNotNull(), F.struct(
            "_jump", (-F.col("_index")).alias("earliest"), DATE, "_lat", "_lon"
        ))).alias("b"),
        (F.count(F.lit(1)) == F.count(value)).alias("_whole"),
    ).where(F.col("_whole") & (F.col("b._jump") > MIN_INCREASE))
    return best.select(
        LOCATION, "year",
        F.col(f"b.{DATE}").alias("onset_date"),
        (-F.col("b.earliest")).cast("int").alias("onset_index"),
        values.increase_quality(F.col("b._jump")).alias("label_quality_score"),
        F.col("b._lat").alias("latitude"),
        F.col("b._lon").alias("longitude"),
    )
