"""Bloom scores, onset dates and confidence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import values
from ..schema import DATE, LOCATION, RAW_VALUE, SMOOTH_VALUE

ONSET_LEVEL = 0.5
REGRESSION_CONFIDENCE = 0.8


def greenness(df: DataFrame) -> Column:
    """The first value column the table has: smoothed, raw, else a constant 0.5."""
    for name in (SMOOTH_VALUE, RAW_VALUE):
        if name in df.columns:
            return F.col(name)
    return F.lit(0.5)


def rule_scores(df: DataFrame) -> DataFrame:
    """Add probability, flag and value by rule; row-local, so it also runs on streams."""
    ndvi = greenness(df)
    probability = values.rule_probability(ndvi, F.month(DATE))
    return df.withColumns({
        "bloom_probability": probability,
        "bloom_predicted": values.rule_flag(probability),
        "ndvi": ndvi,
    })


def probable_onset() -> Column:
    """Aggregate: first date with a probability above one half."""
    return F.min(F.when(F.col("bloom_probability") > ONSET_LEVEL, F.col(DATE)))


def flagged_onset(flag: str = "bloom_predicted") -> Column:
    """Aggregate: first date whose flag is set."""
    return F.min(F.when(F.col(flag), F.col(DATE)))


def onset_by_probability(df: DataFrame, key: Sequence[str] = (LOCATION,)) -> DataFrame:
    return df.groupBy(*key).agg(probable_onset().alias("predicted_onset_date"))


def onset_by_flag(
    df: DataFrame, flag: str = "bloom_predicted", key: Sequence[str] = (LOCATION,)
) -> DataFrame:
    return df.groupBy(*key).agg(flagged_onset(flag).alias("predicted_onset_date"))


def onset_by_day(
    df: DataFrame, key: Sequence[str] = (LOCATION,), predicted: str = "predicted_onset_doy"
) -> DataFrame:
    """Date whose day of the year is nearest to the first row's prediction, ties earliest.

    For series of one row per key and date.
    """
    target = F.first(predicted).over(Window.partitionBy(*key).orderBy(DATE))
    away = F.abs(F.dayofyear(DATE) - F.col("_target"))
    return df.withColumn("_target", target).groupBy(*key).agg(
        F.min(F.struct(away.alias("away"), DATE))[DATE].alias("predicted_onset_date")
    )


def confidence(df: DataFrame, key: Sequence[str] = (LOCATION,)) -> DataFrame:
    """Mean probability per key, or the constant of regression models."""
    if "bloom_probability" in df.columns:
        return df.groupBy(*key).agg(F.avg("bloom_probability").alias("confidence"))
    return df.select(*key).distinct().withColumn("confidence", F.lit(REGRESSION_CONFIDENCE))


def bloom_events(df: DataFrame, key: Sequence[str] = (LOCATION,)) -> DataFrame:
    """Rows flagged by the demo rule per key."""
    flag = values.demo_bloom_flag(greenness(df), F.month(DATE))
    return df.groupBy(*key).agg(
        F.sum(flag.cast("long")).alias("bloom_events"),
        F.count(F.lit(1)).alias("series_rows"),
    )


def location_peak(df: DataFrame, value: str = SMOOTH_VALUE) -> DataFrame:
    """Highest value of each location, its first position and date."""
    w = Window.partitionBy(LOCATION).orderBy(DATE)
    at = df.withColumn("_index", F.row_number().over(w) - 1)
    top = F.max(F.when(F.col(value).isNotNull(), F.struct(
        F.col(value).alias("v"), (-F.col("_index")).alias("i"), DATE
    )))
    return at.groupBy(LOCATION).agg(top.alias("t")).select(
        LOCATION, F.col("t.v").alias("peak_ndvi"), (-F.col("t.i")).alias("peak_index"),
        F.col(f"t.{DATE}").alias("peak_date"),
    )


def first_locations(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` location keys in order."""
    return df.select(LOCATION).distinct().orderBy(LOCATION).limit(n)


def overlay_onsets(scored: DataFrame, labels: DataFrame, n_locations: int = 5) -> DataFrame:
    """Scored series of a few locations, each row beside its location's actual onsets."""
    few = scored.join(F.broadcast(first_locations(scored, n_locations)), LOCATION, "left_semi")
    onsets = labels.groupBy(LOCATION).agg(
        F.sort_array(F.collect_set("onset_date")).alias("actual_onsets")
    )
    return few.join(onsets, LOCATION, "left")
