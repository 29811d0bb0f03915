"""Training sets: feature rows joined with onset labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DATE, LOCATION, RAW_VALUE, SMOOTH_VALUE

KEY = (LOCATION, "year")
# Columns that are never model inputs.
NOT_FEATURES = (
    LOCATION, "latitude", "longitude", DATE, RAW_VALUE, SMOOTH_VALUE, "year",
    "label_quality_score", "bloom_label", "onset_date", "onset_doy", "fold",
)


def feature_columns(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in NOT_FEATURES]


def best_label(labels: DataFrame) -> DataFrame:
    """One label per location and year: the best quality, the earliest onset on ties.

    An aggregate, so copies of a label reduce map-side.
    """
    quality = F.col("label_quality_score")
    rest = [c for c in labels.columns if c not in (*KEY, "onset_date")]
    best = F.min(F.struct(
        quality.isNull().alias("unrated"), (-quality).alias("rank"), "onset_date", *rest
    ))
    picked = labels.groupBy(*KEY).agg(best.alias("best"))
    return picked.select(*[
        F.col(c) if c in KEY else F.col(f"best.{c}").alias(c) for c in labels.columns
    ])


def classification_set(
    features: DataFrame, labels: DataFrame, one_label: bool = False
) -> DataFrame:
    """All feature rows with ``bloom_label``: 1 where (location, year) has a label.

    Several labels of one location and year repeat its rows, unless ``one_label``.
    Whether labels are broadcast is left to their measured size.
    """
    picked = (best_label(labels) if one_label else labels).select(*KEY, "label_quality_score")
    return features.join(picked, list(KEY), "left").withColumn(
        "bloom_label", F.col("label_quality_score").isNotNull().cast("int")
    )


def regression_set(
    features: DataFrame, labels: DataFrame, one_label: bool = False
) -> DataFrame:
    """Labelled feature rows with ``onset_doy``, the onset's day of the year."""
    picked = (best_label(labels) if one_label else labels).where(
        F.col("label_quality_score").isNotNull()
    ).select(*KEY, "onset_date", "label_quality_score")
    return features.join(picked, list(KEY)).withColumn("onset_doy", F.dayofyear("onset_date"))


def class_balance(df: DataFrame, label: str = "bloom_label") -> DataFrame:
    """Rows, positives and their share."""
    return df.agg(
        F.count(F.lit(1)).alias("samples"),
        F.sum(F.col(label).cast("long")).alias("positives"),
        F.avg(label).alias("positive_share"),
    )


def target_range(df: DataFrame, target: str = "onset_doy") -> DataFrame:
    """Rows, lowest and highest target."""
    return df.agg(
        F.count(F.lit(1)).alias("samples"),
        F.min(target).alias("lowest"),
        F.max(target).alias("highest"),
    )
