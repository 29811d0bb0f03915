"""Summaries of a stage's table that are kept per year and merged, not counted anew.

Two tables, replaced year by year as ``publish`` does: ``places`` holds a row per year and
location, which keeps distinct counts exact over any years; ``years`` holds a row per year
with a sketch of its locations, which merges without looking at a location again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DATE, LOCATION, SMOOTH_VALUE
from .publish import YEAR, publish, read_published
from .shared import stored

SKETCH_BITS = 16  # 2^16 registers, 64 KB at most: a standard error of about 0.4 %


def place_years(df: DataFrame, value: str = SMOOTH_VALUE, date: str = DATE) -> DataFrame:
    """Counts, ends and sums per year and location, reduced map-side.

    The year is the table's own column where it has one.  NaN values count as missing.
    """
    year = F.col(YEAR) if YEAR in df.columns else F.year(date)
    known = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    return df.groupBy(year.cast("int").alias(YEAR), F.col(LOCATION)).agg(
        F.count(F.lit(1)).alias("records"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.min(known).alias("lowest"),
        F.max(known).alias("highest"),
        F.count(known).alias("n_values"),
        F.sum(known).alias("total"),
    )


def _merged() -> list[Column]:
    return [
        F.coalesce(F.sum("records"), F.lit(0).cast("long")).alias("records"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.coalesce(F.sum("n_values"), F.lit(0).cast("long")).alias("n_values"),
        F.sum("total").alias("total"),
    ]


def year_rows(places: DataFrame) -> DataFrame:
    """A row per year, with its exact number of locations and a sketch of them."""
    return places.groupBy(YEAR).agg(
        *_merged(),
        F.count(LOCATION).alias("locations"),
        F.hll_sketch_agg(LOCATION, SKETCH_BITS).alias("sketch"),
    )


def publish_summary(
    df: DataFrame, path: str, value: str = SMOOTH_VALUE, date: str = DATE,
    covers: tuple[int, int] | None = None,
) -> None:
    """Add the years of ``df`` to the summary, in place of what it held of them.

    ``covers`` empties years that ``df`` answers for without rows, as in ``publish``.
    """
    places = stored(place_years(df, value, date), "place-years")
    publish(places, f"{path}/places", covers)
    publish(year_rows(places), f"{path}/years", covers)


def _shown(df: DataFrame) -> DataFrame:
    mean = F.try_divide(F.col("total"), F.col("n_values")).alias("mean")
    error = F.try_divide(F.col("estimate") - F.col("locations"), F.col("locations"))
    return df.select(
        "part", YEAR, "records", "locations", "first_date", "last_date", "lowest", "highest", mean,
        F.col("estimate").alias("locations_estimate"),
        F.coalesce(error, F.col("estimate").cast("double")).alias("estimate_error"),
    )


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """A row per year (``part`` is ``year``) and one over all (``all``).

    ``locations`` is exact; ``locations_estimate`` comes from the merged sketches alone, and
    ``estimate_error`` is how far it is off, as a share of the exact count.
    """
    years = read_published(spark, f"{path}/years")
    exact = read_published(spark, f"{path}/places").agg(F.countDistinct(LOCATION)).scalar()
    empty = F.lit(0).cast("long")
    by_year = years.withColumn("part", F.lit("year")).withColumn(
        "estimate", F.hll_sketch_estimate("sketch"))
    whole = years.agg(
        *_merged(), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate")
    ).select(
        "*", F.lit("all").alias("part"), F.lit(None).cast("int").alias(YEAR), exact.alias("locations"),
    ).withColumn("estimate", F.coalesce("estimate", empty))
    return _shown(by_year).unionByName(_shown(whole))


def estimated_locations(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Locations of the years from ``first`` to ``last``, by their sketches alone: the cost
    is a row per year, whatever the table holds."""
    years = read_published(spark, f"{path}/years").where(F.col(YEAR).between(first, last))
    merged = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    return years.agg(F.coalesce(merged, F.lit(0).cast("long")).alias("locations_estimate"))
