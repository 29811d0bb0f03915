"""The test tables in the shapes the operators take.

Every table here is a row-local view of a whole input table; ``oracles`` states the
same views in SQL.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import location_key
from ..operators.clean import mask_clouds
from ..operators.resample import resample
from ..plans.preprocess import preprocess
from ..schema import PHENOLOGY_BANDS

TIES = ("l_orderkey", "l_linenumber", "l_partkey")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _latitude(key: Column) -> Column:
    return (key * 37 % 181 - 90).cast("double")


def _longitude(key: Column) -> Column:
    return (key * 73 % 361 - 180).cast("double")


def raw_observations(lineitem: DataFrame) -> DataFrame:
    """Supplier as place, ship date as date, a value in [0, 1) without ties."""
    return lineitem.select(
        _latitude(F.col("l_suppkey")).alias("latitude"),
        _longitude(F.col("l_suppkey")).alias("longitude"),
        F.col("l_shipdate").cast("date").alias("date"),
        (F.col("l_discount") * 5 + F.col("l_extendedprice") / 249971).alias("ndvi_raw"),
        (F.col("l_linenumber") % 4).alias("quality"),
        *TIES,
    )


def keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("location_id", location_key(F.col("latitude"), F.col("longitude")))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed(raw_observations(read(spark, sf_dir, "lineitem")))


def unclean_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unscaled integers-like values beyond both ends of the range, some fields missing."""
    stored = F.when(F.col("l_partkey") % 11 != 0, F.col("l_discount") * 400000 - 15000)
    return read(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 7, _latitude(F.col("l_suppkey"))).alias("latitude"),
        _longitude(F.col("l_suppkey")).alias("longitude"),
        F.col("l_shipdate").cast("date").alias("date"),
        stored.alias("ndvi_raw"),
        *TIES,
    )


def extract_texts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The observations as the texts of extract files in two layouts, some of them spoilt."""
    raw = raw_observations(read(spark, sf_dir, "lineitem"))
    day = F.when(F.col("l_partkey") % 13 == 0, "no date").otherwise(F.date_format("date", "yyyy-MM-dd"))
    latitude = F.when(F.col("l_partkey") % 17 != 0, F.col("latitude") + F.when(
        F.col("l_partkey") % 19 == 0, 200).otherwise(0)).cast("string")
    units = F.floor(F.col("ndvi_raw") * 10000).cast("string")
    keys = [F.col(c).cast("string") for c in TIES]
    return {
        "service": raw.where("l_linenumber % 2 = 1").select(
            latitude.alias("Latitude"), F.col("longitude").cast("string").alias("Longitude"),
            day.alias("Date"), units.alias("NDVI"), *keys),
        "own": raw.where("l_linenumber % 2 = 0").select(
            *keys, day.alias("date"), units.alias("ndvi_raw"),
            F.when(F.col("l_partkey") % 23 == 0, "good").otherwise(
                F.col("quality").cast("string")).alias("quality"),
            latitude.alias("latitude"), F.col("longitude").cast("string").alias("longitude")),
    }


def event_observations(events: DataFrame) -> DataFrame:
    """User as place, event time as date; also a stream's input."""
    return keyed(events.select(
        _latitude(F.col("user_id")).alias("latitude"),
        _longitude(F.col("user_id")).alias("longitude"),
        F.col("ts").cast("date").alias("date"),
        (F.col("value") / 499).alias("ndvi_raw"),
        (F.col("event_id") % 4).alias("quality"),
        "event_id",
    ))


def monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(observations(spark, sf_dir))


def gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly means with the low ones masked, so every series has gaps."""
    return mask_clouds(monthly(spark, sf_dir), threshold=0.4)


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole preprocessing stage."""
    return preprocess(
        raw_observations(read(spark, sf_dir, "lineitem")), scale="never", tie_break=TIES
    )


def unsmoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly means standing in for smoothed ones."""
    return monthly(spark, sf_dir).withColumn("ndvi_smoothed", F.col("ndvi_raw"))


def stepped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lasting rise plus a little of the monthly means."""
    level = F.when(F.col("date") < F.lit("1998-05-01").cast("date"), 0.25).otherwise(0.6)
    return monthly(spark, sf_dir).withColumn(
        "ndvi_smoothed", level + (F.col("ndvi_raw") - 0.45) * 0.2
    )


def seasonal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A yearly cycle plus a little of the monthly means."""
    angle = F.month("date") * (2 * math.pi) / 12 - math.pi / 2
    return monthly(spark, sf_dir).withColumn(
        "ndvi_smoothed", F.sin(angle) * 0.2 + 0.5 + (F.col("ndvi_raw") - 0.45) * 0.1
    )


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part and supplier as pixel row and column, quarter as image, unscaled value."""
    product = F.when(F.col("l_linenumber") % 2 == 1, "MOD13A2").otherwise("VNP13A1")
    return read(spark, sf_dir, "lineitem").select(
        product.alias("product"),
        (F.col("l_partkey") % 1000 * 0.013 - 60.0).alias("latitude"),
        (F.col("l_suppkey") % 1000 * 0.017 + 100.0).alias("longitude"),
        F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("date"),
        (F.col("l_discount") * 50000 + F.col("l_extendedprice") * 0.04).alias("NDVI"),
    )


def polar_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scaled first product of ``pixels``, moved to the far north across the date line."""
    east = F.col("l_suppkey") * 37 % 1000 * 0.017 + 172.0
    return read(spark, sf_dir, "lineitem").where("l_linenumber % 2 = 1").select(
        (F.col("l_partkey") * 7 % 1000 * 0.013 + 76.5).alias("latitude"),
        F.when(east > 180.0, east - 360.0).otherwise(east).alias("longitude"),
        F.trunc(F.col("l_shipdate").cast("date"), "quarter").alias("date"),
        (F.col("l_discount") * 5 + F.col("l_extendedprice") * 0.000004).alias("ndvi_raw"),
    )


def phenology_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as pixels; days from 0 to 479, one cycle in five missing."""
    order, cust = F.col("o_orderkey"), F.col("o_custkey")

    def band(place: int) -> Column:
        cycle = place % 4 + 1
        days = (order * (place // 4 + 3) + cust * (cycle * 17)) % 480
        return F.when((order + cycle) % 5 != 0, days.cast("double"))

    return read(spark, sf_dir, "orders").select(
        (cust % 500 * 0.011 + 10.0).alias("latitude"),
        (order % 700 * 0.013 + 20.0).alias("longitude"),
        F.trunc(F.col("o_orderdate").cast("date"), "year").alias("date"),
        *[band(i).alias(name) for i, name in enumerate(PHENOLOGY_BANDS)],
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order asks for 180 days of some supplier; a few for places off the globe."""
    places = read(spark, sf_dir, "supplier").agg(F.max("s_suppkey") + 1).scalar()
    key = F.col("o_orderkey") % places
    start = F.col("o_orderdate").cast("date")
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.when(F.col("o_custkey") % 97 == 0, 95.0).otherwise(_latitude(key)).alias("latitude"),
        _longitude(key).alias("longitude"),
        start.alias("start_date"),
        F.date_add(start, 180).alias("end_date"),
    )
