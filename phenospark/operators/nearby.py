"""Nearest-pixel sampling by distance on the sphere, over poles and the date line too.

``grid.sample_nearest`` takes a pixel within a box of degrees; here a pixel counts when its
great-circle distance, to the millimetre, is at most the reach in metres.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DATE, PHENOLOGY_BANDS, RAW_VALUE
from .grid import GRID_STEP, Bounds, first_image

EARTH_RADIUS = 6_371_008.8  # metres, the mean radius
MARGIN = 1e-7  # degrees by which cells are searched wider than the reach; the distance decides


def unwrapped(bounds: Bounds) -> Bounds:
    """``bounds`` with its east edge past 180 where the area crosses the date line."""
    if bounds.east >= bounds.west:
        return bounds
    return Bounds(bounds.west, bounds.south, bounds.east + 360.0, bounds.north)


def wrapped(longitude: Column) -> Column:
    """Longitudes past 180 as those west of the date line."""
    return F.when(longitude > 180.0, longitude - 360.0).otherwise(longitude)


def distance_metres(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance to the millimetre, by the haversine formula."""
    across = F.sin(F.radians(lon2 - lon1) / 2)
    along = F.sin(F.radians(lat2 - lat1) / 2)
    half = along * along + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * across * across
    arc = 2 * EARTH_RADIUS * F.asin(F.sqrt(F.least(half, F.lit(1.0))))
    return F.round(arc, 3)


def longitude_reach(lat1: Column, lat2: Column, reach: float) -> Column:
    """Degrees of longitude within ``reach`` metres between two latitudes; NULL for none.

    From the same formula, solved for the difference of longitudes; 180 where a whole
    circle of latitude is in reach, as around a pole.
    """
    # the haversine of half a circumference is 1: all that exists is within such a reach
    half = F.sin(F.lit(min(reach / EARTH_RADIUS / 2, 1.5707963267948966)))
    along = F.sin(F.radians(lat2 - lat1) / 2)
    left = half * half - along * along
    circle = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    part = F.try_divide(left, circle)
    return (
        F.when(left < 0, F.lit(None).cast("double"))
        .when(part < 1, F.degrees(2 * F.asin(F.sqrt(part))))
        .otherwise(180.0)
    )


def sample_within(
    pixels: DataFrame,
    bounds: Bounds,
    values: Sequence[str] = (RAW_VALUE,),
    step: float = GRID_STEP,
    reach: float = 1000.0,
) -> DataFrame:
    """Per grid point and date, the values of the nearest pixel at most ``reach`` metres away.

    A pixel works out the grid rows that its latitude reaches, on each of them the longitudes
    in reach, which widen towards the poles, and from these the points, turned by a whole
    circle both ways, so an area may cross the date line (``bounds.west`` above
    ``bounds.east``).  There is no join; pixels that reach no row go at the scan, and the
    offers reduce map-side to the best per point and date.  Of pixels at one distance, the
    one with the lowest latitude, longitude and values serves.  Pixels without a place, or
    off the globe, serve nothing.
    """
    area = unwrapped(bounds)
    nx, ny = area.size(step)
    span = F.degrees(F.lit(reach / EARTH_RADIUS)) + MARGIN
    latitude, longitude = F.col("latitude"), F.col("longitude")
    y_low = F.greatest(F.ceil((latitude - span - area.south) / step), F.lit(0))
    y_high = F.least(F.floor((latitude + span - area.south) / step), F.lit(ny - 1))
    near = pixels.where(
        latitude.between(-90, 90) & longitude.between(-180, 180) & (y_low <= y_high)
    ).withColumn("grid_y", F.explode(F.sequence(y_low, y_high)))

    point_lat = F.col("grid_y") * step + area.south
    # the reach is widened as well, or rounding could lose the farthest row
    width = longitude_reach(latitude, point_lat, reach + MARGIN * 111_000) + MARGIN

    def columns(turn: float) -> Column:
        low = F.greatest(F.ceil((longitude + turn - width - area.west) / step), F.lit(0))
        high = F.least(F.floor((longitude + turn + width - area.west) / step), F.lit(nx - 1))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))

    served = F.array_distinct(F.concat(*[columns(turn) for turn in (-360.0, 0.0, 360.0)]))
    point_lon = F.col("grid_x") * step + area.west
    offered = near.where(width.isNotNull()).withColumn("grid_x", F.explode(served)).withColumn(
        "_metres", distance_metres(point_lat, point_lon, latitude, longitude)
    ).where(F.col("_metres") <= reach)
    best = F.min(F.struct("_metres", "latitude", "longitude", *values)).alias("best")
    return offered.groupBy("grid_x", "grid_y", DATE).agg(best).select(
        point_lat.alias("latitude"), wrapped(point_lon).alias("longitude"), DATE,
        F.col("best._metres").alias("metres"), *[F.col(f"best.{v}").alias(v) for v in values],
    )


def sample_phenology_within(
    pixels: DataFrame, bounds: Bounds, step: float = GRID_STEP, reach: float = 500.0,
    all_years: bool = False,
) -> DataFrame:
    """All phenology bands at the grid points, by distance, of the first image or every year."""
    image = pixels if all_years else first_image(pixels)
    return sample_within(image, bounds, PHENOLOGY_BANDS, step, reach)
