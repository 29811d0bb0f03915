"""Area and date filters, regular grids and nearest-pixel sampling of pixel tables.

A pixel table is the long form of a raster stack: one row per (product, date, pixel
centre) with one column per band.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import SCALE_FACTOR
from ..schema import DATE, PHENOLOGY_BANDS, RAW_VALUE

GRID_STEP = 0.1  # degrees
METRES_PER_DEGREE = 111_320.0


@dataclass(frozen=True)
class Bounds:
    """Corners of an area in degrees."""

    west: float
    south: float
    east: float
    north: float

    def size(self, step: float) -> tuple[int, int]:
        """Grid points per axis, both ends included when they fall on the grid."""
        def points(low, high):
            return int(math.floor((high - low) / step + 1e-9)) + 1

        return points(self.west, self.east), points(self.south, self.north)


def area_bounds(area: str | dict) -> Bounds:
    """Bounds of ``"x1,y1,x2,y2"``, a GeoJSON file or a GeoJSON object.

    Of a feature collection, the outer ring of the first feature counts.
    """
    if isinstance(area, str) and not area.endswith((".json", ".geojson")):
        corners = [float(part) for part in area.split(",")]
        if len(corners) != 4:
            raise ValueError("a bounding box needs four numbers: x1,y1,x2,y2")
        x1, y1, x2, y2 = corners
        ring = [(x1, y1), (x2, y2)]
    else:
        if isinstance(area, str):
            with open(area) as handle:
                area = json.load(handle)
        if area["type"] == "FeatureCollection":
            area = area["features"][0]
        ring = area.get("geometry", area)["coordinates"][0]
    lons, lats = [p[0] for p in ring], [p[1] for p in ring]
    return Bounds(min(lons), min(lats), max(lons), max(lats))


def table_bounds(df: DataFrame) -> Bounds:
    """Bounds of a table's coordinates: one aggregate, one row to the driver."""
    row = df.agg(
        F.min("longitude"), F.min("latitude"), F.max("longitude"), F.max("latitude")
    ).first()
    return Bounds(*row)


def within_bounds(df: DataFrame, bounds: Bounds) -> DataFrame:
    return df.where(
        F.col("latitude").between(bounds.south, bounds.north)
        & F.col("longitude").between(bounds.west, bounds.east)
    )


def within_dates(df: DataFrame, start: str, end: str, date: str = DATE) -> DataFrame:
    """``start`` is included, ``end`` is not."""
    first, stop = F.lit(start).cast("date"), F.lit(end).cast("date")
    return df.where((F.col(date) >= first) & (F.col(date) < stop))


def select_band(
    pixels: DataFrame, product: str, band: str = "NDVI", value: str = RAW_VALUE
) -> DataFrame:
    """One band of one product, scaled."""
    return pixels.where(F.col("product") == product).select(
        "latitude", "longitude", DATE, (F.col(band) * SCALE_FACTOR).alias(value)
    )


def first_image(pixels: DataFrame) -> DataFrame:
    """Only the rows of the earliest date."""
    return pixels.where(F.col(DATE) == pixels.agg(F.min(DATE)).scalar())


def _point(i: Column, origin: float, step: float) -> Column:
    return i * step + origin


def grid_points(spark: SparkSession, bounds: Bounds, step: float = GRID_STEP) -> DataFrame:
    """Regular points over the bounds, placed by integer index so no error adds up."""
    nx, ny = bounds.size(step)
    cell = spark.range(nx * ny).select(
        (F.col("id") % nx).alias("grid_x"), F.floor(F.col("id") / nx).alias("grid_y")
    )
    return cell.select(
        "grid_x", "grid_y",
        _point(F.col("grid_y"), bounds.south, step).alias("latitude"),
        _point(F.col("grid_x"), bounds.west, step).alias("longitude"),
    )


def _reached(centre: Column, origin: float, step: float, reach: float, count: int) -> tuple:
    """Lowest and highest grid index within ``reach`` of a pixel centre."""
    low = F.ceil((centre - reach - origin) / step)
    high = F.floor((centre + reach - origin) / step)
    return F.greatest(low, F.lit(0)), F.least(high, F.lit(count - 1))


def sample_nearest(
    pixels: DataFrame,
    bounds: Bounds,
    values: Sequence[str] = (RAW_VALUE,),
    step: float = GRID_STEP,
    scale: float = 1000.0,
) -> DataFrame:
    """Per grid point and date, the values of the nearest pixel within one pixel size.

    Each pixel works out by arithmetic which grid points it may serve, so there is no
    join: pixels near no point go at the scan, the others reduce map-side to the best
    pixel per point and date, however many share one place.
    """
    reach = scale / METRES_PER_DEGREE
    nx, ny = bounds.size(step)
    x_low, x_high = _reached(F.col("longitude"), bounds.west, step, reach, nx)
    y_low, y_high = _reached(F.col("latitude"), bounds.south, step, reach, ny)
    near = pixels.where((x_low <= x_high) & (y_low <= y_high))
    offered = near.withColumn("grid_x", F.explode(F.sequence(x_low, x_high))).withColumn(
        "grid_y", F.explode(F.sequence(y_low, y_high))
    )
    lat = _point(F.col("grid_y"), bounds.south, step)
    lon = _point(F.col("grid_x"), bounds.west, step)
    dy = F.col("latitude") - lat
    dx = (F.col("longitude") - lon) * F.cos(F.radians(lat))
    best = F.min(F.struct(
        (dx * dx + dy * dy).alias("distance"), "latitude", "longitude", *values
    ))
    return offered.groupBy("grid_x", "grid_y", DATE).agg(best.alias("best")).select(
        lat.alias("latitude"), lon.alias("longitude"), DATE,
        *[F.col(f"best.{v}").alias(v) for v in values],
    )


def sample_phenology(
    pixels: DataFrame,
    bounds: Bounds,
    step: float = GRID_STEP,
    scale: float = 500.0,
    all_years: bool = False,
) -> DataFrame:
    """All phenology bands at the grid points, of the first image or of every year."""
    image = pixels if all_years else first_image(pixels)
    return sample_nearest(image, bounds, PHENOLOGY_BANDS, step, scale)
