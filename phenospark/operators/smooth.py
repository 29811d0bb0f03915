"""Savitzky-Golay smoothing as a fixed linear combination of neighbouring rows."""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DATE, LOCATION, RAW_VALUE, SMOOTH_VALUE


def projection(window: int, polyorder: int) -> np.ndarray:
    """Row p holds the weights that give the fitted polynomial's value at place p."""
    half = window // 2
    design = np.vander(np.arange(-half, half + 1, dtype=float), polyorder + 1)
    return design @ np.linalg.pinv(design)


def effective_window(window: int, polyorder: int) -> int:
    """Odd, and wider than the polynomial order."""
    if window % 2 == 0:
        window += 1
    return polyorder + 2 if window <= polyorder else window


def smooth(
    df: DataFrame,
    value: str = RAW_VALUE,
    window: int = 5,
    polyorder: int = 2,
    output: str = SMOOTH_VALUE,
) -> DataFrame:
    """Smooth the valid rows of each location as if adjacent; missing rows stay missing.

    The polynomial fitted to the outermost ``window`` rows serves the rows near either
    end.  Locations with fewer valid rows than ``window`` keep their values.  The series
    must hold one row per location and date.
    """
    span = effective_window(window, polyorder)
    if span % 2 == 0:
        raise ValueError("polyorder must be odd when it is not below the window")
    half, weights = span // 2, projection(span, polyorder)
    # a plain column, so both windows share one shuffle and one sort
    rows = df.withColumn("_ok", F.col(value).isNotNull())
    same = Window.partitionBy(LOCATION, "_ok")
    w = same.orderBy(DATE)
    reach = range(-(span - 1), span)
    rows = rows.withColumns({
        "_from_start": F.row_number().over(w) - 1,
        "_valid": F.count(F.lit(1)).over(same),
        **{
            f"_at{o}": F.col(value) if o == 0 else F.lag(value, -o).over(w)
            for o in reach
        },
    })
    from_end = F.col("_valid") - 1 - F.col("_from_start")

    def fitted(place: int) -> Column:
        return reduce(add, [
            F.col(f"_at{j - place}") * float(weights[place, j]) for j in range(span)
        ])

    smoothed = F.when(~F.col("_ok") | (F.col("_valid") < max(window, span)), F.col(value))
    for place in range(half):
        smoothed = smoothed.when(F.col("_from_start") == place, fitted(place))
    for place in range(half):
        smoothed = smoothed.when(from_end == place, fitted(span - 1 - place))
    return rows.select(*df.columns, smoothed.otherwise(fitted(half)).alias(output))


def apply_smoothing(
    df: DataFrame, window: int = 5, polyorder: int = 2, value: str = RAW_VALUE
) -> DataFrame:
    """Add ``ndvi_smoothed``, falling back to the raw value."""
    out = smooth(df, value, window, polyorder)
    return out.withColumn(SMOOTH_VALUE, F.coalesce(SMOOTH_VALUE, value))
