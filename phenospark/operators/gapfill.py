"""Gap filling within a location's series.

The series must hold one row per location and date (a resampled series does), which
bounds the rows of a location by the calendar.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..schema import DATE, LOCATION, RAW_VALUE

_HELPERS = (
    "_x", "_seen", "_prev", "_next", "_valid", "_first", "_second", "_last", "_before_last",
)


def _place() -> WindowSpec:
    return Window.partitionBy(LOCATION)


def _position(axis: str) -> Column:
    if axis == "position":
        return F.row_number().over(_place().orderBy(DATE)).cast("double")
    if axis == "time":
        return F.unix_date(DATE).cast("double")
    raise ValueError(f"unknown axis: {axis}")


def _with_neighbours(df: DataFrame, value: str, axis: str) -> DataFrame:
    """Nearest valid points on both sides and the two outermost at either end."""
    place = _place()
    ahead, back = place.orderBy(DATE), place.orderBy(F.col(DATE).desc())
    before = Window.unboundedPreceding, -1
    ok = F.col(value).isNotNull()
    point = F.when(ok, F.struct(F.col("_x").alias("x"), F.col(value).alias("v")))
    # "next" runs backwards too: a frame open towards the end is quadratic in Spark
    out = df.withColumn("_x", _position(axis)).withColumns({
        "_seen": F.count(value).over(ahead.rowsBetween(Window.unboundedPreceding, 0)),
        "_prev": F.last(point, ignorenulls=True).over(ahead.rowsBetween(*before)),
        "_valid": F.count(value).over(place),
    })
    rank = F.when(ok, F.col("_seen"))
    out = out.withColumns({
        "_first": F.max(F.when(rank == 1, point)).over(place),
        "_second": F.max(F.when(rank == 2, point)).over(place),
        "_last": F.max(F.when(rank == F.col("_valid"), point)).over(place),
        "_before_last": F.max(F.when(rank == F.col("_valid") - 1, point)).over(place),
    })
    return out.withColumn(
        "_next", F.last(point, ignorenulls=True).over(back.rowsBetween(*before))
    )


def _line(a: Column, b: Column) -> Column:
    slope = F.try_divide(b["v"] - a["v"], b["x"] - a["x"])
    return a["v"] + slope * (F.col("_x") - a["x"])


def interpolate(
    df: DataFrame, method: str = "linear", value: str = RAW_VALUE, axis: str = "position"
) -> DataFrame:
    """Fill missing values; locations with fewer than two valid values stay as they are.

    ``linear`` extends the outermost segments beyond both ends, ``nearest`` takes the
    earlier point on ties, ``cubic`` is a not-a-knot spline and needs four points.
    """
    if method == "cubic":
        return _interpolate_cubic(df, value, axis)
    if method not in ("linear", "nearest"):
        raise ValueError(f"unknown method: {method}")
    near = _with_neighbours(df, value, axis)
    x, prev, nxt = F.col("_x"), F.col("_prev"), F.col("_next")
    if method == "linear":
        filled = (
            F.when(prev.isNull(), _line(F.col("_first"), F.col("_second")))
            .when(nxt.isNull(), _line(F.col("_before_last"), F.col("_last")))
            .otherwise(_line(prev, nxt))
        )
    else:
        filled = (
            F.when(prev.isNull(), nxt["v"])
            .when(nxt.isNull(), prev["v"])
            .when(x - prev["x"] <= nxt["x"] - x, prev["v"])
            .otherwise(nxt["v"])
        )
    here = F.col(value)
    usable = here.isNull() & (F.col("_valid") >= 2)
    return near.withColumn(value, F.when(usable, filled).otherwise(here)).drop(*_HELPERS)


def spline_values(x: np.ndarray, y: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Not-a-knot cubic spline through (x, y), evaluated at ``at``, ends extended."""
    n, h = len(x), np.diff(x)
    rise = np.diff(y) / h
    # unknowns: second derivatives m[1..n-2]; the not-a-knot ends give m[0] and m[n-1]
    diag = 2.0 * (h[:-1] + h[1:])
    low, up = h[1:-1].copy(), h[1:-1].copy()
    rhs = 6.0 * np.diff(rise)
    if n > 3:
        diag[0] += h[0] + h[0] ** 2 / h[1]
        diag[-1] += h[-1] + h[-1] ** 2 / h[-2]
        up[0] -= h[0] ** 2 / h[1]
        low[-1] -= h[-1] ** 2 / h[-2]
    for i in range(1, n - 2):
        factor = low[i - 1] / diag[i - 1]
        diag[i] -= factor * up[i - 1]
        rhs[i] -= factor * rhs[i - 1]
    m = np.empty(n)
    for i in range(n - 3, -1, -1):
        tail = up[i] * m[i + 2] if i < n - 3 else 0.0
        m[i + 1] = (rhs[i] - tail) / diag[i]
    m[0] = m[1] - (m[2] - m[1]) * h[0] / h[1]
    m[-1] = m[-2] + (m[-2] - m[-3]) * h[-1] / h[-2]
    k = np.clip(np.searchsorted(x, at, side="right") - 1, 0, n - 2)
    t = at - x[k]
    slope = rise[k] - h[k] * (2.0 * m[k] + m[k + 1]) / 6.0
    return y[k] + t * (slope + t * (m[k] / 2.0 + t * (m[k + 1] - m[k]) / (6.0 * h[k])))


def _spline_filled(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    ok = ~np.isnan(y)
    if ok.sum() < 4 or ok.all():
        return y
    filled = y.copy()
    filled[~ok] = spline_values(x[ok], y[ok], x[~ok])
    return filled


def _interpolate_cubic(df: DataFrame, value: str, axis: str) -> DataFrame:
    """A spline needs the whole series at once: one array per location, which the
    calendar bounds, through one Arrow-batched function."""

    @F.pandas_udf("array<double>")
    def fill(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([
            _spline_filled(np.asarray(x, dtype="float64"), np.asarray(y, dtype="float64"))
            for x, y in zip(xs, ys)
        ])

    rest = [c for c in df.columns if c not in (LOCATION, value)]
    row = F.struct("_x", F.col(value).alias("_v"), *rest)
    packed = df.withColumn("_x", _position(axis)).groupBy(LOCATION).agg(
        F.sort_array(F.collect_list(row)).alias("_rows")
    )
    filled = packed.withColumn("_filled", fill(F.col("_rows._x"), F.col("_rows._v")))
    each = filled.select(
        LOCATION, F.explode(F.arrays_zip("_rows", "_filled")).alias("_each")
    )
    value_or_null = F.when(~F.isnan("_each._filled"), F.col("_each._filled"))
    return each.select(
        LOCATION, *[F.col(f"_each._rows.{c}").alias(c) for c in rest],
        value_or_null.alias(value),
    ).select(*df.columns)
