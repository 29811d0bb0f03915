"""Feature columns of a processed series.

Every window here is ``location by date``, so one shuffle and one sort serve them all.
The series must hold one row per location and date.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions import calendar, values
from ..schema import DATE, LOCATION, PROCESSED_REQUIRED, SERIES_COLUMNS, SMOOTH_VALUE
from ..schema import RAW_VALUE, require_columns

# Default window sizes and periods.
WINDOWS = (3, 6, 12)
PERIODS = (1, 2, 3, 6, 12)
STATS = ("mean", "std", "min", "max", "slope")
PEAK_LEVEL = 0.5

def _along() -> WindowSpec:
    return Window.partitionBy(LOCATION).orderBy(DATE)


def _trailing(n: int) -> WindowSpec:
    return _along().rowsBetween(-(n - 1), 0)


def _makers(position: str) -> dict:
    return {
        "mean": F.avg,
        "std": F.stddev_samp,
        "min": F.min,
        "max": F.max,
        "slope": lambda v: F.regr_slope(F.col(v), F.col(position)),
    }


def rolling_columns(
    value: str = SMOOTH_VALUE, windows: Sequence[int] = WINDOWS, stats: Sequence[str] = STATS,
    position: str = "_pos",
) -> dict[str, Column]:
    """Trailing statistics; ``slope`` regresses on ``position``, needs two valid values."""
    makers = _makers(position)
    frames = {n: _trailing(n) for n in windows}
    return {
        f"ndvi_{s}_{n}": makers[s](value).over(frame)
        for n, frame in frames.items() for s in stats
    }


def lag_columns(value: str = SMOOTH_VALUE, lags: Sequence[int] = PERIODS) -> dict[str, Column]:
    w = _along()
    return {f"ndvi_lag_{k}": F.lag(value, k).over(w) for k in lags}


def difference_columns(
    value: str = SMOOTH_VALUE, periods: Sequence[int] = PERIODS
) -> dict[str, Column]:
    w = _along()
    return {f"ndvi_diff_{k}": F.col(value) - F.lag(value, k).over(w) for k in periods}


def peak_centre(value: str = SMOOTH_VALUE) -> Column:
    """True where the value tops the five rows around it and the peak level."""
    five = _along().rowsBetween(-2, 2)
    top = (F.col(value) == F.max(value).over(five)) & (F.col(value) > PEAK_LEVEL)
    return F.coalesce(top, F.lit(False)) & (F.count(F.lit(1)).over(five) == 5)


def peak_columns(
    value: str = SMOOTH_VALUE, centre: str = "_centre", position: str = "_pos"
) -> dict[str, Column]:
    """``is_peak``: the row two back is a peak (needs 3 valid of the last 5 rows).

    ``days_since_peak`` counts rows, not days, since the last peak whose five rows lie
    in the trailing twelve (needs 6 valid of them).
    """
    flag = F.coalesce(F.lag(centre, 2).over(_along()), F.lit(False)).cast("int")
    enough = F.count(value).over(_trailing(5)) >= 3
    last = F.max(F.when(F.col(centre), F.col(position))).over(_along().rowsBetween(-9, -2))
    since = F.col(position) - last
    return {
        "is_peak": F.when(enough, flag),
        "days_since_peak": F.when(F.count(value).over(_trailing(12)) >= 6, since),
    }


def interaction_columns(columns: Sequence[str]) -> dict[str, Column]:
    """Products of a value with its context, each only where its inputs exist."""
    wanted = {
        "ndvi_month_interaction": (SMOOTH_VALUE, "month"),
        "ndvi_lat_interaction": (SMOOTH_VALUE, "latitude"),
        "mean_slope_interaction": ("ndvi_mean_3", "ndvi_slope_3"),
    }
    return {
        name: F.col(a) * F.col(b)
        for name, (a, b) in wanted.items()
        if a in columns and b in columns
    }


def feature_names(columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in SERIES_COLUMNS]


def add_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns(calendar.calendar_columns(F.col(DATE)))


def add_climate(df: DataFrame) -> DataFrame:
    return df.withColumns(values.climate_columns(F.col("latitude")))


def add_interactions(df: DataFrame) -> DataFrame:
    return df.withColumns(interaction_columns(df.columns))


def add_rolling(
    df: DataFrame, value: str = SMOOTH_VALUE, windows: Sequence[int] = WINDOWS,
    stats: Sequence[str] = STATS,
) -> DataFrame:
    out = df.withColumn("_pos", F.row_number().over(_along()))
    return out.withColumns(rolling_columns(value, windows, stats)).drop("_pos")


def add_lags(
    df: DataFrame, value: str = SMOOTH_VALUE, lags: Sequence[int] = PERIODS
) -> DataFrame:
    return df.withColumns(lag_columns(value, lags))


def add_differences(
    df: DataFrame, value: str = SMOOTH_VALUE, periods: Sequence[int] = PERIODS
) -> DataFrame:
    return df.withColumns(difference_columns(value, periods))


def add_peaks(df: DataFrame, value: str = SMOOTH_VALUE) -> DataFrame:
    out = df.withColumns({"_pos": F.row_number().over(_along()), "_centre": peak_centre(value)})
    return out.withColumns(peak_columns(value)).drop("_pos", "_centre")


def drop_sparse(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with fewer than half of their features missing."""
    names = list(names or feature_names(df.columns))
    missing = reduce(add, [F.col(c).isNull().cast("int") for c in names])
    return df.where(missing < 0.5 * len(names))


def all_features(
    df: DataFrame,
    windows: Sequence[int] = WINDOWS,
    lags: Sequence[int] = PERIODS,
    periods: Sequence[int] = PERIODS,
    value: str = SMOOTH_VALUE,
) -> DataFrame:
    """The full feature table: 47 columns at the defaults, sparse rows dropped."""
    require_columns(df, PROCESSED_REQUIRED)
    # the windows see the narrow series; row-local columns are added after the sort
    wide = df.withColumns({
        "_pos": F.row_number().over(_along()), "_centre": peak_centre(value),
    })
    by_row = {
        **rolling_columns(value, windows),
        **lag_columns(value, lags),
        **difference_columns(value, periods),
        **peak_columns(value),
    }
    wide = wide.withColumns(by_row).withColumns({
        **calendar.calendar_columns(F.col(DATE)),
        **values.climate_columns(F.col("latitude")),
    })
    dates, place = calendar.calendar_columns(F.col(DATE)), values.climate_columns(F.lit(0.0))
    ordered = wide.select(*df.columns, *dates, *by_row, *place)
    return drop_sparse(ordered.withColumns(interaction_columns(ordered.columns)))


def scoring_features(df: DataFrame, value: str = SMOOTH_VALUE) -> DataFrame:
    """The reduced set used at scoring time: calendar, rolling, lag 1, difference 1."""
    out = df.withColumns({
        **calendar.calendar_columns(F.col(DATE)), "_pos": F.row_number().over(_along()),
    })
    return out.withColumns({
        **rolling_columns(value), **lag_columns(value, (1,)), **difference_columns(value, (1,)),
    }).drop("_pos")


def add_trails(df: DataFrame, value: str = SMOOTH_VALUE) -> DataFrame:
    """What a row needs for the scoring features of any run of rows that ends with it.

    Beside the calendar columns ``trails`` holds the statistics of the last 1, 2, ... rows, up to the widest
    window; ``trail_dates`` the dates before the row's, the nearest first; ``trail_value`` the value before.
    """
    w, widest, makers = _along(), max(WINDOWS), _makers("_pos")
    return df.withColumn("_pos", F.row_number().over(w)).withColumns({
        **calendar.calendar_columns(F.col(DATE)),
        "trails": F.array(*[
            F.struct(*[makers[s](value).over(_trailing(n)).alias(s) for s in STATS])
            for n in range(1, widest + 1)
        ]),
        "trail_dates": F.array(*[F.lag(DATE, k).over(w) for k in range(1, widest)]),
        "trail_value": F.lag(value, 1).over(w),
    }).drop("_pos")


def trail_features(df: DataFrame, start: str, value: str = SMOOTH_VALUE) -> DataFrame:
    """``scoring_features`` of runs of rows that each begin at the date ``start``, without a
    window: from the columns of ``add_trails``, which go."""
    before = [F.get("trail_dates", F.lit(k)) >= F.col(start) for k in range(max(WINDOWS) - 1)]
    rows = df.withColumn("_rows", reduce(add, [F.coalesce(b.cast("int"), F.lit(0)) for b in before]) + 1)
    rows = rows.withColumns({
        **{f"_{n}": F.get("trails", F.least("_rows", F.lit(n)) - 1) for n in WINDOWS},
        "ndvi_lag_1": F.when(F.col("_rows") > 1, F.col("trail_value")),
    })
    dates = calendar.calendar_columns(F.col(DATE))
    own = [c for c in df.columns if c not in dates and not c.startswith("trail")]
    return rows.select(
        *own, *dates, *[F.col(f"_{n}.{s}").alias(f"ndvi_{s}_{n}") for n in WINDOWS for s in STATS],
        "ndvi_lag_1", (F.col(value) - F.col("ndvi_lag_1")).alias("ndvi_diff_1"),
    )


def raw_features(df: DataFrame) -> DataFrame:
    """The demo set on unsmoothed values: no ISO week, mean and std only, periods 1 to 3."""
    names = calendar.calendar_columns(F.col(DATE))
    names.pop("week_of_year")
    return df.withColumns({
        **names,
        **rolling_columns(RAW_VALUE, WINDOWS, ("mean", "std")),
        **lag_columns(RAW_VALUE, (1, 2, 3)),
        **difference_columns(RAW_VALUE, (1, 2, 3)),
        SMOOTH_VALUE: F.col(RAW_VALUE),
    })


def non_null_profile(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per feature: how many rows have it, out of how many; one pass."""
    names = list(names or feature_names(df.columns))
    counted = df.agg(
        F.count(F.lit(1)).alias("total_rows"), *[F.count(c).alias(c) for c in names]
    )
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).alias("non_null")) for c in names
    ]))
    return counted.select(pairs.alias("p"), "total_rows").select(
        "p.feature", "p.non_null", "total_rows"
    )
