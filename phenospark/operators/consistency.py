"""Temporal consistency filter: drop values that jump away from both neighbours."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DATE, LOCATION, RAW_VALUE
from .joins import null_safe_join
from .slices import SLICE, SLICE_KEY, needs_slices, with_slices

MIN_ROWS = 3


def _judge(value: str, neighbour, half: int, threshold: float, rows: Column) -> Column:
    """The value, or NULL where it breaks the rule; looks only at original values."""
    here = F.col(value)
    around = [here if o == 0 else neighbour(o) for o in range(-half, half + 1)]
    total = reduce(add, [F.coalesce(x, F.lit(0.0)) for x in around])
    valid = reduce(add, [x.isNotNull().cast("int") for x in around])
    jump = F.abs(here - neighbour(-1)) > threshold
    far = F.abs(here - F.try_divide(total, valid)) > threshold
    broken = F.coalesce(jump & far & (valid > 1) & (rows >= MIN_ROWS), F.lit(False))
    return F.when(~broken, here)


def consistency_filter(
    df: DataFrame,
    value: str = RAW_VALUE,
    window: int = 3,
    threshold: float = 0.3,
    tie_break: Sequence[str] = (),
    drop: bool = True,
    one_row_per_date: bool = False,
    **hot,
) -> DataFrame:
    """Null (and by default drop) values more than ``threshold`` away from the previous
    value and from the mean of the surrounding ``window`` rows.

    ``tie_break`` orders rows of one date.  Where a location has too many rows for one
    task, its rows are worked on slice by slice, each slice seeing the ``window // 2``
    rows next to it, with the same result; otherwise one plain window per location does.
    Finding that out takes a narrow pass, unless ``one_row_per_date`` says that the calendar already
    bounds a location (a resampled series).
    """
    half = window // 2
    if half == 0:
        return df.dropna(subset=[value]) if drop else df
    order = [DATE, *tie_break, value]
    if one_row_per_date or not needs_slices(df, **hot):
        w = Window.partitionBy(LOCATION).orderBy(*order)
        rows = F.count(F.lit(1)).over(Window.partitionBy(LOCATION))
        out = df.withColumn(value, _judge(
            value, lambda o: F.lag(value, -o).over(w), half, threshold, rows
        ))
    else:
        out = _filter_sliced(df, value, half, threshold, order, hot)
    return out.dropna(subset=[value]) if drop else out


def _filter_sliced(
    df: DataFrame, value: str, half: int, threshold: float, order: list[str], hot: dict
) -> DataFrame:
    inside = Window.partitionBy(*SLICE_KEY)
    w = inside.orderBy(*order)
    rows = with_slices(df, order[1:], **hot).withColumns({
        "_pos": F.row_number().over(w),
        "_rows": F.count(F.lit(1)).over(inside),
    })
    left = F.col("_rows") - F.col("_pos")  # rows that follow in the slice
    entry = F.struct("_pos", F.col(value).alias("v"))
    edges = (
        rows.where((F.col("_pos") <= half) | (left < half))
        .groupBy(*SLICE_KEY)
        .agg(
            F.max("_rows").alias("_slice_rows"),
            F.sort_array(F.collect_list(F.when(F.col("_pos") <= half, entry))).alias("_head"),
            F.sort_array(F.collect_list(F.when(left < half, entry))).alias("_tail"),
        )
    )
    along = Window.partitionBy(LOCATION).orderBy(*SLICE)
    # every slice has a row, so the nearest `half` rows lie in the nearest `half` slices
    before = F.reverse(F.flatten(F.collect_list("_tail").over(along.rowsBetween(-half, -1))))
    after = F.flatten(F.collect_list("_head").over(along.rowsBetween(1, half)))
    halo = edges.select(
        *SLICE_KEY,
        F.sum("_slice_rows").over(Window.partitionBy(LOCATION)).alias("_location_rows"),
        before.alias("_before"),
        after.alias("_after"),
    )

    def neighbour(offset: int) -> Column:
        n = abs(offset)
        if offset < 0:
            beyond = F.get(F.col("_before"), n - F.col("_pos"))["v"]
            return F.when(F.col("_pos") > n, F.col(f"_lag{n}")).otherwise(beyond)
        beyond = F.get(F.col("_after"), (n - left - 1).cast("int"))["v"]
        return F.when(left >= n, F.col(f"_lead{n}")).otherwise(beyond)

    shifted = rows.withColumns({
        **{f"_lag{n}": F.lag(value, n).over(w) for n in range(1, half + 1)},
        **{f"_lead{n}": F.lead(value, n).over(w) for n in range(1, half + 1)},
    })
    judged = null_safe_join(shifted, halo, SLICE_KEY).withColumn(
        value, _judge(value, neighbour, half, threshold, F.col("_location_rows"))
    )
    return judged.select(*df.columns)
