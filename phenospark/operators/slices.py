"""Slices: bounded, date-contiguous pieces of a location's rows.

Raw observations have no bound on rows per location, so a window over one location
could put any share of the table into one task.  A slice is a (location, month) cell; a
cell that is itself too full is cut again by day and, within a day, into ranges of what
orders its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import DATE, LOCATION
from ..sources.shared import stored
from .hot import HOT_ROWS, HOT_SHARE, PARTS, hot_groups

SLICE = ("slice_month", "slice_day", "slice_part")
SLICE_KEY = (LOCATION, *SLICE)


def needs_slices(df: DataFrame, min_rows: int = HOT_ROWS, share: float = HOT_SHARE) -> bool:
    """Whether some location has too many rows for one task (one narrow pass)."""
    return hot_groups(df, [LOCATION], min_rows, share) is not None


def with_slices(
    df: DataFrame,
    order_by: str | Sequence[str],
    min_rows: int = HOT_ROWS,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Add the slice columns.

    ``order_by`` orders the rows of one date, by columns of any kind that can be sorted.  The
    rows of full cells are cut into ranges of (location, date, order) of about equal size,
    by Spark's range partitioning, and stored, so that the cuts stay what they are should a
    task run again; slices follow the order of the rows.  Exact ties are not parted: read
    files with a row number, and order by that, where copies may fill a cell.
    """
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    out = df.withColumn("slice_month", F.trunc(DATE, "month"))
    whole = {"slice_day": F.col("slice_month"), "slice_part": F.lit(0).cast("long")}
    full = hot_groups(out, [LOCATION, "slice_month"], min_rows, share)
    if full is None:
        return out.withColumns(whole)
    ranges = 2 * full.agg(F.sum(PARTS)).first()[0]  # sampled cuts: aim at half a slice
    key = (LOCATION, "slice_month")
    same = [F.col(c).eqNullSafe(F.col(f"hot_{c}")) for c in key]
    full = F.broadcast(full.select(*[F.col(c).alias(f"hot_{c}") for c in key]))
    by = [c for c in dict.fromkeys([LOCATION, DATE, *order])]
    crowded = out.join(full, same, "left_semi").repartitionByRange(ranges, *by).withColumns({
        "slice_day": F.col(DATE), "slice_part": F.spark_partition_id().cast("long"),
    })
    return out.join(full, same, "left_anti").withColumns(whole).unionByName(stored(crowded, "slices"))
