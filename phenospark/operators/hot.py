"""Finding keys that own too many rows for one task, before a plan is chosen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import stored

HOT_SHARE = 1e-5
HOT_ROWS = 1_000_000
PARTS = "hot_parts"


def hot_groups(
    df: DataFrame, key: Sequence[str], min_rows: int = HOT_ROWS, share: float = HOT_SHARE,
) -> DataFrame | None:
    """Keys with more than ``min_rows`` rows and ``share`` of the table, and into how many
    parts to cut each; None when there are none.

    One pass over the key columns, counted map-side.  At most ``1 / share`` keys can
    qualify, which bounds the stored list and makes it safe to broadcast.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("key_rows"))
    total, top = counts.agg(F.sum("key_rows"), F.max("key_rows")).first()
    limit = max(min_rows, (total or 0) * share)
    if top is None or top <= limit:
        return None
    parts = F.ceil(F.col("key_rows") / limit).alias(PARTS)
    hot = counts.where(F.col("key_rows") > limit).select(*key, parts)
    return stored(hot, "hot")
