"""Equi-join that holds up when one key owns a large share of the left side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hot import PARTS, hot_groups

HOT_SHARE = 1e-4
HOT_ROWS = 100_000


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread_by: Sequence[str],
    condition: Column | None = None,
    how: str = "left",
    min_rows: int = HOT_ROWS,
    share: float = HOT_SHARE,
) -> DataFrame:
    """Join on ``key`` (and ``condition`` between aliases ``l`` and ``r``), cutting the
    left rows of each hot key into parts.

    Right rows of a hot key are repeated once per part.  The parts come from a hash of
    ``spread_by``, which should tell left rows apart.  Without a hot key it is a plain
    join.
    """
    names = [f"l.{c}" for c in left.columns]
    names += [f"r.{c}" for c in right.columns if c not in left.columns]
    hot = hot_groups(left, [key], min_rows, share)
    on = F.col(f"l.{key}") == F.col(f"r.{key}")
    if hot is not None:
        parts = F.coalesce(PARTS, F.lit(1).cast("long"))
        left = left.join(F.broadcast(hot), key, "left").withColumn(
            "_part", F.pmod(F.xxhash64(*spread_by), parts)
        )
        right = right.join(F.broadcast(hot), key, "left").withColumn(
            "_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))
        )
        on = on & (F.col("l._part") == F.col("r._part"))
    if condition is not None:
        on = on & condition
    return left.alias("l").join(right.alias("r"), on, how).select(*names)


def null_safe_join(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inner join in which nulls of the key meet, with the key's columns once."""
    other = right.select(*[
        F.col(c).alias(f"_right_{c}") if c in key else F.col(c) for c in right.columns
    ])
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in key]
    return left.join(other, same).drop(*[f"_right_{c}" for c in key])
