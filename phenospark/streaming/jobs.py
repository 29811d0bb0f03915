"""Continuous scoring, monthly means with late data, and trailing features."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clip_values, parse_dates, with_location_key
from ..operators.features import PERIODS, WINDOWS
from ..operators.score import rule_scores
from ..operators.train import BloomModel, predict
from ..schema import DATE, LOCATION, RAW_VALUE

MEMORY = 12  # months a trailing feature may look back
OPEN = 4  # newest months of a place that may still change


def score_stream(observations: DataFrame) -> DataFrame:
    """Rule scores of arriving observations: row-local, no state."""
    cleaned = clip_values(with_location_key(parse_dates(observations)))
    return rule_scores(cleaned.where(F.col(RAW_VALUE).isNotNull()))


def score_stream_with_model(
    features: DataFrame, model: BloomModel, keep: Sequence[str] = (LOCATION, DATE)
) -> DataFrame:
    """Model scores of arriving feature rows: row-local, no state."""
    return predict(model, features, keep)


MONTHS = T.StructType([
    T.StructField(LOCATION, T.StringType()),
    T.StructField("month", T.TimestampType()),
    T.StructField("month_mean", T.DoubleType()),
    T.StructField("month_rows", T.LongType()),
])


def monthly_stream(
    observations: DataFrame, lateness: str | None = "62 days", value: str = RAW_VALUE
) -> DataFrame:
    """Mean and row count per location and calendar month.

    The event time is the month, so state goes once the newest month seen is more than
    ``lateness`` past its start; rows of such a month come too late.  In update mode a
    month appears again with each change; in append mode once, when it closes.
    """
    month = F.date_trunc("month", F.col(DATE).cast("timestamp"))
    rows = observations.withColumn("month", month)
    if lateness:
        rows = rows.withWatermark("month", lateness)
    return rows.groupBy(LOCATION, "month").agg(
        F.avg(value).alias("month_mean"), F.count(F.lit(1)).alias("month_rows")
    )


TRAILING = T.StructType([
    T.StructField(LOCATION, T.StringType()),
    T.StructField(DATE, T.DateType()),
    T.StructField("value", T.DoubleType()),
    *[T.StructField(f"ndvi_lag_{k}", T.DoubleType()) for k in PERIODS],
    *[T.StructField(f"ndvi_diff_{k}", T.DoubleType()) for k in PERIODS],
    *[
        T.StructField(f"ndvi_{s}_{n}", T.DoubleType())
        for n in WINDOWS for s in ("mean", "std", "min", "max", "slope")
    ],
])
MONTH_UPDATES = T.StructType([*MONTHS.fields, T.StructField("batch", T.IntegerType())])
_RECENT = T.StructType([
    T.StructField(LOCATION, T.StringType()),
    T.StructField(DATE, T.DateType()),
    T.StructField("recent", T.ArrayType(T.DoubleType())),
])
_STATE = T.StructType([
    T.StructField("first_month", T.IntegerType()),
    T.StructField("months", T.ArrayType(T.DoubleType())),
])


def _advance(
    key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
) -> Iterator[pd.DataFrame]:
    """Each new or changed month and those after it, with the twelve months before; the state
    is the latest ``MEMORY + OPEN`` months."""
    rows = pd.concat(list(batches), ignore_index=True)
    if not len(rows):
        return
    if "batch" in rows:
        rows = rows.sort_values("batch", kind="stable")  # the newest word on a month counts
    stamp = pd.to_datetime(rows["month"])
    number = (stamp.dt.year * 12 + stamp.dt.month - 1).tolist()
    changed = dict(zip(number, rows["month_mean"].tolist(), strict=True))
    first, held = state.get if state.exists else (min(changed), [])
    last = first + len(held) - 1
    changed = {m: v for m, v in changed.items() if not len(held) or m > last - OPEN}
    if not changed:
        return
    begin, end = min(first, *changed), max(last, *changed)
    months: list[float | None] = [None] * (end - begin + 1)
    months[first - begin:first - begin + len(held)] = held
    for m, v in changed.items():
        months[m - begin] = None if v is None or np.isnan(v) else v
    fresh = range(min(last + 1, *changed) if len(held) else begin, end + 1)  # gaps too
    yield pd.DataFrame({
        LOCATION: key[0],
        DATE: [dt.date(m // 12, m % 12 + 1, 1) for m in fresh],
        "recent": [months[max(0, m - begin - MEMORY):m - begin + 1] for m in fresh],
    })
    kept = months[-(MEMORY + OPEN):]
    state.update((end - len(kept) + 1, kept))


def trailing_columns(recent: DataFrame) -> DataFrame:
    """Lag, difference and rolling features from the array of the last months."""

    def back(k: int) -> Column:
        return F.get("recent", F.size("recent") - 1 - k)

    def total(array: str, term) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda t, x: t + term(x))

    windows = {n: F.slice("recent", F.greatest(F.size("recent") - (n - 1), F.lit(1)), n) for n in WINDOWS}
    seen = recent.withColumns({
        f"seen_{n}": F.filter(
            F.transform(w, lambda v, i: F.struct(i.cast("double").alias("i"), v.alias("v"))),
            lambda x: x["v"].isNotNull(),
        ) for n, w in windows.items()
    })
    seen = seen.withColumns({
        f"{name}_{n}": F.try_divide(total(f"seen_{n}", lambda x, f=field: x[f]), F.size(f"seen_{n}"))
        for n in WINDOWS for name, field in (("place", "i"), ("mean", "v"))
    })

    def rolling(n: int) -> dict[str, Column]:
        array, place, mean = f"seen_{n}", F.col(f"place_{n}"), F.col(f"mean_{n}")
        several = F.size(array) > 1
        spread = total(array, lambda x: (x["v"] - mean) * (x["v"] - mean))
        along = total(array, lambda x: (x["i"] - place) * x["v"])
        width = total(array, lambda x: (x["i"] - place) * (x["i"] - place))
        return {
            "mean": mean, "std": F.when(several, F.sqrt(F.try_divide(spread, F.size(array) - 1))),
            "min": F.array_min(windows[n]), "max": F.array_max(windows[n]),
            "slope": F.when(several, F.try_divide(along, width)),
        }

    return seen.select(
        LOCATION, DATE, back(0).alias("value"),
        *[back(k).alias(f"ndvi_lag_{k}") for k in PERIODS],
        *[(back(0) - back(k)).alias(f"ndvi_diff_{k}") for k in PERIODS],
        *[c.alias(f"ndvi_{s}_{n}") for n in WINDOWS for s, c in rolling(n).items()],
    )


def trailing_stream(months: DataFrame, mode: str = "append") -> DataFrame:
    """Lag, difference and rolling features of each month of a place.

    The input streams a table of monthly means: the closed months that ``monthly_stream``
    appends, or with ``mode="update"`` all changes that ``write_updates`` keeps
    (``MONTH_UPDATES``), whose output repeats what a change touches and is read with
    ``latest_updates``.  A busy place costs no more than a quiet one.  The state per place is
    its last ``MEMORY + OPEN`` months; lateness up to 62 days leaves fewer than ``OPEN``
    months to change.  Empty months count as missing values, as in the batch resample.
    """
    return trailing_columns(months.groupBy(LOCATION).applyInPandasWithState(
        _advance, _RECENT, _STATE, mode, GroupStateTimeout.NoTimeout
    ))


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once, from what is available now."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def write_updates(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep every batch's changed rows under its batch number; a rerun batch replaces
    its own rows, so a restart loses and doubles nothing."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.outputMode("update").foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def latest_updates(updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """The newest row per key of a table written by ``write_updates``."""
    rest = [c for c in updates.columns if c not in (*key, "batch")]
    newest = F.max_by(F.struct(*rest), "batch").alias("newest")
    return updates.groupBy(*key).agg(newest).select(*key, "newest.*")
