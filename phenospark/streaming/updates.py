"""Update tables: a log of changed rows, compacted by key into snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .jobs import latest_updates

BATCH = "batch"


def _log(path: str, generation: int) -> str:
    return f"{path}/log/generation={generation}"


def _snapshot(path: str, generation: int) -> str:
    return f"{path}/snapshot/generation={generation}"


def _rows(spark: SparkSession, place: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(place)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def last_snapshot(spark: SparkSession, path: str) -> int:
    """The newest generation with a whole snapshot, -1 before the first."""
    marks = _rows(spark, f"{path}/marks/*", T.StructType().add("generation", T.IntegerType()))
    newest = None if marks is None else marks.agg(F.max("generation")).first()[0]
    return -1 if newest is None else newest


def _since(spark: SparkSession, path: str, schema: T.StructType, snapshot: int) -> DataFrame:
    """The rows of a snapshot and of the generation after it, with their batch numbers."""
    held = T.StructType([f for f in schema if f.name != BATCH]).add(BATCH, T.LongType())
    rows = spark.createDataFrame([], held)
    for place in ([_snapshot(path, snapshot)] if snapshot >= 0 else []) + [_log(path, snapshot + 1)]:
        found = _rows(spark, place, held)
        rows = rows if found is None else rows.unionByName(found)
    return rows


def read_latest(
    spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str]
) -> DataFrame:
    """The newest row per key of a table that ``write_compacted`` keeps.

    Reads one snapshot and the fewer than ``every`` batches after it, however many the
    stream has written; older files are neither opened nor listed.
    """
    rows = _since(spark, path, schema, last_snapshot(spark, path))
    return latest_updates(rows, key).select(*schema.names)


def write_compacted(
    stream: DataFrame, path: str, checkpoint: str, key: Sequence[str], every: int = 8
) -> StreamingQuery:
    """Keep each batch's changed rows, and after every ``every``th a snapshot by key.

    Batch ``n`` belongs to generation ``n // every``.  A snapshot joins the one before with
    its generation's batches: one shuffle by key, reduced map-side, of the table's keys and
    the changes, never of the history.  It counts once its mark is written, so a reader
    meets no half of it.  All names follow from the batch number: a batch that runs again
    replaces its own files, and a marked snapshot stays as it is.  Nothing is deleted, so
    a reader that began before keeps its files; expire generations older than the last two
    marks by the storage's own rules.  ``every`` must stay the same for a table.
    """
    if BATCH in stream.columns:
        raise ValueError(f"{BATCH} is a column of the log")
    schema = stream.schema

    def store(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        generation, place = divmod(number, every)
        rows.write.mode("overwrite").parquet(f"{_log(path, generation)}/{BATCH}={number}")
        if place < every - 1 or last_snapshot(spark, path) >= generation:
            return
        held = _since(spark, path, schema, generation - 1)
        rest = [c for c in held.columns if c not in key]
        newest = held.groupBy(*key).agg(F.max_by(F.struct(*rest), BATCH).alias("newest"))
        newest.select(*key, "newest.*").write.mode("overwrite").parquet(_snapshot(path, generation))
        mark = spark.range(1).select(F.lit(generation).alias("generation"))
        mark.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/{generation}")

    return (
        stream.writeStream.outputMode("update").foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
