"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries of the digests, one per partition, are merged to at most ``counters``
candidates.  An exact recount verifies them; the verified winners are broadcast and their
copies leave on the map side.  All other digests own at most a ``1 / counters`` share of the
rows, so they take an ordinary shuffle.
"""

from __future__ import annotations

import string
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

COUNTERS = 1024


def text_digest(text: Column) -> Column:
    """Hex SHA-256 of the text in UTF-8, A-Z lower-cased and nothing else changed."""
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.sha2(F.coalesce(lowered, F.lit("")).cast("binary"), 256)


def misra_gries(counts: Counter, digests: list, counters: int) -> None:
    """Add a batch to a summary of at most ``counters`` entries, whose counts fall short of
    the true ones by at most ``seen / (counters + 1)``."""
    counts.update(digests)
    if len(counts) > counters:
        less = sorted(counts.values(), reverse=True)[counters]
        for key in [k for k, n in counts.items() if n <= less]:
            del counts[key]
        for key in counts:
            counts[key] -= less


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests, among them every one that owns more than a
    ``1 / (counters + 1)`` share of the rows: the merged summaries of all partitions."""

    def run(batches):
        import pyarrow as pa

        counts: Counter = Counter()
        for batch in batches:
            misra_gries(counts, batch.column(0).to_pylist(), counters)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(counts.values(), pa.int64())],
                names=["digest", "n"],
            )

    parts = digests.select("digest").mapInArrow(run, "digest string, n long")
    merged = parts.groupBy("digest").agg(F.sum("n").alias("n"))
    # merging takes the count of the first entry beyond the limit from every other
    top = merged.orderBy(F.desc("n"), "digest").limit(counters + 1)
    rows = top.collect()  # bounded by the number of counters
    less = rows[counters]["n"] if len(rows) > counters else 0
    kept = [(r["digest"],) for r in rows[:counters] if r["n"] > less]
    return digests.sparkSession.createDataFrame(kept, "digest string")


def duplicate_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS,
) -> DataFrame:
    """One row per row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text is the empty one.  The
    largest id of a group stays, a null id only where the group has no other.  Rows that
    repeat an id and text belong to one document and carry the same ``kept``.  An empty
    table gives an empty one.
    """
    rows = stored(
        df.select(
            F.col(id_col).cast("long").alias("doc_id"),
            text_digest(F.col(text_col).cast("string")).alias("digest"),
        ), "digests",
    )
    heavy = _heavy(rows, counters)
    tagged = rows.join(F.broadcast(heavy), "digest", "left")
    frequent = tagged.where(F.col("group_size").isNotNull())
    group = Window.partitionBy("digest")
    rest = tagged.where(F.col("group_size").isNull()).select(
        "digest", "doc_id",
        F.max("doc_id").over(group).alias("keep_id"),
        F.count(F.lit(1)).over(group).alias("group_size"),
    )
    return frequent.select(*rest.columns).unionByName(rest).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _heavy(rows: DataFrame, counters: int) -> DataFrame:
    """The verified groups of the frequent digests; at most ``counters`` rows."""
    found = frequent_digests(rows, counters)
    counted = rows.join(F.broadcast(found), "digest").groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    return stored(counted.where(F.col("group_size") > 1), "heavy")


def drop_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS,
) -> DataFrame:
    """The rows of ``df`` that stay, one per text, with their columns as they are.

    Copies of frequent texts go on the map side; what is left of them and all other rows
    meet by digest.  Of rows that repeat an id and text, one stays.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    body = df.select(F.struct(*columns).alias("row")).select(
        "row", F.col(f"row.`{id_col}`").cast("long").alias("doc_id"),
        text_digest(F.col(f"row.`{text_col}`").cast("string")).alias("digest"),
    )
    heavy = _heavy(stored(body.select("doc_id", "digest"), "digests"), counters)
    left = body.join(F.broadcast(heavy), "digest", "left").where(
        F.col("keep_id").isNull() | (F.col("doc_id") == F.col("keep_id"))
    )
    order = Window.partitionBy("digest").orderBy(F.desc_nulls_last("doc_id"))
    return left.withColumn("place", F.row_number().over(order)).where("place = 1").select(
        *[F.col(f"row.`{c}`").alias(c) for c in df.columns]
    )


