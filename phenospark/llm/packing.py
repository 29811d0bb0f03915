"""Concatenate and cut: all documents in one stream of ids, cut into fixed windows.

Two passes of prefix sums: documents inside the task that encoded them, then the totals of
the tasks.  A document's place in the stream is the sum of both, so nothing is shuffled and
no sequence is ever gathered.  Where a window ends inside a document a boundary record starts the
document's next piece.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import END_ID, encode_documents

WINDOW = 4096


def stream_places(encoded: DataFrame) -> DataFrame:
    """Add ``global_start``: the ids of all documents before each one in the stream.

    The totals, one number per task that encoded, pass through the driver.
    """
    totals = encoded.groupBy("part").agg(
        F.max(F.col("start") + F.col("n_tokens")).alias("total")
    ).orderBy("part").collect()
    before = accumulate((r["total"] for r in totals), initial=0)
    offsets = encoded.sparkSession.createDataFrame(
        [(r["part"], b) for r, b in zip(totals, before, strict=False)],
        "part int, part_start long",
    )
    return encoded.join(F.broadcast(offsets), "part").select(
        "doc_id", "n_tokens", "ids", (F.col("part_start") + F.col("start")).alias("global_start")
    )


def cut_windows(placed: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    ``start`` counts the document's ids before the piece, ``offset`` its place in the
    sequence.  Only the last sequence of all is short.
    """
    begin, size = F.col("global_start"), F.col("n_tokens")
    first = F.floor(begin / window)
    last = F.floor((begin + size - 1) / window)
    pieces = placed.where(size > 0).select(
        "doc_id", "ids", begin, size.alias("doc_tokens"),
        F.explode(F.sequence(first, last)).alias("sequence_id"),
    )
    low = F.greatest(begin, F.col("sequence_id") * window)
    high = F.least(begin + F.col("doc_tokens"), (F.col("sequence_id") + 1) * window)
    cut = pieces.select(
        "doc_id", (low - begin).alias("start"), (high - low).alias("length"), "doc_tokens",
        "sequence_id", (low - F.col("sequence_id") * window).alias("offset"), "ids",
    )
    piece = F.substring(
        F.col("ids"), (F.col("start") * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")
    )
    return cut.withColumn("ids", piece).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset", "ids",
    )


def pack(
    df: DataFrame, tokenizer: str, window: int = WINDOW, id_col: str = "doc_id",
    text_col: str = "text", end_id: int = END_ID,
) -> DataFrame:
    """Pack documents into sequences of ``window`` ids; one row per piece, with its ids.

    A null text is the empty one, whose only id is the end id.  Rows that repeat an id are
    documents of their own.  An empty table gives no pieces.
    """
    encoded = encode_documents(df, tokenizer, id_col, text_col, end_id)
    return cut_windows(stream_places(encoded), window)
