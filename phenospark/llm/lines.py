"""Substring deduplication by hashing lines and sentences.

Units are the lines of a text and the sentences inside its lines.  A unit is normalised (lower case,
white space to one space) and hashed to 128 bits.  Digests are grouped over all documents;
the earliest ranked occurrence stays, all others go, with their offsets in the original.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, stored, texts

LEAST_WORDS = 6
_SENTENCE = re.compile(r"[^\s].*?(?:[.!?](?=\s)|$)", re.DOTALL)
_LINE = re.compile(r"[^\n]+")
UNITS = "doc_id long, text_key long, start int, end int, high long, low long"


def normalise(unit: str) -> str:
    return " ".join(unit.lower().split())


def spans(text: str) -> list[tuple[int, int]]:
    """Lines and, in lines of several sentences, the sentences: code points, end exclusive."""
    return [(a, b) for a, b, _ in marked_spans(text)]


def marked_spans(text: str) -> list[tuple[int, int, bool]]:
    """The spans, and whether each is a whole line."""
    found = []
    for line in _LINE.finditer(text):
        a, b = line.span()
        inside = [m.span() for m in _SENTENCE.finditer(text, a, b)]
        if inside:
            found.append((inside[0][0], inside[-1][1], True))
            if len(inside) > 1:
                found += [(*span, False) for span in inside]
    return found


def units(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
    least_line_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per unit: doc_id, hash of the text, start, end, digest halves.

    Whole lines count from ``least_line_words`` words on (1: every line that is not blank), sentences
    inside lines from ``least_words`` on.
    """

    def make():
        def work(columns):
            for doc_id, key, text in zip(*(columns[c].to_pylist() for c in ("doc_id", "text_key", "text")), strict=True):
                for a, b, line in marked_spans(text):
                    words = text[a:b].lower().split()
                    if len(words) >= (least_line_words if line else least_words):
                        digest = xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))
                        yield doc_id, key, a, b, int.from_bytes(digest[:8], signed=True), int.from_bytes(
                            digest[8:], signed=True
                        )

        return work

    keyed = texts(df, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    return map_rows(keyed, make, UNITS, 20_000)


def repeated_units(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
    least_line_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per unit to remove: doc_id, start, end, keep_doc_id, keep_start, copies, and ``text_key``,
    which tells different texts under one id apart.

    The earliest occurrence by (doc_id, start) stays; a null doc_id ranks first.  A null or empty text has
    no units, rows that repeat an id and text repeat its occurrence, of which all but the
    first go only where their rank differs.  Digests are reduced map-side; only those that
    occur twice are joined back, and a hot one is split by the join.
    """
    found = stored(units(df, id_col, text_col, least_words, least_line_words), "units")
    rank = F.struct("doc_id", "start")
    several = stored(
        found.groupBy("high", "low").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1"), "repeated",
    )
    return found.join(several, ["high", "low"]).where(~rank.eqNullSafe(F.col("first"))).select(
        "doc_id", "start", "end", F.col("first.doc_id").alias("keep_doc_id"),
        F.col("first.start").alias("keep_start"), "copies", "text_key",
    )


def remove_units(
    df: DataFrame, removed: DataFrame, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, clean text, and the spans of the original that are left.

    Spans may overlap (a line and its sentences); a document with none comes back as it is.  Of several
    texts under one id each loses its own units only.
    """
    cut = removed.groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("cut")
    )
    body = texts(df, id_col, text_col)
    same = F.col("doc_id").eqNullSafe(F.col("cut_id")) & (F.xxhash64("text") == F.col("text_key"))
    joined = body.join(cut.withColumnRenamed("doc_id", "cut_id"), same, "left")

    def run(batches):
        for batch in batches:
            rows = [keep(t, c) for t, c in zip(*(batch.column(x).to_pylist() for x in ("text", "cut")), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.list_(pa.list_(pa.int32()))),
            ], names=["doc_id", "text", "kept"])

    return joined.select("doc_id", "text", "cut").mapInArrow(
        run, "doc_id long, text string, kept array<array<int>>"
    )


def keep(text: str, cut: list[dict] | None) -> tuple[str, list[list[int]]]:
    """What is left of a text, and the spans it came from."""
    left, at = [], 0
    for span in cut or []:
        if span["start"] > at:
            left.append([at, span["start"]])
        at = max(at, span["end"])
    if at < len(text):
        left.append([at, len(text)])
    return "".join(text[a:b] for a, b in left), left
