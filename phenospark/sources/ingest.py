"""Extract files of any known layout into one typed table, lines that do not fit beside it."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.values import null_if_nan
from ..operators.clean import coordinate_ok
from ..schema import RAW, RAW_REQUIRED
from .readers import EXTRACT_NAMES, normalise_extract

FILE, RECORD, REASON, ACCEPTED = "source_file", "record", "rejected_for", "accepted"
DATES = "yyyy-MM-dd"


@dataclass(frozen=True)
class Ingested:
    """``rows`` are all lines with their file, reason and, where they did not parse, their text;
    ``files`` are the files with their header line."""

    rows: DataFrame
    files: DataFrame

    def accepted(self) -> DataFrame:
        return self.rows.where(ACCEPTED).drop(RECORD, REASON, ACCEPTED)

    def rejects(self) -> DataFrame:
        return self.rows.where(~F.col(ACCEPTED)).drop(ACCEPTED)

    def counts(self) -> DataFrame:
        """Accepted and rejected lines of every file, those without a line included."""
        seen = self.rows.groupBy(FILE).agg(
            F.count_if(ACCEPTED).alias("accepted"), F.count_if(~F.col(ACCEPTED)).alias("rejected")
        )
        return self.files.select(FILE).join(seen, FILE, "left").fillna(0, ["accepted", "rejected"])


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """The first line that is not blank of every file that has one.

    A narrow pass over the text that reduces map-side to a row per file.  A file's splits
    carry their offset, and ids rise along a split, so the earliest pair is the first line.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(paths).select(
        F.col("_metadata.file_path").alias(FILE), "value",
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"),
    )
    return lines.where(F.trim("value") != "").groupBy(FILE).agg(
        F.min_by("value", "place").alias("header")
    )


def layout_of(
    header: str, columns: T.StructType, required: Sequence[str]
) -> T.StructType | None:
    """The types of a header's columns in its order, named as here; None for a layout that
    lacks a required column, repeats a name or takes one that the table of lines needs.
    A column that ``columns`` does not name stays text."""
    ours = {service.lower(): name for service, name in EXTRACT_NAMES.items()}
    ours |= {f.name.lower(): f.name for f in columns}
    types = {f.name: f.dataType for f in columns}
    found = [c.strip() for c in next(csv.reader([header.lstrip("﻿")]))]
    names = [ours.get(c.lower(), c) for c in found]
    lower = [c.lower() for c in names]
    if "" in lower or len(set(lower)) < len(lower) or not set(required) <= set(names):
        return None
    if {FILE, RECORD, REASON, ACCEPTED} & set(lower):
        return None
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in names])


def _address(file: str) -> str:
    """A listed file as a path to read: decoded, its glob marks taken literally."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(file))


def _reason(required: Sequence[str]) -> Column:
    missing = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    return F.coalesce(
        F.when(F.col(RECORD).isNotNull(), "malformed"), *missing,
        F.when(~coordinate_ok(), "off the globe"),
    )


def _known(
    spark: SparkSession, files: list[str], layout: T.StructType, required: Sequence[str]
) -> DataFrame:
    lines = (
        spark.read.schema(layout.add(RECORD, T.StringType())).option("header", True)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD)
        .option("dateFormat", DATES).csv([_address(f) for f in files])
        .withColumn(FILE, F.col("_metadata.file_path"))
    )
    doubles = [f.name for f in layout if isinstance(f.dataType, T.DoubleType)]
    lines = lines.withColumns({c: null_if_nan(F.col(f"`{c}`")) for c in doubles})
    return normalise_extract(lines).withColumn(REASON, _reason(required))


def _unknown(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.text([_address(f) for f in files]).select(
        F.col("value").alias(RECORD), F.col("_metadata.file_path").alias(FILE),
        F.lit("header").alias(REASON),
    )


def ingest(
    spark: SparkSession, paths: str | Sequence[str], path: str,
    columns: T.StructType = RAW, required: Sequence[str] = RAW_REQUIRED,
) -> Ingested:
    """Read every CSV file under ``paths``, publish its lines under ``path``, and read them back.

    Files are grouped by header, so a layout is one typed read however many files have it;
    the driver learns the file names, which it lists anyway.  No line is lost: one that does
    not parse (``malformed``: too few or many fields, a wrong number or date), misses a
    required value or lies off the globe is a reject with its reason, and so is every line,
    the header too, of a file whose layout is unknown.  Lines are parsed once, on the way to
    Parquet, since a read of fewer columns would find fewer bad ones.  Values are the stored
    integers and are scaled.  Blank lines are skipped; a quoted line break is not supported.
    A second run on the same ``path`` replaces the first.
    """
    file_headers(spark, paths).write.mode("overwrite").parquet(f"{path}/files")
    files = spark.read.schema(f"{FILE} string, header string").parquet(f"{path}/files")
    known: dict[str, tuple[T.StructType, list[str]]] = {}
    strange: list[str] = []
    for row in files.groupBy("header").agg(F.collect_list(FILE).alias("names")).collect():
        layout = layout_of(row["header"], columns, required)
        if layout is None:
            strange += row["names"]
        else:
            known.setdefault(layout.json(), (layout, []))[1].extend(row["names"])
    marks = T.StructType([T.StructField(c, T.StringType()) for c in (FILE, RECORD, REASON)])
    lines = spark.createDataFrame([], T.StructType([*columns.fields, *marks.fields]))
    parts = [_known(spark, names, layout, required) for layout, names in known.values()]
    if strange:
        parts.append(_unknown(spark, strange))
    for part in parts:
        lines = lines.unionByName(part, allowMissingColumns=True)
    lines = lines.withColumn(ACCEPTED, F.col(REASON).isNull())
    lines.write.mode("overwrite").partitionBy(ACCEPTED).parquet(f"{path}/rows")
    return Ingested(spark.read.schema(lines.schema).parquet(f"{path}/rows"), files)
