"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.shared import shared_folder, stored

__all__ = ["map_rows", "read_table", "shared_folder", "stored", "texts"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the whole text, a null text as the empty one."""
    return df.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def map_rows(
    df: DataFrame, make: Callable[[], Callable[[dict], Iterable[tuple]]], schema: str,
    batch_rows: int = 5000,
) -> DataFrame:
    """Run a generator of tuples over each batch of columns, as Arrow batches of bounded size.

    ``make`` runs once a task, on the executor, and returns a function from a dict of
    column lists (or Arrow arrays) to the tuples of result rows.
    """
    names = [part.split()[0] for part in schema.split(", ")]
    types = [_ARROW[part.split()[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            held: list[tuple] = []
            for row in work({n: batch.column(n) for n in batch.schema.names}):
                held.append(row)
                if len(held) >= batch_rows:
                    yield _batch(held, names, types)
                    held = []
            if held:
                yield _batch(held, names, types)

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names
    )


_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}
