"""A stream scored by the newest published model, and the registry it looks in.

A registry is a folder with the saved models and a list of versions.  A version joins the
list when its model is wholly written, so a reader never loads half of one.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.train import BloomModel, predict
from ..schema import DATE, LOCATION
from ..sources.writers import load_model, save_model

VERSION = "model_version"
VERSIONS = "version int, place string"


class NoModelError(LookupError):
    """A stream had rows to score before any model was published."""


def versions(spark: SparkSession, registry: str) -> DataFrame:
    """The published versions with the place of each; none where there is no registry."""
    try:
        return spark.read.schema(VERSIONS).json(f"{registry}/versions")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSIONS)


def newest_version(spark: SparkSession, registry: str) -> tuple[int, str] | None:
    """Number and place of the newest version.

    Two publishers at once may take the same number; the later place by name then counts,
    for every reader alike.
    """
    newest = versions(spark, registry).agg(F.max(F.struct("version", "place")).alias("newest")).first()["newest"]
    return None if newest is None else (newest["version"], newest["place"])


def publish_model(spark: SparkSession, model: BloomModel, registry: str) -> int:
    """Save the model as the next version and return its number, from 1."""
    last = newest_version(spark, registry)
    number = 1 if last is None else last[0] + 1
    place = save_model(spark, model, f"{registry}/models/version={number}-{uuid.uuid4().hex}")
    row = spark.createDataFrame([(number, place)], VERSIONS)
    row.coalesce(1).write.mode("append").json(f"{registry}/versions")
    return number


def write_model_scores(
    features: DataFrame, registry: str, path: str, checkpoint: str, keep: Sequence[str] = (LOCATION, DATE)
) -> StreamingQuery:
    """Score arriving feature rows; each names the version it was scored by.

    Every batch looks for a newer version, which costs a read of the list, and loads it only
    when there is one.  A batch is scored by one version as a whole.  A batch run again
    after a failure replaces its own rows, perhaps by those of a newer version: no row is
    lost, doubled, or scored by two.  A batch without any model fails the stream, and is
    scored when the stream is started again after a model has been published.
    """
    held: dict[str, object] = {}

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = newest_version(spark, registry)
        if newest is None:
            raise NoModelError(f"no model in {registry}")
        version, place = newest
        if held.get("place") != place:
            held.update(place=place, model=load_model(spark, place))
        scored = predict(held["model"], batch, keep).withColumn(VERSION, F.lit(version))
        scored.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        features.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
