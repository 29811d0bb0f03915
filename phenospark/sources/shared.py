"""Where intermediate tables and stream state go."""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
WAREHOUSE = "spark.sql.warehouse.dir"


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the warehouse.

    Raises where only a driver-local warehouse is left and executors run on other machines.
    """
    base = spark.conf.get(SETTING, None)
    if base:
        return base.rstrip("/")
    base = spark.conf.get(WAREHOUSE, os.path.abspath("spark-warehouse"))  # Spark's own default
    master = spark.conf.get("spark.master", "local")
    if urlsplit(base).scheme in ("", "file") and not master.split("[")[0] == "local":
        raise ValueError(f"set {SETTING} to a folder that driver and executors share")
    return base.rstrip("/")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder under the shared folder of the session."""
    return f"{shared_base(spark)}/phenospark/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write the table to the shared folder and read it back.

    For tables that several passes read: nothing upstream runs again, and a lost executor
    costs no more than a re-read.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
