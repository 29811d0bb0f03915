"""From documents to packed training sequences, one stage after the other.

Each stage takes the session, the documents its predecessor kept and the folder of the
tables; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from phenospark.llm import exact_dedup, minhash, mixing, packing, toxicity
from phenospark.llm.common import read_table, stored
from phenospark.llm.queries import tokenizer_path

WEIGHTS = {"fine": 0.9, "poor": 0.1}


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    return toxicity.drop_toxic(docs, toxicity.quality_labels(read_table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the smallest doc_id stays."""
    return minhash.drop_near_duplicates(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated until fine and poor ones have their target shares; none goes."""
    return mixing.repeat_documents(docs, mixing.label_domains(read_table(spark, sf_dir, "labels")), WEIGHTS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a sequence, with its ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies),
    ("mixing", mix_domains), ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table, each written and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
