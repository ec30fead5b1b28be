"""The corpus pipeline: each stage calls one operator on all documents that its predecessor kept.

A stage takes (spark, docs, folder) and returns a DataFrame; ``run`` writes it as Parquet to shared storage and rereads
it for the next stage. All but the last return the columns of ``documents``, whichever those are. Null and empty
texts pass every stage (the quality score of such texts decides on them like on any other); an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontaminate, mixing, rule_quality, secret_scan, simhash
from tidewatch.llm.common import read_table, stored
from tidewatch.session import scratch_folder


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return rule_quality.accepted(docs, read_table(spark, folder, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without the words that lie in benchmark windows."""
    return decontaminate.decontaminated(docs, read_table(spark, folder, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secret_scan.redacted(docs, scratch_folder(spark))


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.words_taken(docs)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("mix", mix),
]

# A fitted model and fingerprints cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
