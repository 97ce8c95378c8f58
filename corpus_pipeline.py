"""From raw documents to token ids: quality, near-duplicates, benchmark leaks, personal data, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from metaenrich.llm import stages
from metaenrich.llm.common import Scratch, table

STAGES = [
    ("quality", stages.good_quality),
    ("near_duplicates", stages.one_of_each_group),
    ("decontamination", stages.without_benchmarks),
    ("personal_data", stages.redacted),
    ("encoding", stages.encoded),
]

#: A trained model and a tokenizer stand in the way of SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written as Parquet and read again as the next one's documents."""
    scratch = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
