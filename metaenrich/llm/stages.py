"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns a frame.

All but the last return the columns of their input. Null and empty texts pass the filters (an empty set of shingles is
nobody's copy, an empty text holds no benchmark item) unless the quality model rejects them. Rows repeated in every
column are copies of each other, so one stays. Rows without doc_id are told apart by their content; they stay where no
copy with doc_id does.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, edit_match, ordinal, pii_crf, token_groups
from .common import table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ordinal.select_good(docs, ordinal.train(docs, table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the row with the smallest doc_id (then by a hash of the whole row) stays."""
    key, first = (f"{name}_{uuid.uuid4().hex}" for name in ("key", "first"))  # names that no table has
    whole = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64(F.to_json(F.struct("*"))).alias("row"))
    keyed = docs.withColumn(key, whole)
    found = token_groups.components(keyed, key=key)
    firsts = found.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias(first)).distinct()
    stays = keyed.join(firsts, F.col(key) == F.col(first), "left_semi")
    if not docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        stays = stays.dropDuplicates([key])
    return stays.drop(key)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return edit_match.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii_crf.redact(docs, pii_crf.train(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keep = tuple(c for c in ("doc_id", "lang", "source") if c in docs.columns)
    return bpe.encode_documents(docs, bpe.read_vocabulary(public_tokenizers.path(bpe.VOCABULARY)), keep=keep)
