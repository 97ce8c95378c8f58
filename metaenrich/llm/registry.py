"""The registered queries of this subpackage: thin wrappers that apply each operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, delta_lloyd, edit_match, fingerprint_index, html_template, imatch, langid, oracles, ordinal, periodic_runs, pii_crf, poly_dedup, sharding, token_groups
from .common import table


def _vocabulary(name: str = bpe.VOCABULARY) -> str:
    import public_tokenizers

    return bpe.read_vocabulary(public_tokenizers.path(name))


def op5_edit_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_match.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


def op7_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return ordinal.score(docs, ordinal.train(docs, table(spark, sf_dir, "labels")))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), _vocabulary(), ids=False, digests=True)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op1_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii_crf.digest(pii_crf.detect(docs, pii_crf.train(docs)))


def op3_fingerprint_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_index.remove_repeats(table(spark, sf_dir, "documents"))


def op4_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_groups.components(table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op11_delta_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delta_lloyd.digest(delta_lloyd.cluster(table(spark, sf_dir, "embeddings")))


def op12_poly_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poly_dedup.duplicates(table(spark, sf_dir, "documents"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.find(table(spark, sf_dir, "documents"), prepare=periodic_runs.stretched))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_html_template, op2_pii_crf, op3_fingerprint_index, op4_token_groups, op5_edit_match, op6_imatch, op7_ordinal, op8_bpe, op9_sharding, op10_langid,
        op11_delta_lloyd, op12_poly_dedup, op13_periodic_runs,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_fingerprint_index": oracles.OP3, "op4_token_groups": oracles.OP4, "op11_delta_lloyd": oracles.op11(), "op12_poly_dedup": oracles.OP12}
