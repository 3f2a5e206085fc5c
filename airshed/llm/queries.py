"""The registered queries of the training-data operators.

Each query applies its operator, with production parameters, to its whole
table and returns the digest columns of its contract.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from airshed.llm import (chat_format, collocations, hyperminhash, language_mixture, mixing, packing, periodic_runs,
                         product_quantiser, quality_neighbours, quartile_digest, secret_crf, site_style, toxicity_cnn)
from airshed.llm.common import table


def op1_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extract(table(spark, sf_dir, "pages"))


def op2_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quartile_digest.fingerprints(table(spark, sf_dir, "documents"))


def op4_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = mixing.with_topic(table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "topic", "n_tokens")
    return mixing.mix(docs)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op6_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_crf.scan(docs, secret_crf.fit(docs)).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op7_product_quantiser(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_quantiser.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return toxicity_cnn.score(docs, toxicity_cnn.fit(docs, table(spark, sf_dir, "labels")))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat_format.with_probe(spark, table(spark, sf_dir, "conversations"))
    return chat_format.digests(chat_format.format_conversations(rows))


def op10_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_mixture.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of ``documents``."""
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of ``documents``, of which a tenth get a periodic tail before."""
    return periodic_runs.digest(periodic_runs.runs(table(spark, sf_dir, "documents"), edit=periodic_runs.planted))


def op13_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of ``documents``, learned from ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_neighbours.score(docs, quality_neighbours.fit(docs, table(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_site_style, op2_hyperminhash, op3_quartile_digest, op4_raking, op5_packing, op6_secret_crf,
              op7_product_quantiser, op8_toxicity_cnn, op9_chat_format, op10_language_mixture, op11_collocations,
              op12_periodic_runs, op13_quality_neighbours)
}

#: DuckDB SQL of the queries that SQL can express.
ORACLE: dict[str, str] = {"op4_raking": mixing.oracle_sql(), "op11_collocations": collocations.oracle_sql()}
