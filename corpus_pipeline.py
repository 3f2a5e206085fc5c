"""The corpus pipeline: five operators, each on what the one before kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next one's documents. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm import hyperminhash, language_mixture, mixing, packing, secret_crf
from airshed.llm.common import Scratch

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Similarity of word shingles from which a document is a near duplicate.
NEAR = (80, 100)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (null text, no letter) go; a missing
    ``lang`` becomes the predicted one."""
    model = language_mixture.fit(docs.where(language_mixture.fold(F.col("doc_id")) != language_mixture.TEST_FOLD))
    found = language_mixture.predict(docs.select(*COLUMNS), model).where(F.col("lang_pred") != language_mixture.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str,
               threshold: tuple[int, int] = NEAR) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the
    smallest id. Of rows with the same id the first by text (null first),
    then by the other columns, stays. Rows without an id cannot be named as
    duplicates and stay."""
    kept = hyperminhash.near_duplicates(docs, threshold=threshold).where("kept").select("doc_id").distinct()
    first = F.min(F.struct(*COLUMNS[1:])).alias("_first")
    named = docs.select(*COLUMNS).join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(first).select("doc_id", "_first.*")
    return named.unionByName(docs.select(*COLUMNS).where("doc_id is null"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; no document goes."""
    found = secret_crf.scan(docs.select(*COLUMNS), secret_crf.fit(docs))
    return found.withColumn("text", F.col("redacted")).withColumn(
        "n_chars", F.when(F.col("spans") != "", F.length("text")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample that brings sources, languages and topics to their targets."""
    return mixing.mix(mixing.with_topic(docs.select(*COLUMNS))).where("kept").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.digest(packing.pack(docs))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("redact_secrets", redact_secrets),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

#: Mixture inference, near duplicates and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``; between them the documents
    are a table in the shared checkpoint folder."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, scratch.settle(stage(spark, docs, sf_dir))
        scratch.drop(before)
    return STAGES[-1][1](spark, docs, sf_dir)
