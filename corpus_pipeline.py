"""A corpus pipeline: five stages over `documents`, each written as Parquet and read again as the next one's input.

Quality rules drop the documents they reject and the lines they remove; SimHash keeps one document of each group; the secret
scan masks what it reports; the mixture drops or repeats documents and orders them by training position; the last stage
encodes every text into sampled pieces. All stages but the last return the columns of documents. `n_chars`, where present,
follows the text.

Defined results: empty tables stay empty through every stage; a null text is rejected by the first stage; further columns
pass through the first four.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm import mixture, pieces, quality_rules, secrets, simhash
from lattica.llm.common import read_table
from lattica.session import discard, scratch


def _recount(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recount(quality_rules.clean(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _recount(secrets.redact(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = pieces.sample_encode(docs.select("doc_id", "source", "lang", "text"))
    return rows.withColumn("n_pieces", F.size("piece_ids").cast("long"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("simhash_dedup", near_dedup),
    ("secret_scan", mask_secrets),
    ("mixture", mix_sources),
    ("sentencepiece", encode),
]

#: SQL has neither XXH64 nor the sampled segmentations; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Stages but the last are written to the checkpoint folder, which executors share; a stage's
    rows are deleted once the next one's are there, but for those that the result reads."""
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
