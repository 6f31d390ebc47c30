"""A training corpus from raw documents: five stages, each written and read again before the next.

Defined results: a null or empty text has no language and goes in the first stage; a table without a known ``lang`` teaches no
language, so that all its documents go there; a null ``doc_id`` is an id like any other; rows repeated in id and text are near
duplicates of one another, so one of them stays; ties go to the smallest id; very long texts are taken whole; other
columns are handed on by all stages but the last; an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sheetloom.llm import isolation, language_id, line_dedup, packing, simhash
from sheetloom.llm.common import ensure_folder, ship
from sheetloom.sources.staging import Staging


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised."""
    ship(spark)
    return language_id.keep(docs, language_id.train(docs))


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules and are not anomalous."""
    ship(spark)
    return isolation.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that stand elsewhere; one that holds nothing else goes."""
    ship(spark)
    return line_dedup.keep(docs)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    ship(spark)
    return simhash.keep_one(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids and places in sequences."""
    ship(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_languages),
    ("quality_rules", apply_rules),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_documents),
    ("packing", pack_documents),
]

#: SQL cannot express the fitted stages and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.

    What a stage keeps is written to the shared checkpoint folder and read again; it is removed once the next
    stage has written its own. The last one stays for the result to be read from.
    """
    ensure_folder(spark)
    folder = spark.sparkContext.getCheckpointDir()
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        staging = Staging(spark, folder)
        docs = staging(stage(spark, docs, sf_dir), name)
        if before is not None:
            before.release()
        before = staging
    return docs
