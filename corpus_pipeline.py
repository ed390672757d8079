"""From raw documents to encoded training data: five stages, each over all rows the last one kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from worklens.llm import langid, mixing, rules, sentences, simhash
from worklens.llm.common import shared_folder


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined."""
    return langid.filter_documents(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counted rules and lie within their language's perplexity band."""
    return rules.filter_documents(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.filter_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the pieces of each text."""
    return sentences.encode(docs)


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_dedup),
    ("mixing sources", mix_sources),
    ("SentencePiece encoding", encode_pieces),
]

# trained models, fingerprints and segmentations have no SQL; tests hold the rows against a plain version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over ``documents``; what a stage returns is written as Parquet and read again.

    The files go to the folder that all executors share (``spark.checkpoint.dir``); only where that
    is unset and the master is local, as in tests, a temporary folder is made.
    """
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
