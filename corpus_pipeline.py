"""Corpus pipeline: five of the operators in a row, each on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fluxsieve.llm import decontaminate, exact_dedup, language, pieces, simhash
from fluxsieve.llm.common import session, stored, table
from fluxsieve.llm.queries import PIECE_MODEL


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages; those without letters or like none of the samples go."""
    session(spark)
    return language.identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    session(spark)
    return exact_dedup.survivors(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    session(spark)
    return simhash.survivors(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every document that is left."""
    session(spark)
    return pieces.encoded(docs, PIECE_MODEL).withColumnRenamed("id", "doc_id")


STAGES = [("language ID", language_id), ("exact dedup", exact), ("SimHash near-dedup", near_dedup),
          ("benchmark decontamination", decontamination), ("SentencePiece", sentencepiece)]
#: SQL has neither suffix automata nor sampled segmentations; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": (run, ORACLE_SQL)}
