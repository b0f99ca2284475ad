"""Corpus pipeline: quality, near duplicates, benchmark passages, secrets, source mix.

Every stage takes all documents that the one before kept and returns them with the columns of
``documents``; the last returns one row per document with the words that the mix takes of it.
Stages are written to the shared folder and read again, so a lost executor costs one stage at most.
An empty table passes through; extra columns of the documents are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pseudora.llm import decontamination, mixing, ngramjoin, quality, secrets
from pseudora.llm.queries import table
from pseudora.llm.store import dropped, stored


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    return ngramjoin.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in the text replaced by a mark."""
    clean = secrets.redact_secrets(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document that is left."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality classifier", good),
    ("n-gram Jaccard join", distinct),
    ("benchmark decontamination", decontaminated),
    ("secret scans", redacted),
    ("mixing sources to target weights", mixed),
]

#: The first stage is a fitted classifier, which SQL cannot express. Tests compare what the second and third
#: stage keep with brute force, and the whole run with the stages' reports.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not None:
            dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
