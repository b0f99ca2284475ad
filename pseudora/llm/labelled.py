"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from fitting: crc32 of its id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled_sample(labels: DataFrame, label: str, limit: int) -> DataFrame:
    """(doc_id, label): at most ``limit`` ids outside the held-out fold, half of each label.

    The first in hash order are taken; ids whose labels disagree are left out, NULL labels too.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = rows.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_most"))
    ids = ids.where("label = _most").select("doc_id", F.col("label").cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), "doc_id"]
    halves = [ids.where(F.col("label") == k).orderBy(*order).limit(limit // 2) for k in (0, 1)]
    return halves[0].union(halves[1])
