"""Whole rows as one column, so that no name of theirs meets the names an operator works with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.llm.store import stored

ROW = "row"  # the only name beside those an operator asks for

#: Row numbers that are broadcast at most, 8 bytes each; more take a shuffled join.
BROADCAST_ROWS = 2_000_000


def packed(docs: DataFrame, *needed: str) -> DataFrame:
    """``row``, the whole row, and copies of the columns that are needed."""
    return docs.select(F.struct("*").alias(ROW), *[F.col(name) for name in needed if name != ROW])


def unpacked(df: DataFrame, names: list[str], **results: Column) -> DataFrame:
    """The columns of the packed rows; results replace those of the same name or follow."""
    own = [results.pop(name).alias(name) if name in results else F.col(ROW)[name].alias(name) for name in names]
    return df.select(*own, *[column.alias(name) for name, column in results.items()])


def without(df: DataFrame, dropped: DataFrame, key: str, most: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` whose key is not among the distinct ones of ``dropped``, its only column.

    The keys are stored and counted. So long as they are few enough they are broadcast, and no row
    moves; beyond that an anti join shuffles the rows.
    """
    keys = stored(dropped.select(key), "dropped-keys")
    few = keys.count() <= most
    return df.join(F.broadcast(keys) if few else keys, key, "left_anti")
