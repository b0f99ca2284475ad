"""Lineage columns of raw tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.functions.hashing import record_hash


def timestamp_column(run_ts: datetime | Column | None) -> Column:
    """The given moment, or the query's start when none is given."""
    if run_ts is None:
        return F.current_timestamp()
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts)


def add_bronze_metadata(
    df: DataFrame,
    *,
    source_system: str,
    source_file: str,
    batch_id: str,
    run_ts: datetime | Column | None = None,
) -> DataFrame:
    """Append source, file, ingest time, batch and a fingerprint of the business columns."""
    return df.select(
        "*",
        F.lit(source_system).alias("_source_system"),
        F.lit(source_file).alias("_source_file"),
        timestamp_column(run_ts).alias("_ingested_at"),
        F.lit(batch_id).alias("_batch_id"),
        record_hash(df.columns).alias("_record_hash"),
    )
