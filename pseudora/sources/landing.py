"""Headered CSV landing files."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from pseudora.operators.bronze import add_bronze_metadata
from pseudora.sources.tables import write_table


@dataclass(frozen=True)
class BronzeIngestSpec:
    source_system: str
    landing_path: str
    file_name: str
    target_table: str

    @property
    def source_file_path(self) -> str:
        return self.landing_path.rstrip("/") + "/" + self.file_name


def read_landing_csv(spark: SparkSession, source_file_path: str) -> DataFrame:
    """Every column is a string; no pass over the data to guess types."""
    return spark.read.csv(source_file_path, header=True, inferSchema=False)


def ingest_csv_to_bronze(
    *,
    spark: SparkSession,
    spec: BronzeIngestSpec,
    batch_id: str,
    run_ts: datetime | None = None,
    table_format: str = "parquet",
) -> None:
    """Landing file to raw table with lineage columns, replacing the table."""
    raw = add_bronze_metadata(
        read_landing_csv(spark, spec.source_file_path),
        source_system=spec.source_system,
        source_file=spec.source_file_path,
        batch_id=batch_id,
        run_ts=run_ts,
    )
    write_table(raw, spec.target_table, table_format=table_format)
