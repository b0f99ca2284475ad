"""Validation reports over the stage tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bronze_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each named table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def profile_summary(profile: DataFrame) -> DataFrame:
    return (
        profile.groupBy("source_system", "table_name")
        .agg(F.count(F.lit(1)).alias("profiled_columns"))
        .orderBy("source_system", "table_name")
    )


def profile_report(profile: DataFrame) -> DataFrame:
    return profile.select(
        "source_system",
        "table_name",
        "column_name",
        "row_count",
        "null_count",
        F.round("null_rate", 4).alias("null_rate"),
        "distinct_count",
        F.round("distinct_rate", 4).alias("distinct_rate"),
        "min_length",
        "max_length",
        F.round("avg_length", 2).alias("avg_length"),
        "inferred_type",
        "sample_values",
    ).orderBy("source_system", "table_name", "column_name")


def decision_report(decisions: DataFrame) -> DataFrame:
    return decisions.select(
        "source_system",
        "table_name",
        "column_name",
        "concept_id",
        "concept_name",
        "canonical_field_name",
        "pii_category",
        "mapping_score",
        "mapping_reason",
        "decision",
    ).orderBy("source_system", "table_name", "column_name")


def eligibility_report(eligibility: DataFrame) -> DataFrame:
    """Every row of the stored eligibility table in record order.

    The row position in the table breaks ties, so that one id with very many rows is still cut
    into several sort ranges.
    """
    return (
        eligibility.withColumn("_position", F.monotonically_increasing_id())
        .orderBy("source_system", "source_record_id", "_position")
        .drop("_position")
    )
