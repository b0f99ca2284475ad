"""The five stages over catalog tables. Each stage reads tables, writes tables and nothing else.

Outputs that build on another output of the same stage read it back from storage, so no plan is
evaluated twice and a lost executor costs no more than the stage at hand. Every output names the
ones it builds on; those that do not wait for one another are written at the same time.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pseudora.functions.hashing import resolve_salt
from pseudora.functions.rules import normalize_key
from pseudora.operators.controls import (
    RECORD_KEY,
    build_consent_status,
    build_deletion_requests,
    build_retention_policy,
    unreadable_policies,
)
from pseudora.operators.eligibility import build_compliance_events, build_processing_eligibility
from pseudora.operators.identity import build_standardized_customer_df
from pseudora.operators.mapping import build_mapping_decisions, build_semantic_mapping_candidates
from pseudora.operators.profiling import SourceTableSpec, profile_sources
from pseudora.sources.landing import BronzeIngestSpec, ingest_csv_to_bronze
from pseudora.plans.skew import KeyCounts, measured
from pseudora.plans.together import Graph, run_graph
from pseudora.sources.tables import note, noted, write_table

RECORD_KEY_COUNTS = "record_key_counts"
REPORTED = 20  # unreadable policies that a warning names


@dataclass(frozen=True)
class Layout:
    """Catalog and schema names of the stage tables."""

    catalog: str = "spark_catalog"
    bronze: str = "bronze"
    metadata: str = "metadata"
    silver: str = "silver"
    compliance: str = "compliance"

    def table(self, schema: str, name: str) -> str:
        return f"{self.catalog}.{getattr(self, schema)}.{name}"

    def create_schemas(self, spark: SparkSession, folder: str | None = None) -> None:
        for schema in (self.bronze, self.metadata, self.silver, self.compliance):
            place = f" LOCATION '{folder}/{schema}'" if folder else ""
            spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.catalog}.{schema}{place}")


@dataclass(frozen=True)
class Run:
    """Parameters shared by the stages; unset times mean the time of the run."""

    layout: Layout = Layout()
    batch_id: str = "manual"
    run_ts: datetime | None = None
    as_of: date | None = None
    table_format: str = "parquet"

    def write(self, df: DataFrame, schema: str, name: str) -> DataFrame:
        return write_table(df, self.layout.table(schema, name), table_format=self.table_format)

    def write_counted(self, df: DataFrame, schema: str, name: str) -> DataFrame:
        """Write a table of records and note its most frequent record keys, found on the way."""
        watched, counts = measured(df, record_key(df))
        written = self.write(watched, schema, name)
        note(df.sparkSession, self.layout.table(schema, name), RECORD_KEY_COUNTS, counts())
        return written

    def counts(self, spark: SparkSession, schema: str, name: str) -> KeyCounts | None:
        return noted(spark, self.layout.table(schema, name), RECORD_KEY_COUNTS)


def record_key(df: DataFrame) -> list:
    """The record key of a table as the joins of stage 05 compare it."""
    return [normalize_key(F.col(RECORD_KEY[0])), F.col(RECORD_KEY[1]).cast("string")]


# Source system and data set of the six landing files.
LANDING_FILES = (
    ("crm", "crm_customers"),
    ("erp", "erp_clients"),
    ("reference", "semantic_concepts"),
    ("compliance", "consent_preferences"),
    ("compliance", "deletion_requests"),
    ("compliance", "data_retention_policy"),
)
CUSTOMER_SOURCES = LANDING_FILES[:2]


def landing_specs(run: Run, landing_paths: dict[str, str]) -> list[BronzeIngestSpec]:
    """Ingest specs for the landing folders given per source system."""
    return [
        BronzeIngestSpec(
            source_system=system,
            landing_path=landing_paths[system],
            file_name=f"{name}.csv",
            target_table=run.layout.table("bronze", f"{name}_raw"),
        )
        for system, name in LANDING_FILES
    ]


def ingest_graph(spark: SparkSession, run: Run, specs: Sequence[BronzeIngestSpec]) -> Graph:
    def ingest(spec: BronzeIngestSpec) -> Callable[[], DataFrame]:
        return lambda: ingest_csv_to_bronze(
            spark=spark, spec=spec, batch_id=run.batch_id, run_ts=run.run_ts, table_format=run.table_format
        )

    return {spec.target_table: ((), ingest(spec)) for spec in specs}


def run_ingest(spark: SparkSession, run: Run, specs: Sequence[BronzeIngestSpec]) -> None:
    run_graph(spark, ingest_graph(spark, run, specs))


def run_profiling(spark: SparkSession, run: Run) -> DataFrame:
    specs = [
        SourceTableSpec(system, f"{name}_raw", run.layout.table("bronze", f"{name}_raw"))
        for system, name in CUSTOMER_SOURCES
    ]
    return profile_sources(
        spark=spark,
        specs=specs,
        target_table=run.layout.table("metadata", "source_column_profile"),
        batch_id=run.batch_id,
        run_ts=run.run_ts,
        table_format=run.table_format,
    )


def run_semantic_mapping(
    *,
    spark: SparkSession,
    profile_table: str,
    concepts_table: str,
    candidates_table: str,
    decisions_table: str,
    batch_id: str,
    run_ts: datetime | None = None,
    table_format: str = "parquet",
) -> DataFrame:
    candidates = write_table(
        build_semantic_mapping_candidates(
            spark.table(profile_table),
            spark.table(concepts_table),
            batch_id=batch_id,
            run_ts=run_ts,
        ),
        candidates_table,
        table_format=table_format,
    )
    return write_table(
        build_mapping_decisions(candidates), decisions_table, table_format=table_format
    )


def standardization_graph(spark: SparkSession, run: Run, key: str) -> Graph:
    raw = {name: run.layout.table("bronze", f"{name}_raw") for _, name in CUSTOMER_SOURCES}

    def standardized(system: str, name: str) -> Callable[[], DataFrame]:
        return lambda: run.write(
            build_standardized_customer_df(
                spark.table(raw[name]), source_system=system, source_dataset_name=name, pseudonymization_salt=key
            ),
            "silver",
            f"{name}_standardized",
        )

    def candidates() -> DataFrame:
        crm, erp = (spark.table(run.layout.table("silver", f"{name}_standardized")) for _, name in CUSTOMER_SOURCES)
        return run.write_counted(crm.unionByName(erp), "silver", "customer_identity_candidates")

    graph = {f"{name}_standardized": ([raw[name]], standardized(system, name)) for system, name in CUSTOMER_SOURCES}
    return graph | {"customer_identity_candidates": (list(graph), candidates)}


def run_standardization(
    spark: SparkSession, run: Run, *, salt: str | None, allow_dev_salt: bool = False
) -> DataFrame:
    key = resolve_salt(salt, allow_dev_salt=allow_dev_salt)
    return _run_alone(spark, standardization_graph(spark, run, key))["customer_identity_candidates"]


def compliance_graph(spark: SparkSession, run: Run) -> Graph:
    ts = run.run_ts

    def raw(name: str) -> str:
        return run.layout.table("bronze", f"{name}_raw")

    def table(name: str, schema: str = "compliance") -> DataFrame:
        return spark.table(run.layout.table(schema, name))

    def consents() -> DataFrame:
        status = build_consent_status(spark.table(raw("consent_preferences")), run_ts=ts)
        return run.write_counted(status, "compliance", "consent_status")

    def deletions() -> DataFrame:
        requests = build_deletion_requests(spark.table(raw("deletion_requests")), run_ts=ts)
        return run.write(requests, "compliance", "deletion_requests")

    def policy() -> DataFrame:
        stated = spark.table(raw("data_retention_policy"))
        odd = unreadable_policies(stated).limit(REPORTED).collect()
        if odd:
            named = ", ".join(f"{row['dataset_name']} ({row['retention_days']})" for row in odd)
            warnings.warn(f"retention days that are no number, the default applies: {named}", stacklevel=2)
        return run.write(build_retention_policy(stated, run_ts=ts), "compliance", "retention_policy")

    def eligibility() -> DataFrame:
        decided = build_processing_eligibility(
            identity_candidates=table("customer_identity_candidates", "silver"),
            consent_status=table("consent_status"),
            deletion_requests=table("deletion_requests"),
            retention_policy=table("retention_policy"),
            as_of=run.as_of,
            run_ts=ts,
            identity_counts=run.counts(spark, "silver", "customer_identity_candidates"),
            consent_counts=run.counts(spark, "compliance", "consent_status"),
        )
        return run.write(decided, "compliance", "processing_eligibility")

    def events() -> DataFrame:
        return run.write(build_compliance_events(table("processing_eligibility"), run_ts=ts), "compliance", "compliance_events")

    controls = ["consent_status", "deletion_requests", "retention_policy"]
    return {
        "consent_status": ([raw("consent_preferences")], consents),
        "deletion_requests": ([raw("deletion_requests")], deletions),
        "retention_policy": ([raw("data_retention_policy")], policy),
        "processing_eligibility": ([*controls, "customer_identity_candidates"], eligibility),
        "compliance_events": (["processing_eligibility"], events),
    }


def _run_alone(spark: SparkSession, graph: Graph) -> dict[str, DataFrame]:
    """Run one stage, whose inputs from other stages are there."""
    return run_graph(spark, {name: ([n for n in needs if n in graph], write) for name, (needs, write) in graph.items()})


def run_compliance_controls(
    spark: SparkSession, run: Run | None = None, *, catalog: str = "spark_catalog"
) -> DataFrame:
    """Stage 05; without a run, over the usual schemas of a catalog at the present time."""
    run = run or Run(layout=Layout(catalog=catalog))
    return _run_alone(spark, compliance_graph(spark, run))["compliance_events"]


def run_all(
    spark: SparkSession,
    run: Run,
    landing_paths: dict[str, str],
    *,
    salt: str | None,
    allow_dev_salt: bool = False,
) -> DataFrame:
    """Stages 01 to 05, every table as soon as those it builds on are there; returns eligibility."""
    key = resolve_salt(salt, allow_dev_salt=allow_dev_salt)
    table = run.layout.table

    def mapped() -> DataFrame:
        return run_semantic_mapping(
            spark=spark,
            profile_table=table("metadata", "source_column_profile"),
            concepts_table=table("bronze", "semantic_concepts_raw"),
            candidates_table=table("metadata", "semantic_mapping_candidates"),
            decisions_table=table("metadata", "mapping_decisions"),
            batch_id=run.batch_id,
            run_ts=run.run_ts,
            table_format=run.table_format,
        )

    sources = [table("bronze", f"{name}_raw") for _, name in CUSTOMER_SOURCES]
    graph = {
        **ingest_graph(spark, run, landing_specs(run, landing_paths)),
        "source_column_profile": (sources, lambda: run_profiling(spark, run)),
        "mapping_decisions": (["source_column_profile", table("bronze", "semantic_concepts_raw")], mapped),
        **standardization_graph(spark, run, key),
        **compliance_graph(spark, run),
    }
    run_graph(spark, graph)
    return spark.table(table("compliance", "processing_eligibility"))
