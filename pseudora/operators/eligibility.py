"""What each identity record may be used for, and the events that say why not."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pseudora.functions.rules import (
    DEFAULT_RETENTION_DAYS,
    DELETION_REQUESTED,
    event_day,
    match_identifier_present,
    may_process,
    normalize_key,
    older_than,
    suppression_reasons,
)
from pseudora.functions.hashing import quoted
from pseudora.operators.bronze import timestamp_column
from pseudora.operators.controls import RECORD_KEY, active_deletions
from pseudora.plans.skew import LOOKUP_MAX_ROWS, ROWS_PER_TASK, KeyCounts, lookup_left_join, spread_left_join

DATASET_KEY = ("source_system", "source_dataset_name")

# Data set of a source system whose records do not name theirs.
DEFAULT_DATASETS = (("crm", "crm_customers"), ("erp", "erp_clients"))

CONSENT_COLUMNS = (
    *RECORD_KEY,
    "raw_analytics_consent",
    "raw_marketing_consent",
    "consent_updated_at",
)


def prepare_identity_candidates(identities: DataFrame) -> DataFrame:
    """Normalize the join keys; derive the data set name where the column is absent."""
    if "source_dataset_name" in identities.columns:
        dataset = normalize_key(F.col("source_dataset_name"))
    else:
        system = F.lower("source_system")
        dataset = F.coalesce(*[F.when(system == s, F.lit(name)) for s, name in DEFAULT_DATASETS])
    return identities.select(
        normalize_key(F.col("source_system")).alias("source_system"),
        dataset.alias("source_dataset_name"),
        F.col("source_record_id").cast("string").alias("source_record_id"),
        "customer_pseudo_id",
        "email_hash",
        "phone_hash",
        "standard_email",
        "standard_phone",
        "standard_name",
        "date_of_birth",
        "postal_code",
        "address_text",
        "source_record_hash",
        "_source_file",
        "_ingested_at",
        "_batch_id",
    )


def retention_lookup(policy: DataFrame) -> DataFrame:
    """Policy keyed like identity records; repeated policies stay and fan out the join."""
    return policy.select(
        "source_system",
        F.col("dataset_name").alias("source_dataset_name"),
        "date_column",
        "retention_days",
        "policy_owner",
    )


def join_controls(
    prepared: DataFrame,
    consent_status: DataFrame,
    deletion_requests: DataFrame,
    retention_policy: DataFrame,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    max_policies: int = LOOKUP_MAX_ROWS,
    identity_counts: KeyCounts | None = None,
    consent_counts: KeyCounts | None = None,
) -> DataFrame:
    """Identity with consent, blocking deletion and retention; one shuffle of the identities.

    ``prepared`` comes from storage: the row number drawn there deals its rows in every join, so a
    task that is run again deals them alike. Counts of frequent record keys, where the caller has
    them, save a look at the keys.
    """
    flagged = spread_left_join(
        prepared.withColumn("_row", F.monotonically_increasing_id()),
        RECORD_KEY,
        many=consent_status.select(*CONSENT_COLUMNS),
        unique=[active_deletions(deletion_requests)],
        left_spread_by=F.col("_row"),
        rows_per_task=rows_per_task,
        left_counts=identity_counts,
        many_counts=consent_counts,
    )
    return lookup_left_join(
        flagged,
        retention_lookup(retention_policy),
        DATASET_KEY,
        left_spread_by=F.col("_row"),
        max_rows=max_policies,
        rows_per_task=rows_per_task,
        counted=prepared,
    ).drop("_row")


def with_flags(joined: DataFrame, *, as_of: date | None = None) -> DataFrame:
    """Add blockers, permissions and suppression reasons to identities joined with controls."""
    known = joined.withColumns(
        {
            **{
                flag: F.coalesce(F.col(flag), F.lit(False))
                for flag in (
                    "raw_analytics_consent",
                    "raw_marketing_consent",
                    "has_deletion_request",
                )
            },
            "retention_expired": older_than(
                F.to_date("_ingested_at"), F.col("retention_days"), as_of
            ),
            "has_valid_source_record_id": F.col("source_record_id").isNotNull(),
            "has_match_identifier": match_identifier_present(
                F.col("email_hash"), F.col("phone_hash"), F.col("customer_pseudo_id")
            ),
        }
    ).withColumn(
        "has_valid_identifier", F.col("has_valid_source_record_id") & F.col("has_match_identifier")
    )
    analytics, marketing = F.col("raw_analytics_consent"), F.col("raw_marketing_consent")
    blockers = {
        "deletion": F.col("has_deletion_request"),
        "expired": F.col("retention_expired"),
        "valid": F.col("has_valid_identifier"),
    }
    return known.withColumns(
        {
            "can_process_for_analytics": may_process(analytics, **blockers),
            "can_process_for_marketing": may_process(marketing, **blockers),
            # entity resolution is an analytical use
            "can_process_for_entity_resolution": may_process(analytics, **blockers),
            "suppression_reasons": suppression_reasons(
                analytics=analytics, marketing=marketing, **blockers
            ),
        }
    )


def build_processing_eligibility(
    *,
    identity_candidates: DataFrame,
    consent_status: DataFrame,
    deletion_requests: DataFrame,
    retention_policy: DataFrame,
    as_of: date | None = None,
    run_ts: datetime | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    identity_counts: KeyCounts | None = None,
    consent_counts: KeyCounts | None = None,
) -> DataFrame:
    """Permissions of every identity record with the controls and reasons behind them."""
    joined = join_controls(
        prepare_identity_candidates(identity_candidates),
        consent_status,
        deletion_requests,
        retention_policy,
        rows_per_task=rows_per_task,
        identity_counts=identity_counts,
        consent_counts=consent_counts,
    )
    return with_flags(joined, as_of=as_of).select(
        "source_system",
        "source_dataset_name",
        "source_record_id",
        "customer_pseudo_id",
        "email_hash",
        "phone_hash",
        "standard_email",
        "standard_phone",
        "standard_name",
        "date_of_birth",
        "postal_code",
        "address_text",
        "raw_analytics_consent",
        "raw_marketing_consent",
        "can_process_for_analytics",
        "can_process_for_marketing",
        "has_deletion_request",
        "deletion_request_id",
        "deletion_requested_at",
        "deletion_status",
        F.coalesce("retention_days", F.lit(DEFAULT_RETENTION_DAYS)).alias("retention_days"),
        F.col("date_column").alias("retention_date_column"),
        F.col("policy_owner").alias("retention_policy_owner"),
        "retention_expired",
        "has_valid_source_record_id",
        "has_match_identifier",
        "has_valid_identifier",
        "suppression_reasons",
        F.get("suppression_reasons", F.lit(0)).alias("suppression_reason"),
        "can_process_for_entity_resolution",
        "consent_updated_at",
        "source_record_hash",
        "_source_file",
        "_ingested_at",
        F.col("_batch_id").alias("batch_id"),
        timestamp_column(run_ts).alias("evaluated_at"),
    )


def build_compliance_events(
    processing_eligibility: DataFrame, *, run_ts: datetime | None = None
) -> DataFrame:
    """One suppression event per record and reason; records without a reason have none."""
    concerns_deletion = F.col("event_type") == DELETION_REQUESTED
    return processing_eligibility.select(
        "*", F.explode("suppression_reasons").alias("event_type")
    ).select(
        "source_system",
        "source_dataset_name",
        "source_record_id",
        "customer_pseudo_id",
        "event_type",
        F.lit("SUPPRESSION").alias("event_category"),
        F.when(concerns_deletion, F.col("deletion_request_id")).alias("related_request_id"),
        timestamp_column(run_ts).alias("event_timestamp"),
        "batch_id",
    )


def flag_retention_by_event_date(
    records: DataFrame,
    policy: DataFrame,
    *,
    as_of: date | None = None,
    max_policies: int = LOOKUP_MAX_ROWS,
) -> DataFrame:
    """Retention by the age of the date column that each data set's policy names.

    Adds ``date_column``, ``retention_days``, ``event_date`` and ``retention_expired``. A missing
    or malformed date, or a policy that names no column of the records, is never expired.
    """
    joined = lookup_left_join(
        records, retention_lookup(policy), DATASET_KEY, max_rows=max_policies
    )
    named = F.lower("date_column")
    text = F.coalesce(
        *[F.when(named == name.lower(), quoted(name).cast("string")) for name in records.columns]
    )
    expired = older_than(F.col("event_date"), F.col("retention_days"), as_of)
    return joined.withColumn("event_date", event_day(text)).select(
        *records.columns,
        "date_column",
        F.coalesce("retention_days", F.lit(DEFAULT_RETENTION_DAYS)).alias("retention_days"),
        "event_date",
        F.coalesce(expired, F.lit(False)).alias("retention_expired"),
    )
