"""Registered queries: one per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pseudora.functions.hashing import (
    build_pseudo_id_column,
    hash_column,
    pseudo_id_first_available,
    record_hash,
)
from pseudora.functions.naming import infer_simple_type, normalize_identifier
from pseudora.functions.rules import older_than, parse_boolean
from pseudora.functions.standardize import (
    empty_string_to_null,
    mask_email,
    match_name,
    normalize_email_column,
    normalize_phone_column,
    normalize_postal_code_column,
    normalize_text_column,
)
from pseudora.operators import (
    bronze,
    controls,
    eligibility,
    identity,
    mapping,
    pairs,
    profiling,
    reports,
)
from pseudora.plans import skew, stages
from pseudora.plans.together import run_together
from pseudora.sources import landing, tables
from workloads.adapter import (
    AS_OF,
    BATCH_ID,
    RUN_TS,
    SALT,
    TABLES,
    VIEWS,
    used_names,
)


class Inputs:
    """The test tables of one scale factor and the source-shaped views over them."""

    schemas: dict[str, StructType] = {}  # by path, so that footers are read once

    def __init__(self, spark: SparkSession, sf_dir: str, query: str):
        # Oracle results are in UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.query, self.folders = query, 0

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in self.schemas:
            self.schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(self.schemas[path]).parquet(path)

    def view(self, name: str) -> DataFrame:
        sql = VIEWS[name]
        for source in used_names(sql, TABLES):
            self.table(source).createOrReplaceTempView(source)
        return self.spark.sql(sql)

    def landed(self, name: str, file: str) -> DataFrame:
        """A view with the technical columns that ingest adds."""
        return self.view(name).select(
            "*",
            F.lit(f"/landing/{file}").alias("_source_file"),
            F.lit(RUN_TS).alias("_ingested_at"),
            F.lit(BATCH_ID).alias("_batch_id"),
        )

    # raw and identity tables

    def crm_bronze(self) -> DataFrame:
        return bronze.add_bronze_metadata(
            self.view("crm"),
            source_system="crm",
            source_file="/landing/crm_customers.csv",
            batch_id=BATCH_ID,
            run_ts=F.to_timestamp("created_at"),
        )

    def erp_bronze(self) -> DataFrame:
        return bronze.add_bronze_metadata(
            self.view("erp"),
            source_system="erp",
            source_file="/landing/erp_clients.csv",
            batch_id=BATCH_ID,
            run_ts=F.to_timestamp("registered_at"),
        )

    def crm_identity(self) -> DataFrame:
        return identity.build_standardized_customer_df(
            self.crm_bronze(),
            source_system="crm",
            source_dataset_name="crm_customers",
            pseudonymization_salt=SALT,
        )

    def identities(self) -> DataFrame:
        erp = identity.build_standardized_customer_df(
            self.erp_bronze(),
            source_system="erp",
            source_dataset_name="erp_clients",
            pseudonymization_salt=SALT,
        )
        return self.crm_identity().unionByName(erp)

    # controls

    def consents(self, name: str = "consents_raw") -> DataFrame:
        return controls.build_consent_status(self.landed(name, "consents.csv"), run_ts=RUN_TS)

    def deletions(self) -> DataFrame:
        raw = self.landed("deletions_raw", "deletions.csv")
        return controls.build_deletion_requests(raw, run_ts=RUN_TS)

    def policy(self) -> DataFrame:
        raw = self.landed("policies_raw", "policies.csv")
        return controls.build_retention_policy(raw, run_ts=RUN_TS)

    def prepared(self) -> DataFrame:
        return eligibility.prepare_identity_candidates(self.identities())

    def eligibility(self) -> DataFrame:
        return eligibility.build_processing_eligibility(
            identity_candidates=self.identities(),
            consent_status=self.consents(),
            deletion_requests=self.deletions(),
            retention_policy=self.policy(),
            as_of=AS_OF,
            run_ts=RUN_TS,
        )

    # metadata

    def catalog_profile(self) -> DataFrame:
        return self.view("column_catalog").withColumn(
            "inferred_type", infer_simple_type(F.col("column_name"))
        )

    def candidates(self) -> DataFrame:
        return mapping.build_semantic_mapping_candidates(
            self.catalog_profile(), self.view("concepts"), batch_id=BATCH_ID, run_ts=RUN_TS
        )

    def profile(self, df: DataFrame, table_name: str) -> DataFrame:
        return profiling.profile_columns(
            df,
            source_system="test",
            table_name=table_name,
            columns=df.columns,
            batch_id=BATCH_ID,
            run_ts=RUN_TS,
        )

    # stored intermediate results

    def folder(self) -> str:
        """The query's next folder; calling the query again uses the same ones."""
        self.folders += 1
        return f"{tables.shared_folder(self.spark)}/{self.query}-{self.folders}"

    def stored(self, df: DataFrame) -> DataFrame:
        """The DataFrame written to the shared folder and read back, as between stages."""
        path = self.folder()
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    def run(self) -> stages.Run:
        """Stage parameters with schemas of their own in the shared folder."""
        tag = self.query
        layout = stages.Layout(
            bronze=f"bronze_{tag}",
            metadata=f"metadata_{tag}",
            silver=f"silver_{tag}",
            compliance=f"compliance_{tag}",
        )
        layout.create_schemas(self.spark, tables.shared_folder(self.spark))
        return stages.Run(layout=layout, batch_id=BATCH_ID, run_ts=RUN_TS, as_of=AS_OF)

    def land(self, name: str, folder: str, file: str) -> None:
        """Write a view as a headered landing CSV, outer spaces kept."""
        self.view(name).write.csv(
            f"{folder}/{file}.csv",
            mode="overwrite",
            header=True,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )

    def stored_customers(self, run: stages.Run) -> None:
        run.write(self.crm_bronze(), "bronze", "crm_customers_raw")
        run.write(self.erp_bronze(), "bronze", "erp_clients_raw")


def plain(df: DataFrame) -> DataFrame:
    """Timestamps and arrays as text, so that results compare across engines."""
    shown = {}
    for name, kind in df.dtypes:
        if kind in ("timestamp", "date", "timestamp_ntz"):
            shown[name] = F.col(name).cast("string")
        elif kind.startswith("array"):
            shown[name] = F.array_join(name, ",")
    return df.withColumns(shown) if shown else df


# --- ingest -----------------------------------------------------------------------------------


def bronze_ingest(i: Inputs) -> DataFrame:
    run, folder = i.run(), i.folder()
    i.land("crm", folder, "crm_customers")
    spec = landing.BronzeIngestSpec(
        "crm", folder + "/", "crm_customers.csv", run.layout.table("bronze", "crm_customers_raw")
    )
    landing.ingest_csv_to_bronze(spark=i.spark, spec=spec, batch_id=BATCH_ID, run_ts=RUN_TS)
    return i.spark.table(spec.target_table).withColumn(
        "_source_file", F.substring_index("_source_file", "/", -1)
    )


def ingest_csv_roundtrip(i: Inputs) -> DataFrame:
    folder = i.folder()
    i.land("erp", folder, "erp_clients")
    return landing.read_landing_csv(i.spark, f"{folder}/erp_clients.csv")


def table_overwrite_roundtrip(i: Inputs) -> DataFrame:
    """A table of orders replaced by one of customers, schema included."""
    target = i.run().layout.table("bronze", "replaced")
    tables.write_table(i.table("orders"), target)
    return tables.write_table(i.view("crm"), target)


def catalog_inventory(i: Inputs) -> DataFrame:
    """Raw tables that the catalog lists, with their row counts."""
    run = i.run()
    i.stored_customers(run)
    names = ("crm_customers_raw", "erp_clients_raw")
    counts = reports.bronze_counts(
        {name: i.spark.table(run.layout.table("bronze", name)) for name in names}
    )
    listed = tables.table_inventory(i.spark, f"{run.layout.catalog}.{run.layout.bronze}")
    return listed.select("table_name").join(counts, "table_name", "left")


def bronze_counts(i: Inputs) -> DataFrame:
    return reports.bronze_counts(
        {"crm_customers_raw": i.crm_bronze(), "erp_clients_raw": i.erp_bronze()}
    )


def row_fingerprints(i: Inputs) -> DataFrame:
    lines = i.table("lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", record_hash(lines.columns).alias("hash")
    )


# --- expressions ------------------------------------------------------------------------------


def std_empty_to_null(i: Inputs) -> DataFrame:
    return i.view("crm").select(
        "last_name",
        empty_string_to_null(F.col("crm_customer_id")).alias("record_id"),
        empty_string_to_null(F.col("email")).alias("email"),
    )


def std_email(i: Inputs) -> DataFrame:
    return i.view("crm").select(
        "last_name", normalize_email_column(F.col("email")).alias("standard_email")
    )


def std_phone(i: Inputs) -> DataFrame:
    return i.view("crm").select(
        "last_name",
        "phone",
        normalize_phone_column(F.col("phone")).alias("standard_phone"),
        normalize_phone_column(F.col("phone"), "49").alias("german_phone"),
    )


def std_text(i: Inputs) -> DataFrame:
    return i.table("documents").select(
        "doc_id", normalize_text_column(F.col("text")).alias("standard_text")
    )


def std_postal(i: Inputs) -> DataFrame:
    return i.view("crm").select(
        "last_name",
        normalize_postal_code_column(F.col("postal_code")).alias("postal_code"),
        normalize_postal_code_column(F.col("street")).alias("packed_street"),
    )


def parse_boolean_words(i: Inputs) -> DataFrame:
    return i.view("consents_raw").select(
        "source_customer_id",
        parse_boolean(F.col("analytics_consent")).alias("analytics"),
        parse_boolean(F.col("marketing_consent")).alias("marketing"),
    )


def infer_type(i: Inputs) -> DataFrame:
    return i.view("column_catalog").select(
        "row_count", "column_name", infer_simple_type(F.col("column_name")).alias("inferred_type")
    )


def slugs(i: Inputs) -> DataFrame:
    names = i.view("column_catalog").select(F.col("column_name").alias("name"))
    return names.union(i.table("documents").select("text")).select(
        "name", normalize_identifier(F.col("name")).alias("slug")
    )


def match_names(i: Inputs) -> DataFrame:
    texts = i.table("documents").select(F.col("doc_id").alias("id"), "text")
    names = i.view("crm").select(F.lit(-1).cast("bigint"), "last_name")
    return texts.union(names).select("id", match_name(F.col("text")).alias("match_name"))


def mask_emails(i: Inputs) -> DataFrame:
    # a page address with an '@' put in stands for text that is hardly an e-mail
    odd = i.table("pages").select(
        F.col("url").alias("address"), F.replace("url", F.lit("."), F.lit("@")).alias("email")
    )
    crm = i.view("crm").select("last_name", "email")
    return crm.union(odd).select(
        F.col("last_name").alias("owner"), mask_email(F.col("email")).alias("masked")
    )


def hash_identifiers(i: Inputs) -> DataFrame:
    return i.view("crm").select(
        "last_name",
        hash_column(normalize_email_column(F.col("email")), SALT).alias("email_hash"),
        hash_column(normalize_phone_column(F.col("phone")), SALT).alias("phone_hash"),
        hash_column(F.col("last_name"), SALT).alias("name_hash"),
    )


def pseudo_id(i: Inputs) -> DataFrame:
    columns = map(F.col, ("email", "phone", "crm_customer_id"))
    return i.view("crm").select(
        "last_name", build_pseudo_id_column(*columns, salt=SALT).alias("pseudo_id")
    )


def pseudo_id_first(i: Inputs) -> DataFrame:
    columns = map(F.col, ("email", "phone", "last_name"))
    return i.view("crm").select(
        "last_name", pseudo_id_first_available(*columns, salt=SALT).alias("pseudo_id")
    )


def first_existing(i: Inputs) -> DataFrame:
    crm = i.view("crm")
    return crm.select(
        "last_name",
        identity.first_existing_column(crm, ["e_mail", "EMAIL", "phone", "Country"]).alias("first"),
        identity.first_existing_column(crm, ["fax", "telex"]).alias("none"),
    )


# --- profiling --------------------------------------------------------------------------------


def profile_null_stats(i: Inputs) -> DataFrame:
    return i.profile(i.crm_bronze(), "crm").select(
        "column_name", "row_count", "null_count", "null_rate"
    )


def profile_distinct_stats(i: Inputs) -> DataFrame:
    names = ("lineitem", "embeddings", "events")
    profiles = run_together(i.spark, [partial(i.profile, i.table(name), name) for name in names])
    found = [p.select("table_name", "column_name", "distinct_count", "distinct_rate") for p in profiles]
    return reduce(DataFrame.unionByName, found)


def profile_length_stats(i: Inputs) -> DataFrame:
    return i.profile(i.table("documents"), "documents").select(
        "column_name", "min_length", "max_length", "avg_length"
    )


def profile_sample_values(i: Inputs) -> DataFrame:
    return i.profile(i.table("orders"), "orders").select("column_name", "sample_values")


def profile_column(i: Inputs) -> DataFrame:
    return profiling.profile_column(
        df=i.table("documents"),
        source_system="test",
        table_name="documents",
        column_name="text",
        batch_id=BATCH_ID,
        run_ts=RUN_TS,
    )


def profile_table(i: Inputs) -> DataFrame:
    run = i.run()
    i.stored_customers(run)
    name = "crm_customers_raw"
    spec = profiling.SourceTableSpec("crm", name, run.layout.table("bronze", name))
    return profiling.profile_table(spark=i.spark, spec=spec, batch_id=BATCH_ID, run_ts=RUN_TS)


def profile_sources(i: Inputs) -> DataFrame:
    run = i.run()
    i.stored_customers(run)
    return stages.run_profiling(i.spark, run)


def profile_summary(i: Inputs) -> DataFrame:
    return reports.profile_summary(profile_sources(i))


def profile_report(i: Inputs) -> DataFrame:
    return reports.profile_report(profile_sources(i))


# --- mapping ----------------------------------------------------------------------------------


def mapping_match_flags(i: Inputs) -> DataFrame:
    return mapping.match_flags(i.catalog_profile(), i.view("concepts"))


def mapping_candidates(i: Inputs) -> DataFrame:
    return i.candidates()


def mapping_decisions(i: Inputs) -> DataFrame:
    return mapping.build_mapping_decisions(i.candidates())


def semantic_mapping_stage(i: Inputs) -> DataFrame:
    run = i.run()
    i.stored_customers(run)
    stages.run_profiling(i.spark, run)
    run.write(i.view("concepts"), "bronze", "semantic_concepts_raw")
    table = run.layout.table
    return stages.run_semantic_mapping(
        spark=i.spark,
        profile_table=table("metadata", "source_column_profile"),
        concepts_table=table("bronze", "semantic_concepts_raw"),
        candidates_table=table("metadata", "semantic_mapping_candidates"),
        decisions_table=table("metadata", "mapping_decisions"),
        batch_id=BATCH_ID,
        run_ts=RUN_TS,
    )


def concept_dump(i: Inputs) -> DataFrame:
    run = i.run()
    run.write(i.view("concepts"), "bronze", "semantic_concepts_raw")
    return i.spark.table(run.layout.table("bronze", "semantic_concepts_raw"))


def decision_report(i: Inputs) -> DataFrame:
    return reports.decision_report(mapping.build_mapping_decisions(i.candidates()))


# --- identity ---------------------------------------------------------------------------------


def prepare_identity_derived_dataset(i: Inputs) -> DataFrame:
    return eligibility.prepare_identity_candidates(
        i.identities().drop("source_dataset_name")
    )


# --- compliance -------------------------------------------------------------------------------


def identifier_validity(i: Inputs) -> DataFrame:
    return i.eligibility().select(
        "source_record_hash",
        "has_valid_source_record_id",
        "has_match_identifier",
        "has_valid_identifier",
    )


def consent_left_join(i: Inputs, rows_per_task: int = skew.ROWS_PER_TASK) -> DataFrame:
    """Identities with repeated consents: each repetition yields a row."""
    return skew.spread_left_join(
        i.prepared(),
        controls.RECORD_KEY,
        many=i.consents("consents_repeated").select(*eligibility.CONSENT_COLUMNS),
        rows_per_task=rows_per_task,
    ).select(
        "source_system",
        "source_record_id",
        "source_record_hash",
        "raw_analytics_consent",
        "raw_marketing_consent",
        "consent_updated_at",
    )


def deletion_left_join(i: Inputs) -> DataFrame:
    return skew.spread_left_join(
        i.prepared(), controls.RECORD_KEY, unique=[controls.active_deletions(i.deletions())]
    ).select(
        "source_system",
        "source_record_id",
        "source_record_hash",
        "deletion_request_id",
        "has_deletion_request",
        "deletion_requested_at",
        "deletion_status",
    )


def retention_left_join(i: Inputs, max_rows: int = skew.LOOKUP_MAX_ROWS) -> DataFrame:
    return skew.lookup_left_join(
        i.prepared(),
        eligibility.retention_lookup(i.policy()),
        eligibility.DATASET_KEY,
        max_rows=max_rows,
    ).select(
        "source_system",
        "source_dataset_name",
        "source_record_hash",
        "date_column",
        "retention_days",
        "policy_owner",
    )


def retention_expired_ingest(i: Inputs) -> DataFrame:
    joined = skew.lookup_left_join(
        i.prepared(), eligibility.retention_lookup(i.policy()), eligibility.DATASET_KEY
    )
    expired = older_than(F.to_date("_ingested_at"), F.col("retention_days"), AS_OF)
    return joined.select("source_record_hash", expired.alias("retention_expired"))


def retention_expired_event_date(i: Inputs) -> DataFrame:
    crm = i.view("crm").selectExpr(
        "'crm' AS source_system",
        "'crm_customers' AS source_dataset_name",
        "last_name AS owner",
        "created_at",
        "updated_at",
    )
    erp = i.view("erp").selectExpr(
        "'erp' AS source_system",
        "'erp_clients' AS source_dataset_name",
        "erp_client_id AS owner",
        "last_invoice_at",
    )
    records = crm.unionByName(erp, allowMissingColumns=True)
    return eligibility.flag_retention_by_event_date(records, i.policy(), as_of=AS_OF)


def eligibility_flags(i: Inputs) -> DataFrame:
    return i.eligibility().select(
        "source_record_hash",
        "raw_analytics_consent",
        "raw_marketing_consent",
        "has_deletion_request",
        "retention_expired",
        "has_valid_identifier",
        "can_process_for_analytics",
        "can_process_for_marketing",
        "can_process_for_entity_resolution",
    )


def suppression_reasons(i: Inputs) -> DataFrame:
    return i.eligibility().select(
        "source_record_hash", "suppression_reasons", "suppression_reason"
    )


def compliance_events(i: Inputs) -> DataFrame:
    return eligibility.build_compliance_events(i.eligibility(), run_ts=RUN_TS)


def compliance_stage(i: Inputs) -> DataFrame:
    """Stage 05 over stored tables; returns the stored events."""
    run = i.run()
    run.write(i.identities(), "silver", "customer_identity_candidates")
    for view, name in (
        ("consents_raw", "consent_preferences"),
        ("deletions_raw", "deletion_requests"),
        ("policies_raw", "data_retention_policy"),
    ):
        run.write(i.landed(view, f"{name}.csv"), "bronze", f"{name}_raw")
    return stages.run_compliance_controls(i.spark, run)


def eligibility_report(i: Inputs) -> DataFrame:
    return reports.eligibility_report(i.stored(i.eligibility()))


def all_stages(i: Inputs) -> DataFrame:
    """Stages 01 to 05 from landing CSVs; returns the stored eligibility without file names."""
    run, folder = i.run(), i.folder()
    for view, name in (
        ("crm", "crm_customers"),
        ("erp", "erp_clients"),
        ("concepts", "semantic_concepts"),
        ("consents_raw", "consent_preferences"),
        ("deletions_raw", "deletion_requests"),
        ("policies_raw", "data_retention_policy"),
    ):
        i.land(view, folder, name)
    paths = {system: folder for system, _ in stages.LANDING_FILES}
    return stages.run_all(i.spark, run, paths, salt=SALT).drop("_source_file")


# --- resolution -------------------------------------------------------------------------------


def identifier_links(i: Inputs) -> DataFrame:
    return pairs.link_identifiers(i.stored(i.eligibility()))


def block_pairs(i: Inputs, *, every: bool = False, scored: bool = False) -> DataFrame:
    return pairs.block_pairs(i.stored(i.eligibility()), every=every, scored=scored)


PAIR_KEY = (
    "left_source_system",
    "left_source_record_id",
    "right_source_system",
    "right_source_record_id",
)


def _scored(i: Inputs, *columns: str, every: bool = False) -> DataFrame:
    return pairs.score_pairs(block_pairs(i, every=every, scored=True)).select(*PAIR_KEY, *columns)


def labelled_pair_scores(i: Inputs) -> DataFrame:
    """Given pairs, a third of them with one and the same record, scored against their label."""
    found = pairs.attach_pair_records(i.view("labelled_pairs"), i.identities())
    return pairs.score_pairs(found).select(
        *PAIR_KEY, "expected_decision", "score", "match_class", "deterministic_match"
    )


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "bronze_ingest": bronze_ingest,
    "bronze_metadata": Inputs.crm_bronze,
    "record_hash": row_fingerprints,
    "ingest_csv_roundtrip": ingest_csv_roundtrip,
    "table_overwrite_roundtrip": table_overwrite_roundtrip,
    "catalog_inventory": catalog_inventory,
    "bronze_counts": bronze_counts,
    "std_empty_to_null": std_empty_to_null,
    "std_email": std_email,
    "std_phone": std_phone,
    "std_text": std_text,
    "std_postal": std_postal,
    "parse_boolean": parse_boolean_words,
    "infer_type": infer_type,
    "normalize_identifier": slugs,
    "match_name": match_names,
    "mask_email": mask_emails,
    "hash_identifiers": hash_identifiers,
    "pseudo_id": pseudo_id,
    "pseudo_id_first_available": pseudo_id_first,
    "first_existing_column": first_existing,
    "profile_null_stats": profile_null_stats,
    "profile_distinct_stats": profile_distinct_stats,
    "profile_length_stats": profile_length_stats,
    "profile_sample_values": profile_sample_values,
    "profile_column": profile_column,
    "profile_table": profile_table,
    "profile_sources": profile_sources,
    "profile_summary": profile_summary,
    "profile_report": profile_report,
    "mapping_match_flags": mapping_match_flags,
    "mapping_candidates": mapping_candidates,
    "mapping_decisions": mapping_decisions,
    "semantic_mapping_stage": semantic_mapping_stage,
    "concept_dump": concept_dump,
    "decision_report": decision_report,
    "standardize_customers": Inputs.crm_identity,
    "identity_candidates": Inputs.identities,
    "prepare_identity_derived_dataset": prepare_identity_derived_dataset,
    "consent_status": Inputs.consents,
    "deletion_requests": Inputs.deletions,
    "retention_policy": Inputs.policy,
    "active_deletions": lambda i: controls.active_deletions(i.deletions()),
    "identifier_validity": identifier_validity,
    "consent_left_join": consent_left_join,
    # Limits low enough that the ways for large keys and large lookups are taken at any scale.
    "consent_join_cut_keys": lambda i: consent_left_join(i, rows_per_task=20),
    "retention_join_large_lookup": lambda i: retention_left_join(i, max_rows=1),
    "deletion_left_join": deletion_left_join,
    "retention_left_join": retention_left_join,
    "retention_expired_ingest": retention_expired_ingest,
    "retention_expired_event_date": retention_expired_event_date,
    "eligibility_flags": eligibility_flags,
    "suppression_reasons": suppression_reasons,
    "processing_eligibility": Inputs.eligibility,
    "compliance_events": compliance_events,
    "compliance_stage": compliance_stage,
    "eligibility_report": eligibility_report,
    "all_stages": all_stages,
    "identifier_links": identifier_links,
    "block_pairs": block_pairs,
    "pair_text_similarity": lambda i: _scored(i, "name_score", "address_score"),
    "pair_exact_features": lambda i: _scored(i, "date_of_birth_score", "postal_code_score", every=True),
    "pair_weighted_score": lambda i: _scored(i, "score", every=True),
    "pair_classification": lambda i: _scored(i, "match_class", "deterministic_match", every=True),
    "labelled_pair_scores": labelled_pair_scores,
}


def _registered(name: str, build: Callable[[Inputs], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(build(Inputs(spark, sf_dir, name)))

    return query


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _registered(name, build) for name, build in QUERIES.items()}
