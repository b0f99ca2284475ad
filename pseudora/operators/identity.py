"""One identity schema for differently shaped customer sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.functions.hashing import build_pseudo_id_column, hash_column, quoted
from pseudora.functions.standardize import (
    empty_string_to_null,
    normalize_email_column,
    normalize_phone_column,
    normalize_postal_code_column,
    normalize_text_column,
)

# Source columns that may hold each field, in order of preference.
FIELD_CANDIDATES = {
    "source_record_id": (
        "source_customer_id",
        "source_record_id",
        "customer_id",
        "crm_customer_id",
        "erp_client_id",
        "client_id",
        "id",
    ),
    "first_name": ("first_name", "given_name", "forename"),
    "last_name": ("last_name", "surname", "family_name"),
    "full_name": ("full_name", "name", "customer_name", "client_name"),
    "email": ("email", "email_address", "contact_email"),
    "phone": (
        "phone",
        "phone_number",
        "phone_number_e164",
        "contact_phone",
        "primary_phone",
        "mobile",
        "mobile_number",
        "mobile_phone",
        "telephone",
        "tel",
    ),
    "date_of_birth": ("date_of_birth", "birth_date", "dob"),
    "postal_code": ("postal_code", "zip", "zip_code"),
    "street": ("address", "street", "street_address"),
    "city": ("city",),
    "country": ("country",),
}


def first_existing_column(df: DataFrame, candidates: Sequence[str]) -> Column:
    """First non-NULL value among the candidates that the table has; NULL if it has none."""
    by_lower_name = {name.lower(): name for name in df.columns}
    present = [by_lower_name[name.lower()] for name in candidates if name.lower() in by_lower_name]
    values = [quoted(name).cast("string") for name in present]
    return F.coalesce(*values) if values else F.lit(None).cast("string")


def build_standardized_customer_df(
    df: DataFrame, *, source_system: str, source_dataset_name: str, pseudonymization_salt: str
) -> DataFrame:
    """Project a raw customer table to the identity schema."""
    raw = {
        field: first_existing_column(df, candidates)
        for field, candidates in FIELD_CANDIDATES.items()
    }
    raw_name = F.coalesce(
        raw["full_name"], F.concat_ws(" ", raw["first_name"], raw["last_name"])
    )
    raw_address = F.concat_ws(" ", raw["street"], raw["city"], raw["country"])
    standard = df.select(
        empty_string_to_null(raw["source_record_id"]).alias("source_record_id"),
        normalize_text_column(raw_name).alias("standard_name"),
        normalize_email_column(raw["email"]).alias("standard_email"),
        normalize_phone_column(raw["phone"]).alias("standard_phone"),
        empty_string_to_null(raw["date_of_birth"]).alias("date_of_birth"),
        normalize_postal_code_column(raw["postal_code"]).alias("postal_code"),
        normalize_text_column(raw_address).alias("address_text"),
        F.col("_record_hash").alias("source_record_hash"),
        "_source_file",
        "_ingested_at",
        "_batch_id",
    )
    identifiers = ("standard_email", "standard_phone", "standard_name", "date_of_birth")
    salt = pseudonymization_salt
    return standard.select(
        F.lit(source_system).alias("source_system"),
        F.lit(source_dataset_name).alias("source_dataset_name"),
        "source_record_id",
        "standard_name",
        "standard_email",
        "standard_phone",
        "date_of_birth",
        "postal_code",
        "address_text",
        hash_column(F.col("standard_email"), salt).alias("email_hash"),
        hash_column(F.col("standard_phone"), salt).alias("phone_hash"),
        build_pseudo_id_column(*map(F.col, identifiers), salt=salt).alias("customer_pseudo_id"),
        "source_record_hash",
        "_source_file",
        "_ingested_at",
        "_batch_id",
    )
