"""Deterministic salted pseudonyms and row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pseudora.functions.standardize import collapse_whitespace

# Fixed value: the public development salt that existing development hashes were made with.
LOCAL_DEV_SALT = "LOCAL_DEV_ONLY_REPLACE_WITH_SECRET_SCOPE_VALUE"

# Separator of hashed parts, pseudonym prefix and its number of hex digits.
PART_SEPARATOR = "||"
PSEUDO_ID_PREFIX = "cust_"
PSEUDO_ID_HEX_DIGITS = 24


def resolve_salt(salt: str | None, *, allow_dev_salt: bool = False) -> str:
    """Return the salt to use; a missing or empty one is an error unless opted out of."""
    if salt:
        return salt
    if allow_dev_salt:
        return LOCAL_DEV_SALT
    raise ValueError("a salt is required; pass allow_dev_salt=True for the public development salt")


def canonical_column(value: Column) -> Column:
    """Trimmed lower-case form that is hashed; blank is NULL."""
    return F.nullif(F.lower(F.trim(value.cast("string"))), F.lit(""))


def _salted(payload: Column, salt: str) -> Column:
    # concat gives NULL when the payload is NULL, and so does sha2
    return F.sha2(F.concat(F.lit(salt + PART_SEPARATOR), payload), 256)


def _pseudo_id(digest: Column) -> Column:
    return F.concat(F.lit(PSEUDO_ID_PREFIX), F.substring(digest, 1, PSEUDO_ID_HEX_DIGITS))


def hash_column(value: Column, salt: str) -> Column:
    """SHA-256 of salt and canonical value, NULL for a missing value."""
    return _salted(canonical_column(value), salt)


def build_pseudo_id_column(*values: Column, salt: str) -> Column:
    """Pseudonym over all identifiers together; NULL only if every one is missing."""
    parts = [canonical_column(value) for value in values]
    joint = F.concat_ws(PART_SEPARATOR, *[F.coalesce(part, F.lit("")) for part in parts])
    return F.when(F.coalesce(*parts).isNotNull(), _pseudo_id(_salted(joint, salt)))


def pseudo_id_first_available(*values: Column, salt: str) -> Column:
    """Pseudonym of the first identifier that is present."""
    first = F.coalesce(*[F.lower(collapse_whitespace(value)) for value in values])
    return _pseudo_id(_salted(first, salt))


def record_hash(columns: Sequence[str]) -> Column:
    """Row fingerprint over the named columns in the given order; NULL hashes like ''."""
    parts = [F.coalesce(quoted(name).cast("string"), F.lit("")) for name in columns]
    return F.sha2(F.concat_ws(PART_SEPARATOR, *parts), 256)


def quoted(name: str) -> Column:
    """Column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")
