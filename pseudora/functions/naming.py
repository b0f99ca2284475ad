"""Expressions over column and concept names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Name fragments that reveal a type, tried in this order.
TYPE_FRAGMENTS = (
    ("email", ("email",)),
    ("phone", ("phone", "mobile")),
    ("date", ("birth", "dob")),
    ("postal_code", ("postal", "zip")),
    ("name", ("name",)),
    ("address", ("address",)),
)


def infer_simple_type(column_name: Column) -> Column:
    """Guess the type of a column from its name alone."""
    name = F.lower(column_name)
    is_identifier = name.endswith("_id") | (name == "id")
    guess = F.when(is_identifier, F.lit("identifier")).otherwise(F.lit("unknown"))
    for type_name, fragments in reversed(TYPE_FRAGMENTS):
        found = reduce(Column.__or__, [name.contains(fragment) for fragment in fragments])
        guess = F.when(found, F.lit(type_name)).otherwise(guess)
    return guess


def normalize_identifier(value: Column) -> Column:
    """Slug: runs of anything but ASCII letters and digits become one underscore."""
    return F.lower(F.regexp_replace(F.trim(value.cast("string")), r"\P{Alnum}+", "_"))


def grams(column: str, sizes: Sequence[int]) -> Column:
    """Array of the distinct substrings of a text column of the given sizes; the empty one has size 0.

    Its length is at most the number of sizes times that of the text, however long that is.
    """
    parts = []
    for width in sizes:
        starts = f"sequence(1, length({column}) - {width - 1})" if width else "array(1)"
        pieces = f"transform({starts}, k -> substr({column}, k, {width}))"
        parts.append(f"IF(length({column}) >= {width}, {pieces}, CAST(array() AS array<string>))")
    return F.expr(f"array_distinct(concat({', '.join(parts)}))")
