"""Column functions against fixed vectors and plain Python definitions."""

from __future__ import annotations

import hashlib
import re
import unicodedata
from datetime import date

import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pseudora.functions import hashing, lcs, naming, rules, similarity, standardize


def test_blank_and_text(evaluate):
    values = [" Ota \t  Vrba  ", "   ", "", None, "\tA\t", "Ż  Ó"]
    assert evaluate(standardize.empty_string_to_null, values) == [
        "Ota \t  Vrba", None, None, None, "\tA\t", "Ż  Ó",
    ]
    assert evaluate(standardize.normalize_text_column, values) == [
        "ota vrba", None, None, None, " a ", "ż ó",
    ]
    assert evaluate(standardize.collapse_whitespace, [" a \tb ", "　", None]) == [
        "a b", None, None,
    ]


def test_email_and_postal_code(evaluate):
    assert evaluate(
        standardize.normalize_email_column, [" Ota+List@Mail.TEST ", "  ", None]
    ) == ["ota+list@mail.test", None, None]
    assert evaluate(
        standardize.normalize_postal_code_column, ["7 79  00", " 110-00 ", "ab 1c", " ", None]
    ) == ["77900", "110-00", "AB1C", None, None]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("733 919 828", "+48733919828"),
        ("+420 733-919-828", "+420733919828"),
        ("0049 30 5556677", "+49305556677"),
        ("001234567", "+48001234567"),
        ("12345", "+12345"),
        (" (41) 77-88", "+417788"),
        ("00", "+"),
        ("", None),
        ("+", None),
        ("n/a", None),
        (None, None),
        ("00" + "1" * 120, "+" + "1" * 120),
    ],
)
def test_phone(evaluate, raw, expected):
    assert evaluate(standardize.normalize_phone_column, [raw]) == [expected]


def folded(text: str) -> str | None:
    plain = unicodedata.normalize("NFKD", re.sub(r"\s+", " ", text.strip()))
    plain = "".join(c for c in plain if not unicodedata.combining(c))
    kept = re.sub("[^A-Za-z0-9 -]", "", plain).upper()
    return " ".join(kept.split()) or None


def test_match_name(evaluate):
    values = ["  Łucja  Ønský ", "Łódź", "O'Neil-Smith", "ﬁn ½", "´ ´", "\x01a\x01", "Ⅳ"]
    expected = ["UCJA NSKY", "ODZ", "ONEIL-SMITH", "FIN 12", None, "A", "IV"]
    assert evaluate(standardize.match_name, values) == expected
    assert [folded(v) for v in values] == expected
    assert evaluate(standardize.match_name, [None, " "]) == [None, None]


def test_match_name_on_every_character_of_the_first_planes(evaluate):
    chars = [chr(c) for c in range(1, 0x30000) if not 0xD800 <= c <= 0xDFFF]
    texts = ["a" + c + "b" for c in chars]
    assert evaluate(standardize.match_name, texts) == [folded(t) for t in texts]


def test_mask_email(evaluate):
    values = ["otto@mail.test", " A@x.pl ", "no mail", "a@b@c", "@x", "AB@x", None, ""]
    assert evaluate(standardize.mask_email, values) == [
        "ot***@mail.test", "****@x.pl", None, "****@b@c", "****@x", "ab***@x", None, None,
    ]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_hashes(spark, evaluate):
    def salted(value):
        return hashing.hash_column(value, "s")

    assert evaluate(salted, ["ABC", " abc ", "", None]) == [sha("s||abc")] * 2 + [None] * 2
    assert evaluate(lambda v: hashing.hash_column(v, "t"), ["abc"]) == [sha("t||abc")]

    df = spark.createDataFrame([(" A", None), (None, "b  c"), (None, " ")], "x string, y string")
    x, y = F.col("x"), F.col("y")
    rows = df.select(
        hashing.build_pseudo_id_column(x, y, salt="s").alias("joint"),
        hashing.pseudo_id_first_available(x, y, salt="s").alias("first"),
        hashing.record_hash(["x", "y"]).alias("record"),
    ).collect()
    assert [r.joint for r in rows] == [
        "cust_" + sha("s||a||")[:24], "cust_" + sha("s||||b  c")[:24], None,
    ]
    assert [r.first for r in rows] == [
        "cust_" + sha("s||a")[:24], "cust_" + sha("s||b c")[:24], None,
    ]
    assert [r.record for r in rows] == [sha(" A||"), sha("||b  c"), sha("|| ")]


def test_salt_is_required():
    assert hashing.resolve_salt("x") == "x"
    for missing in (None, ""):
        with pytest.raises(ValueError, match="salt"):
            hashing.resolve_salt(missing)
        assert hashing.resolve_salt(missing, allow_dev_salt=True) == hashing.LOCAL_DEV_SALT


def test_names(evaluate):
    names = [
        "Email_Address", "mobile_no", "date_of_birth", "DOB", "zip", "client_full_name",
        "street_address", "customer_id", "id", "valid", "created_at",
    ]
    assert evaluate(naming.infer_simple_type, names) == [
        "email", "phone", "date", "date", "postal_code", "name", "address", "identifier",
        "identifier", "unknown", "unknown",
    ]
    assert evaluate(naming.normalize_identifier, [" Full  Name ", "a--b", "%%", "ż", None]) == [
        "full_name", "a_b", "_", "_", None,
    ]
    (pieces, empty) = evaluate(lambda v: naming.grams("v", (0, 1, 2)), ["abab", ""])
    assert sorted(pieces) == ["", "a", "ab", "b", "ba"]
    assert empty == [""]
    sizes = evaluate(lambda v: F.size(naming.grams("v", (1, 4, 8))), ["".join(map(chr, range(97, 97 + n))) for n in (200, 2000)])
    assert 9 < sizes[1] / sizes[0] < 11


def test_booleans(evaluate):
    values = [" YES ", "true", "1", "y", "no", "maybe", "", None]
    assert evaluate(rules.parse_boolean, values) == [True] * 4 + [False] * 4


def test_event_day_and_age(evaluate):
    same = ["2024-01-31", "2024-01-31T23:30:00-05:00", "20240131", " 2024-01-31 ", "20240131T2330Z", "2024-W05-3", "2024W053"]
    assert evaluate(rules.event_day, same) == [date(2024, 1, 31)] * len(same)
    other = ["2024-13-01", "x", "", None, "2024", "2024-0131", "2024-01-31T25:00", "2024-01-31 and more", "2023-W53-1", "2024-W00"]
    assert evaluate(rules.event_day, other) == [None] * len(other)
    assert evaluate(rules.event_day, ["2020-W53-7", "2026-W01-1", "2024-01-01x10:00:00.5"]) == [
        date(2021, 1, 3), date(2025, 12, 29), date(2024, 1, 1),
    ]

    def expired(value):
        return rules.older_than(value.cast("date"), F.lit(30), date(2024, 3, 1))

    assert evaluate(expired, ["2024-01-31", "2024-01-30", None]) == [False, True, None]


@pytest.mark.parametrize("deletion", [True, False])
@pytest.mark.parametrize("expired", [True, False, None])
@pytest.mark.parametrize("valid", [True, False])
def test_permissions_and_reasons(spark, deletion, expired, valid):
    df = spark.createDataFrame(
        [(a, m, deletion, expired, valid) for a in (True, False) for m in (True, False)],
        "a boolean, m boolean, d boolean, e boolean, v boolean",
    )
    a, m, d, e, v = map(F.col, "amdev")
    rows = df.select(
        "a",
        "m",
        rules.may_process(a, d, e, v).alias("analytics"),
        rules.suppression_reasons(analytics=a, marketing=m, deletion=d, expired=e, valid=v).alias(
            "reasons"
        ),
    ).collect()
    blocked = True if deletion or not valid else expired
    for row in rows:
        allowed = False if not row.a or blocked else (None if blocked is None else True)
        assert row.analytics is allowed
        wanted = [
            (deletion, "DELETION_REQUESTED"),
            (expired, "RETENTION_EXPIRED"),
            (not valid, "INVALID_IDENTIFIER"),
            (not row.a, "NO_ANALYTICS_CONSENT"),
            (not row.m, "NO_MARKETING_CONSENT"),
        ]
        assert row.reasons == [reason for applies, reason in wanted if applies]


def lcs_by_table(a: str, b: str) -> int:
    row = [0] * (len(a) + 1)
    for y in b:
        new = [0]
        for i, x in enumerate(a):
            new.append(row[i] + 1 if x == y else max(row[i + 1], new[-1]))
        row = new
    return row[-1]


TEXT = st.one_of(
    st.none(), st.text("abcé😀 ", max_size=12), st.text("ab", min_size=60, max_size=140)
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=20))
def test_lcs_lengths(pairs):
    left = pd.Series([p[0] for p in pairs], dtype=object)
    right = pd.Series([p[1] for p in pairs], dtype=object)
    expected = [None if None in p else lcs_by_table(*p) for p in pairs]
    got = [None if pd.isna(x) else int(x) for x in lcs.lcs_lengths(left, right)]
    assert got == expected


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), max_size=30), st.sampled_from([0, 40, 10**6]))
def test_lcs_of_batches_and_tables_of_any_size(pairs, table):
    """Repeated texts are read once, and a table too large is not made."""
    pairs = pairs + [(b, a) for a, b in pairs] + pairs
    expected = [None if None in p else lcs_by_table(*p) for p in pairs]
    left, right = (pa.array([p[k] for p in pairs], type=pa.string()) for k in (0, 1))
    most, lcs._TABLE = lcs._TABLE, table
    try:
        assert lcs.lcs_column.func(left, right).to_pylist() == expected
    finally:
        lcs._TABLE = most


def test_similarities(spark):
    rows = [
        ("Věra Müllerová", "mullerova  VERA", 1.0),
        ("tř. Míru 9", "Míru 9", None),
        ("", "x", 0.0),
        (None, "x", 0.0),
        ("łł", "łł", 0.0),
    ]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "a string, b string")
    a, b = F.col("a"), F.col("b")
    got = df.select(
        similarity.name_similarity(a, b).alias("name"),
        similarity.text_similarity(a, b).alias("text"),
        similarity.exact_or_zero(a, b).alias("same"),
    ).collect()
    assert [r.name for r, (_, _, want) in zip(got, rows, strict=True) if want is not None] == [
        want for _, _, want in rows if want is not None
    ]
    assert got[1].text == pytest.approx(0.75)
    assert [r.same for r in got] == [0.0, 0.0, 0.0, 0.0, 1.0]


def test_postal_code_similarity(spark):
    df = spark.createDataFrame([("ab 1", "AB1"), ("00-001", "00001"), (None, None)], "a string, b string")
    got = df.select(similarity.postal_code_similarity(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r.s for r in got] == [1.0, 0.0, 0.0]


def test_rounding_equals_exact_decimal_rounding(spark):
    values = [k / 1e5 for k in range(0, 100001)] + [k / 77777 for k in range(0, 77777, 7)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", similarity.round_half_even(F.col("v"), 4).alias("r")).collect()
    assert [r.r for r in rows] == [round(r.v, 4) for r in rows]


def test_weights_and_classes(spark):
    one = F.lit(1.0)
    score = similarity.weighted_customer_similarity(
        name=one, date_of_birth=one, postal_code=one, address=one
    )
    assert spark.range(1).select(score.alias("s")).first().s == 1.0
    df = spark.createDataFrame([(0.95,), (0.92,), (0.80,), (0.75,), (0.40,)], "s double")
    got = [r.c for r in df.select(similarity.classify_match(F.col("s")).alias("c")).collect()]
    assert got == ["MATCH", "MATCH", "REVIEW_REQUIRED", "REVIEW_REQUIRED", "NO_MATCH"]
