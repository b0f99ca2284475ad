"""Standardization of contact and identity values as native Column expressions."""

from __future__ import annotations

import re
import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace code points that count as a separator, the same set that
# Unicode text processing uses (Java's plain \s is ASCII only).
UNICODE_WHITESPACE = (
    "\\t-\\r\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
)

_NAME_KEEPS = re.compile("[A-Za-z0-9 -]")
_EXPANDS = "\x01"


def empty_string_to_null(value: Column) -> Column:
    """Trim spaces; a value with nothing left is NULL."""
    return F.nullif(F.trim(value.cast("string")), F.lit(""))


def normalize_email_column(value: Column) -> Column:
    return F.lower(empty_string_to_null(value))


def normalize_phone_column(value: Column, default_country_code: str = "48") -> Column:
    """International form ``+<digits>``; nine bare digits are read as a national number.

    The order of the rules matters: a leading plus wins over the length rule, and the length
    rule wins over the ``00`` prefix, so ``001234567`` is a national number.
    """
    text = F.trim(value.cast("string"))
    digits = F.regexp_replace(text, r"\D+", "")
    subscriber = (
        F.when(text.startswith("+"), digits)
        .when(F.length(digits) == 9, F.concat(F.lit(default_country_code), digits))
        .when(digits.startswith("00"), F.substr(digits, F.lit(3)))
        .otherwise(digits)
    )
    return F.when(digits != "", F.concat(F.lit("+"), subscriber))


def normalize_text_column(value: Column) -> Column:
    """Lower case with inner whitespace runs collapsed; accents stay."""
    single_spaced = F.regexp_replace(F.trim(value.cast("string")), r"\s+", " ")
    return F.nullif(F.lower(single_spaced), F.lit(""))


def normalize_postal_code_column(value: Column) -> Column:
    """Upper case without whitespace; hyphens stay."""
    packed = F.regexp_replace(F.trim(value.cast("string")), r"\s+", "")
    return F.nullif(F.upper(packed), F.lit(""))


def collapse_whitespace(value: Column) -> Column:
    """Trim and collapse every Unicode whitespace run to one space; blank is NULL."""
    spaced = F.regexp_replace(value.cast("string"), f"[{UNICODE_WHITESPACE}]+", " ")
    return F.nullif(F.trim(spaced), F.lit(""))


@cache
def _ascii_forms() -> tuple[str, str, dict[str, str]]:
    """Derive, from the Unicode database, what each non-ASCII character leaves in a match name.

    Returns the two aligned strings for ``translate`` and a dictionary of the characters that
    leave several, such as ligatures; ``translate`` turns those into a mark.
    """
    source, target, longer = [], [], {}
    for code_point in range(sys.maxunicode + 1):
        char = chr(code_point)
        if char == " " or 0xD800 <= code_point <= 0xDFFF:
            continue
        if char.isspace():
            source.append(char)
            target.append(" ")
            continue
        if code_point < 0x80:
            continue
        kept = "".join(_NAME_KEEPS.findall(unicodedata.normalize("NFKD", char)))
        if len(kept) == 1:
            source.append(char)
            target.append(kept)
        elif kept:
            source.append(char)
            target.append(_EXPANDS)
            longer[char] = kept
    return "".join(source), "".join(target), longer


def match_name(value: Column) -> Column:
    """Name form for matching: no accents, only ``A-Z 0-9`` space and hyphen, upper case.

    Letters without a decomposition (such as the Polish barred l) are dropped, not replaced.
    One ``translate`` does nearly all texts. Only those in which it marked a character that
    expands to several are cut at these characters and put together again.
    """
    source, target, longer = _ascii_forms()
    text = value.cast("string")
    plain = F.translate(text, source, target)
    entries = ",".join(f"{char}={kept}" for char, kept in longer.items())
    expansions = F.str_to_map(F.lit(entries), F.lit(","), F.lit("="))
    cut = F.regexp_replace(text, "([" + "".join(longer) + "])", f"{_EXPANDS}$1{_EXPANDS}")
    pieces = F.transform(
        F.split(cut, _EXPANDS), lambda piece: F.coalesce(expansions[piece], piece)
    )
    expanded = F.translate(F.array_join(pieces, ""), source, target)
    ascii_text = F.when(plain.contains(_EXPANDS), expanded).otherwise(plain)
    # \p{Alnum} is ASCII only and, in Java, many times faster than the spelled out ranges
    letters = F.regexp_replace(ascii_text, r"[^\p{Alnum} -]+", "")
    return F.nullif(F.upper(F.trim(F.regexp_replace(letters, " {2,}", " "))), F.lit(""))


def mask_email(value: Column) -> Column:
    """Displayable e-mail: two leading characters of the local part, then the domain."""
    email = F.lower(collapse_whitespace(value))
    at = F.instr(email, "@")
    local = F.substring_index(email, "@", 1)
    shown = F.when(F.length(local) > 1, F.substring(local, 1, 2)).otherwise(F.lit("*"))
    return F.when(at > 0, F.concat(shown, F.lit("***@"), F.substr(email, at + 1)))
