"""Compliance rules as Column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Suppression reasons, in the order in which they are reported.
DELETION_REQUESTED = "DELETION_REQUESTED"
RETENTION_EXPIRED = "RETENTION_EXPIRED"
INVALID_IDENTIFIER = "INVALID_IDENTIFIER"
NO_ANALYTICS_CONSENT = "NO_ANALYTICS_CONSENT"
NO_MARKETING_CONSENT = "NO_MARKETING_CONSENT"

# Request statuses that block processing, accepted spellings of "yes", and the
# retention period where no policy applies.
DELETION_BLOCKING_STATUSES = ("APPROVED", "ACTIVE", "COMPLETED")
TRUE_WORDS = ("true", "1", "yes", "y")
DEFAULT_RETENTION_DAYS = 3650


def normalize_key(value: Column) -> Column:
    """Lower-case trimmed form of source system and dataset names."""
    return F.lower(F.trim(value.cast("string")))


def parse_boolean(value: Column) -> Column:
    """True for the accepted spellings of yes; anything else, NULL included, is false."""
    return F.coalesce(normalize_key(value).isin(*TRUE_WORDS), F.lit(False))


def as_of_column(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def older_than(day: Column, retention_days: Column, as_of: date | None) -> Column:
    """True when the day lies strictly more than the given number of days before ``as_of``."""
    limit = F.coalesce(retention_days, F.lit(DEFAULT_RETENTION_DAYS))
    return F.datediff(as_of_column(as_of), day) > limit


_CLOCK = "(?:[01][0-9]|2[0-3])"
_SIXTY = "[0-5][0-9]"
_ZONE = f"(?:Z|[+-]{_CLOCK}(?::?{_SIXTY}(?::?{_SIXTY}(?:[.][0-9]+)?)?)?)?"
_TIME = "|".join(f"{_CLOCK}(?:{colon}{_SIXTY}(?:{colon}{_SIXTY}(?:[.,][0-9]+)?)?)?" for colon in (":", ""))
_ISO_DAY = f"([0-9]{{4}})(-?)([0-9]{{2}})\\2([0-9]{{2}})(?:.(?:{_TIME}){_ZONE})?"
_ISO_WEEK = f"([0-9]{{4}})(-?)W([0-9]{{2}})(?:\\2([1-7]))?(?:.(?:{_TIME}){_ZONE})?"


def event_day(text: Column) -> Column:
    """Calendar day written in an ISO date or timestamp text; NULL if it is not one.

    Blanks around the text are trimmed. Extended and basic forms count, days of ISO weeks too; the
    day is the one written, whatever the zone. A form must cover the whole text.
    """
    trimmed = F.trim(text)

    def part(form: str, group: int) -> Column:
        return F.regexp_extract(trimmed, f"^(?:{form})$", group)

    day = F.concat_ws("-", part(_ISO_DAY, 1), part(_ISO_DAY, 3), part(_ISO_DAY, 4)).try_cast("date")
    week = part(_ISO_WEEK, 3).try_cast("int")
    fourth = F.concat(part(_ISO_WEEK, 1), F.lit("-01-04")).try_cast("date")
    weekday = F.coalesce(part(_ISO_WEEK, 4).try_cast("int"), F.lit(1))
    monday = F.date_sub(fourth, F.weekday(fourth))
    of_week = F.date_add(monday, (week - 1) * 7 + weekday - 1)
    # Week 53 of a year without one would be a day of the next year's first week.
    same_year = F.year(F.date_add(of_week, 4 - weekday)) == F.year(fourth)
    return F.coalesce(day, F.when(same_year & (week > 0), of_week))


def match_identifier_present(*identifiers: Column) -> Column:
    return F.coalesce(*identifiers).isNotNull()


def may_process(consent: Column, deletion: Column, expired: Column, valid: Column) -> Column:
    """Consent given and no global blocker; an unknown blocker leaves the answer unknown."""
    return consent & ~(deletion | expired | ~valid)


def suppression_reasons(
    *, analytics: Column, marketing: Column, deletion: Column, expired: Column, valid: Column
) -> Column:
    """Array of the reasons that apply; empty when nothing stands in the way."""
    checks = (
        (DELETION_REQUESTED, deletion),
        (RETENTION_EXPIRED, expired),
        (INVALID_IDENTIFIER, ~valid),
        (NO_ANALYTICS_CONSENT, ~analytics),
        (NO_MARKETING_CONSENT, ~marketing),
    )
    return F.array_compact(F.array(*[F.when(applies, F.lit(reason)) for reason, applies in checks]))
