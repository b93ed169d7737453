"""Match-date expressions (F4-F8, F13): ANSI-safe, all built-in.

The parse patterns and regular expressions are fixed values of the match data
format: ``(Tue) 14 Sep 2021 (W37)`` style text, ISO timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow.functions.casts import text_to_integral

# --- fixed values ----------------------------------------------------------
TEXT_DATE_REGEX = r"(\d{1,2} \w{3} \d{4})"
TEXT_DATE_FORMAT = "d MMM yyyy"
TEXT_DAY_REGEX = r"\((\w{3})\)"
TEXT_WEEK_REGEX = r"\(W(\d{1,2})\)"
ISO_DATE_FORMAT = "yyyy-MM-dd"
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_date_string(d: Column) -> Column:
    return F.date_format(d, ISO_DATE_FORMAT)


def date_from_timestamp(c: Column | str) -> Column:
    """Timestamp (or timestamp-like text) -> ``yyyy-MM-dd`` text; garbage -> null."""
    return iso_date_string(_col(c).try_cast("date"))


def date_from_text(c: Column | str) -> Column:
    """Free text holding ``d MMM yyyy`` -> ``yyyy-MM-dd`` text; no match -> null."""
    found = F.regexp_extract(_col(c), TEXT_DATE_REGEX, 1)
    # no match gives "": skip the (exception-driven) failed parse for it
    return iso_date_string(F.when(found != "", F.try_to_date(found, TEXT_DATE_FORMAT)))


def day_from_iso(c: Column | str) -> Column:
    """Three-letter English day name of a ``yyyy-MM-dd`` value."""
    return F.substring(F.date_format(_col(c).try_cast("date"), "EEEE"), 1, 3)


def week_from_iso(c: Column | str) -> Column:
    """ISO week number of a ``yyyy-MM-dd`` value (F8)."""
    return F.weekofyear(_col(c).try_cast("date"))


def day_from_text(c: Column | str) -> Column:
    """Weekday token written as ``(Tue)`` in the text; empty when absent."""
    return F.regexp_extract(_col(c), TEXT_DAY_REGEX, 1)


def week_from_text(c: Column | str) -> Column:
    """Week number written as ``(W37)`` in the text; null when absent."""
    return text_to_integral(F.regexp_extract(_col(c), TEXT_WEEK_REGEX, 1), "int")
