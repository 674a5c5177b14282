"""Mail-style (RFC 2822) dates as naive UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from earshot.functions.once import let
from earshot.functions.text import strip

# Month and weekday names of RFC 2822.
MONTHS = (
    "january february march april may june july august september october november december"
).split()
WEEKDAYS = "mon tue wed thu fri sat sun".split()

# Zone names of RFC 2822 with their offsets in minutes.
ZONE_MINUTES = {
    "est": -300, "edt": -240,
    "cst": -360, "cdt": -300,
    "mst": -420, "mdt": -360,
    "pst": -480, "pdt": -420,
    "ast": -240, "adt": -180,
}

_DAYS = "|".join(WEEKDAYS)
_SHORT_MONTHS = "|".join(m[:3] for m in MONTHS)
_ANY_MONTHS = "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS)
_STRICT = (
    rf"(?i)\A(?:{_DAYS}),\s+(\d{{1,2}})\s+({_SHORT_MONTHS})\s+(\d{{4}})\s+"
    r"(\d{1,2}):(\d{1,2}):(\d{1,2})\s+([+-]\d{2}:?[0-5]\d(?::?[0-5]\d)?|(?-i:Z))\z"
)
_LENIENT = (
    rf"(?i)\A(?:[^\s,]*,\s*|(?:{_DAYS})\s+)?(\d{{1,2}})[\s-]+({_ANY_MONTHS})[\s-]+0*(\d{{2}}|\d{{4}}),?\s+"
    r"(\d{1,2})[:.](\d{2})(?:[:.](\d{2}))?(?:(?:\s+|(?=[+-]))(\S+).*)?\z"
)
_FIELDS = "$1 $2 $3 $4 $5 $6 $7"


def _zone_seconds(zone: Column, numeric: str) -> Column:
    digits = F.regexp_replace(zone, r"[^0-9]", "")
    part = lambda start: F.coalesce(F.substring(digits, start, 2).try_cast("int"), F.lit(0))
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    named = F.create_map(*[F.lit(x) for pair in ZONE_MINUTES.items() for x in pair])
    return F.when(zone.rlike(numeric), sign * (part(1) * 3600 + part(3) * 60 + part(5))).otherwise(
        F.coalesce(F.try_element_at(named, F.lower(zone)), F.lit(0)) * 60
    )


def _from_fields(fields: Column, numeric_zone: str) -> Column:
    """UTC timestamp from day, month, year, hour, minute, second and zone."""
    text = lambda i: F.get(fields, F.lit(i))
    number = lambda i: text(i).try_cast("int")
    month = F.array_position(
        F.array(*[F.lit(m[:3]) for m in MONTHS]), F.lower(F.substring(text(1), 1, 3))
    ).cast("int")
    # Two-digit years: 69..99 belong to the last century.
    year = F.when(F.length(text(2)) > 2, number(2)).otherwise(
        number(2) + F.when(number(2) > 68, 1900).otherwise(2000)
    )
    second = F.coalesce(number(5), F.lit(0))
    local = F.try_make_timestamp_ntz(year, month, number(0), number(3), number(4), second)
    # Second 60 would roll over instead of failing.
    return F.when(second < 60, F.timestamp_add("SECOND", -_zone_seconds(text(6), numeric_zone), local))


def _assemble(text: Column, pattern: str, numeric_zone: str) -> Column:
    """The text is matched once and taken apart into its fields."""
    fields = F.split(F.regexp_replace(text, pattern, _FIELDS), " ")
    return F.when(text.rlike(pattern), let(fields, lambda f: _from_fields(f, numeric_zone)))


def feed_date(col: Column) -> Column:
    """``Sun, 16 Nov 2025 23:55:00 +0000`` and nothing looser; NULL when it does not fit."""
    return _assemble(col, _STRICT, r"^[+-]")


_ISO = (
    r"\A\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?(?:Z|[+-]\d{2}:?\d{2})?)?\z"
)


def iso_date(col: Column) -> Column:
    """ISO date or time as naive UTC, without fractions; NULL for any other form. No zone counts as UTC."""
    text = strip(col)
    zoned = F.regexp_replace(text, r"([+-]\d{2})(\d{2})\z", "$1:$2")
    whole = F.regexp_replace(F.when(text.rlike(r"T|\s"), zoned).otherwise(text), r"\.\d+", "")
    # A time without seconds gets them before its zone.
    whole = F.regexp_replace(whole, r"([T ]\d{2}:\d{2})(?=Z|[+-]|\z)", "$1:00")
    utc = F.when(whole.rlike(r"[T ].*(?:Z|[+-]\d{2}:\d{2})\z"), whole).otherwise(
        F.when(F.length(whole) > 10, F.concat(whole, F.lit("Z"))).otherwise(F.concat(whole, F.lit("T00:00:00Z")))
    )
    seconds = F.unix_seconds(utc.try_cast("timestamp"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(text.rlike(_ISO), F.timestamp_add("SECOND", seconds, epoch))


def mail_date(col: Column) -> Column:
    """Lenient mail date: optional weekday, short years, zone names; NULL when unparseable.

    A zone that is missing, unknown or not of the form ``+hhmm`` counts as UTC.
    """
    return let(strip(col), lambda text: _assemble(text, _LENIENT, r"^[+-]\d{4}$"))
