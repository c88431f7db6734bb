"""Scalar expressions (all built-in, JVM side, inside whole-stage codegen).

Landed data is typed with the ``try_`` family so a bad value becomes null
instead of failing the job; this holds with ANSI mode on or off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "col_of", "try_date", "try_double", "try_int", "try_long", "try_bool",
    "try_timestamp", "try_ts_ntz", "try_instant_ntz", "date_text", "text_date", "default_if_null",
    "next_day", "month_text_date", "month_text_year", "first_token",
    "strip_quotes", "full_match", "sanitize_ident", "strip_control", "truncate",
    "percent", "falsy_or", "blank_or", "empty_if_null", "stamp_text", "iso_text",
    "run_ts", "drop_zones", "clean_strings",
]


# The text patterns of identifier sanitising (characters other
# than letters, digits, underscore and hyphen become "_") and of control
# character removal (all C0 controls except tab, newline and carriage return).
IDENT_OTHER = r"[^A-Za-z0-9_-]"
CONTROL_CHARS = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# F1
def try_date(c, fmt: str | None = None) -> Column:
    """Text to date, null when the text is not a date."""
    c = col_of(c)
    return F.try_to_date(c, fmt) if fmt else F.try_to_date(c)


# F2 / F4
def try_double(c) -> Column:
    return col_of(c).try_cast(T.DoubleType())


def try_int(c) -> Column:
    return col_of(c).try_cast(T.IntegerType())


def try_long(c) -> Column:
    return col_of(c).try_cast(T.LongType())


def try_bool(c) -> Column:
    return col_of(c).try_cast(T.BooleanType())


# F3
def try_timestamp(c) -> Column:
    """Zoned text to an instant (session zone UTC), null on failure."""
    return F.try_to_timestamp(col_of(c))


def try_ts_ntz(c) -> Column:
    """Text to a wall-clock timestamp without zone, null on failure."""
    return col_of(c).try_cast(T.TimestampNTZType())


def try_instant_ntz(c) -> Column:
    """Text to the instant it names (offsets are honoured; without one the
    session's zone, UTC, holds), as a UTC timestamp without zone; null on failure."""
    return F.to_utc_timestamp(F.try_to_timestamp(col_of(c)), F.current_timezone()).cast(T.TimestampNTZType())


# F6
def date_text(c) -> Column:
    return F.date_format(col_of(c), "yyyy-MM-dd")


def text_date(c) -> Column:
    return try_date(c, "yyyy-MM-dd")


# F7
def default_if_null(c, default) -> Column:
    return F.coalesce(col_of(c), default if isinstance(default, Column) else F.lit(default))


# F8
def next_day(c, days: int = 1) -> Column:
    return F.date_add(col_of(c), days)


def _month_parts(c) -> Column:
    return F.split(F.trim(col_of(c)), "-")


# F9
def month_text_date(c) -> Column:
    """``MM-YYYY`` to the first day of that month.

    Exactly two parts are required; a month outside 1-12 or any other
    shape gives null (they go to rejects, never abort the run).
    """
    parts = _month_parts(c)
    month = F.get(parts, 0).try_cast(T.IntegerType())
    year = F.get(parts, 1).try_cast(T.IntegerType())
    text = F.format_string("%04d-%02d-01", year, month)
    ok = (F.size(parts) == 2) & month.between(1, 12) & year.between(1, 9999)
    return F.when(ok, F.try_to_date(text, "yyyy-MM-dd"))


# F10
def month_text_year(c) -> Column:
    parts = _month_parts(c)
    year = F.get(parts, 1).try_cast(T.IntegerType())
    month = F.get(parts, 0).try_cast(T.IntegerType())
    return F.when((F.size(parts) == 2) & month.between(1, 12), year)


# F11
def first_token(c) -> Column:
    return F.get(F.split(F.trim(col_of(c)), r"\s+"), 0)


# F13
def strip_quotes(c) -> Column:
    """Remove one pair of wrapping double or single quotes (line breaks inside
    included)."""
    return F.regexp_replace(col_of(c), r"""(?s)\A(["'])(.*)\1\z""", "$2")


# F14
def full_match(c, pattern: str) -> Column:
    return F.coalesce(col_of(c).rlike(rf"\A(?:{pattern})\z"), F.lit(False))


# F15
def sanitize_ident(c) -> Column:
    return F.regexp_replace(col_of(c), IDENT_OTHER, "_")


# F16: control characters except tab, newline and carriage return.
def strip_control(c) -> Column:
    return F.regexp_replace(col_of(c), CONTROL_CHARS, "")


# F18
def truncate(c, n: int) -> Column:
    return F.substring(col_of(c), 1, n)


# F19
def percent(c, scale: int = 2) -> Column:
    return F.round(F.coalesce(col_of(c), F.lit(0.0)) * 100, scale)


# "a or b" where 0 (numbers) or the empty string (text) counts as missing.
def falsy_or(a, b) -> Column:
    """Numeric ``a or b``: ``b`` when ``a`` is null or 0."""
    a = col_of(a)
    return F.coalesce(F.nullif(a, F.lit(0)), col_of(b))


def blank_or(a, b) -> Column:
    """Text ``a or b``: ``b`` when ``a`` is null or empty."""
    a = col_of(a)
    return F.coalesce(F.nullif(a, F.lit("")), col_of(b))


# F21
def empty_if_null(c) -> Column:
    return F.coalesce(col_of(c), F.lit(""))


# F22
def stamp_text(c) -> Column:
    return F.date_format(col_of(c), "yyyyMMdd_HHmmss")


def iso_text(c) -> Column:
    return F.date_format(col_of(c), "yyyy-MM-dd'T'HH:mm:ss")


# one timestamp per run, passed in, never current_timestamp() in output.
def run_ts(value: str) -> Column:
    return F.lit(value).cast(T.TimestampNTZType())


# F17
def drop_zones(df: DataFrame) -> DataFrame:
    """Cast every zoned timestamp column to a zone-less one."""
    return df.select([
        F.col(f.name).cast(T.TimestampNTZType()).alias(f.name)
        if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
        for f in df.schema.fields])


def clean_strings(df: DataFrame) -> DataFrame:
    """F16 over every string column."""
    return df.select([
        strip_control(f.name).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields])
