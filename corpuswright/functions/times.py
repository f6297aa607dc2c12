"""Timestamps kept as ISO-8601 text: parsed to instants on demand, independent of session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONED = r"(?:[zZ]|[+-]\d{2}:?\d{2}(?::?\d{2})?)$"
DATE_ONLY = r"^\d{4}-\d{2}-\d{2}$"
ISO = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?(?:[zZ]|[+-]\d{2}:?\d{2})?)?$"


def parse_timestamp(c: Column) -> Column:
    """ISO text to an instant; a zone-less value is UTC, anything else becomes null."""
    text = F.trim(c)
    utc = (
        F.when(text.rlike(DATE_ONLY), F.concat(text, F.lit("T00:00:00Z")))
        .when(text.rlike(ZONED), text)
        .otherwise(F.concat(text, F.lit("Z")))
    )
    return F.when(text.rlike(ISO), F.try_to_timestamp(utc))


def age_days(c: Column, as_of: Column) -> Column:
    """Whole elapsed days between the ISO text ``c`` and the instant ``as_of`` (floored)."""
    return F.floor((F.unix_micros(as_of) - F.unix_micros(parse_timestamp(c))) / F.lit(86_400_000_000))


def instant(value: str | Column) -> Column:
    """``as_of`` argument as a column: ISO text or an existing timestamp column."""
    return parse_timestamp(F.lit(value)) if isinstance(value, str) else value
