"""Text-to-value expressions that yield NULL on bad input, under any ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text that counts as a number. Signs, decimals, exponents,
# surrounding blanks and infinities pass; NaN and type suffixes (1d, 1f) do not.
NUMBER_PATTERN = (
    r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))\s*$"
)


def parse_int(column: Column) -> Column:
    """32-bit integer, NULL where the text is no integer or does not fit."""
    return column.try_cast("int")


def parse_timestamp(column: Column, *formats: str) -> Column:
    """Timestamp from the first of ``formats`` that fits, else NULL.

    The wall-clock time is read in the session time zone; keep that zone at UTC
    so that years and months do not depend on where the job runs.
    """
    if not formats:
        raise ValueError("parse_timestamp needs at least one format")
    attempts = [F.try_to_timestamp(column, F.lit(fmt)) for fmt in formats]
    return attempts[0] if len(attempts) == 1 else F.coalesce(*attempts)


def is_numeric_text(column: Column) -> Column:
    """True where the value reads as a number; NULL stays NULL."""
    return column.cast("string").rlike(NUMBER_PATTERN)
