"""Types of text values, as a lattice whose join is an aggregate.

    boolean                 int < bigint < decimal < double                 date < timestamp

Nothing (empty or NULL) is below all of them and string above. A value has a bit; the state
of a column is the bits that occur and the most digits of a decimal, so that states of files
or tasks are merged by OR and maximum, and a type follows from the merged state alone.

A value has the type that Spark's CSV reader infers for it, but for a whole number in
exponent form (``1.5E1``), which is a double here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BOOLEAN, INT, BIGINT, DECIMAL, DOUBLE, DATE, TIMESTAMP, STRING = (1 << i for i in range(8))
NUMBERS, MOMENTS = INT | BIGINT | DECIMAL | DOUBLE, DATE | TIMESTAMP
MOST_DIGITS = 38
# The greatest absolute values of whole types, of positive and of negative numbers.
INT_LIMITS = ("2147483647", "2147483648")
BIGINT_LIMITS = ("9223372036854775807", "9223372036854775808")
# Digits that a decimal needs to hold all integers of a type.
INT_DIGITS, BIGINT_DIGITS = 10, 20

# Texts of numbers and days as the CSV reader takes them. Type suffixes,
# hexadecimal exponents and blanks around a number pass as a double.
WHOLE = r"^[+-]?[0-9]+\z"
WHOLE_WITH_POINT = r"^[+-]?[0-9]+\.?\z"
_DECIMAL_FLOAT = r"(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_HEX_FLOAT = r"0[xX](?:[0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?[0-9]+"
FLOAT = rf"^[\x00-\x20]*[+-]?(?:NaN|Infinity|(?:{_DECIMAL_FLOAT}|{_HEX_FLOAT})[dDfF]?)[\x00-\x20]*\z"
INFINITIES = ("Inf", "-Inf")
# What every text of a moment begins with: a cast that fails costs an exception for each value.
MOMENT = r"^[\x00-\x20\x7f]*(?:[+-]?[0-9]{4}|[Tt]?[0-9]{1,2}:)"
DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"


def _digits(text: Column) -> Column:
    return F.greatest(F.length(F.regexp_replace(text, r"^[+-]?0*|\.\z", "")), F.lit(1))


def _fits(whole: Column, limits: tuple[str, str]) -> Column:
    """Whether the text of a whole number is within limits, by its digits and without a cast that fails."""
    digits = F.regexp_replace(whole, "^[+-]?0*", "")
    limit = F.when(whole.startswith("-"), limits[1]).otherwise(limits[0])
    return (F.length(digits) < len(limits[0])) | ((F.length(digits) == len(limits[0])) & (digits <= limit))


def type_bit(text: Column) -> Column:
    """The bit of a value's type, 0 for none."""
    number = (
        F.when(text.rlike(WHOLE) & _fits(text, INT_LIMITS), INT)
        .when(text.rlike(WHOLE) & _fits(text, BIGINT_LIMITS), BIGINT)
        .when(text.rlike(WHOLE_WITH_POINT) & (_digits(text) <= MOST_DIGITS), DECIMAL)
        .otherwise(DOUBLE)
    )
    return (
        F.when(text.isNull() | (text == ""), 0)
        .when(text.rlike(FLOAT) | text.isin(*INFINITIES), number)
        .when(text.rlike(DAY) & text.try_cast("date").isNotNull(), DATE)
        .when(text.rlike(MOMENT) & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .otherwise(STRING)
    )


def type_state(text: Column) -> dict[str, Column]:
    """Aggregates ``bits`` and ``digits`` that make up the state of a text column."""
    bit = type_bit(text)
    return {
        "bits": F.coalesce(F.bit_or(bit), F.lit(0)),
        "digits": F.coalesce(F.max(F.when(bit == DECIMAL, _digits(text))), F.lit(0)),
    }


def merged_state(bits: Column, digits: Column) -> dict[str, Column]:
    """The same aggregates over columns of states."""
    return {"bits": F.coalesce(F.bit_or(bits), F.lit(0)), "digits": F.coalesce(F.max(digits), F.lit(0))}


def type_name(bits: Column, digits: Column) -> Column:
    """The narrowest type that holds all values of a state; string for no values."""

    def only(mask: int) -> Column:
        return (bits != 0) & (bits.bitwiseAND(F.lit(~mask & 0xFF)) == 0)

    def has(bit: int) -> Column:
        return bits.bitwiseAND(F.lit(bit)) != 0

    places = F.greatest(
        digits, F.when(has(INT), INT_DIGITS).otherwise(0), F.when(has(BIGINT), BIGINT_DIGITS).otherwise(0)
    )
    number = (
        F.when(has(DOUBLE), "double")
        .when(has(DECIMAL), F.concat(F.lit("decimal("), places.cast("string"), F.lit(",0)")))
        .when(has(BIGINT), "bigint")
        .otherwise("int")
    )
    return (
        F.when(only(BOOLEAN), "boolean")
        .when(only(NUMBERS), number)
        .when(only(MOMENTS), F.when(has(TIMESTAMP), "timestamp").otherwise("date"))
        .otherwise("string")
    )
