"""Row rules: accept a row, or reject it with the first rule it breaks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.functions.parsing import is_numeric_text

ACCEPTED = "accepted"
REASON = "reject_reason"


@dataclass(frozen=True)
class Rule:
    """A named row condition. NULL counts as failing, as it does in a filter."""

    reason: str
    ok: Column


def required(columns: Sequence[str], reason: str = "null_field") -> Rule:
    return Rule(reason, reduce(and_, [F.col(c).isNotNull() for c in columns]))


def matches(column: str, pattern: str, reason: str) -> Rule:
    return Rule(reason, F.col(column).rlike(pattern))


def digits(column: str, reason: str = "invalid_id") -> Rule:
    """ASCII digits only, of any length."""
    return matches(column, r"^\d+$", reason)


def positive(columns: Sequence[str], reason: str = "non_positive_value") -> Rule:
    return Rule(reason, reduce(and_, [F.col(c) > 0 for c in columns]))


def parsed(column: str, reason: str = "bad_date") -> Rule:
    """The parsed copy of a text column is there."""
    return Rule(reason, F.col(column).isNotNull())


def numeric(column: str, reason: str = "not_numeric") -> Rule:
    return Rule(reason, is_numeric_text(F.col(column)))


def accept(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every rule, as one plain conjunction the scan can use."""
    return df.filter(reduce(and_, [rule.ok for rule in rules]))


def classify(df: DataFrame, rules: Sequence[Rule], reason: str = REASON) -> DataFrame:
    """Every row, with the first broken rule in ``reason`` (NULL if none is)."""
    verdict = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule in rules:
        verdict = verdict.when(~F.coalesce(rule.ok, F.lit(False)), F.lit(rule.reason))
    return df.withColumn(reason, verdict)


def reject(df: DataFrame, rules: Sequence[Rule], reason: str = REASON) -> DataFrame:
    """Rows that break a rule, each with its reason."""
    return classify(df, rules, reason).filter(F.col(reason).isNotNull())


def reason_counts(rules: Sequence[Rule], reason: str = REASON) -> list[Column]:
    """Aggregates over a classified frame: accepted rows, then rows per rule."""
    counts = [F.count_if(F.col(reason).isNull()).alias(ACCEPTED)]
    for name in dict.fromkeys(rule.reason for rule in rules):
        counts.append(F.count_if(F.col(reason) == name).alias(name))
    return counts


def reject_summary(df: DataFrame, rules: Sequence[Rule], reason: str = REASON) -> DataFrame:
    """``reject_reason, n`` for the accepted rows and for each rule, zeros included.

    The reasons are known beforehand, so this is a single global aggregate (one
    small row per task is shuffled) and not a grouping by reason.
    """
    names = [ACCEPTED, *dict.fromkeys(rule.reason for rule in rules)]
    counts = classify(df, rules, reason).agg(*reason_counts(rules, reason))
    return counts.unpivot([], names, reason, "n")
