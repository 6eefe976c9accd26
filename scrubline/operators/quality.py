"""Quality checks as rows, computed in one aggregate."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.operators.profiling import as_rows, distinct_with_null


class QualityError(Exception):
    """Raised for failed checks when the caller asked for that."""


@dataclass(frozen=True)
class Check:
    """``kind``: not_null, at_least (min >= bound), above (min > bound) or has_values."""

    kind: str
    column: str
    bound: float | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"

    def observed(self) -> Column:
        if self.kind == "not_null":
            return F.count_if(F.col(self.column).isNull())
        if self.kind in ("at_least", "above"):
            return F.min(F.col(self.column))
        if self.kind == "has_values":
            return distinct_with_null(self.column)
        raise ValueError(f"unknown check {self.kind!r}")

    def passes(self, observed: Column) -> Column:
        if self.kind == "not_null":
            return observed == 0
        if self.kind == "above":
            return observed > self.bound
        if self.kind == "at_least":
            return observed >= self.bound
        return observed >= 1


def check_rows(checks: Sequence[Check], observed: Sequence[str]) -> list[dict[str, Column]]:
    """The fields of each check row, from the columns that hold the observed values."""
    return [
        {
            "check_name": F.lit(check.name),
            "observed": F.col(name).cast("double"),
            "passed": F.coalesce(check.passes(F.col(name)), F.lit(False)),
        }
        for check, name in zip(checks, observed)
    ]


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``check_name, observed, passed``. On no rows the minima are NULL and fail."""
    names = [f"c{i}" for i in range(len(checks))]
    observed = df.agg(*[check.observed().alias(n) for check, n in zip(checks, names)])
    return as_rows(observed, check_rows(checks, names))


def enforce(failed: Sequence[str], on_fail: str = "warn") -> None:
    """Report failed checks: ``warn`` or ``raise``."""
    if on_fail not in ("warn", "raise"):
        raise ValueError(f"on_fail must be warn or raise, not {on_fail!r}")
    if failed:
        message = "quality checks failed: " + ", ".join(failed)
        if on_fail == "raise":
            raise QualityError(message)
        warnings.warn(message, stacklevel=2)
