"""Column statistics. Each function is one aggregate over one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.functions.inference import type_name, type_state
from scrubline.functions.parsing import is_numeric_text, parse_timestamp


def as_rows(one_row: DataFrame, rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into several rows, one per entry of ``rows``."""
    return one_row.select(F.inline(row_array(rows)))


def row_array(rows: Sequence[Mapping[str, Column]]) -> Column:
    return F.array(*[F.struct(*[v.alias(k) for k, v in row.items()]) for row in rows])


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``column_name, nulls``."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "nulls")


def any_null_rows(df: DataFrame) -> DataFrame:
    """Rows with a NULL in any column."""
    return df.filter(reduce(or_, [F.col(c).isNull() for c in df.columns]))


def distinct_with_null(column: str) -> Column:
    """Distinct values with NULL as one of them; 0 on no rows."""
    has_null = F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
    return F.count_distinct(F.col(column)) + has_null


def distinct_counts(
    df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """``column_name, distinct_with_null, distinct_non_null``.

    ``approximate`` swaps the exact counts for sketches, which need no shuffle of
    the values; the result is then an estimate.
    """
    columns = list(columns or df.columns)
    count = F.approx_count_distinct if approximate else F.count_distinct
    aggregates = []
    for i, c in enumerate(columns):
        aggregates.append(count(F.col(c)).alias(f"d{i}"))
        has_null = F.max(F.col(c).isNull().cast("int"))
        aggregates.append(F.coalesce(has_null, F.lit(0)).alias(f"n{i}"))
    return as_rows(
        df.agg(*aggregates),
        [
            {
                "column_name": F.lit(c),
                "distinct_with_null": F.col(f"d{i}") + F.col(f"n{i}"),
                "distinct_non_null": F.col(f"d{i}"),
            }
            for i, c in enumerate(columns)
        ],
    )


def range_stats(df: DataFrame, ranges: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row: ``total_rows`` and e.g. ``min_x, max_x, sum_x`` for ``{"x": ("min", "max", "sum")}``."""
    kinds = {"min": F.min, "max": F.max, "sum": F.sum}
    aggregates = [F.count(F.lit(1)).alias("total_rows")]
    for column, wanted in ranges.items():
        aggregates += [kinds[k](F.col(column)).alias(f"{k}_{column}") for k in wanted]
    return df.agg(*aggregates)


@dataclass(frozen=True)
class CastTarget:
    """``kind`` is string, numeric, float, int or timestamp (with the formats to try).

    ``numeric`` takes any number, decimals too; ``int`` takes whole 32-bit numbers.
    """

    column: str
    kind: str
    formats: tuple[str, ...] = ()

    def bad(self) -> Column:
        """True where a value is there but does not convert."""
        value = F.col(self.column)
        if self.kind == "string":
            converts = value.try_cast("string").isNotNull()
        elif self.kind in ("numeric", "float"):
            text = F.lower(F.trim(value.cast("string")))
            converts = is_numeric_text(value) | (text == "nan")
        elif self.kind == "int":
            converts = value.cast("string").rlike(r"^\s*[+-]?\d+\s*$") & value.try_cast("int").isNotNull()
        elif self.kind == "timestamp":
            # Without any format nothing converts.
            converts = parse_timestamp(value, *self.formats).isNotNull() if self.formats else F.lit(False)
        else:
            raise ValueError(f"unknown cast target {self.kind!r} for {self.column}")
        return value.isNotNull() & ~converts


def castability(df: DataFrame, targets: Sequence[CastTarget]) -> DataFrame:
    """``column_name, target, bad_values, passed``; NULLs pass, one bad value fails."""
    counts = df.agg(*[F.count_if(t.bad()).alias(f"b{i}") for i, t in enumerate(targets)])
    return as_rows(
        counts,
        [
            {
                "column_name": F.lit(t.column),
                "target": F.lit(t.kind),
                "bad_values": F.col(f"b{i}"),
                "passed": F.col(f"b{i}") == 0,
            }
            for i, t in enumerate(targets)
        ],
    )


def inferred_types(df: DataFrame) -> DataFrame:
    """``column_name, data_type``: per text column the narrowest type that holds all its values.

    One aggregate over one pass; types of other columns are what they are declared.
    """
    states = {f"{part}{i}": v for i, c in enumerate(df.columns) for part, v in type_state(F.col(f"`{c}`").cast("string")).items()}
    return as_rows(
        df.agg(*[value.alias(name) for name, value in states.items()]),
        [
            {
                "column_name": F.lit(c),
                "data_type": type_name(F.col(f"bits{i}"), F.col(f"digits{i}")) if kind == "string" else F.lit(kind),
            }
            for i, (c, kind) in enumerate(df.dtypes)
        ],
    )


def schema_table(df: DataFrame) -> DataFrame:
    """``column_name, data_type, nullable, nulls``: the schema beside what the data hold."""
    fields = df.schema.fields
    counts = df.agg(*[F.count_if(F.col(f.name).isNull()).alias(f"n{i}") for i, f in enumerate(fields)])
    return as_rows(
        counts,
        [
            {
                "column_name": F.lit(f.name),
                "data_type": F.lit(f.dataType.simpleString()),
                "nullable": F.lit(f.nullable),
                "nulls": F.col(f"n{i}"),
            }
            for i, f in enumerate(fields)
        ],
    )


def shape(df: DataFrame) -> DataFrame:
    """``row_count, column_count``."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
    )


def sample_values(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """The first ``n`` distinct values in order: a report item, so the limit is the point."""
    values = df.select(F.col(column).alias("value")).distinct()
    return values.orderBy(F.col("value").asc_nulls_first()).limit(n)


def preview(df: DataFrame, n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows in order (of all columns, unless told otherwise): the limit is the point."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order_by or df.columns]).limit(n)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Leave out columns without any value. Runs one aggregate to find them."""
    filled = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[c for c in df.columns if filled[c] > 0])
