"""The profiling job: what is in a CSV directory, and is it fit for cleansing?"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.functions.inference import type_name, type_state
from scrubline.functions.parsing import is_numeric_text
from scrubline.operators import dedup
from scrubline.operators.dates import likely_formats
from scrubline.operators.profiling import CastTarget, any_null_rows, as_rows, distinct_with_null
from scrubline.sinks import write_csv
from scrubline.sources import CsvDialect, file_inventory, read_csv_by_name
from scrubline.sources.headers import Layouts, file_headers, layouts

_N = "__copies"


@dataclass(frozen=True)
class ProfileConfig:
    """Columns by the names in the files; the defaults are those of the sales record.

    A timestamp target without formats is tried with those that its values show
    (``operators.dates``), which reads that column once more and is reported as ``formats``.
    """

    dialect: CsvDialect = CsvDialect()
    expected_header: tuple[str, ...] | None = None
    key_column: str = "Order ID"
    date_column: str = "Order Date"
    cast_targets: tuple[CastTarget, ...] = (
        CastTarget("Product", "string"),
        CastTarget("Quantity Ordered", "numeric"),
        CastTarget("Price Each", "float"),
        CastTarget("Order Date", "timestamp", ("MM/dd/yy HH:mm", "M/d/yy H:mm")),
    )


def _item(section: str, item: str, value: Column) -> dict[str, Column]:
    return {
        "section": F.lit(section),
        "item": F.lit(item),
        "value": value.cast("string"),
    }


def rows_where(condition: Column) -> Column:
    """Rows, copies included, in the groups that meet a condition."""
    return F.coalesce(F.sum(F.when(condition, F.col(_N))), F.lit(0))


def table_report(df: DataFrame, config: ProfileConfig = ProfileConfig()) -> DataFrame:
    """``section, item, value`` about the rows of a frame, from one pass over it.

    ``types`` are the narrowest that hold all values of a text column. The distinct rows with their copies are worked out once; every figure then
    follows from these groups: sums of copies give row counts, plain counts give
    figures on deduplicated rows. Distinct counts are kept apart from the other
    figures, which would otherwise be carried along with every distinct value; both
    read the same shuffle.
    """
    groups = dedup.copies(df, name=_N)
    nulls = {c: F.col(f"`{c}`").isNull() for c in df.columns}
    numeric_key = F.coalesce(is_numeric_text(F.col(config.key_column)), F.lit(False))
    bad = {t.column: F.count_if(numeric_key & t.bad()) for t in config.cast_targets}

    counts = {
        ("nulls", "rows_with_any"): rows_where(reduce(or_, nulls.values())),
        **{("nulls", c): rows_where(is_null) for c, is_null in nulls.items()},
        ("duplicates", "beyond_first"): F.coalesce(F.sum(F.col(_N) - 1), F.lit(0)),
        ("duplicates", "members"): rows_where(F.col(_N) > 1),
        **{("bad_values", c): count for c, count in bad.items()},
    }
    found = {key: F.col(f"f{i}") for i, key in enumerate(counts)}
    states = {f"{part}{i}": value for i, c in _texts(df) for part, value in type_state(F.col(f"`{c}`")).items()}
    counted = groups.agg(
        *[value.alias(f"f{i}") for i, value in enumerate(counts.values())],
        *[value.alias(name) for name, value in states.items()],
    )
    rows = [_item(section, item, value) for (section, item), value in found.items()]
    rows += [_item("castable", c, found["bad_values", c] == 0) for c in bad]
    rows += [_item("types", c, type_name(F.col(f"bits{i}"), F.col(f"digits{i}"))) for i, c in _texts(df)]

    distinct = groups.agg(
        F.coalesce(F.sum(_N), F.lit(0)).alias("rows"),
        distinct_with_null(config.key_column).alias("keys"),
        F.count_distinct(config.date_column).alias("dates"),
    )
    key_rows = [
        _item("ready", "spark_reads", F.col("rows") > 0),
        _item("shape", "rows", F.col("rows")),
        _item("shape", "columns", F.lit(len(df.columns))),
        _item("distinct", config.key_column, F.col("keys")),
        _item("distinct", config.date_column, F.col("dates")),
        _item("duplicates", f"potential_by_{config.key_column}", F.col("rows") - F.col("keys")),
    ]
    return as_rows(counted, rows).unionByName(as_rows(distinct, key_rows))


def _texts(df: DataFrame) -> list[tuple[int, str]]:
    return [(i, c) for i, (c, kind) in enumerate(df.dtypes) if kind == "string"]


def files_report(
    spark: SparkSession,
    source: str,
    found: Layouts,
    config: ProfileConfig = ProfileConfig(),
) -> DataFrame:
    """``section, item, value`` about the files: how many, how large, same header?

    ``found`` are the layouts; headers are compared with the expected one, or else
    with that of the first file by name.
    """
    differing = found.files - found.like_expected
    inventory = file_inventory(spark, source, config.dialect.pattern)
    sizes = inventory.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes")
    )
    return as_rows(
        sizes,
        [
            _item("files", "count", F.col("files")),
            _item("files", "total_kb", F.round(F.col("bytes") / 1024, 1)),
            _item("files", "present", F.col("files") > 0),
            _item("headers", "differing_files", F.lit(differing)),
            _item("headers", "consistent", F.lit(differing == 0)),
            _item("ready", "input", (F.col("files") > 0) & F.lit(differing == 0)),
        ],
    )


def profile(
    spark: SparkSession,
    source: str,
    config: ProfileConfig = ProfileConfig(),
    export_to: str | None = None,
) -> DataFrame:
    """Full report on a directory; optionally exports rows with NULLs and duplicates as CSV."""
    found = layouts(file_headers(spark, source, config.dialect), config.expected_header)
    df = read_csv_by_name(spark, source, config.dialect, found=found)
    if export_to:
        write_csv(any_null_rows(df), f"{export_to}/null_rows")
        write_csv(dedup.duplicate_members(df), f"{export_to}/duplicate_rows")
    targets = tuple(
        replace(t, formats=likely_formats(df, t.column)) if t.kind == "timestamp" and not t.formats else t for t in config.cast_targets
    )
    guessed = {t.column: ", ".join(t.formats) for t, given in zip(targets, config.cast_targets) if t.formats != given.formats}
    report = files_report(spark, source, found, config).unionByName(table_report(df, replace(config, cast_targets=targets)))
    for column, formats in guessed.items():
        report = report.unionByName(as_rows(spark.range(1), [_item("formats", column, F.lit(formats))]))
    return report


def ready(report: DataFrame) -> bool:
    """Input present, headers alike, and Spark read rows: the items of the section "ready" all hold."""
    return report.filter((F.col("section") == "ready") & (F.col("value") != "true")).isEmpty()
