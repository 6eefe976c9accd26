"""Run metrics as a one-row frame, and the text made from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import types as T

from scrubline.operators.rules import ACCEPTED

if TYPE_CHECKING:
    from scrubline.plans.cleansing import CleanseConfig

CHECKS_SCHEMA = "check_name string, observed double, passed boolean"


def metrics_schema(config: CleanseConfig, reasons: Sequence[str]) -> T.StructType:
    types = {f.name: f.dataType for f in config.schema.fields}
    types = {new: types[old] for old, new in zip(config.schema.names, config.columns)}
    schema = T.StructType()
    for name in ("input_files", "initial_rows", "cleaned_rows", "deduplicated_rows", "output_rows"):
        schema.add(name, "long")
    for reason in reasons:
        schema.add(f"{reason}_removed", "long")
    schema.add("removed_rows", "long").add("duplicates_removed", "long")
    schema.add("quality_passed", "boolean").add("quality_issues", T.ArrayType(T.StringType()))
    for c in config.distinct_columns:
        schema.add(f"distinct_{c}", "long")
    for c in config.total_columns:
        whole = isinstance(types[c], T.IntegralType)
        schema.add(f"total_{c}", "long" if whole else "double")
    schema.add("min_date", "timestamp").add("max_date", "timestamp")
    for c in config.range_columns:
        schema.add(f"min_{c}", types[c]).add(f"max_{c}", types[c])
    schema.add("output_format", "string").add("partition_count", "integer")
    schema.add("partitions", T.ArrayType(T.StringType())).add("location", "string")
    return schema


def metrics_values(
    input_files: int,
    counts: Mapping[str, int],
    stats: Mapping[str, object],
    checks: Sequence[Row],
    partitions: Sequence[str],
    location: str,
) -> dict[str, object]:
    """Every figure of a run by name."""
    reasons = [reason for reason in counts if reason != ACCEPTED]
    rejected = sum(counts[reason] for reason in reasons)
    issues = [c.check_name for c in checks if not c.passed]
    return {
        **stats,
        "input_files": input_files,
        "initial_rows": counts[ACCEPTED] + rejected,
        "cleaned_rows": counts[ACCEPTED],
        "deduplicated_rows": stats["output_rows"],
        **{f"{reason}_removed": counts[reason] for reason in reasons},
        "removed_rows": rejected,
        "duplicates_removed": counts[ACCEPTED] - stats["output_rows"],
        "quality_passed": not issues,
        "quality_issues": issues,
        "output_format": "parquet",
        "partition_count": len(partitions),
        "partitions": list(partitions),
        "location": location,
    }


def metrics_frame(
    spark: SparkSession,
    config: CleanseConfig,
    values: Mapping[str, object],
    counts: Mapping[str, int],
) -> DataFrame:
    """The figures of a run in one typed row."""
    schema = metrics_schema(config, [reason for reason in counts if reason != ACCEPTED])
    return spark.createDataFrame([tuple(values[name] for name in schema.names)], schema)


def checks_frame(spark: SparkSession, checks: Sequence[Row]) -> DataFrame:
    return spark.createDataFrame([tuple(c) for c in checks], CHECKS_SCHEMA)


def render(metrics: Mapping[str, object]) -> str:
    """The figures as aligned text, one per line."""
    lines = []
    for name, value in metrics.items():
        if isinstance(value, bool):
            value = "yes" if value else "no"
        elif isinstance(value, int):
            value = f"{value:,}"
        elif isinstance(value, float):
            value = f"{value:,.2f}"
        elif isinstance(value, list):
            value = ", ".join(value) or "none"
        elif value is None:
            value = "n/a"
        lines.append(f"{name.replace('_', ' '):<32}: {value}")
    return "\n".join(lines)


def write_report(spark: SparkSession, metrics: DataFrame, folder: str) -> None:
    """Store the metrics as JSON and the summary as text, each a single small row."""
    text = render(metrics.first().asDict())
    metrics.write.mode("overwrite").json(f"{folder}/metrics")
    summary = spark.createDataFrame([(text,)], "value string")
    summary.write.mode("overwrite").text(f"{folder}/summary")
