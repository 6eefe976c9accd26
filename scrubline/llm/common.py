"""What several operators need: written tables, bounded Arrow batches, sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scrubline.plans.scratch import drop_scratch, scratch_path

_MADE: dict[str, list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def working_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, which ``drop_working_tables`` deletes."""
    path = scratch_path(spark, label)
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, read back from a table in the shared folder: lineage is cut there."""
    path = working_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_working_tables(spark: SparkSession) -> int:
    """Delete what operators have written in this session, and say how many tables there were.

    Frames that they have returned read these tables: use or write them first.
    """
    paths = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        drop_scratch(spark, path)
    return len(paths)


def bounded_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Let Python workers take texts in batches of so many rows in this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
