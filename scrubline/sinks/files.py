"""Outputs. File sizes are left to adaptive execution, never to one task."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_WHOLE = "__whole"


@contextmanager
def _millisecond_timestamps(spark: SparkSession) -> Iterator[None]:
    """Parquet timestamps as INT64 milliseconds; the writer takes this from the session only."""
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, "TIMESTAMP_MILLIS")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def write_partitioned_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    mode: str = "overwrite",
    only_theirs: bool = False,
    scattered: Column | bool = True,
) -> None:
    """Parquet in one directory per value of ``partition_by``.

    Rows of a partition are brought together so that it gets few files. Adaptive
    execution splits a large partition over several tasks and merges small ones.
    ``only_theirs``: of a table that is there, only partitions that ``df`` has rows of are replaced.
    ``scattered``: the partitions that need this, as a condition or all or none; rows of others are written where they are.
    """
    if isinstance(scattered, bool):
        balanced = df.hint("rebalance", *partition_by) if scattered else df
    else:
        balanced = df.filter(~scattered).union(df.filter(scattered).hint("rebalance", *partition_by))
    replaced = "dynamic" if only_theirs else "static"
    with _millisecond_timestamps(df.sparkSession):
        balanced.write.mode(mode).option("partitionOverwriteMode", replaced).partitionBy(*partition_by).parquet(path)


def write_single_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Unpartitioned Parquet: one part file while the data are small.

    All rows are sent to one shuffle partition, which adaptive execution splits
    at ``spark.sql.adaptive.advisoryPartitionSizeInBytes``. Small outputs end up in
    one file; a large one in as many as it takes, with no task given the whole.
    The work before the write keeps its own parallelism.
    """
    everything = F.pmod(F.xxhash64(F.col(f"`{df.columns[0]}`")), F.lit(1))
    balanced = df.withColumn(_WHOLE, everything).hint("rebalance", _WHOLE).drop(_WHOLE)
    with _millisecond_timestamps(df.sparkSession):
        balanced.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with header, quotes doubled and blanks kept so that any text survives a round trip."""
    blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(header=True, escape='"', **blanks).csv(path)


def partition_listing(
    spark: SparkSession, path: str, partition_by: Sequence[str], schema: StructType | None = None
) -> DataFrame:
    """The partitions of a Parquet output and their rows, from footers only.

    An output without any rows has no files to take a schema from; give it then.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path).groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n"))
