"""Statistics and checks over growing directories: each file is read once, in whichever run it is new."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions import snake_columns
from scrubline.operators.states import ROWS, merge_states, partial_states
from scrubline.sources import CsvDialect
from scrubline.sources.csv import scan_files
from scrubline.sources.files import literal_path, path_exists, versioned_files

VERSION = ["file_path", "size_bytes", "modified"]


@dataclass(frozen=True)
class States:
    """``per_file``: a row per file there is now; ``read``: how many files this run has read."""

    per_file: DataFrame
    columns: list[str]
    read: int

    def merged(self) -> DataFrame:
        return merge_states(self.per_file, self.columns)


def update_states(
    spark: SparkSession, sources: Sequence[str], store: str, schema: T.StructType, dialect: CsvDialect = CsvDialect()
) -> States:
    """States of all files of some CSV directories, under a declared schema; only new files are read.

    States are kept in ``store``, a Parquet folder, by path, size and time of change of a file: a
    file that has changed is read again, and one that is gone does not count any more.
    An interrupted run leaves nothing behind, and two runs at once do no harm. The
    names of the new files come to the driver, as a scan of them needs them there.
    """
    listed = reduce(DataFrame.unionByName, [versioned_files(spark, source, dialect.pattern) for source in sources])
    empty = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("file_path", T.StringType())]))
    columns = [c for c in snake_columns(empty).columns if c != "file_path"]
    held = None
    new = listed
    if path_exists(spark, store):
        kind = _states(empty).schema
        kind.add("size_bytes", T.LongType()).add("modified", T.TimestampType())
        held = spark.read.schema(kind).parquet(store)
        new = listed.join(held.select(*VERSION), VERSION, "left_anti")
    found = new.collect()
    if found:
        rows = scan_files(spark, [literal_path(row.file_path) for row in found], schema, dialect, file_column="file_path")
        fresh = spark.createDataFrame(found, listed.schema).join(_states(rows), "file_path", "left")
        # A file of a header alone has no rows, and its state is kept all the same.
        fresh.withColumn(ROWS, F.coalesce(ROWS, F.lit(0))).write.mode("append").parquet(store)
    if found or held is None:
        held = spark.read.parquet(store) if path_exists(spark, store) else spark.createDataFrame([], _states(empty).schema)
    if "modified" not in held.columns:
        return States(held, columns, 0)
    return States(listed.join(held.dropDuplicates(VERSION), VERSION), columns, len(found))


def _states(rows: DataFrame) -> DataFrame:
    return partial_states(snake_columns(rows), "file_path")
