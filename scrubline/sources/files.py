"""What files are there, from the listing alone."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _listed(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)


def listed_files(df: DataFrame) -> DataFrame:
    """``file_path`` of all files that a scan has listed, empty ones too, as ``_metadata.file_path`` writes it."""
    paths = sorted({re.sub("^([^:/]+):///", r"\1:/", path) for path in df.inputFiles()})
    return df.sparkSession.createDataFrame([(path,) for path in paths], "file_path string")


def data_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """``file_path, file_name, size_bytes`` of the files in a directory, not below it, that have any bytes.

    Only listing columns are selected, so no file is opened.
    """
    return _listed(spark, path, pattern).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("size_bytes"),
    )


def versioned_files(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """``file_path, size_bytes, modified`` of the files in a directory that have any bytes."""
    return _listed(spark, path, pattern).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("size_bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return file_system.exists(hadoop_path)


def file_inventory(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """``file_path, file_name, size_bytes`` of all files in a directory, not below it, from one listing.

    Scans skip files of zero bytes, so these are named by the listing that the scan is made from.
    """
    listed = _listed(spark, path, pattern)
    sizes = listed.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("size_bytes"))
    return listed_files(listed).join(sizes, "file_path", "left").select(
        "file_path", F.substring_index("file_path", "/", -1).alias("file_name"), F.coalesce("size_bytes", F.lit(0)).alias("size_bytes")
    )


def literal_path(file_path: str) -> str:
    """A listed path in the form that readers take: decoded, wildcards escaped."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(file_path))


def preflight(spark: SparkSession, path: str, pattern: str = "*.csv") -> DataFrame:
    """``check_name, observed, passed, first_files, more``: is there any input at all?

    ``first_files`` names up to five, ``observed`` counts all of them, ``more`` those not named.
    """
    inventory = file_inventory(spark, path, pattern)
    first = inventory.orderBy("file_name").limit(5)
    names = first.agg(F.array_sort(F.collect_list("file_name")).alias("first_files"))
    total = inventory.agg(F.count(F.lit(1)).alias("observed"))
    return total.select(
        F.lit("input_files_present").alias("check_name"),
        F.col("observed"),
        (F.col("observed") > 0).alias("passed"),
        names.scalar().alias("first_files"),
        F.greatest(F.col("observed") - 5, F.lit(0)).alias("more"),
    )
