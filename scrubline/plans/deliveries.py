"""Deliveries one after another into a table of the latest row per key, partition by partition."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from scrubline.operators import dedup
from scrubline.plans.scratch import drop_scratch, scratch_path
from scrubline.sinks import write_partitioned_parquet
from scrubline.sources.files import path_exists

# Fixed value: the folder of NULL in a partitioned table.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# Up to so many hashes of keys are sent to all tasks.
FEW_SHARED = 1_000_000
# A partition of more files than that, on average below that size, is brought together.
MANY_FILES, SMALL_FILE = 8, 8 << 20

_HASH, _FILE, _BYTES = "__hash", "__file", "__bytes"
# Above any number of rows with one hash.
_NEW = 1 << 40


def _in_partitions(rows: Sequence[Row], columns: Sequence[str]) -> Column:
    """A condition on partition columns only, so that others are not read."""
    return reduce(or_, [reduce(and_, [F.col(c).eqNullSafe(F.lit(row[c])) for c in columns]) for row in rows])


def _shared_hashes(arrived: DataFrame, held: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Hashes of keys that a delivered row has in common with any other row, delivered or held.

    Only hashes are shuffled. Different keys of one hash do no harm: their rows are compared by key.
    """
    counted = arrived.select(F.xxhash64(*keys).alias(_HASH), F.lit(_NEW).alias("n"))
    if held is not None:
        counted = counted.union(held.select(F.xxhash64(*keys), F.lit(1)))
    return counted.groupBy(_HASH).agg(F.sum("n").alias("n")).filter(F.col("n") > _NEW).select(_HASH)


def _crowded(held: DataFrame, columns: Sequence[str]) -> list[Row]:
    """Partitions of many small files; only what the listing knows is read."""
    files = held.select(*columns, F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_size").alias(_BYTES)).distinct()
    sizes = files.groupBy(*columns).agg(F.count(F.lit(1)).alias(_FILE), F.avg(_BYTES).alias(_BYTES))
    return sizes.filter((F.col(_FILE) > MANY_FILES) & (F.col(_BYTES) < SMALL_FILE)).select(*columns).collect()


def merge_latest(
    spark: SparkSession,
    delivery: DataFrame,
    target: str,
    keys: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
) -> list[tuple]:
    """Brings a delivery into a partitioned Parquet table that holds the latest row per key.

    The result is as if all deliveries had come at once. Only partitions that get rows, or
    lose one to a later row of its key, are read as a whole and written again; of the others
    the keys are read. Returns these partitions. ``delivery`` has the columns of the table.

    Whole rows are shuffled once, when the delivery is staged partition by partition. Rows whose
    key no other row has stay where they are, those with a key in common are deduplicated. If
    more than ``FEW_SHARED`` hashes of keys are in common, all rows are. Files of a partition
    therefore become more with the deliveries, until they are brought together again.

    Merged rows are staged in the shared folder before any partition is replaced; a
    partition that has lost all rows is deleted last. If a run breaks off, running it again
    gives the same table.
    """
    columns = list(partition_by)
    stages: list[str] = []

    def staged(df: DataFrame, label: str) -> DataFrame:
        stages.append(scratch_path(spark, label))
        df.write.parquet(stages[-1])
        return spark.read.schema(df.schema).parquet(stages[-1])

    try:
        arrived = staged(delivery.hint("rebalance", *columns), "delivery")
        held = spark.read.schema(delivery.schema).parquet(target) if path_exists(spark, target) else None
        shared = staged(_shared_hashes(arrived, held, keys), "shared-hashes")
        # Texts that a collation holds equal differ in their hashes.
        few = shared.count() <= FEW_SHARED and not any("collate" in kind for name, kind in delivery.dtypes if name in keys)

        def rows(df: DataFrame, how: str) -> DataFrame:
            """Rows with a hash in common (``left_semi``) or the others (``left_anti``)."""
            marked = df.withColumn(_HASH, F.xxhash64(*keys))
            return marked.join(F.broadcast(shared), _HASH, how).select(*df.columns)

        def in_common(df: DataFrame) -> DataFrame:
            return rows(df, "left_semi") if few else df

        def latest(df: DataFrame) -> DataFrame:
            found = dedup.keep_latest(in_common(df), keys, order_by, tie_breakers)
            return rows(df, "left_anti").unionByName(found.hint("rebalance", *columns)) if few else found

        touched = latest(arrived).select(*columns)
        if held is not None:
            same = [F.col(f"held.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
            new_keys = in_common(arrived).select(*keys).alias("new")
            met = in_common(held.select(*dict.fromkeys([*keys, *columns]))).alias("held").join(new_keys, reduce(and_, same), "left_semi")
            touched = touched.unionByName(met.select(*columns))
        parts = touched.distinct().collect()
        if not parts:
            return []
        if held is None:
            write_partitioned_parquet(latest(arrived), target, columns, only_theirs=True, scattered=not few)
        else:
            affected = held.filter(_in_partitions(parts, columns))
            crowded = _crowded(affected, columns)
            scattered = not few or (_in_partitions(crowded, columns) if crowded else False)
            merged = staged(latest(affected.unionByName(arrived)), "merged")
            write_partitioned_parquet(merged, target, columns, only_theirs=True, scattered=scattered)
            left = {tuple(row) for row in merged.select(*columns).distinct().collect()}
            for row in parts:
                if tuple(row) not in left:
                    folders = [f"{c}={NULL_FOLDER if row[c] is None else row[c]}" for c in columns]
                    drop_scratch(spark, "/".join([target.rstrip("/"), *folders]))
        return sorted((tuple(row) for row in parts), key=str)
    finally:
        for path in stages:
            drop_scratch(spark, path)
