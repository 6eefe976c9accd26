"""Deduplication by business key and by whole row.

Everything here stays balanced when one key or one group of copies holds a large
part of the table: rows are reduced inside each input partition before the
shuffle, and copies that must be put out again are dealt over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_COPIES = "__copies"
_CHUNK = "__chunk"
_MARK = "__fingerprint"
_RANK = "__rank"
_SIZE = "__size"


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the greatest by ``order_by``, NULLs last.

    NULL keys form a group like any other. Rows equal in ``order_by`` are told
    apart by ``tie_breakers``, also descending (all other columns, unless given),
    so that the outcome does not depend on how the rows were distributed.

    Spark limits each key to its best row inside every input partition before it
    shuffles, so a hot key sends one row per input partition, not its whole group.
    """
    if tie_breakers is None:
        used = {*keys, *order_by}
        tie_breakers = [c for c in df.columns if c not in used]
    latest = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in [*order_by, *tie_breakers]]
    )
    ranked = df.withColumn(_RANK, F.row_number().over(latest))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def drop_exact(df: DataFrame) -> DataFrame:
    """One copy of each distinct row; NULLs compare equal."""
    return df.dropDuplicates()


def copies(df: DataFrame, columns: Sequence[str] | None = None, name: str = _COPIES) -> DataFrame:
    """Distinct rows (or keys) with their number of copies, pre-aggregated map-side."""
    columns = list(columns or df.columns)
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def fingerprint(columns: Sequence[str], bits: int = 128) -> Column:
    """A hash of whole rows, NULLs and their places included; equal rows have the same one."""
    cells = [cell for c in columns for cell in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    one, other = F.xxhash64(*cells), F.xxhash64(F.lit(1), *cells)
    if bits < 64:
        one, other = F.pmod(one, F.lit(1 << bits)), F.lit(0).cast("bigint")
    return F.struct(one.alias("one"), other.alias("other"))


def copies_of_wide_rows(
    df: DataFrame, columns: Sequence[str] | None = None, name: str = _COPIES, bits: int = 128, most_broadcast: int = 500_000
) -> DataFrame:
    """As ``copies``, for wide rows of which few have a copy: what is shuffled does not grow with their width.

    Rows are grouped by a fingerprint first. Rows whose fingerprint comes once have no copy;
    only the others are grouped as a whole, so that two rows of one fingerprint are never taken for
    copies. Fingerprints that come several times are counted, and broadcast if there are at
    most ``most_broadcast`` (24 bytes each); beyond that a join finds their rows.
    """
    columns = list(columns or df.columns)
    keyed = df.select(*[F.col(f"`{c}`") for c in columns]).withColumn(_MARK, fingerprint(columns, bits))
    several = copies(keyed, [_MARK]).filter(F.col(_COPIES) > 1).select(_MARK)
    if several.limit(most_broadcast + 1).count() <= most_broadcast:
        several = F.broadcast(several)
    alone = keyed.join(several, _MARK, "left_anti").select(*columns, F.lit(1).cast("bigint").alias(name))
    verified = copies(keyed.join(several, _MARK, "left_semi"), columns, name)
    return alone.unionByName(verified)


def exact_duplicate_count(df: DataFrame) -> DataFrame:
    """``duplicates``: rows beyond the first of each set of equal rows."""
    extra = F.coalesce(F.sum(F.col(_COPIES) - 1), F.lit(0)).cast("bigint")
    return copies(df).agg(extra.alias("duplicates"))


def duplicate_members(df: DataFrame, chunk_rows: int = 1_000) -> DataFrame:
    """Every row that has at least one equal row, all copies included.

    Copies are equal, so they are counted (with map-side aggregation) and put out
    again from the count, instead of being brought together. A group of more
    than ``chunk_rows`` copies is first cut into counted chunks, which are dealt
    over all shuffle partitions; only then are the rows put out.
    """
    columns = df.columns
    groups = copies(df).filter(F.col(_COPIES) > 1)
    modest = groups.filter(F.col(_COPIES) <= chunk_rows)
    # At most 100,000 chunks per group, so that their list stays small as well.
    size = F.greatest(F.lit(chunk_rows), F.ceil(F.col(_COPIES) / 100_000))
    last = F.floor((F.col(_COPIES) - 1) / F.col(_SIZE))
    taken = F.col(_CHUNK) * F.col(_SIZE)
    # A given number of partitions: adaptive execution would merge the chunks
    # again, as it only sees the few bytes they take before the rows are put out.
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    huge = (
        groups.filter(F.col(_COPIES) > chunk_rows)
        .withColumn(_SIZE, size)
        .withColumn(_CHUNK, F.explode(F.sequence(F.lit(0), last)))
        .withColumn(_COPIES, F.least(F.col(_SIZE), F.col(_COPIES) - taken))
        .repartition(partitions, *columns, _CHUNK)
        .drop(_SIZE, _CHUNK)
    )
    counted = modest.unionByName(huge)
    repeat = F.array_repeat(F.lit(True), F.col(_COPIES).cast("int"))
    return counted.select(*columns, F.explode(repeat).alias(_CHUNK)).drop(_CHUNK)


def key_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once, whole rows kept.

    The repeated keys are unique on their side, so a hot key only makes its
    partition of the row side long, which adaptive execution splits.
    """
    other = [f"__key_{i}" for i in range(len(keys))]
    repeated = copies(df, keys).filter(F.col(_COPIES) > 1).drop(_COPIES).toDF(*other)
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, other)]
    return df.join(repeated, reduce(and_, same), "left_semi")


def key_duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``total, distinct_keys, potential_duplicates``; NULL counts as a key value."""
    return copies(df, keys).agg(
        F.coalesce(F.sum(_COPIES), F.lit(0)).alias("total"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.col(_COPIES) - 1), F.lit(0)).alias("potential_duplicates"),
    )


def summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``before, after, removed`` of ``keep_latest`` over the same keys.

    One row per key is left, so counting keys is enough: only the key columns
    are read and shuffled.
    """
    return key_duplicate_count(df, keys).toDF("before", "after", "removed")
