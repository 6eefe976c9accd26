"""Comparing the rows of a key with each other, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deal_blocks(keyed: DataFrame, block: int, key: str = "key", id_col: str = "id") -> DataFrame:
    """Rows of keys that have several, dealt out so that any two of a key meet in one lot.

    Adds ``lo``, ``hi`` (the lot's blocks) and ``side``. A key's rows are parted by hash
    into blocks of about ``block``; a lot holds two blocks, which are compared across,
    or one, which is compared within. Rows come sorted by key, lo and hi.
    """
    counts = keyed.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    rows = (
        keyed.join(counts, key)
        .withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64(id_col), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("lo", F.least("own", "other"))
        .withColumn("hi", F.greatest("own", "other"))
        .withColumn("side", (F.col("own") != F.col("lo")).cast("int"))
        .drop("n", "blocks", "own", "other")
    )
    return rows.repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi")


def _changes(batch: pa.RecordBatch, by: list[str]) -> np.ndarray:
    """Rows, but the first, that begin another group."""
    new = np.zeros(batch.num_rows, bool)
    for c in by:
        values = batch.column(c).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def groups(batches: Iterator[pa.RecordBatch], by: list[str], at_least: int = 1) -> Iterator[pa.Table]:
    """Whole groups of sorted rows; several together until there are ``at_least`` rows."""
    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        first = tuple(batch.column(c)[0].as_py() for c in by)
        cuts = _changes(batch, by).tolist()
        starts = ([0] if held and first != last else []) + cuts
        at = 0
        for cut in starts:
            if size + cut - at >= at_least and (held or cut > at):
                yield pa.Table.from_batches([*held, *([batch.slice(at, cut - at)] if cut > at else [])])
                held, size, at = [], 0, cut
        held.append(batch.slice(at))
        size += batch.num_rows - at
        last = tuple(batch.column(c)[batch.num_rows - 1].as_py() for c in by)
    if held:
        yield pa.Table.from_batches(held)


def pairs(table: pa.Table, by: list[str], room: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs to compare in whole lots of ``deal_blocks``, about ``room`` at a time."""
    n = table.num_rows
    new = np.zeros(n, bool)
    for c in by:
        values = table.column(c).to_numpy(zero_copy_only=False)
        new[1:] |= values[1:] != values[:-1]
    lot = np.cumsum(new)
    within = (table.column("lo").to_numpy() == table.column("hi").to_numpy())
    side = table.column("side").to_numpy()
    widest = np.bincount(lot).max() if n else 0
    found, held = [], 0
    for d in range(1, widest):
        i = np.flatnonzero(lot[d:] == lot[:-d])
        i = i[within[i] | (side[i] != side[i + d])]
        found.append((i, i + d))
        held += len(i)
        if held >= room:
            yield np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
            found, held = [], 0
    if held:
        yield np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the first row of its component under the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
