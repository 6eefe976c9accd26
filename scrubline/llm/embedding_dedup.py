"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest reference points (pivots). It is put in the inverted
lists of those of them that are rarest, and vectors that meet in a list are candidates if
they share enough pivots; a pair is judged only in the list of the rarest pivot it shares.
Candidates are verified by cosine in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.blocks import deal_blocks, groups, smallest_linked
from scrubline.llm.common import bounded_batches, written
from scrubline.llm.components import components
from scrubline.llm.vectors import matrix, usable

BLOCK = 2048


def _unit(x: np.ndarray) -> np.ndarray:
    # Scaled first: squares of very large or small components stay finite.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def spread(sample: np.ndarray, wanted: int) -> np.ndarray:
    """Up to ``wanted`` rows of the sample as pivots, one of each neighbourhood (cosine 0.5) first.

    Only where that gives too few do closer ones follow.
    """
    chosen: list[int] = []
    closest = np.full(len(sample), -np.inf)
    for apart in (0.5, 0.8, 0.95):
        for i in range(len(sample)):
            if len(chosen) < wanted and closest[i] < apart:
                chosen.append(i)
                closest = np.maximum(closest, sample @ sample[i])
    return sample[chosen]


def by_rarity(points: np.ndarray, sample: np.ndarray, nearest: int) -> np.ndarray:
    """The pivots, those first that are near the fewest rows of the sample."""
    near = np.argpartition(-(sample @ points.T), min(nearest, len(points)) - 1, axis=1)[:, :nearest]
    return points[np.argsort(np.bincount(near.ravel(), minlength=len(points)), kind="stable")]


def described(x: np.ndarray, points: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of the nearest pivots of each row, rarest first; ties to the rarer pivot."""
    order = np.argsort(-(x @ points.T), axis=1, kind="stable")[:, :nearest]
    return np.sort(order, axis=1)


def bits(numbers: np.ndarray, n: int) -> np.ndarray:
    """Rows of pivot numbers as bit masks of 64-bit words."""
    masks = np.zeros((len(numbers), -(-n // 64)), np.uint64)
    for column in numbers.T:
        masks[np.arange(len(masks)), column >> 6] |= np.uint64(1) << (column & 63).astype(np.uint64)
    return masks


def sharing(a: np.ndarray, b: np.ndarray, least: int, here: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two sets of masks that share ``least`` pivots, the rarest of which is ``here``."""
    word, low = here >> 6, np.uint64((1 << (here & 63)) - 1)
    common = np.bitwise_count(a[:, None, word] & b[None, :, word])
    first = (a[:, None, word] & b[None, :, word] & low) == 0
    for w in range(a.shape[1]):
        if w != word:
            both = np.bitwise_count(a[:, None, w] & b[None, :, w])
            common += both
            if w < word:
                first &= both == 0
    return np.nonzero(first & (common >= least))


def index_size(n: int) -> tuple[int, int, int]:
    """For n different vectors: pivots, how many are nearest, and how many a candidate shares.

    Lists grow as the root of n while pivots can be sent to every task.
    """
    return min(2048, max(256, round(2 * n**0.5))), 16, 5


def link_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    pivots: int | None = None,
    nearest: int | None = None,
    shared: int | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Links by cosine of at least ``threshold``: vec_id, n_links, component_id, kept; one row per vector.

    ``n_links`` counts other vectors linked directly, ``component_id`` is the smallest id
    reachable. Vectors that are null, zero, not finite, or of another length than most,
    link with nothing. Rows with equal id and vector are one vector; an id with several
    vectors has a row for each. Equal vectors are compared once for all.

    Two vectors are compared if they share ``shared`` of their ``nearest`` pivots, out of
    ``pivots`` (``index_size`` of the number of different vectors by default), so that some
    links can be missed: see the README for the recall measured. None is made below the
    threshold. With all of them given by a few pivots the comparison is exact.

    A vector is in nearest - shared + 1 lists, in which it meets all vectors it shares enough
    pivots with. Long lists are compared in blocks. No pair leaves a task: what comes out are
    sums of links and stars of what is linked.
    """
    rows, alone, classes, found = _linked(vectors, threshold, pivots, nearest, shared, id_col, vector_col)
    linked = found.filter("id IS NOT NULL").groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.filter("id IS NOT NULL").select(F.col("id").alias("a"), F.col("root").alias("b")))
    classes = classes.join(linked, "id", "left").join(parts, "id", "left")
    told = classes.select(
        "v",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    result = rows.join(told, "v").select("id", "n_links", "component_id").unionByName(alone)
    return result.select(
        F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def compared_pairs(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vector_col: str = "embedding", **index: int) -> int:
    """How many pairs of different vectors ``link_vectors`` verifies by cosine."""
    settings = [index.get(name) for name in ("pivots", "nearest", "shared")]
    found = _linked(vectors, threshold, *settings, id_col, vector_col)[3]
    return found.filter("id IS NULL").agg(F.coalesce(F.sum("links"), F.lit(0))).first()[0]


def _linked(
    vectors: DataFrame, threshold: float, pivots: int | None, nearest: int | None, shared: int | None, id_col: str, vector_col: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Vectors that take part, rows of the others, different vectors, and what each lot of a list found.

    The last has links and the root in the lot by id, and with a null id the number of
    pairs that were verified.
    """
    spark = vectors.sparkSession
    bounded_batches(spark, 4096)
    v = F.col(vector_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    fit = usable(F.col("v")) & F.col("id").isNotNull()
    rows = written(rows.withColumn("fit", fit).dropDuplicates(["id", "v"]), "vectors")
    alone = rows.filter("NOT fit").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    rows = rows.filter("fit").drop("fit")
    lengths = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").head(1)
    dim = lengths[0]["dim"] if lengths else 1
    odd = rows.filter(F.size("v") != dim)
    alone = alone.unionByName(odd.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    rows = rows.filter(F.size("v") == dim)
    classes = written(rows.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("weight")), "vector-classes")

    usual = index_size(classes.count())
    wanted, k, least = (given or default for given, default in zip((pivots, nearest, shared), usual))
    sample = classes.orderBy(F.xxhash64("id"), "id").limit(8 * wanted).select("v").toArrow()
    sample = _unit(matrix(sample.column(0), dim)) if sample.num_rows else np.ones((1, dim))
    points = spread(sample, wanted)
    k = min(k, len(points))
    least = min(least, k)
    known = spark.sparkContext.broadcast(by_rarity(points, sample, k))
    n_points = len(points)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = described(_unit(matrix(batch.column("v"), dim)), known.value, k)
            # Of two rows that share enough pivots, the rarest shared one is among these of both.
            lists = numbers[:, : k - least + 1]
            row = pa.array(np.repeat(np.arange(len(numbers)), lists.shape[1]))
            packed = pa.py_buffer(numbers.astype("<u2").tobytes())
            near = pa.Array.from_buffers(pa.binary(2 * k), len(numbers), [None, packed]).cast(pa.binary())
            rest = [batch.column(c).take(row) for c in ("id", "weight", "v")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists.ravel().astype(np.int64)), near.take(row), *rest], ["key", "near", "id", "weight", "v"]
            )

    kind = f"key long, near binary, id long, weight long, v {dict(classes.dtypes)['v']}"
    keyed = classes.mapInArrow(describe, kind)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["key", "lo", "hi"]):
            ids, weight = group.column("id").to_numpy(), group.column("weight").to_numpy()
            x = _unit(matrix(group.column("v"), dim))
            near = np.frombuffer(b"".join(group.column("near").to_pylist()), "<u2").reshape(len(ids), k).astype(np.int64)
            masks, here = bits(near, n_points), group.column("key")[0].as_py()
            side = group.column("side").to_numpy()
            apart = group.column("lo")[0].as_py() != group.column("hi")[0].as_py()
            left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if apart else (np.arange(len(ids)),) * 2
            links, verified = np.zeros(len(ids), np.int64), 0
            ends: list[tuple[np.ndarray, np.ndarray]] = []
            for a in range(0, len(left), 256):
                part = left[a : a + 256]
                i, j = sharing(masks[part], masks[right], least, here)
                i, j = part[i], right[j]
                if not apart:
                    i, j = i[i < j], j[i < j]
                verified += len(i)
                step = max(1, (1 << 21) // dim)
                for c in range(0, len(i), step):
                    one, other = i[c : c + step], j[c : c + step]
                    close = (x[one] * x[other]).sum(1) >= threshold
                    one, other = one[close], other[close]
                    ends.append((one, other))
                    np.add.at(links, one, weight[other])
                    np.add.at(links, other, weight[one])
            i, j = (np.concatenate(e) for e in zip(*ends)) if ends else (np.empty(0, int),) * 2
            root = smallest_linked(len(ids), i, j)
            hit = np.unique(np.concatenate([i, j]))
            columns = [
                pa.array([None, *ids[hit].tolist()], pa.int64()),
                pa.array([verified, *links[hit].tolist()], pa.int64()),
                pa.array([None, *ids[root[hit]].tolist()], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "links", "root"])

    found = deal_blocks(keyed, BLOCK).mapInArrow(compare, "id long, links long, root long")
    return rows, alone, classes, written(found, "vector-links")
