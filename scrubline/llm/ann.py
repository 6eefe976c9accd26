"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

Vectors get one coordinate more, which makes all equally long, so that the largest
inner product is the smallest angle. Trees split by the plane between two sampled
vectors. A query goes down all trees at once through one priority queue, by how far it
is on the right side of each split, and collects leaves until these hold enough rows.
Candidates of the leaves are ranked by their exact inner product.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.llm.blocks import groups
from scrubline.llm.common import bounded_batches, written
from scrubline.llm.vectors import matrix, usable

RESULT_SCHEMA = "query_id long, rank int, vec_id long, score double"
BLOCK = 4096


@dataclass
class Tree:
    # By inner node: a plane, its offset, and the two nodes below (negative: leaf -1 - number).
    planes: np.ndarray
    offsets: np.ndarray
    below: np.ndarray
    # Sampled rows by leaf.
    sizes: np.ndarray


def grow(sample: np.ndarray, leaf_size: int, rng: np.random.Generator) -> Tree:
    """One tree over the sample; sets that no plane splits stay leaves."""
    planes, offsets, below, sizes = [], [], [], []

    def node(rows: np.ndarray) -> int:
        if len(rows) > leaf_size:
            for _ in range(3):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                plane, middle = a - b, (a + b) / 2
                norm = np.linalg.norm(plane)
                if norm == 0:
                    continue
                plane = plane / norm
                margin = sample[rows] @ plane
                offset = float(plane @ middle)
                right = margin > offset
                if min(right.sum(), (~right).sum()) < len(rows) / 10:
                    offset = float(np.median(margin))
                    right = margin > offset
                if 0 < right.sum() < len(rows):
                    me = len(planes)
                    planes.append(plane)
                    offsets.append(offset)
                    below.append([0, 0])
                    below[me] = [node(rows[~right]), node(rows[right])]
                    return me
        sizes.append(len(rows))
        return -len(sizes)

    root = node(np.arange(len(sample)))
    if root < 0:
        planes, offsets, below = [np.zeros(sample.shape[1])], [0.0], [[-1, -1]]
    return Tree(np.array(planes), np.array(offsets), np.array(below), np.array(sizes))


def leaf_of(tree: Tree, x: np.ndarray) -> np.ndarray:
    """Leaf of each vector."""
    at = np.zeros(len(x), np.int64)
    while (inner := np.flatnonzero(at >= 0)).size:
        n = at[inner]
        right = np.einsum("ij,ij->i", x[inner], tree.planes[n]) > tree.offsets[n]
        at[inner] = tree.below[n, right.astype(int)]
    return -1 - at


def leaves_for(forest: list[Tree], x: np.ndarray, wanted: float) -> list[tuple[int, int]]:
    """Leaves of all trees, best first through one queue, until they hold ``wanted`` sampled rows."""
    margins = [tree.planes @ x - tree.offsets for tree in forest]
    queue = [(-np.inf, t, 0) for t in range(len(forest))]
    found, held = [], 0.0
    while queue and held < wanted:
        priority, t, n = heapq.heappop(queue)
        if n < 0:
            found.append((t, -1 - n))
            held += forest[t].sizes[-1 - n]
            continue
        margin = margins[t][n]
        left, right = forest[t].below[n]
        heapq.heappush(queue, (max(priority, margin), t, int(left)))
        heapq.heappush(queue, (max(priority, -margin), t, int(right)))
    return found


def build_forest(sample: np.ndarray, trees: int, leaf_size: int, seed: int = 11) -> list[Tree]:
    rng = np.random.default_rng(seed)
    return [grow(sample, leaf_size, rng) for _ in range(trees)]


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    trees: int = 12,
    leaf_share: float = 0.01,
    search_share: float = 1.6,
    sample_rows: int = 20_000,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` rows of largest inner product found for each row that ``queries`` marks.

    Returns query_id, rank (from 1), vec_id, score; a query is no candidate of its own,
    ties go to the smaller id. Vectors that are null, zero, not finite, or of another
    length than most, take no part. Rows with equal ids and vectors count once.

    The forest is grown on a sample of ``sample_rows`` rows with leaves of ``leaf_share``
    of it; every row is indexed. A search ends when its leaves hold ``search_share`` of
    as many rows as there are, counting a row once per tree, so fewer distinct
    rows are compared. Leaves above ``BLOCK`` rows are searched in blocks.
    """
    spark = vectors.sparkSession
    bounded_batches(spark, 4096)
    v = F.col(vector_col)
    rows = vectors.withColumn("__query", F.coalesce(queries, F.lit(False)))
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), "__query").filter(
        usable(v) & F.col("id").isNotNull()
    )
    rows = written(rows.dropDuplicates(["id", "v"]), "ann-rows")
    lengths = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").head(1)
    if not lengths:
        return spark.createDataFrame([], RESULT_SCHEMA)
    dim = lengths[0]["dim"]
    rows = rows.filter(F.size("v") == dim)
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))).first()[0]
    sampled = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()

    def lifted(x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(longest - (x * x).sum(1), 0))
        return np.column_stack([x, rest]) / np.sqrt(longest)

    sample = lifted(matrix(sampled.column(0).combine_chunks(), dim))
    forest = spark.sparkContext.broadcast(build_forest(sample, trees, max(k, int(leaf_share * len(sample)))))
    wanted = search_share * len(sample)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = lifted(matrix(batch.column(1), dim))
            leaves = [leaf_of(tree, x) + (t << 32) for t, tree in enumerate(forest.value)]
            take = pa.array(np.tile(np.arange(len(x)), len(leaves)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(leaves)), *(batch.column(i).take(take) for i in (0, 1))], ["leaf", "id", "v"]
            )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1), dim)
            # A query looks for directions; its own length changes no order.
            unit = np.column_stack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros(len(x))])
            found = [leaves_for(forest.value, u, wanted) for u in unit]
            take = pa.array(np.repeat(np.arange(len(x)), [len(f) for f in found]))
            leaves = np.array([(t << 32) + leaf for f in found for t, leaf in f], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaves), *(batch.column(i).take(take) for i in (0, 1))], ["leaf", "id", "v"]
            )

    kind = f"leaf long, id long, v {dict(rows.dtypes)['v']}"
    indexed = rows.select("id", "v").mapInArrow(index, kind).withColumn("asks", F.lit(False))
    asked = rows.filter("__query").select("id", "v").mapInArrow(ask, kind).withColumn("asks", F.lit(True))

    # Large leaves are dealt out in blocks; every query goes to all blocks of a leaf.
    indexed = written(indexed, "ann-index")
    blocks = indexed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    indexed = indexed.join(blocks, "leaf").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    asked = asked.join(blocks, "leaf").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    lists = indexed.drop("blocks").unionByName(asked.drop("blocks"))
    lists = lists.repartition("leaf", "block").sortWithinPartitions("leaf", "block")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["leaf", "block"]):
            asks = group.column("asks").to_numpy(zero_copy_only=False)
            ids, x = group.column("id").to_numpy(), matrix(group.column("v").combine_chunks(), dim)
            own, own_ids = x[~asks], ids[~asks]
            query, query_ids = x[asks], ids[asks]
            if not len(own) or not len(query):
                continue
            best_ids, best_scores = [], []
            for a in range(0, len(query), 512):
                scores = query[a : a + 512] @ own.T
                scores[query_ids[a : a + 512, None] == own_ids[None]] = -np.inf
                for i, s in enumerate(scores):
                    top = np.arange(len(s))
                    if len(s) > k:
                        # Matrix products differ in the last bits from one block to another.
                        top = np.flatnonzero(s >= np.partition(s, -k)[-k] - 1e-9 * longest)
                    top = top[s[top] > -np.inf]
                    exact = (own[top] * query[a + i]).sum(1)
                    first = np.lexsort((own_ids[top], -exact))[:k]
                    best_ids.append(own_ids[top[first]])
                    best_scores.append(exact[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(query_ids), pa.array(best_ids, pa.list_(pa.int64())), pa.array(best_scores, pa.list_(pa.float64()))],
                ["query_id", "ids", "scores"],
            )

    partial = lists.mapInArrow(rank, "query_id long, ids array<long>, scores array<double>")
    found = partial.groupBy("query_id").agg(
        F.flatten(F.collect_list(F.arrays_zip(F.transform("scores", lambda s: -s).alias("s"), F.col("ids").alias("i")))).alias("found")
    )
    # A candidate is found once per tree at most, with the same score.
    first = F.slice(F.array_distinct(F.slice(F.array_sort("found"), 1, k * trees)), 1, k)
    ranked = found.select("query_id", F.posexplode(first).alias("rank", "x"))
    return ranked.select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("x.i").alias("vec_id"), (-F.col("x.s")).alias("score")
    )
