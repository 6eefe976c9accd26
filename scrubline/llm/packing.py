"""Packing documents into as few sequences of a fixed length as possible.

Lengths are whole numbers up to the capacity, so a packing is described by how many
pieces there are of each length. Plans are made over that histogram: pairs and single
pieces that provably dominate all other ways to place a piece (Martello and Toth) are
fixed first, the rest goes best-fit by decreasing length. Spark numbers the pieces of
each length, and each piece finds its place in the plan by its number.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scrubline.llm.common import bounded_batches, written
from scrubline.llm.encoding import crc32_of_ids, word_encoder

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
PLACED_SCHEMA = PIECE_SCHEMA + ", sequence_id long, offset long"
SALTS = 64


class Histogram:
    """Pieces left, by length, with the questions that the reduction asks."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {k: n for k, n in counts.items() if n > 0}
        self.sizes = sorted(self.counts)

    def take(self, size: int, n: int) -> None:
        self.counts[size] -= n
        if not self.counts[size]:
            del self.counts[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def smallest(self, n: int) -> list[int]:
        """The n smallest pieces."""
        out: list[int] = []
        for size in self.sizes:
            out += [size] * min(self.counts[size], n - len(out))
            if len(out) == n:
                break
        return out

    def largest_up_to(self, room: int) -> int:
        """The largest size that fits, 0 if none does."""
        i = bisect_left(self.sizes, room + 1)
        return self.sizes[i - 1] if i else 0


def reduce_dominated(hist: Histogram, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Fix sets that dominate every other set with the same piece; returns (contents, number of sequences).

    A piece that nothing fits beside stays alone. A pair that fills the sequence
    dominates whatever else could stand beside the piece; so does the largest
    partner if no two pieces fit beside it.
    """
    fixed = []
    for size in sorted(hist.sizes, reverse=True):
        partner = capacity - size
        if partner > size or size not in hist.counts or partner not in hist.counts:
            continue
        n = hist.counts[size] // 2 if partner == size else min(hist.counts[size], hist.counts[partner])
        if n:
            hist.take(size, n)
            hist.take(partner, n)
            fixed.append((((size, 1), (partner, 1)) if size != partner else ((size, 2),), n))
    for size in sorted(hist.sizes, reverse=True):
        while size in hist.counts:
            hist.take(size, 1)  # the piece itself is no partner
            partner, two = hist.largest_up_to(capacity - size), hist.smallest(2)
            left = hist.counts.get(size, 0)
            if not partner:
                n, contents = 1 + left, ((size, 1),)
                if left:
                    hist.take(size, left)
            elif len(two) < 2 or sum(two) > capacity - size:
                if partner == size:
                    n, contents = 1, ((size, 2),)
                    hist.take(size, 1)
                else:
                    n, contents = min(1 + left, hist.counts[partner]), ((size, 1), (partner, 1))
                    if n > 1:
                        hist.take(size, n - 1)
                    hist.take(partner, n)
            else:
                hist.counts[size] = left + 1
                if not left:
                    insort(hist.sizes, size)
                break
            fixed.append((contents, n))
    return fixed


def best_fit(hist: Histogram, capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Best-fit by decreasing length, for equal sequences at once."""
    open_: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
    rooms: list[int] = []

    def add(room: int, contents: tuple, n: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((contents, n))

    for size in reversed(hist.sizes):
        left = hist.counts[size]
        moved = []
        while left:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                each = capacity // size
                if left // each:
                    moved.append((capacity - each * size, ((size, each),), left // each))
                if left % each:
                    moved.append((capacity - left % each * size, ((size, left % each),), 1))
                break
            room = rooms[i]
            contents, n = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(i)
            each = room // size
            full, rest = min(n, left // each), 0
            left -= full * each
            if full:
                moved.append((room - each * size, (*contents, (size, each)), full))
            if full < n and left:
                rest, left = left, 0
                moved.append((room - rest * size, (*contents, (size, rest)), 1))
            if n - full - bool(rest):
                add(room, contents, n - full - bool(rest))
        for x in moved:
            add(*x)
    return [x for group in open_.values() for x in group]


def plan(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Places by length and number: rows ``key`` (length, first number), base, per sequence, offset."""
    hist = Histogram(counts)
    groups = reduce_dominated(hist, capacity)
    groups += best_fit(hist, capacity)
    taken: dict[int, int] = {}
    rows, base = [], 0
    for contents, n in groups:
        offset = 0
        for size, each in contents:
            first = taken.get(size, 0)
            rows.append((size, first, base, each, offset))
            taken[size] = first + each * n
            offset += size * each
        base += n
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return dict(zip(("size", "first", "base", "each", "offset"), columns)) | {"n": np.int64(base)}


def cut_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token pieces of whole texts: documents above the capacity are cut there, others stay whole."""
    bounded_batches(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.frombuffer(encoder.encode(text.as_py()) + end, encoder.dtype)
                for k, a in enumerate(range(0, len(ids), capacity)):
                    part = ids[a : a + capacity]
                    for column, value in zip(out, (doc, k, a, len(part), crc32_of_ids(part))):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(out, types)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        cut, PIECE_SCHEMA
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents; one row per piece with its sequence and the place there.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null or
    empty text is a piece of the end id alone. Rows with equal ids are packed one by
    one. Only the histogram of lengths, at most ``capacity`` numbers, comes to the
    driver; its plan goes back to the tasks and is bounded likewise.
    """
    spark = docs.sparkSession
    pieces = cut_pieces(docs, tokenizer, end_id, capacity, id_col, text_col)
    salt = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int")
    pieces = written(pieces.withColumn("salt", salt), "pieces")

    counts = pieces.groupBy("length").count().collect()
    places = spark.sparkContext.broadcast(plan({r["length"]: r["count"] for r in counts}, capacity))

    # Numbers within a length: those within a salt, after all of smaller salts.
    salts = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    salts = salts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = pieces.withColumn("number", F.row_number().over(within)).join(salts, ["length", "salt"])
    numbered = numbered.withColumn("number", F.col("before") + F.col("number") - 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        keys = (p["size"] << 44) | p["first"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            at = np.searchsorted(keys, (length << 44) | number, "right") - 1
            nth, slot = np.divmod(number - p["first"][at], p["each"][at])
            added = [p["base"][at] + nth, p["offset"][at] + slot * length]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(5)] + [pa.array(x, pa.int64()) for x in added],
                [f.split()[0] for f in PLACED_SCHEMA.split(", ")],
            )

    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(place, PLACED_SCHEMA)
