"""Token ids as flat binary files with 64-bit document offsets, memory-mapped.

A folder holds, per shard, ``ids-N.bin`` (unsigned integers, documents one after
another) and ``offsets-N.bin`` (64-bit: where each document starts among the ids of
all shards, and the end of the last). Shards follow each other in document order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scrubline.llm.common import bounded_batches, written
from scrubline.llm.encoding import crc32_of_ids, word_encoder

SHARD_SCHEMA = "shard long, n_docs long, n_null_ids long, n_tokens long, width int"
LOT_DOCS, LOT_IDS = 10_000, 4_000_000
DOC_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _replace(fs, folder: str, name: str, parts: Iterator[bytes]) -> None:
    """Write a file under an own name, then put it in place: repeated tasks do no harm."""
    own = f"{folder}/.{name}-{TaskContext.get().taskAttemptId()}"
    with fs.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    if not isinstance(fs, arrow_fs.LocalFileSystem):
        if fs.get_file_info(f"{folder}/{name}").type != arrow_fs.FileType.NotFound:
            fs.delete_file(f"{folder}/{name}")
    fs.move(own, f"{folder}/{name}")


def map_file(fs, path: str, dtype: np.dtype, first: int = 0, n: int | None = None) -> np.ndarray:
    """``n`` integers of a file from the one numbered ``first`` on (all by default).

    They are mapped, not read, where the file system allows it; else only they are read.
    """
    n = fs.get_file_info(path).size // dtype.itemsize - first if n is None else n
    if n == 0:
        return np.empty(0, dtype)
    if isinstance(fs, arrow_fs.LocalFileSystem):
        return np.memmap(path, dtype, "r", first * dtype.itemsize, (n,))
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read_at(n * dtype.itemsize, first * dtype.itemsize), dtype)


def lots(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Documents, by offsets, in lots of up to ``LOT_DOCS`` and about ``LOT_IDS`` ids."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + LOT_IDS, "right")) - 1
        b = min(max(b, a + 1), a + LOT_DOCS, n)
        yield a, b
        a = b


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode all texts in ascending id order into one file per shard.

    Returns one row per shard: shard, n_docs, n_null_ids, n_tokens, width of an id.
    Every document ends with ``end_id``; a null or empty text is that id alone. Null
    ids come first; rows with equal ids stand in order of their texts.
    """
    bounded_batches(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        fs, path = arrow_fs.FileSystem.from_uri(folder)
        shard = TaskContext.get().partitionId()
        lengths, ids, n_null = [], [], 0

        def parts() -> Iterator[bytes]:
            nonlocal n_null
            for batch in batches:
                ids.append(batch.column(0).fill_null(0).to_numpy(zero_copy_only=False))
                n_null += batch.column(0).null_count
                for text in batch.column(1):
                    got = encoder.encode(text.as_py()) + end
                    lengths.append(len(got) // encoder.dtype.itemsize)
                    yield got

        fs.create_dir(path, recursive=True)
        _replace(fs, path, f"ids-{shard}.bin", parts())
        n = np.array(lengths, "<i8")
        _replace(fs, path, f"lengths-{shard}.bin", iter([n.tobytes()]))
        _replace(fs, path, f"docs-{shard}.bin", (x.astype("<i8").tobytes() for x in ids))
        row = [[shard], [len(n)], [n_null], [int(n.sum())], [encoder.dtype.itemsize]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, [pa.int64()] * 4 + [pa.int32()])],
            ["shard", "n_docs", "n_null_ids", "n_tokens", "width"],
        )

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    return written(ordered.mapInArrow(encode, SHARD_SCHEMA), "token-shards")


def read_token_files(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32.

    Bases of the shards are prefix sums of their token counts; they are written
    into the offset files, and documents are cut out of the mapped ids by these. There is
    a task per shard that has documents; none holds more than a lot of ids.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                shard, base = row["shard"], row["base"]
                lengths = map_file(fs, f"{path}/lengths-{shard}.bin", np.dtype("<i8"))
                offsets = np.concatenate([[0], np.cumsum(lengths)]) + base
                _replace(fs, path, f"offsets-{shard}.bin", iter([offsets.astype("<i8").tobytes()]))
                offsets = map_file(fs, f"{path}/offsets-{shard}.bin", np.dtype("<i8"))
                docs = map_file(fs, f"{path}/docs-{shard}.bin", np.dtype("<i8"))
                for a, b in lots(offsets):
                    bounds = np.array(offsets[a : b + 1])
                    kind = np.dtype(f"<u{row['width']}")
                    ids = map_file(fs, f"{path}/ids-{shard}.bin", kind, int(bounds[0]) - base, int(bounds[-1] - bounds[0]))
                    crcs = [crc32_of_ids(ids[x:y]) for x, y in zip(bounds[:-1] - bounds[0], bounds[1:] - bounds[0])]
                    null = np.arange(a, b) < row["n_null_ids"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[a:b], pa.int64(), mask=null), pa.array(bounds[:-1]),
                         pa.array(np.diff(bounds)), pa.array(crcs, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    # One row per shard: a running sum over a list of files, not over documents.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
    filled = based.filter("n_docs > 0")
    # A given number of ranges: adaptive execution would merge the few rows into one task.
    return filled.repartitionByRange(max(1, filled.count()), "shard").mapInArrow(read, DOC_SCHEMA)
