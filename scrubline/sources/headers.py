"""The first record of each file, at a cost per file and not per byte."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import chain
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.sources.dialect import CsvDialect
from scrubline.sources.files import data_files

# A header may have so many characters, a directory so many different column names.
MOST_CHARACTERS = 1 << 20
MOST_NAMES = 20_000
SCHEMA = "file_path string, header array<string>"


def first_record(lines: Iterable[str], dialect: CsvDialect = CsvDialect()) -> list[str] | None:
    """The fields of the first record that is not an empty line; None if there is none.

    Only as many lines are taken as the record has.
    """
    doubled = dialect.escape == dialect.quote
    options = {"quotechar": dialect.quote, "doublequote": doubled, "escapechar": None if doubled else dialect.escape}
    csv.field_size_limit(MOST_CHARACTERS)
    lines = (line for line in lines if line.strip("\r\n")) if not dialect.multiline else iter(lines)
    for line in lines:
        if not line.strip("\r\n"):
            continue
        more = lines if dialect.multiline else ()
        return next(csv.reader(chain([line], more), **options))
    return None


def _head(file_path: str, dialect: CsvDialect) -> list[str] | None:
    encoding = "utf-8-sig" if dialect.encoding.upper() in ("UTF-8", "UTF8") else dialect.encoding
    with open(unquote(urlsplit(file_path).path), encoding=encoding, errors="replace", newline="") as file:
        text = file.read(MOST_CHARACTERS)
    # Line ends of all kinds, also in quotes, as the reader takes them.
    lines = io.StringIO(text, newline=None)
    found = first_record(lines, dialect)
    if len(text) == MOST_CHARACTERS and not lines.read(1):
        raise ValueError(f"the first record of {file_path} is longer than {MOST_CHARACTERS} characters")
    return found


def _rows(paths: list[str], headers: list[list[str] | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(headers, pa.list_(pa.string()))], ["file_path", "header"])


def file_headers(spark: SparkSession, path: str, dialect: CsvDialect = CsvDialect(), by_lines: bool | None = None) -> DataFrame:
    """``file_name, file_path, header``: the fields of the first record of each file.

    Files on a file system that every worker mounts (``file:`` paths) are opened in lots, as the
    listing deals them out, and read up to the end of that record. Where only Spark can
    open files (``by_lines``), their lines pass by once, unsorted and unshuffled. Files
    without any text have a NULL header; those of zero bytes have no row.
    """
    files = data_files(spark, path, dialect.pattern).select("file_path")
    if by_lines is None:
        by_lines = urlsplit(spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
            spark._jsparkSession.sessionState().newHadoopConf()).getUri().toString()).scheme != "file"
    if by_lines:
        headers = files.join(_headers_by_lines(spark, path, dialect), "file_path", "left")
    else:

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                paths = batch.column(0).to_pylist()
                yield _rows(paths, [_head(p, dialect) for p in paths])

        headers = files.mapInArrow(read, SCHEMA)
    return headers.select(F.substring_index("file_path", "/", -1).alias("file_name"), "file_path", "header")


def _headers_by_lines(spark: SparkSession, path: str, dialect: CsvDialect) -> DataFrame:
    # Lines are bytes here: the text source knows one encoding only.
    lines = spark.read.option("pathGlobFilter", dialect.pattern).text(path).select(
        F.col("value").cast("binary").alias("value"), "_metadata.file_path", F.col("_metadata.file_block_start").alias("start")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(zip(*(c.to_pylist() for c in batch.columns)) for batch in batches)
        held: list[tuple[bytes, str, int]] = []
        done: str | None = None

        def decoded(line: bytes) -> str:
            return line.decode(dialect.encoding, "replace").removeprefix("\ufeff") + "\n"

        def rest(of: str) -> Iterator[str]:
            for row in rows:
                if row[1] != of:
                    held.append(row)
                    return
                yield decoded(row[0])

        while row := held.pop() if held else next(rows, None):
            value, file_path, start = row
            if start == 0 and file_path != done and value:
                done = file_path
                yield _rows([file_path], [first_record(chain([decoded(value)], rest(file_path)), dialect)])

    return lines.mapInArrow(read, SCHEMA)


@dataclass(frozen=True)
class Layouts:
    """What is known of the headers of a directory: one row, whatever the number of files."""

    files: int
    different: int
    first: list[str] | None
    usual: list[str] | None
    widest: int
    like_expected: int


def layouts(headers: DataFrame, expected: Sequence[str] | None = None) -> Layouts:
    """Counts files and different headers, and finds that of the first file by name and the most usual one.

    ``like_expected`` are the files with the expected header, or else that of the first file.
    Headers are counted in Spark; files without text have none.
    """
    kinds = headers.groupBy("header").agg(F.count(F.lit(1)).alias("files"), F.min("file_path").alias("path"))
    told = F.col("header").isNotNull()
    wanted = F.array(*[F.lit(c) for c in expected]) if expected is not None else None
    like = F.sum(F.when(F.col("header") == wanted, F.col("files"))) if expected is not None else F.min_by("files", "path")
    row = kinds.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.count_if(told).alias("different"),
        F.min_by("header", F.when(told, F.col("path"))).alias("first"),
        F.max_by("header", F.when(told, F.struct("files", "path"))).alias("usual"),
        F.coalesce(F.max(F.size("header")), F.lit(0)).alias("widest"),
        F.coalesce(like, F.lit(0)).alias("like_expected"),
    ).first()
    return Layouts(**row.asDict())


def column_names(headers: DataFrame, most: int = MOST_NAMES) -> list[str]:
    """All column names, by first appearance over the files by name; an error beyond ``most``.

    Names that differ in case only are one; repeats within a header are numbered.
    """
    cells = headers.filter(F.col("header").isNotNull()).select("file_path", F.posexplode(numbered_in_rows(F.col("header"))))
    names = cells.groupBy(F.lower("col").alias("lower")).agg(F.min(F.struct("file_path", "pos", "col")).alias("at"))
    found = names.orderBy("at").limit(most + 1).select("at.col").collect()
    if len(found) > most:
        raise ValueError(f"more than {most} different column names")
    return [row[0] for row in found]


def numbered(header: Sequence[str]) -> list[str]:
    """The names of a header; one that came before in any case gets its number (v, v_1)."""
    lower = [c.lower() for c in header]
    repeats = [lower[:i].count(c) for i, c in enumerate(lower)]
    return [f"{c}_{n}" if n else c for c, n in zip(header, repeats)]


def numbered_in_rows(header: Column) -> Column:
    """The same for a column of headers."""
    lower = F.transform(header, F.lower)

    def name(c: Column, i: Column) -> Column:
        n = F.size(F.filter(F.slice(lower, 1, i), lambda earlier: earlier == F.lower(c)))
        return F.when(n > 0, F.concat_ws("_", c, n.cast("string"))).otherwise(c)

    return F.transform(header, name)
