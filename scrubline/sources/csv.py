"""CSV directories: whole-directory scans, no reader per file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.sources.dialect import CsvDialect
from scrubline.sources.files import listed_files
from scrubline.sources.headers import Layouts, column_names, file_headers, layouts, numbered, numbered_in_rows


def _options(dialect: CsvDialect) -> dict[str, str]:
    return {"quote": dialect.quote, "escape": dialect.escape}


def _reader(spark: SparkSession, dialect: CsvDialect) -> DataFrameReader:
    return (
        spark.read.option("header", True)
        .option("pathGlobFilter", dialect.pattern)
        .option("multiLine", dialect.multiline)
        .option("encoding", dialect.encoding)
        .options(**_options(dialect))
    )


def scan_files(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    dialect: CsvDialect,
    check_headers: bool = False,
    file_column: str | None = None,
    malformed: str | None = None,
) -> DataFrame:
    """Rows by position, without the header lines; ``file_column`` adds the file they are from.

    ``malformed`` adds the text of records that do not fit the schema.
    """
    reader = _reader(spark, dialect).option("enforceSchema", not check_headers)
    if malformed:
        reader = reader.option("columnNameOfCorruptRecord", malformed)
        parsed = [F.col(f"`{c}`").cast("string") for c in schema.names]
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType(), True)])
    rows = reader.schema(schema).csv(path)
    if malformed:
        # The text is told with nothing of all columns behind it: the reader would else parse
        # the columns that are asked for only, and find fewer records malformed.
        nothing = F.substring(F.concat_ws("", *parsed), 1, 0)
        rows = rows.withColumn(malformed, F.when(F.col(malformed).isNotNull(), F.concat(malformed, nothing)))
    return rows.select("*", F.col("_metadata.file_path").alias(file_column)) if file_column else rows


def _tokens_to_null(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    if not tokens:
        return df
    return df.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(*tokens), F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _require_files(df: DataFrame, path: str, dialect: CsvDialect) -> None:
    """An error if there is nothing to scan, by the listing that the scan has made already."""
    if not df.inputFiles():
        raise ValueError(f"no {dialect.pattern} files in {path}")


def read_csv_dir(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    dialect: CsvDialect = CsvDialect(),
    on_header_mismatch: str = "raise",
    malformed: str | None = None,
) -> DataFrame:
    """All files of a directory as one scan under a declared schema.

    Values that do not fit their type become NULL. ``malformed`` names a further column for
    the text of records with such values, or with too few or too many. ``on_header_mismatch``:
    "raise" has the scan compare each header with the schema and fail the job,
    "by_name" lines columns up by header, "ignore" binds columns by position.
    """
    if on_header_mismatch == "by_name":
        if malformed:
            raise ValueError("malformed records are told by position only")
        return read_csv_by_name(spark, path, dialect, schema)
    if on_header_mismatch not in ("raise", "ignore"):
        raise ValueError(f"unknown on_header_mismatch {on_header_mismatch!r}")
    rows = scan_files(spark, path, schema, dialect, check_headers=on_header_mismatch == "raise", malformed=malformed)
    _require_files(rows, path, dialect)
    return _tokens_to_null(rows, dialect.null_tokens)


def read_csv_inferred(spark: SparkSession, path: str, dialect: CsvDialect = CsvDialect()) -> DataFrame:
    """File or directory with column types inferred, at the cost of one more pass.

    Files are read as a whole where records may run over several lines.
    """
    return _reader(spark, dialect).option("inferSchema", True).csv(path)


def header_consistency(
    spark: SparkSession,
    path: str,
    expected: Sequence[str] | None = None,
    dialect: CsvDialect = CsvDialect(),
) -> DataFrame:
    """``file_name, header, consistent`` for every file, order of columns included.

    Compared with ``expected``, or else with the first file by name.
    """
    headers = file_headers(spark, path, dialect)
    wanted = headers.agg(F.min_by("header", "file_path")).scalar() if expected is None else _names(expected)
    same = F.coalesce(F.col("header") == wanted, F.lit(False))
    return headers.select("file_name", "header", same.alias("consistent"))


def _names(header: Sequence[str]) -> Column:
    return F.array(*[F.lit(c) for c in header])


def read_csv_by_name(
    spark: SparkSession,
    path: str,
    dialect: CsvDialect = CsvDialect(),
    schema: T.StructType | None = None,
    found: Layouts | None = None,
) -> DataFrame:
    """All files, columns lined up by header name; missing ones are NULL.

    Columns come in order of first appearance over the files by name, as text, or
    as ``schema`` declares them (other columns are then left out).

    Names match in any case; a name that a header repeats is numbered (v, v_1).

    However many layouts there are, the data are scanned once. Headers stay in Spark; only
    the most usual one and, without a schema, the column names come to the driver. Where
    headers differ, each row finds the places of its columns by its file, in a join with
    the files that do not have the most usual header. ``found`` hands in the ``layouts``
    where the caller has them already.
    """
    headers = file_headers(spark, path, dialect)
    found = found or layouts(headers)
    if not found.different:
        _require_files(scan_files(spark, path, T.StructType([T.StructField("c", T.StringType())]), dialect), path, dialect)
        return spark.createDataFrame([], schema or T.StructType([]))
    if found.different == 1:
        df = _one_layout(spark, path, dialect, found.usual, schema)
    else:
        df = _many_layouts(spark, path, dialect, headers, found, schema)
    return _tokens_to_null(df, dialect.null_tokens)


def _one_layout(
    spark: SparkSession,
    path: str,
    dialect: CsvDialect,
    header: Sequence[str],
    schema: T.StructType | None,
) -> DataFrame:
    names = numbered(header)
    declared = {f.name.lower(): f for f in schema.fields} if schema else {}
    texts = {c.lower(): T.StructField(c, T.StringType(), True) for c in names}
    fields = [declared.get(c, texts[c]) for c in texts]
    rows = scan_files(spark, path, T.StructType(fields), dialect)
    if schema is None:
        return rows
    absent = {f.name: F.lit(None).cast(f.dataType) for c, f in declared.items() if c not in texts}
    return rows.withColumns(absent).select(*[F.col(f"`{c}`") for c in schema.names])


def _many_layouts(
    spark: SparkSession,
    path: str,
    dialect: CsvDialect,
    headers: DataFrame,
    found: Layouts,
    schema: T.StructType | None,
) -> DataFrame:
    slots = [f"__{i}" for i in range(found.widest)]
    texts = T.StructType([T.StructField(slot, T.StringType(), True) for slot in slots])
    rows = scan_files(spark, path, texts, dialect, file_column="file_path")
    names = column_names(headers) if schema is None else schema.names

    # Places of the wanted columns, per file: as many expressions as columns, however many layouts.
    lower = F.transform(numbered_in_rows(F.col("header")), F.lower)
    places = F.array(*[F.array_position(lower, c.lower()).cast("int") for c in names])
    unusual = headers.filter(F.col("header") != _names(found.usual)).select("file_path", places.alias("__places"))
    joined = rows.join(unusual, "file_path", "left")

    usual_slots = {c.lower(): F.col(slot) for c, slot in zip(numbered(found.usual), slots)}
    cells = F.array(*slots)

    def value(i: int, name: str) -> Column:
        own = usual_slots.get(name.lower(), F.lit(None).cast("string"))
        there = F.get(cells, F.col("__places")[i] - 1)
        return F.when(F.col("__places").isNull(), own).otherwise(there)

    values = [value(i, c) for i, c in enumerate(names)]
    if schema is None:
        return joined.select(*[v.alias(c) for v, c in zip(values, names)])
    return joined.select(*[_as_type(v, f.dataType).alias(f.name) for v, f in zip(values, schema.fields)])


def _as_type(text: Column, kind: T.DataType) -> Column:
    """Text to a declared type by the CSV reader's rule: no blanks around whole numbers."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.IntegralType):
        text = F.when(text.rlike(r"^[+-]?\d+$"), text)
    return text.try_cast(kind)


def rows_per_file(
    spark: SparkSession, path: str, schema: T.StructType, dialect: CsvDialect = CsvDialect()
) -> DataFrame:
    """``file_name, n`` for every file of the directory, 0 for those without rows."""
    rows = scan_files(spark, path, schema, dialect, file_column="file_path")
    _require_files(rows, path, dialect)
    counts = rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))
    # The files are those of the scan's own listing.
    return listed_files(rows).join(counts, "file_path", "left").select(
        F.substring_index("file_path", "/", -1).alias("file_name"), F.coalesce("n", F.lit(0)).alias("n")
    )
