"""Messy sales records made from the test tables, in SQL that two engines share.

Every line item becomes one record. Which records are spoilt, and how, follows
from the order key: blank records, repeated header lines, IDs with letters or
beyond 32 bits, zero quantities, negative prices, and dates that do not parse.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.plans.cleansing import SALES_SCHEMA
from scrubline.plans.scratch import drop_scratch, scratch_path
from scrubline.sinks import write_csv
from scrubline.sources import CsvDialect
from scrubline.sources.files import literal_path

_WRITTEN: dict[tuple[str, str, str], str] = {}

RAW_COLUMNS = (
    "order_id",
    "product",
    "quantity_ordered",
    "price_each",
    "order_date",
    "purchase_address",
)

RAW_SELECT = """
SELECT
  CASE WHEN l_orderkey % 41 = 0 THEN NULL
       WHEN l_orderkey % 43 = 0 THEN 'Order ID'
       WHEN l_orderkey % 47 = 0 THEN 'X' || CAST(l_orderkey AS STRING)
       WHEN l_orderkey % 997 = 0 THEN '99999999999'
       ELSE CAST(l_orderkey AS STRING) END AS order_id,
  CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE p_name END AS product,
  CASE WHEN l_orderkey % 41 = 0 OR l_orderkey % 43 = 0 THEN NULL
       WHEN l_orderkey % 53 = 0 THEN 0
       ELSE CAST(l_quantity AS INT) END AS quantity_ordered,
  CASE WHEN l_orderkey % 41 = 0 OR l_orderkey % 43 = 0 THEN NULL
       WHEN l_orderkey % 59 = 0 THEN -p_retailprice
       ELSE p_retailprice END AS price_each,
  CASE WHEN l_orderkey % 41 = 0 THEN NULL
       WHEN l_orderkey % 43 = 0 THEN 'Order Date'
       WHEN l_orderkey % 61 = 0 THEN '13/45/19 22:30'
       WHEN l_orderkey % 67 = 0 THEN '4/7/19 22:30'
       ELSE lpad(CAST(month(l_shipdate) AS STRING), 2, '0') || '/' ||
            lpad(CAST(day(l_shipdate) AS STRING), 2, '0') || '/' ||
            lpad(CAST((year(l_shipdate) + 20) % 100 AS STRING), 2, '0') || ' ' ||
            lpad(CAST(l_partkey % 24 AS STRING), 2, '0') || ':' ||
            lpad(CAST(l_suppkey % 60 AS STRING), 2, '0') END AS order_date,
  CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE c_name || ', ' || c_mktsegment END AS purchase_address
"""
RAW_TEMPLATE = RAW_SELECT + """FROM {lineitem}
JOIN {orders} ON l_orderkey = o_orderkey
JOIN {part} ON l_partkey = p_partkey
JOIN {customer} ON o_custkey = c_custkey
"""
RAW_TABLES = ("lineitem", "orders", "part", "customer")
RAW_SQL = RAW_TEMPLATE.format(**{name: name for name in RAW_TABLES})


# A label that parts all records into feeds, as if they came from several senders.
FEEDS = ("blank", "coded", "header", "plain")
FEED_SQL = """CASE WHEN order_id IS NULL THEN 'blank'
       WHEN order_id = 'Order ID' THEN 'header'
       WHEN order_id LIKE 'X%' THEN 'coded'
       ELSE 'plain' END"""


CSV_FILES, LAYOUT_FILES = 8, 6

# The quantity of some records is no number.
BAD_QUANTITY_SQL = "order_id LIKE '%7'"

# Texts of every type, and of types that only all values together show.
TYPED_SQL = """
SELECT CASE WHEN l_linenumber % 2 = 0 THEN 'true' ELSE 'FALSE' END AS flag,
       CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE CAST(l_linenumber AS STRING) END AS gaps,
       CAST(l_orderkey + 3000000000 AS STRING) AS big,
       CAST(l_orderkey AS STRING) || '00000000000000000000' AS huge,
       CASE WHEN l_orderkey % 7 = 0 THEN '1d' ELSE CAST(l_linenumber AS STRING) END AS suffixed,
       CASE WHEN l_orderkey % 11 = 0 THEN '  ' ELSE CAST(l_linenumber AS STRING) END AS blanks,
       CASE WHEN l_orderkey % 13 = 0 THEN 'true' ELSE CAST(l_linenumber AS STRING) END AS mixed,
       {day} AS day,
       {day} || CASE WHEN l_orderkey % 3 = 0 THEN ' 10:00:00' ELSE '' END AS moment,
       CASE WHEN l_orderkey % 1000 = 0 THEN '4/7/19' ELSE {day} END AS almost
FROM {lineitem}
"""

# Dates in five formats, two of which have one shape.
DATED_SQL = """
SELECT CASE l_linenumber % 5
       WHEN 0 THEN {day}
       WHEN 1 THEN {month2} || '/' || {day2} || '/' || {year4}
       WHEN 2 THEN {day2} || '/' || {month2} || '/' || {year4}
       WHEN 3 THEN CAST(day(l_shipdate) AS STRING) || ' Jun ' || {year4} || ' ' || {day2} || ':' || {month2}
       ELSE CASE WHEN l_orderkey % 2 = 0 THEN 'unknown' END END AS dated
FROM {lineitem}
"""
_DAY_PARTS = {
    "year4": "CAST(year(l_shipdate) AS STRING)",
    "month2": "lpad(CAST(month(l_shipdate) AS STRING), 2, '0')",
    "day2": "lpad(CAST(day(l_shipdate) AS STRING), 2, '0')",
}
_DAY = "{year4} || '-' || {month2} || '-' || {day2}".format(**_DAY_PARTS)
TYPED_SQL = TYPED_SQL.replace("{day}", f"({_DAY})")
DATED_SQL = DATED_SQL.replace("{day}", _DAY)
for _name, _part in _DAY_PARTS.items():
    DATED_SQL = DATED_SQL.replace("{" + _name + "}", _part)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(
    spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]
) -> str:
    """Path of a table that is written once per session and directory."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _WRITTEN:
        path = scratch_path(spark, label)
        write(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


def fresh_path(spark: SparkSession, sf_dir: str, label: str) -> str:
    """A new path to write to on every call, which ``drop_written`` deletes as well."""
    path = scratch_path(spark, label)
    _WRITTEN[spark.sparkContext.applicationId, sf_dir, path] = path
    return path


def drop_written(spark: SparkSession) -> None:
    """Delete what this session wrote."""
    for key in [k for k in _WRITTEN if k[0] == spark.sparkContext.applicationId]:
        drop_scratch(spark, _WRITTEN.pop(key))


def _joined(lineitem: DataFrame, orders: DataFrame, part: DataFrame, customer: DataFrame) -> DataFrame:
    """The rows of ``RAW_TEMPLATE``, by joins that shuffle line items while they are narrow.

    Customers go to their orders first, and names of parts to line items before those of customers,
    so that no row is shuffled as a whole record. All joins merge, whatever the size: what is
    shuffled grows in proportion to the tables.
    """
    ordered = orders.select("o_orderkey", "o_custkey").join(customer.hint("merge"), F.expr("o_custkey = c_custkey"))
    lines = lineitem.join(part.hint("merge"), F.expr("l_partkey = p_partkey"))
    joined = lines.join(ordered.hint("merge"), F.expr("l_orderkey = o_orderkey"))
    return joined.sparkSession.sql(RAW_SELECT + "FROM {joined}", joined=joined)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records, read back from a table.

    The records stand for files that were delivered: queries over them scan a
    table instead of repeating the joins that make it.
    """

    def write(path: str) -> None:
        _joined(*[table(spark, sf_dir, name) for name in RAW_TABLES]).write.parquet(path)

    return spark.read.parquet(written(spark, sf_dir, "raw-records", write))


def with_file_headers(df: DataFrame) -> DataFrame:
    """The raw columns under the names they have in files."""
    return df.withColumnsRenamed(dict(zip(RAW_COLUMNS, SALES_SCHEMA.names)))


def line_dialect(spark: SparkSession, sf_dir: str) -> CsvDialect:
    """Files of records are split into lines unless a text of theirs holds a line break.

    With such a text, records run over several lines and each file is read by a single task.
    """
    records = raw(spark, sf_dir)
    broken = reduce(or_, [F.col(c).rlike(r"[\r\n]") for c, kind in records.dtypes if kind == "string"])
    return CsvDialect(multiline=not records.filter(broken).isEmpty())


@contextmanager
def _tasks_kept(spark: SparkSession) -> Iterator[None]:
    """A union keeps the tasks of all its sides; it would else merge sides of one task each."""
    key = "spark.sql.unionOutputPartitioning"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _write_files(records: DataFrame, files: int, path: str, wanted: str = "true") -> None:
    """Records of a working table as so many CSV files, from as many lots of the table's files and so without a shuffle.

    A table of fewer files is small, and its rows are dealt out. Each lot should hold ``wanted`` rows.
    """
    spark, parts = records.sparkSession, sorted(literal_path(part) for part in records.inputFiles())
    if len(parts) < files:
        return write_csv(with_file_headers(records.filter(wanted)).repartition(files), path)
    lots = [spark.read.schema(records.schema).parquet(*parts[i::files]).coalesce(1) for i in range(files)]
    with _tasks_kept(spark):
        write_csv(with_file_headers(reduce(DataFrame.union, lots).filter(wanted)), path)


def csv_folder(spark: SparkSession, sf_dir: str) -> str:
    """All records as a directory of ``CSV_FILES`` CSV files."""

    def write(path: str) -> None:
        _write_files(raw(spark, sf_dir), CSV_FILES, path)

    return written(spark, sf_dir, "csv", write)


def csv_layouts(spark: SparkSession, sf_dir: str) -> str:
    """All records in one directory of two layouts: the full one, and one without
    the address in another column order. Each layout has ``LAYOUT_FILES`` files."""
    fewer = ["product", "order_id", "order_date", "price_each", "quantity_ordered"]

    def write(path: str) -> None:
        records, plain = raw(spark, sf_dir), f"{FEED_SQL} = 'plain'"
        _write_files(records, LAYOUT_FILES, path, plain)
        others = with_file_headers(records.filter(f"NOT ({plain})").select(*fewer)).repartition(LAYOUT_FILES)
        write_csv(others, path, mode="append")

    return written(spark, sf_dir, "layouts", write)


def csv_feeds(spark: SparkSession, sf_dir: str) -> str:
    """All records as one CSV directory per feed."""

    def write(path: str) -> None:
        labelled = raw(spark, sf_dir).withColumn("feed", F.expr(FEED_SQL))
        rows = with_file_headers(labelled).write.option("header", True).option("escape", '"')
        rows.partitionBy("feed").csv(path)

    return written(spark, sf_dir, "feeds", write)


def text_feeds(spark: SparkSession, sf_dir: str) -> str:
    """The products of all records as one directory of text lines per feed."""

    def write(path: str) -> None:
        lines = raw(spark, sf_dir).select(F.coalesce("product", F.lit("")).alias("value"), F.expr(FEED_SQL).alias("feed"))
        lines.write.partitionBy("feed").text(path)

    return written(spark, sf_dir, "text-feeds", write)


def malformed_csv(spark: SparkSession, sf_dir: str) -> str:
    """All records as a CSV directory, with a word for the quantity of some."""

    def write(path: str) -> None:
        word = F.when(F.expr(BAD_QUANTITY_SQL), "abc").otherwise(F.col("quantity_ordered").cast("string"))
        write_csv(with_file_headers(raw(spark, sf_dir).withColumn("quantity_ordered", word)), path)

    return written(spark, sf_dir, "malformed", write)


def typed_texts(spark: SparkSession, sf_dir: str) -> str:
    """Texts of many types, none of them with a line break, as a CSV directory."""

    def write(path: str) -> None:
        write_csv(spark.sql(TYPED_SQL, lineitem=table(spark, sf_dir, "lineitem")), path)

    return written(spark, sf_dir, "typed-texts", write)


def dated_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as texts of several formats in a column."""
    return spark.sql(DATED_SQL, lineitem=table(spark, sf_dir, "lineitem"))
