"""The cleansing job: CSV directory -> clean, deduplicated Parquet and run metrics."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions import parse_int, parse_timestamp, snake_case, snake_columns
from scrubline.operators import dedup, quality, rules
from scrubline.operators.profiling import distinct_with_null, row_array
from scrubline.operators.quality import Check
from scrubline.operators.rules import Rule
from scrubline.plans import report
from scrubline.plans.scratch import drop_scratch, scratch_path
from scrubline.sinks import partition_listing, write_partitioned_parquet, write_single_parquet
from scrubline.sources import CsvDialect, read_csv_dir

# Fixed value: the columns of the input files.
SALES_SCHEMA = T.StructType(
    [
        T.StructField("Order ID", T.StringType(), True),
        T.StructField("Product", T.StringType(), True),
        T.StructField("Quantity Ordered", T.IntegerType(), True),
        T.StructField("Price Each", T.DoubleType(), True),
        T.StructField("Order Date", T.StringType(), True),
        T.StructField("Purchase Address", T.StringType(), True),
    ]
)


@dataclass(frozen=True)
class CleanseConfig:
    """Columns and rules of the job; the defaults are those of the sales record.

    Apart from ``schema`` (names as in the files), columns are given by their
    names after renaming.

    ``metrics``: "staged" writes the classified rows once to a columnar working
    table and counts there, so counts are exact whatever is re-run; "observed"
    counts while writing, in a single scan, but tasks that Spark repeats after a
    lost executor may be counted again.

    IDs beyond 32 bits are NULL in the output, but rows are told apart by the whole
    number. ``merge_overflow`` takes them as one ID, NULL, before deduplication.

    ``malformed_column``: where the text of records that do not fit the schema goes. They are
    then rejected under that name, and not for the NULL that such a value becomes.

    ``report_to``: a folder for the metrics (JSON) and the summary (text).
    """

    schema: T.StructType = SALES_SCHEMA
    dialect: CsvDialect = CsvDialect()
    on_header_mismatch: str = "raise"
    id_column: str = "order_id"
    positive_columns: tuple[str, ...] = ("quantity_ordered", "price_each")
    date_column: str = "order_date"
    date_formats: tuple[str, ...] = ("MM/dd/yy HH:mm",)
    year_column: str = "order_year"
    month_column: str = "order_month"
    keys: tuple[str, ...] = ("order_id", "product")
    tie_breakers: tuple[str, ...] | None = None
    range_columns: tuple[str, ...] = ("quantity_ordered", "price_each")
    total_columns: tuple[str, ...] = ("quantity_ordered",)
    distinct_columns: tuple[str, ...] = ("product", "order_id")
    checks: tuple[Check, ...] = field(
        default_factory=lambda: (
            Check("not_null", "order_id"),
            Check("not_null", "product"),
            Check("not_null", "quantity_ordered"),
            Check("not_null", "price_each"),
            Check("at_least", "quantity_ordered", 1),
            Check("above", "price_each", 0),
            Check("has_values", "product"),
            Check("has_values", "order_id"),
        )
    )
    reject_overflow: bool = False
    merge_overflow: bool = False
    reject_non_finite: bool = False
    malformed_column: str | None = None
    output: str = "partitioned"
    metrics: str = "staged"
    on_fail: str = "warn"
    report_to: str | None = None

    @property
    def columns(self) -> list[str]:
        return [snake_case(c) for c in self.schema.names]

    @property
    def parsed_column(self) -> str:
        return f"{self.date_column}_parsed"

    @property
    def partition_columns(self) -> list[str]:
        return [self.year_column, self.month_column]


def record_rules(config: CleanseConfig) -> list[Rule]:
    """The row rules in order; a row is rejected by the first one it breaks."""
    found = [Rule(config.malformed_column, F.col(config.malformed_column).isNull())] if config.malformed_column else []
    found += [
        rules.required(config.columns, "null_field"),
        rules.digits(config.id_column, f"invalid_{config.id_column}"),
    ]
    if config.reject_overflow:
        fits = parse_int(F.col(config.id_column)).isNotNull()
        found.append(Rule(f"overflow_{config.id_column}", fits))
    found.append(rules.positive(config.positive_columns, "non_positive_value"))
    if config.reject_non_finite:
        finite = F.lit(True)
        for c in config.positive_columns:
            finite = finite & (F.col(c).cast("double") < F.lit(float("inf")))
        found.append(Rule("non_finite_value", finite))
    found.append(rules.parsed(config.parsed_column, "bad_date"))
    return found


def with_parsed_date(df: DataFrame, config: CleanseConfig) -> DataFrame:
    parsed = parse_timestamp(F.col(config.date_column), *config.date_formats)
    return df.withColumn(config.parsed_column, parsed)


def typed(accepted: DataFrame, config: CleanseConfig) -> DataFrame:
    """Accepted rows with their ID as an integer."""
    return accepted.withColumn(config.id_column, parse_int(F.col(config.id_column)))


def with_year_month(df: DataFrame, config: CleanseConfig) -> DataFrame:
    date = F.col(config.parsed_column)
    return df.withColumns({config.year_column: F.year(date), config.month_column: F.month(date)})


def clean(df: DataFrame, config: CleanseConfig = CleanseConfig()) -> DataFrame:
    """Rows that pass the rules, typed; the text date is kept beside the parsed one."""
    accepted = rules.accept(with_parsed_date(df, config), record_rules(config))
    return with_year_month(typed(accepted, config), config)


def latest(cleaned: DataFrame, config: CleanseConfig = CleanseConfig()) -> DataFrame:
    """The latest row per key."""
    breakers = config.tie_breakers
    if breakers is None:
        # Year and month follow from the date and settle nothing.
        used = {*config.keys, config.parsed_column, *config.partition_columns}
        breakers = [c for c in cleaned.columns if c not in used]
    return dedup.keep_latest(cleaned, config.keys, [config.parsed_column], breakers)


def latest_records(cleaned: DataFrame, config: CleanseConfig = CleanseConfig()) -> DataFrame:
    """The latest row per key as the output record, the parsed date in place of its text.

    What the record does not hold, or what follows from it, is not shuffled.
    """
    needed = cleaned.drop(config.date_column, *config.partition_columns)
    dated = with_year_month(latest(needed, config), config)
    record = [
        F.col(config.parsed_column).alias(c) if c == config.date_column else F.col(c)
        for c in config.columns
    ]
    return dated.select(*record, *config.partition_columns)


def latest_accepted(accepted: DataFrame, config: CleanseConfig = CleanseConfig()) -> DataFrame:
    """Output records from accepted rows whose ID is still text.

    The ID is cast after deduplication: rows that overflow stay apart.
    """
    if config.merge_overflow or config.id_column not in config.keys:
        return latest_records(typed(accepted, config), config)
    number = F.regexp_replace(config.id_column, r"^0+(?=\d)", "")
    return typed(latest_records(accepted.withColumn(config.id_column, number), config), config)


def clean_latest(df: DataFrame, config: CleanseConfig = CleanseConfig()) -> DataFrame:
    """Rows that pass the rules, the latest per key, as output records."""
    accepted = rules.accept(with_parsed_date(df, config), record_rules(config))
    return latest_accepted(accepted, config)


@dataclass(frozen=True)
class CleanseResult:
    """``metrics`` and ``checks`` are small frames; ``text`` is the summary to print."""

    location: str
    metrics: DataFrame
    checks: DataFrame
    text: str


def cleanse(
    spark: SparkSession, source: str, target: str, config: CleanseConfig = CleanseConfig()
) -> CleanseResult:
    """Read, clean, deduplicate, write, check and report.

    The source is listed once, its CSV text is scanned once and the key shuffle runs once. With
    the default dialect a file is one task, however large it is; ``multiline=False`` splits files. Checks and value
    statistics come from one aggregate over the Parquet just written. A failed
    check is reported after the write, as a warning or (``on_fail="raise"``) an error.
    """
    if config.output not in ("partitioned", "single"):
        raise ValueError(f"unknown output {config.output!r}")
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        warnings.warn("session time zone is not UTC: dates are read in that zone", stacklevel=2)
    raw = read_csv_dir(spark, source, config.schema, config.dialect, config.on_header_mismatch, config.malformed_column)
    # From the listing that the scan has made; files of zero bytes are among them.
    input_files = len(set(raw.inputFiles()))
    records = with_parsed_date(snake_columns(raw), config)
    if config.metrics == "staged":
        counts, schema = _run_staged(spark, records, target, config)
    elif config.metrics == "observed":
        counts, schema = _run_observed(records, target, config)
    else:
        raise ValueError(f"unknown metrics mode {config.metrics!r}")

    stats, checks = _output_statistics(spark, target, schema, config)
    partitions = []
    if config.output == "partitioned":
        listing = partition_listing(spark, target, config.partition_columns, schema)
        partitions = sorted("/".join(map(str, r[:-1])) for r in listing.collect())
    values = report.metrics_values(input_files, counts, stats, checks, partitions, target)
    metrics = report.metrics_frame(spark, config, values, counts)
    if config.report_to:
        report.write_report(spark, metrics, config.report_to)
    quality.enforce(values["quality_issues"], config.on_fail)
    return CleanseResult(
        target,
        metrics,
        report.checks_frame(spark, checks),
        report.render({name: values[name] for name in metrics.columns}),
    )


def _write_latest(accepted: DataFrame, target: str, config: CleanseConfig) -> T.StructType:
    """Dedup and write accepted records; returns the schema of the output."""
    df = latest_accepted(accepted, config)
    if config.output == "partitioned":
        write_partitioned_parquet(df, target, config.partition_columns)
    else:
        write_single_parquet(df, target)
    return df.schema


def _accepted(classified: DataFrame, config: CleanseConfig) -> DataFrame:
    accepted = classified.filter(F.col(rules.REASON).isNull()).drop(rules.REASON)
    return accepted.drop(config.malformed_column) if config.malformed_column else accepted


def _run_staged(
    spark: SparkSession, records: DataFrame, target: str, config: CleanseConfig
) -> tuple[dict, T.StructType]:
    """Classified rows go to a working table, where counting reads a single column."""
    row_rules = record_rules(config)
    staging = scratch_path(spark, "classified")
    try:
        staged = rules.classify(records, row_rules).drop(config.date_column)
        staged.write.parquet(staging)
        classified = spark.read.schema(staged.schema).parquet(staging)
        schema = _write_latest(_accepted(classified, config), target, config)
        return classified.agg(*rules.reason_counts(row_rules)).first().asDict(), schema
    finally:
        drop_scratch(spark, staging)


def _run_observed(
    records: DataFrame, target: str, config: CleanseConfig
) -> tuple[dict, T.StructType]:
    """Counts ride along with the write."""
    row_rules = record_rules(config)
    seen = Observation("classified")
    classified = rules.classify(records, row_rules).observe(seen, *rules.reason_counts(row_rules))
    schema = _write_latest(_accepted(classified, config), target, config)
    return seen.get, schema


def _output_statistics(
    spark: SparkSession, target: str, schema: T.StructType, config: CleanseConfig
) -> tuple[dict, Sequence]:
    """One aggregate over the written rows gives statistics and check values alike."""
    aggregates = {"output_rows": F.count(F.lit(1))}
    for c in config.range_columns:
        aggregates[f"min_{c}"], aggregates[f"max_{c}"] = F.min(c), F.max(c)
    for c in config.total_columns:
        aggregates[f"total_{c}"] = F.sum(c)
    for c in config.distinct_columns:
        aggregates[f"distinct_{c}"] = distinct_with_null(c)
    aggregates["min_date"], aggregates["max_date"] = F.min(config.date_column), F.max(config.date_column)
    names = [f"check_{i}" for i in range(len(config.checks))]
    observed = {name: check.observed() for name, check in zip(names, config.checks)}
    one_row = (
        spark.read.schema(schema)
        .parquet(target)
        .agg(*[value.alias(name) for name, value in (aggregates | observed).items()])
    )
    checks = row_array(quality.check_rows(config.checks, names)).alias("checks")
    values = one_row.select(*aggregates, checks).first().asDict()
    return values, values.pop("checks")
