"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.catalogue.fixture import (
    FEED_SQL,
    FEEDS,
    RAW_COLUMNS,
    csv_feeds,
    csv_folder,
    csv_layouts,
    dated_texts,
    fresh_path,
    line_dialect,
    malformed_csv,
    raw,
    table,
    text_feeds,
    typed_texts,
    with_file_headers,
)
from scrubline.functions import snake_columns
from scrubline.operators import dates, dedup, profiling, quality, rules
from scrubline.operators.profiling import CastTarget
from scrubline.operators.states import RELATIVE_ERROR, checks_of_state, statistics
from scrubline.plans import CleanseConfig, cleanse, profile
from scrubline.plans.cleansing import (
    SALES_SCHEMA,
    clean,
    clean_latest,
    record_rules,
    typed,
    with_parsed_date,
    with_year_month,
)
from scrubline.plans.deliveries import merge_latest
from scrubline.plans.incremental import update_states
from scrubline.plans.profiling import ProfileConfig
from scrubline.sinks import (
    partition_listing,
    write_csv,
    write_partitioned_parquet,
    write_single_parquet,
)
from scrubline.sources import (
    CsvDialect,
    file_inventory,
    header_consistency,
    preflight,
    read_csv_by_name,
    read_csv_dir,
    read_csv_inferred,
    rows_per_file,
)


SALES = CleanseConfig()
MONTHS = ["order_year", "order_month"]
SALES_CASTS = [
    CastTarget("product", "string"),
    CastTarget("quantity_ordered", "numeric"),
    CastTarget("price_each", "float"),
    CastTarget("order_date", "timestamp", ("MM/dd/yy HH:mm", "M/d/yy H:mm")),
    CastTarget("order_id", "int"),
]


def comparable(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, so that another engine can compare them."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


# -- cleansing -----------------------------------------------------------------


def cleanse_keep_latest(spark, sf_dir):
    return comparable(clean_latest(raw(spark, sf_dir)))


def cleanse_merge_overflow(spark, sf_dir):
    return comparable(clean_latest(raw(spark, sf_dir), CleanseConfig(merge_overflow=True)))


def clean_rows(spark, sf_dir):
    return comparable(clean(raw(spark, sf_dir)))


def reject_summary(spark, sf_dir):
    return rules.reject_summary(with_parsed_date(raw(spark, sf_dir), SALES), record_rules(SALES))


def rejected_rows(spark, sf_dir):
    records = with_parsed_date(raw(spark, sf_dir), SALES)
    return rules.reject(records, record_rules(SALES)).select(*RAW_COLUMNS, rules.REASON)


def malformed_rows(spark, sf_dir):
    config = CleanseConfig(malformed_column="malformed_record")
    dialect = line_dialect(spark, sf_dir)
    records = read_csv_dir(spark, malformed_csv(spark, sf_dir), SALES_SCHEMA, dialect, malformed=config.malformed_column)
    rejected = rules.reject(with_parsed_date(snake_columns(records), config), record_rules(config))
    return rejected.select(*RAW_COLUMNS, config.malformed_column, rules.REASON)


def required_filter(spark, sf_dir):
    return rules.accept(raw(spark, sf_dir), [rules.required(RAW_COLUMNS)])


def digit_id_filter(spark, sf_dir):
    return rules.accept(raw(spark, sf_dir), [rules.digits("order_id")])


def positive_filter(spark, sf_dir):
    return rules.accept(raw(spark, sf_dir), [rules.positive(["quantity_ordered", "price_each"])])


def parsed_date_filter(spark, sf_dir):
    records = with_parsed_date(raw(spark, sf_dir), SALES)
    return rules.accept(records, [rules.parsed("order_date_parsed")]).select(*RAW_COLUMNS)


def numeric_id_filter(spark, sf_dir):
    return rules.accept(raw(spark, sf_dir), [rules.numeric("order_id")])


# -- profiling -----------------------------------------------------------------


def any_null_rows(spark, sf_dir):
    return profiling.any_null_rows(raw(spark, sf_dir))


def null_counts(spark, sf_dir):
    return profiling.null_counts(raw(spark, sf_dir))


def range_stats(spark, sf_dir):
    records = clean(raw(spark, sf_dir)).drop("order_date")
    records = records.withColumnRenamed("order_date_parsed", "order_date")
    ranges = {
        "quantity_ordered": ("min", "max", "sum"),
        "price_each": ("min", "max"),
        "order_date": ("min", "max"),
    }
    return comparable(profiling.range_stats(records, ranges))


def distinct_counts(spark, sf_dir):
    return profiling.distinct_counts(raw(spark, sf_dir), ["order_id", "product", "order_date"])


def key_duplicate_count(spark, sf_dir):
    return dedup.key_duplicate_count(raw(spark, sf_dir), ["order_id"])


def castability(spark, sf_dir):
    distinct = dedup.drop_exact(raw(spark, sf_dir))
    return profiling.castability(rules.accept(distinct, [rules.numeric("order_id")]), SALES_CASTS)


def inferred_types(spark, sf_dir):
    return profiling.inferred_types(read_csv_by_name(spark, typed_texts(spark, sf_dir), CsvDialect(multiline=False)))


def date_formats(spark, sf_dir):
    return dates.date_formats(dated_texts(spark, sf_dir), "dated")


def schema_table(spark, sf_dir):
    return profiling.schema_table(raw(spark, sf_dir))


def shape(spark, sf_dir):
    return profiling.shape(raw(spark, sf_dir))


def sample_values(spark, sf_dir):
    return profiling.sample_values(raw(spark, sf_dir), "order_date")


def preview(spark, sf_dir):
    return comparable(profiling.preview(clean(raw(spark, sf_dir))))


def drop_all_null_columns(spark, sf_dir):
    padded = raw(spark, sf_dir).withColumn("nothing", F.lit(None).cast("string"))
    return profiling.drop_all_null_columns(padded)


def quality_checks(spark, sf_dir):
    return quality.run_checks(clean_latest(raw(spark, sf_dir)), SALES.checks)


# -- deduplication -------------------------------------------------------------


def exact_duplicate_count(spark, sf_dir):
    return dedup.exact_duplicate_count(raw(spark, sf_dir))


def duplicate_members(spark, sf_dir):
    return dedup.duplicate_members(raw(spark, sf_dir))


def drop_exact(spark, sf_dir):
    return dedup.drop_exact(raw(spark, sf_dir))


def accepted_records(spark, sf_dir):
    """Accepted records as the job deduplicates them: IDs are text, so that those beyond 32 bits stay apart."""
    accepted = rules.accept(with_parsed_date(raw(spark, sf_dir), SALES), record_rules(SALES))
    return accepted.withColumn("order_id", F.regexp_replace("order_id", r"^0+(?=\d)", ""))


def dedup_summary(spark, sf_dir):
    return dedup.summary(accepted_records(spark, sf_dir), SALES.keys)


def events_latest(spark, sf_dir):
    return dedup.keep_latest(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts"])


def documents_exact_text_duplicates(spark, sf_dir):
    # Texts are long: compare their SHA-256, so that only the rows themselves carry text.
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    keyed = documents.withColumn("text_digest", F.sha2("text", 256))
    return dedup.key_members(keyed, ["text_digest"]).drop("text_digest")


def wide_row_copies(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").drop("doc_id")
    found = dedup.copies_of_wide_rows(documents, name="copies")
    return found.select(F.md5("text").alias("text_md5"), "lang", "source", "n_chars", "copies")


# -- sources, sinks, set operations --------------------------------------------


def column_normalise(spark, sf_dir):
    return snake_columns(with_file_headers(raw(spark, sf_dir)))


def union_positional(spark, sf_dir):
    records = raw(spark, sf_dir)
    plain = F.expr(FEED_SQL) == "plain"
    others = records.filter(~plain).toDF(*[f"c{i}" for i in range(len(RAW_COLUMNS))])
    return records.filter(plain).union(others)


def csv_round_trip(spark, sf_dir):
    return snake_columns(read_csv_dir(spark, csv_folder(spark, sf_dir), SALES_SCHEMA, line_dialect(spark, sf_dir)))


def csv_union_by_name(spark, sf_dir):
    path, dialect = csv_layouts(spark, sf_dir), line_dialect(spark, sf_dir)
    return snake_columns(read_csv_dir(spark, path, SALES_SCHEMA, dialect, on_header_mismatch="by_name"))


def csv_inferred(spark, sf_dir):
    return snake_columns(read_csv_inferred(spark, csv_folder(spark, sf_dir), line_dialect(spark, sf_dir)))


def rows_per_feed(spark, sf_dir):
    base = csv_feeds(spark, sf_dir)
    per_feed = []
    for feed in FEEDS:
        files = rows_per_file(spark, f"{base}/feed={feed}", SALES_SCHEMA)
        per_feed.append(files.agg(F.sum("n").alias("n")).select(F.lit(feed).alias("feed"), "n"))
    return reduce(DataFrame.unionByName, per_feed)


def headers_by_layout(spark, sf_dir):
    checked = header_consistency(spark, csv_layouts(spark, sf_dir), SALES_SCHEMA.names)
    return checked.groupBy(F.array_join("header", "|").alias("header"), "consistent").agg(F.count(F.lit(1)).alias("files"))


def bytes_per_feed(spark, sf_dir):
    base = text_feeds(spark, sf_dir)
    per_feed = []
    for feed in FEEDS:
        files = file_inventory(spark, f"{base}/feed={feed}", "*.txt")
        per_feed.append(files.agg(F.sum("size_bytes").alias("size_bytes")).select(F.lit(feed).alias("feed"), "size_bytes"))
    return reduce(DataFrame.unionByName, per_feed)


def preflight_per_feed(spark, sf_dir):
    base = text_feeds(spark, sf_dir)
    told = []
    for feed in FEEDS:
        for pattern in ("*.txt", "*.csv"):
            found = preflight(spark, f"{base}/feed={feed}", pattern)
            named = (F.size("first_files") + F.col("more") == F.col("observed")).alias("all_told")
            told.append(found.select(F.lit(feed).alias("feed"), F.lit(pattern).alias("pattern"), "check_name", "passed", named))
    return reduce(DataFrame.unionByName, told)


def partitioned_round_trip(spark, sf_dir):
    path = fresh_path(spark, sf_dir, "partitioned")
    write_partitioned_parquet(clean_latest(raw(spark, sf_dir)), path, MONTHS)
    return comparable(spark.read.parquet(path))


def partition_rows(spark, sf_dir):
    path = fresh_path(spark, sf_dir, "partitioned")
    write_partitioned_parquet(clean_latest(raw(spark, sf_dir)), path, MONTHS)
    return partition_listing(spark, path, MONTHS)


def single_parquet_round_trip(spark, sf_dir):
    path = fresh_path(spark, sf_dir, "single")
    write_single_parquet(clean_latest(raw(spark, sf_dir)), path)
    return comparable(spark.read.parquet(path))


def duplicate_members_csv(spark, sf_dir):
    path = fresh_path(spark, sf_dir, "members")
    write_csv(with_file_headers(dedup.duplicate_members(raw(spark, sf_dir))), path)
    return snake_columns(read_csv_dir(spark, path, SALES_SCHEMA))


# -- whole jobs ----------------------------------------------------------------

def comparable_metrics(metrics: DataFrame) -> DataFrame:
    texts = {c: F.array_join(F.array_sort(c), ",") for c in ("partitions", "quality_issues")}
    return comparable(metrics.drop("location").withColumns(texts))


def cleanse_metrics(spark, sf_dir):
    source, config = csv_folder(spark, sf_dir), CleanseConfig(dialect=line_dialect(spark, sf_dir))
    return comparable_metrics(cleanse(spark, source, fresh_path(spark, sf_dir, "cleansed"), config).metrics)


def summary_report(spark, sf_dir):
    config = CleanseConfig(dialect=line_dialect(spark, sf_dir), report_to=fresh_path(spark, sf_dir, "report"))
    result = cleanse(spark, csv_folder(spark, sf_dir), fresh_path(spark, sf_dir, "cleansed"), config)
    stored = spark.read.schema(result.metrics.schema).json(f"{config.report_to}/metrics")
    return comparable_metrics(stored)


def cleanse_partitioned(spark, sf_dir):
    config = CleanseConfig(dialect=line_dialect(spark, sf_dir))
    result = cleanse(spark, csv_folder(spark, sf_dir), fresh_path(spark, sf_dir, "cleansed"), config)
    return comparable(spark.read.parquet(result.location))


def cleanse_output(spark, sf_dir):
    source = csv_folder(spark, sf_dir)
    config = CleanseConfig(dialect=line_dialect(spark, sf_dir), output="single", metrics="observed")
    result = cleanse(spark, source, fresh_path(spark, sf_dir, "cleansed"), config)
    return comparable(spark.read.parquet(result.location))


def profile_report(spark, sf_dir):
    report = profile(spark, csv_folder(spark, sf_dir), ProfileConfig(dialect=line_dialect(spark, sf_dir)))
    # Compression and quotes decide how large files are.
    return report.filter("item <> 'total_kb'")


# -- deliveries ------------------------------------------------------------------


def two_deliveries(spark, sf_dir):
    """States of the records' files, which come in two deliveries."""
    base, store = csv_feeds(spark, sf_dir), fresh_path(spark, sf_dir, "states")
    sources = [f"{base}/feed={feed}" for feed in FEEDS]
    update_states(spark, sources[:2], store, SALES_SCHEMA)
    return update_states(spark, sources, store, SALES_SCHEMA)


def incremental_profile(spark, sf_dir):
    states = two_deliveries(spark, sf_dir)
    found = statistics(states.merged(), states.columns).drop("total")
    exact = profiling.distinct_counts(raw(spark, sf_dir)).select("column_name", "distinct_with_null")
    off = F.abs(F.col("distinct_estimate") - F.col("distinct_with_null")) / F.greatest(F.col("distinct_with_null"), F.lit(1))
    within = (off <= 3 * RELATIVE_ERROR).alias("within_bound")
    return found.join(exact, "column_name").select(*[c for c in found.columns if c != "distinct_estimate"], within)


def incremental_checks(spark, sf_dir):
    checks = checks_of_state(two_deliveries(spark, sf_dir).merged(), SALES.checks)
    counted = F.when(~F.col("check_name").startswith("has_values"), F.col("observed"))
    return checks.select("check_name", counted.alias("observed"), "passed")


def deliveries_one_by_one(spark, sf_dir):
    records = with_year_month(accepted_records(spark, sf_dir), SALES).drop("order_date")
    path = fresh_path(spark, sf_dir, "latest")
    breakers = ["quantity_ordered", "price_each", "purchase_address"]
    for i in range(3):
        delivery = records.filter(F.col("quantity_ordered") % 3 == i)
        merge_latest(spark, delivery, path, SALES.keys, ["order_date_parsed"], MONTHS, breakers)
    found = spark.read.schema(records.schema).parquet(path).withColumnRenamed("order_date_parsed", "order_date")
    return comparable(typed(found, SALES))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse_keep_latest(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "cleanse_keep_latest": cleanse_keep_latest,
        "cleanse_merge_overflow": cleanse_merge_overflow,
        "clean_rows": clean_rows,
        "reject_summary": reject_summary,
        "rejected_rows": rejected_rows,
        "malformed_rows": malformed_rows,
        "required_filter": required_filter,
        "digit_id_filter": digit_id_filter,
        "positive_filter": positive_filter,
        "parsed_date_filter": parsed_date_filter,
        "numeric_id_filter": numeric_id_filter,
        "any_null_rows": any_null_rows,
        "null_counts": null_counts,
        "range_stats": range_stats,
        "distinct_counts": distinct_counts,
        "key_duplicate_count": key_duplicate_count,
        "castability": castability,
        "inferred_types": inferred_types,
        "date_formats": date_formats,
        "schema_table": schema_table,
        "shape": shape,
        "sample_values": sample_values,
        "preview": preview,
        "drop_all_null_columns": drop_all_null_columns,
        "quality_checks": quality_checks,
        "exact_duplicate_count": exact_duplicate_count,
        "duplicate_members": duplicate_members,
        "drop_exact": drop_exact,
        "dedup_summary": dedup_summary,
        "events_latest": events_latest,
        "documents_exact_text_duplicates": documents_exact_text_duplicates,
        "wide_row_copies": wide_row_copies,
        "column_normalise": column_normalise,
        "union_positional": union_positional,
        "csv_round_trip": csv_round_trip,
        "csv_union_by_name": csv_union_by_name,
        "csv_inferred": csv_inferred,
        "rows_per_file": rows_per_feed,
        "header_consistency": headers_by_layout,
        "file_inventory": bytes_per_feed,
        "input_preflight": preflight_per_feed,
        "partitioned_round_trip": partitioned_round_trip,
        "partition_rows": partition_rows,
        "single_parquet_round_trip": single_parquet_round_trip,
        "duplicate_members_csv": duplicate_members_csv,
        "cleanse_metrics": cleanse_metrics,
        "summary_report": summary_report,
        "cleanse_output": cleanse_output,
        "cleanse_partitioned": cleanse_partitioned,
        "profile_report": profile_report,
        "incremental_profile": incremental_profile,
        "incremental_checks": incremental_checks,
        "deliveries_one_by_one": deliveries_one_by_one,
    }
