"""The same queries as SQL for a second engine (DuckDB)."""

from __future__ import annotations

from scrubline.catalogue.fixture import BAD_QUANTITY_SQL, CSV_FILES, FEED_SQL, LAYOUT_FILES, RAW_COLUMNS, RAW_SQL, TYPED_SQL
from scrubline.functions.parsing import NUMBER_PATTERN

COLUMNS = ", ".join(RAW_COLUMNS)
ANY_NULL = " OR ".join(f"{c} IS NULL" for c in RAW_COLUMNS)
PARSED = (
    r"CASE WHEN regexp_full_match(order_date, '\d\d/\d\d/\d\d \d\d:\d\d') "
    "THEN try_strptime(order_date, '%m/%d/%y %H:%M') END"
)
NUMERIC_ID = f"regexp_matches(order_id, '{NUMBER_PATTERN}')"
# One- and two-digit months, days and hours, as the lenient date formats take them.
LENIENT_DATE = (
    r"CASE WHEN regexp_full_match(order_date, '\d{1,2}/\d{1,2}/\d\d \d{1,2}:\d\d') "
    "THEN try_strptime(order_date, '%m/%d/%y %H:%M') END"
)

LAYERS = f"""
WITH raw AS ({RAW_SQL}),
classified AS (
  SELECT *, CASE
    WHEN {ANY_NULL} THEN 'null_field'
    WHEN NOT regexp_full_match(order_id, '[0-9]+') THEN 'invalid_order_id'
    WHEN NOT (quantity_ordered > 0 AND price_each > 0) THEN 'non_positive_value'
    WHEN order_date_parsed IS NULL THEN 'bad_date' END AS reject_reason
  FROM (SELECT *, {PARSED} AS order_date_parsed FROM raw)
),
clean AS (
  SELECT TRY_CAST(order_id AS INTEGER) AS order_id, product, quantity_ordered, price_each,
         order_date, purchase_address, order_date_parsed,
         CAST(year(order_date_parsed) AS INTEGER) AS order_year,
         CAST(month(order_date_parsed) AS INTEGER) AS order_month
  FROM classified WHERE reject_reason IS NULL
),
merged AS (
  SELECT * EXCLUDE (rank) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY order_id, product
      ORDER BY order_date_parsed DESC, quantity_ordered DESC, price_each DESC,
               purchase_address DESC, order_date DESC) AS rank
    FROM clean)
  WHERE rank = 1
),
latest AS (
  SELECT TRY_CAST(order_id AS INTEGER) AS order_id, product, quantity_ordered, price_each,
         purchase_address, order_date_parsed,
         CAST(year(order_date_parsed) AS INTEGER) AS order_year,
         CAST(month(order_date_parsed) AS INTEGER) AS order_month
  FROM (
    SELECT *, row_number() OVER (
      PARTITION BY TRY_CAST(order_id AS HUGEINT), product
      ORDER BY order_date_parsed DESC, quantity_ordered DESC, price_each DESC,
               purchase_address DESC) AS rank
    FROM classified WHERE reject_reason IS NULL)
  WHERE rank = 1
),
output AS (
  SELECT order_id, product, quantity_ordered, price_each, order_date_parsed AS order_date,
         purchase_address, order_year, order_month
  FROM latest
),
copies AS (SELECT {COLUMNS}, count(*) AS n FROM raw GROUP BY ALL)
"""


def _long(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _checks() -> str:
    nulls = [
        f"SELECT 'not_null:{c}' AS check_name, CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) AS observed, "
        f"count(*) FILTER ({c} IS NULL) = 0 AS passed FROM latest"
        for c in ("order_id", "product", "quantity_ordered", "price_each")
    ]
    values = [
        f"SELECT 'has_values:{c}', CAST(count(*) AS DOUBLE), count(*) >= 1 FROM (SELECT DISTINCT {c} FROM latest)"
        for c in ("product", "order_id")
    ]
    return _long(
        nulls
        + [
            "SELECT 'at_least:quantity_ordered', CAST(min(quantity_ordered) AS DOUBLE), min(quantity_ordered) >= 1 FROM latest",
            "SELECT 'above:price_each', CAST(min(price_each) AS DOUBLE), min(price_each) > 0 FROM latest",
        ]
        + values
    )


def _bad_number(column: str) -> str:
    return f"count(*) FILTER (NOT regexp_matches(CAST({column} AS VARCHAR), '{NUMBER_PATTERN}'))"


# Values that are there but do not convert, per column.
BAD_VALUES = {
    "product": "count(*) FILTER (product IS NOT NULL AND TRY_CAST(product AS VARCHAR) IS NULL)",
    "quantity_ordered": _bad_number("quantity_ordered"),
    "price_each": _bad_number("price_each"),
    "order_date": f"count(*) FILTER (order_date IS NOT NULL AND ({LENIENT_DATE}) IS NULL)",
    "order_id": "count(*) FILTER (order_id IS NOT NULL AND TRY_CAST(order_id AS INTEGER) IS NULL)",
}
CAST_KINDS = {
    "product": "string",
    "quantity_ordered": "numeric",
    "price_each": "float",
    "order_date": "timestamp",
    "order_id": "int",
}
NUMERIC_ROWS = f"(SELECT DISTINCT * FROM raw WHERE {NUMERIC_ID})"


def _castability() -> str:
    return _long(
        [
            f"SELECT '{c}' AS column_name, '{kind}' AS target, {BAD_VALUES[c]} AS bad_values, "
            f"{BAD_VALUES[c]} = 0 AS passed FROM {NUMERIC_ROWS}"
            for c, kind in CAST_KINDS.items()
        ]
    )


def _metrics() -> str:
    reason = "count(*) FILTER (reject_reason = '{0}') AS {0}_removed"
    reasons = ", ".join(
        reason.format(r)
        for r in ("null_field", "invalid_order_id", "non_positive_value", "bad_date")
    )
    return f"""{LAYERS}
SELECT * FROM (
  SELECT {CSV_FILES}::BIGINT AS input_files, count(*) AS initial_rows,
         count(*) FILTER (reject_reason IS NULL) AS cleaned_rows, {reasons},
         count(*) FILTER (reject_reason IS NOT NULL) AS removed_rows,
         count(*) FILTER (reject_reason IS NULL) - (SELECT count(*) FROM output) AS duplicates_removed
  FROM classified),
(SELECT count(*) AS deduplicated_rows, count(*) AS output_rows,
        count(*) FILTER (order_id IS NULL) = 0 AS quality_passed,
        (SELECT count(*) FROM (SELECT DISTINCT product FROM output)) AS distinct_product,
        (SELECT count(*) FROM (SELECT DISTINCT order_id FROM output)) AS distinct_order_id,
        CAST(sum(quantity_ordered) AS BIGINT) AS total_quantity_ordered,
        min(order_date) AS min_date, max(order_date) AS max_date,
        min(quantity_ordered) AS min_quantity_ordered, max(quantity_ordered) AS max_quantity_ordered,
        min(price_each) AS min_price_each, max(price_each) AS max_price_each,
        CAST(count(DISTINCT order_year * 100 + order_month) AS INTEGER) AS partition_count,
        'parquet' AS output_format
 FROM output),
(SELECT coalesce(string_agg(month, ',' ORDER BY month), '') AS partitions
 FROM (SELECT DISTINCT order_year || '/' || order_month AS month FROM output)),
(SELECT coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (NOT passed), '') AS quality_issues
 FROM ({_checks()}))"""


def _narrowest(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    fits = {
        "int": f"regexp_full_match({text}, '[+-]?[0-9]+') AND TRY_CAST({text} AS INTEGER) IS NOT NULL",
        "double": f"TRY_CAST({text} AS DOUBLE) IS NOT NULL",
        "timestamp": f"TRY_CAST({text} AS TIMESTAMP) IS NOT NULL",
    }
    cases = [f"WHEN count({column}) > 0 AND count(*) FILTER ({t}) = count({column}) THEN '{k}'" for k, t in fits.items()]
    return f"CASE {' '.join(cases)} ELSE 'string' END"


def _types() -> str:
    """The narrowest type of each column, by tests of all its values."""
    whole = "regexp_full_match({0}, '[+-]?[0-9]+')"
    number = "regexp_full_match({0}, '[ ]*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)(e[+-]?[0-9]+)?[df]?[ ]*')"
    day = "(regexp_full_match({0}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND TRY_CAST({0} AS DATE) IS NOT NULL)"
    digits = "length(regexp_replace({0}, '^[+-]?0*', ''))"
    tests = {
        "'boolean'": "lower({0}) IN ('true', 'false')",
        "'int'": f"{whole} AND TRY_CAST({{0}} AS INTEGER) IS NOT NULL",
        "'bigint'": f"{whole} AND TRY_CAST({{0}} AS BIGINT) IS NOT NULL",
        f"'decimal(' || max({digits}) || ',0)'": f"{whole} AND {digits} <= 38",
        "'double'": number,
        "'date'": day,
        "'timestamp'": f"({day} OR regexp_full_match({{0}}, '[0-9]{{{{4}}}}-[0-9]{{{{2}}}}-[0-9]{{{{2}}}} [0-9]{{{{2}}}}:[0-9]{{{{2}}}}:[0-9]{{{{2}}}}'))",
    }
    rows = []
    for column in ("flag", "gaps", "big", "huge", "suffixed", "blanks", "mixed", "day", "moment", "almost"):
        cases = " ".join(f"WHEN bool_and({t.format(column)}) FILTER ({column} IS NOT NULL) THEN {k.format(column)}" for k, t in tests.items())
        rows.append(f"SELECT '{column}' AS column_name, CASE {cases} ELSE 'string' END AS data_type FROM typed")
    return f"WITH typed AS ({TYPED_SQL.format(lineitem='lineitem')}) {_long(rows)}"


def _date_formats() -> str:
    shapes = {
        "0000-#-#": [("yyyy-MM-dd", "day(l_shipdate) > 12")],
        "#/#/0000": [
            ("MM/dd/yyyy", "l_linenumber % 5 = 1 AND day(l_shipdate) > 12"),
            ("dd/MM/yyyy", "l_linenumber % 5 = 2 AND day(l_shipdate) > 12"),
        ],
        "# MMM 0000 #:#": [("d MMM yyyy HH:mm", "true")],
    }
    numbers = {"0000-#-#": "(0)", "#/#/0000": "(1, 2)", "# MMM 0000 #:#": "(3)"}
    rows = [
        f"SELECT '{shape}' AS shape, count(*) AS n, '{pattern}' AS pattern, count(*) FILTER ({evidence}) AS evidence, true AS certain "
        f"FROM lineitem WHERE l_linenumber % 5 IN {numbers[shape]}"
        for shape, patterns in shapes.items()
        for pattern, evidence in patterns
    ]
    other = (
        "SELECT NULL, count(*), NULL, 0, false FROM lineitem WHERE l_linenumber % 5 = 4 AND l_orderkey % 2 = 0"
    )
    return _long([*rows, other])


def _profile() -> str:
    names = {
        "order_id": "Order ID",
        "product": "Product",
        "quantity_ordered": "Quantity Ordered",
        "price_each": "Price Each",
        "order_date": "Order Date",
        "purchase_address": "Purchase Address",
    }
    text = "CAST({} AS VARCHAR)"
    items = [
        ("shape", "rows", "(SELECT count(*) FROM raw)"),
        ("shape", "columns", "6"),
        ("nulls", "rows_with_any", f"(SELECT count(*) FROM raw WHERE {ANY_NULL})"),
        ("duplicates", "beyond_first", "(SELECT CAST(sum(n - 1) AS BIGINT) FROM copies)"),
        ("duplicates", "members", "(SELECT CAST(sum(n) AS BIGINT) FROM copies WHERE n > 1)"),
        ("distinct", "Order ID", "(SELECT count(*) FROM (SELECT DISTINCT order_id FROM raw))"),
        ("distinct", "Order Date", "(SELECT count(DISTINCT order_date) FROM raw)"),
        (
            "duplicates",
            "potential_by_Order ID",
            "((SELECT count(*) FROM raw) - (SELECT count(*) FROM (SELECT DISTINCT order_id FROM raw)))",
        ),
        ("files", "count", str(CSV_FILES)),
        ("files", "present", "TRUE"),
        ("headers", "differing_files", "0"),
        ("headers", "consistent", "TRUE"),
        ("ready", "input", "TRUE"),
        ("ready", "spark_reads", "(SELECT count(*) > 0 FROM raw)"),
    ]
    items += [("types", header, f"(SELECT {_narrowest(c)} FROM raw)") for c, header in names.items()]
    for c in ("product", "quantity_ordered", "price_each", "order_date"):
        bad = f"(SELECT {BAD_VALUES[c]} FROM {NUMERIC_ROWS})"
        items += [("bad_values", names[c], bad), ("castable", names[c], f"({bad} = 0)")]
    items += [
        ("nulls", header, f"(SELECT count(*) FROM raw WHERE {c} IS NULL)")
        for c, header in names.items()
    ]
    rows = [f"SELECT '{s}' AS section, '{i}' AS item, {text.format(v)} AS value" for s, i, v in items]
    return f"{LAYERS} {_long(rows)}"


def oracle_sql() -> dict[str, str]:
    def over(body: str) -> str:
        return f"{LAYERS} {body}"

    all_raw = over(f"SELECT {COLUMNS} FROM raw")
    members = over(
        f"SELECT {COLUMNS} FROM (SELECT *, count(*) OVER (PARTITION BY {COLUMNS}) AS n FROM raw) WHERE n > 1"
    )
    output = over("SELECT * FROM output")
    null_flags = [
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM raw" for c in RAW_COLUMNS
    ]
    kinds = ("string", "string", "int", "double", "string", "string")
    schema_rows = [
        f"SELECT '{c}' AS column_name, '{k}' AS data_type, TRUE AS nullable, "
        f"count(*) FILTER ({c} IS NULL) AS nulls FROM raw"
        for c, k in zip(RAW_COLUMNS, kinds)
    ]
    distinct_rows = [
        f"SELECT '{c}' AS column_name, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM raw)) AS distinct_with_null, "
        f"(SELECT count(DISTINCT {c}) FROM raw) AS distinct_non_null"
        for c in ("order_id", "product", "order_date")
    ]
    return {
        "cleanse_keep_latest": output,
        "cleanse_merge_overflow": over(
            "SELECT order_id, product, quantity_ordered, price_each, order_date_parsed AS order_date, "
            "purchase_address, order_year, order_month FROM merged"
        ),
        "clean_rows": over("SELECT * FROM clean"),
        "reject_summary": over(
            "SELECT coalesce(reject_reason, 'accepted') AS reject_reason, count(*) AS n "
            "FROM classified GROUP BY 1"
        ),
        "rejected_rows": over(
            f"SELECT {COLUMNS}, reject_reason FROM classified WHERE reject_reason IS NOT NULL"
        ),
        "malformed_rows": over(
            "SELECT order_id, product, CASE WHEN NOT bad THEN quantity_ordered END AS quantity_ordered, price_each, order_date, "
            "purchase_address, CASE WHEN bad THEN order_id || ',' || product || ',abc,' || CAST(price_each AS VARCHAR) || ',' || "
            "order_date || ',\"' || purchase_address || '\"' END AS malformed_record, "
            "CASE WHEN bad THEN 'malformed_record' ELSE reject_reason END AS reject_reason "
            f"FROM (SELECT *, coalesce({BAD_QUANTITY_SQL}, false) AS bad FROM classified) WHERE bad OR reject_reason IS NOT NULL"
        ),
        "required_filter": over(f"SELECT {COLUMNS} FROM raw WHERE NOT ({ANY_NULL})"),
        "digit_id_filter": over(
            f"SELECT {COLUMNS} FROM raw WHERE regexp_full_match(order_id, '[0-9]+')"
        ),
        "positive_filter": over(
            f"SELECT {COLUMNS} FROM raw WHERE quantity_ordered > 0 AND price_each > 0"
        ),
        "parsed_date_filter": over(
            f"SELECT {COLUMNS} FROM classified WHERE order_date_parsed IS NOT NULL"
        ),
        "numeric_id_filter": over(f"SELECT {COLUMNS} FROM raw WHERE {NUMERIC_ID}"),
        "any_null_rows": over(f"SELECT {COLUMNS} FROM raw WHERE {ANY_NULL}"),
        "null_counts": over(_long(null_flags)),
        "range_stats": over(
            "SELECT count(*) AS total_rows, min(quantity_ordered) AS min_quantity_ordered, "
            "max(quantity_ordered) AS max_quantity_ordered, "
            "CAST(sum(quantity_ordered) AS BIGINT) AS sum_quantity_ordered, "
            "min(price_each) AS min_price_each, max(price_each) AS max_price_each, "
            "min(order_date_parsed) AS min_order_date, max(order_date_parsed) AS max_order_date FROM clean"
        ),
        "distinct_counts": over(_long(distinct_rows)),
        "key_duplicate_count": over(
            "SELECT count(*) AS total, (SELECT count(*) FROM (SELECT DISTINCT order_id FROM raw)) AS distinct_keys, "
            "count(*) - (SELECT count(*) FROM (SELECT DISTINCT order_id FROM raw)) AS potential_duplicates FROM raw"
        ),
        "castability": over(_castability()),
        "inferred_types": _types(),
        "date_formats": _date_formats(),
        "schema_table": over(_long(schema_rows)),
        "shape": over("SELECT count(*) AS row_count, CAST(6 AS INTEGER) AS column_count FROM raw"),
        "sample_values": over(
            "SELECT DISTINCT order_date AS value FROM raw ORDER BY 1 NULLS FIRST LIMIT 5"
        ),
        "preview": over(
            "SELECT * FROM clean ORDER BY order_id NULLS FIRST, product, quantity_ordered, price_each, "
            "order_date, purchase_address LIMIT 5"
        ),
        "drop_all_null_columns": all_raw,
        "quality_checks": over(_checks()),
        "exact_duplicate_count": over(
            "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM copies"
        ),
        "duplicate_members": members,
        "drop_exact": over(f"SELECT DISTINCT {COLUMNS} FROM raw"),
        "dedup_summary": over(
            "SELECT count(*) AS before, (SELECT count(*) FROM latest) AS after, "
            "count(*) - (SELECT count(*) FROM latest) AS removed FROM clean"
        ),
        "events_latest": (
            "SELECT * EXCLUDE (rank) FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
            "ORDER BY ts DESC, event_id DESC) AS rank FROM events) WHERE rank = 1"
        ),
        "documents_exact_text_duplicates": (
            "SELECT doc_id, text FROM documents WHERE text IN "
            "(SELECT text FROM documents GROUP BY text HAVING count(*) > 1)"
        ),
        "wide_row_copies": (
            "SELECT md5(text) AS text_md5, lang, source, n_chars, count(*) AS copies FROM documents GROUP BY text, lang, source, n_chars"
        ),
        "column_normalise": all_raw,
        "union_positional": all_raw,
        "csv_round_trip": all_raw,
        "csv_union_by_name": over(
            f"SELECT order_id, product, quantity_ordered, price_each, order_date, "
            f"CASE WHEN {FEED_SQL} = 'plain' THEN purchase_address END AS purchase_address FROM raw"
        ),
        "csv_inferred": all_raw,
        "rows_per_file": over(f"SELECT {FEED_SQL} AS feed, count(*) AS n FROM raw GROUP BY 1"),
        "header_consistency": over(
            "SELECT CASE WHEN plain THEN "
            "'Order ID|Product|Quantity Ordered|Price Each|Order Date|Purchase Address' ELSE "
            f"'Product|Order ID|Order Date|Price Each|Quantity Ordered' END AS header, plain AS consistent, {LAYOUT_FILES}::BIGINT AS files "
            f"FROM (SELECT DISTINCT {FEED_SQL} = 'plain' AS plain FROM raw)"
        ),
        "file_inventory": over(
            f"SELECT {FEED_SQL} AS feed, CAST(sum(strlen(coalesce(product, '')) + 1) AS BIGINT) AS size_bytes FROM raw GROUP BY 1"
        ),
        "input_preflight": over(
            "SELECT feed, pattern, 'input_files_present' AS check_name, pattern = '*.txt' AS passed, true AS all_told "
            f"FROM (SELECT DISTINCT {FEED_SQL} AS feed FROM raw), (VALUES ('*.txt'), ('*.csv')) AS p(pattern)"
        ),
        "partitioned_round_trip": output,
        "partition_rows": over(
            "SELECT order_year, order_month, count(*) AS n FROM output GROUP BY ALL"
        ),
        "single_parquet_round_trip": output,
        "duplicate_members_csv": members,
        "cleanse_metrics": _metrics(),
        "summary_report": _metrics(),
        "cleanse_output": output,
        "cleanse_partitioned": output,
        "profile_report": _profile(),
        "incremental_profile": over(
            _long(
                f"SELECT '{c}' AS column_name, count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS nulls, "
                f"CAST(min({c}) AS VARCHAR) AS low, CAST(max({c}) AS VARCHAR) AS high, '{k}' AS data_type, "
                "true AS within_bound FROM raw"
                for c, k in zip(RAW_COLUMNS, kinds)
            )
        ),
        "incremental_checks": over(
            "SELECT check_name, CASE WHEN check_name NOT LIKE 'has_values%' THEN observed END AS observed, passed "
            f"FROM ({_checks().replace('FROM latest', 'FROM raw')})"
        ),
        "deliveries_one_by_one": output,
    }
