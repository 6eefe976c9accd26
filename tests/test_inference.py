"""Types of text values: the same as the CSV reader infers, and merged as states."""

import itertools

import pytest
from pyspark.sql import functions as F

from scrubline.functions.inference import BIGINT, INT, STRING, WHOLE, merged_state, type_bit, type_name, type_state
from scrubline.operators.profiling import inferred_types
from scrubline.sources import read_csv_by_name

VALUES = [
    "1", "+1", "-1", " 1", "1 ", "0001", "2147483647", "2147483648", "3000000000", "9223372036854775808", "9" * 20, "1" * 38, "1" * 39,
    "5.", "5.0", ".5", "1e5", "1d", "1f", "1D", "NaN", "nan", "Inf", "inf", "-Inf", "+Inf", "Infinity", "-Infinity", "true", "TRUE",
    "False", "yes", "t", "  ", "2019-01", "2019-01-05", "2019-1-5", " 2019-01-05", "2019-01-05 ", "2019-01-05 12:00",
    "2019-01-05T12:00:00Z", "2019-01-05T", "2019-01-05 12:00:00.123", "2019-02-30", "2019-13-01", "2019-01-05 25:00:00",
    "2019-01-05 12:00:00+02:00", "12:00", "01/05/2019", "20190105", "0x1p3", "0x10", "1,000", "--1", "+", ".", "", "1e400", "10000-01-01",
]
MIXED = [
    ("1", "3000000000"), ("3000000000", "9" * 19), ("9" * 20, "12"), ("9" * 20, "1.5"), ("9" * 38, "1" + "0" * 38), ("1.5", "1"),
    ("1", "true"), ("true", "FALSE"), ("true", "1.5"), ("true", "2019-01-05"), ("1", "2019-01-05"), ("2019-01-05", "2019-01-05 12:00"),
    ("", "1"), ("", ""), ("", "true"), ("  ", "1"), ("1d", "1"), ("1d", "9" * 20), ("x", "1"), ("2019-01", "2019-01-05"),
]


@pytest.fixture(scope="module")
def columns(spark, tmp_path_factory):
    """A directory of two files with a column per case, which the reader infers in one go."""
    cases = [(v, v) for v in VALUES] + MIXED + [pair[::-1] for pair in MIXED]
    folder = tmp_path_factory.mktemp("types")
    for row in range(2):
        cells = ",".join(f'"{case[row]}"' for case in cases)
        (folder / f"{row}.csv").write_text(",".join(f"c{i}" for i in range(len(cases))) + ",end\n" + cells + ",x\n")
    inferred = dict(spark.read.option("header", True).option("inferSchema", True).csv(str(folder)).dtypes)
    return str(folder), cases, inferred


def test_types_equal_those_of_the_reader(spark, columns):
    path, cases, inferred = columns
    found = {r.column_name: r.data_type for r in inferred_types(read_csv_by_name(spark, path)).collect()}
    wrong = {cases[i]: (found[f"c{i}"], inferred[f"c{i}"]) for i in range(len(cases)) if found[f"c{i}"] != inferred[f"c{i}"]}
    assert not wrong


def test_states_merge_to_the_type_of_all(spark):
    """Whatever the split, the merged states of parts give the type of the whole."""
    values = ["1", "3000000000", "9" * 25, "1.5", "true", "2019-01-05", "2019-01-05 12:00", "x", None]
    rows = [(i, j, v) for i, group in enumerate(itertools.product(values, repeat=3)) for j, v in enumerate(group)]
    df = spark.createDataFrame(rows, "g int, part int, v string")

    def named(parts):
        return [value.alias(name) for name, value in parts.items()]

    whole = df.groupBy("g").agg(*named(type_state(F.col("v")))).select("g", type_name(F.col("bits"), F.col("digits")).alias("t"))
    parts = df.groupBy("g", (F.col("part") % 2).alias("p")).agg(*named(type_state(F.col("v"))))
    merged = parts.groupBy("g").agg(*named(merged_state(F.col("bits"), F.col("digits"))))
    merged = merged.select("g", type_name(F.col("bits"), F.col("digits")).alias("t"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))


def test_columns_that_are_no_text_keep_their_type(spark):
    df = spark.sql("SELECT 1 AS i, CAST(NULL AS STRING) AS nothing, DATE'2020-01-01' AS d, '7' AS s")
    assert [tuple(r) for r in inferred_types(df).collect()] == [("i", "int"), ("nothing", "string"), ("d", "date"), ("s", "int")]
    assert [r.data_type for r in inferred_types(df.limit(0)).collect()] == ["int", "string", "date", "string"]


def test_no_cast_of_whole_numbers_fails(spark):
    edges = [f"{sign}{zeros}{n}" for sign in ("", "+", "-") for zeros in ("", "00") for n in
             (0, 9, 2147483646, 2147483647, 2147483648, 2147483649, 9999999999, 9223372036854775807, 9223372036854775808, 9223372036854775809)]
    moments = ["12:30", "T1:02:03", " 2019-1-2 ", "+12019-01-02", "2019-01", "2019-01-02T03:04:05Z", "4/7/19", "lamp", "20x", "-", "\x7f2019-02-03\x01"]
    df = spark.createDataFrame([(v,) for v in edges + moments], "v string")
    v = F.col("v")
    bit = type_bit(v)
    plan = df.select(bit)._jdf.queryExecution().optimizedPlan().toString()
    assert "as int)" not in plan and "as bigint)" not in plan
    told = F.when(v.rlike(WHOLE) & v.try_cast("int").isNotNull(), INT).when(v.rlike(WHOLE) & v.try_cast("bigint").isNotNull(), BIGINT)
    assert df.filter(told.isNotNull() & (told != bit)).isEmpty()
    assert df.filter(told.isNull() & v.rlike(WHOLE) & bit.isin(INT, BIGINT)).isEmpty()
    assert df.filter((bit == STRING) & v.try_cast("timestamp").isNotNull()).isEmpty()
