"""CSV directories on small files with every known oddity."""

import datetime
import math
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.functions import parse_timestamp
from scrubline.plans.cleansing import SALES_SCHEMA
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
from scrubline.sources.files import literal_path
from scrubline.sources.headers import MOST_CHARACTERS, column_names, file_headers, first_record, layouts

HEADER = "Order ID,Product,Quantity Ordered,Price Each,Order Date,Purchase Address"


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, text in files.items():
            (tmp_path / f"{name.replace('_', ' ')}.csv").write_text(text, encoding="utf-8")
        return str(tmp_path)

    return write


def by_id(df):
    return {r["Order ID"]: r for r in df.collect()}


def test_reader_oddities(spark, folder):
    lines = [
        HEADER,
        '1,Cable,2,11.95,04/19/19 08:46,"917 1st St, Dallas, TX 75001"',
        "",
        ",,,,,",
        HEADER,
        "2,Cable,1.0,1e2,04/19/19 08:46,a",
        "3,Cable, 2 ,NaN,04/19/19 08:46,a",
        '4,Cable,"1,000",Inf,04/19/19 08:46,a',
        "5,Cable,1e2,1,04/19/19 08:46,NA",
        '6,"",1,1,04/19/19 08:46,a',
        "7,Cable,1",
        "8,Cable,1,1,04/19/19 08:46,a,extra",
        '9,"say ""hi""\nsecond line",1,1,04/19/19 08:46,a',
        " 16,Cable,1,1,04/19/19 08:46,a",
    ]
    path = folder(a="\n".join(lines) + "\n")
    df = read_csv_dir(spark, path, SALES_SCHEMA)
    assert df.count() == 12
    rows = by_id(df)
    assert rows["1"]["Purchase Address"] == "917 1st St, Dallas, TX 75001"
    assert rows[None].asDict() == dict.fromkeys(SALES_SCHEMA.names)
    assert rows["Order ID"]["Quantity Ordered"] is None and rows["Order ID"]["Price Each"] is None
    assert [rows[i]["Quantity Ordered"] for i in "2345"] == [None] * 4
    assert rows["2"]["Price Each"] == 100.0
    assert math.isnan(rows["3"]["Price Each"]) and math.isinf(rows["4"]["Price Each"])
    assert rows["5"]["Purchase Address"] == "NA"
    assert rows["6"]["Product"] is None
    assert rows["7"]["Price Each"] is None and rows["7"]["Purchase Address"] is None
    assert rows["8"]["Purchase Address"] == "a"
    assert rows["9"]["Product"] == 'say "hi"\nsecond line'
    assert " 16" in rows


def test_null_tokens(spark, folder):
    path = folder(a=f"{HEADER}\n1,NA,2,1.5,null,x\n")
    row = read_csv_dir(spark, path, SALES_SCHEMA, CsvDialect(null_tokens=("NA", "null"))).first()
    assert row["Product"] is None and row["Order Date"] is None and row["Purchase Address"] == "x"


def test_no_files_is_an_error(spark, tmp_path):
    (tmp_path / "notes.txt").write_text("x")
    with pytest.raises(ValueError, match="no .* files"):
        read_csv_dir(spark, str(tmp_path), SALES_SCHEMA)
    row = preflight(spark, str(tmp_path)).first()
    assert (row.observed, row.passed, row.first_files) == (0, False, [])


def test_files_below_are_not_read(spark, folder, tmp_path):
    path = folder(a=f"{HEADER}\n1,A,1,1,d,x\n")
    (tmp_path / "below").mkdir()
    (tmp_path / "below" / "b.csv").write_text(f"{HEADER}\n2,A,1,1,d,x\n")
    assert read_csv_dir(spark, path, SALES_SCHEMA).count() == 1
    assert file_inventory(spark, path).count() == 1


def test_swapped_header(spark, folder):
    path = folder(
        a=f"{HEADER}\n1,A,1,1,d,x\n",
        b="Product,Order ID,Quantity Ordered,Price Each,Order Date,Purchase Address\nB,2,1,1,d,x\n",
    )
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_dir(spark, path, SALES_SCHEMA).collect()
    bound = read_csv_dir(spark, path, SALES_SCHEMA, on_header_mismatch="ignore")
    assert sorted(r["Order ID"] for r in bound.collect()) == ["1", "B"]
    named = read_csv_dir(spark, path, SALES_SCHEMA, on_header_mismatch="by_name")
    assert named.schema == SALES_SCHEMA
    assert sorted((r["Order ID"], r["Product"]) for r in named.collect()) == [("1", "A"), ("2", "B")]


@pytest.mark.parametrize("multiline", [True, False])
def test_by_name_lines_up_columns(spark, folder, multiline):
    path = folder(
        a_1="x,y\n1,2\n3,4\n",
        b="y,z\n5,6\n",
        c="x,y\n7,8\n",
        d='z,"x"\n9,"q, r"\n',
    )
    df = read_csv_by_name(spark, path, CsvDialect(multiline=multiline))
    assert df.columns == ["x", "y", "z"]
    assert sorted(tuple(r) for r in df.na.fill("-").collect()) == [
        ("-", "5", "6"),
        ("1", "2", "-"),
        ("3", "4", "-"),
        ("7", "8", "-"),
        ("q, r", "-", "9"),
    ]


def test_by_name_takes_any_case_and_numbers_repeats(spark, folder):
    schema = T.StructType([T.StructField("K", T.StringType()), T.StructField("V_1", T.IntegerType())])
    one = folder(a="k,v,V\n1,2,3\n")
    assert [tuple(r) for r in read_csv_by_name(spark, one, schema=schema).collect()] == [("1", 3)]
    assert read_csv_by_name(spark, one).columns == ["k", "v", "V_1"]
    with open(f"{one}/b.csv", "w") as out:
        out.write("V,K\n5,4\n")
    assert sorted(map(str, read_csv_by_name(spark, one, schema=schema).collect())) == [
        "Row(K='1', V_1=3)", "Row(K='4', V_1=None)"
    ]
    plain = read_csv_by_name(spark, one)
    assert plain.columns == ["k", "v", "V_1"]
    assert sorted(tuple(r) for r in plain.na.fill("-").collect()) == [("1", "2", "3"), ("4", "5", "-")]


def test_by_name_takes_many_layouts(spark, folder):
    path = folder(**{f"f{i}": f"x{i},k\n{i},{i}\n" for i in range(1_500)})
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("x7", T.IntegerType())])
    rows = read_csv_by_name(spark, path, CsvDialect(multiline=False), schema).collect()
    assert sorted(r.k for r in rows) == list(range(1_500))
    assert [r.k for r in rows if r.x7 is not None] == [7]


def test_by_name_types_follow_the_reader(spark, folder):
    schema = T.StructType(
        [T.StructField("n", T.IntegerType()), T.StructField("d", T.DoubleType()), T.StructField("e", T.StringType())]
    )
    values = ["1", " 2 ", "1.0", "1e2", "99999999999", "x", "", "-7"]
    body = "".join(f"{v},{v}\n" for v in values)
    one = folder(a="n,d\n" + body)
    same = read_csv_by_name(spark, one, schema=schema)
    assert same.schema == schema
    expected = sorted(same.collect(), key=str)
    os.makedirs(f"{one}/two")
    with open(f"{one}/two/a.csv", "w") as out:
        out.write("n,d\n" + body)
    with open(f"{one}/two/b.csv", "w") as out:
        out.write("d\n")
    assert sorted(read_csv_by_name(spark, f"{one}/two", schema=schema).collect(), key=str) == expected


def test_inventory_headers_and_rows(spark, folder):
    path = folder(
        big_one=f"{HEADER}\n1,A,1,1,d,x\n2,A,1,1,d,x\n",
        empty="",
        header_only=f"{HEADER}\n",
        swapped="Product,Order ID\n",
    )
    sizes = {r.file_name.replace("%20", " "): r.size_bytes for r in file_inventory(spark, path).collect()}
    assert sizes == {f: os.path.getsize(f"{path}/{f}") for f in os.listdir(path)} and sizes["empty.csv"] == 0
    checked = {
        r.file_name.replace("%20", " "): r.consistent
        for r in header_consistency(spark, path, SALES_SCHEMA.names).collect()
    }
    assert checked == {
        "big one.csv": True, "header only.csv": True, "swapped.csv": False,
    }
    first_by_name = header_consistency(spark, path)
    assert {r.consistent for r in first_by_name.collect()} == {True, False}
    rows = {r.file_name.replace("%20", " "): r.n for r in rows_per_file(spark, path, SALES_SCHEMA).collect()}
    assert rows == {"big one.csv": 2, "header only.csv": 0, "swapped.csv": 0, "empty.csv": 0}


def test_headers_need_no_text_scan_and_no_sort(spark, folder):
    path = folder(a="x,y\n1,2\n", b="x,y\n")
    for df in (file_headers(spark, path), header_consistency(spark, path), header_consistency(spark, path, ["x", "y"])):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(node in plan for node in ("FileScan text", "Sort [", "Exchange hashpartitioning"))


@pytest.mark.parametrize("by_lines", [False, True])
def test_headers_of_all_kinds(spark, tmp_path, by_lines):
    files = {
        "plain": "a,b\n1,2\n", "quoted": '"a, b","say ""x"""\n1,2\n', "lines": '"two\nlines",b\n1,2\n',
        "blank first": "\n\na,b\n", "windows": "a,b\r\n1,2\r\n", "no end": "a,b", "open": '"a,b\n1,2\n', "blank": "\n",
    }
    for name, text in files.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    (tmp_path / "mark.csv").write_bytes("\ufeffé,b\n".encode())
    found = {r.file_name.replace("%20", " "): r.header for r in file_headers(spark, str(tmp_path), by_lines=by_lines).collect()}
    assert found == {
        "plain.csv": ["a", "b"], "quoted.csv": ["a, b", 'say "x"'], "lines.csv": ["two\nlines", "b"], "blank first.csv": ["a", "b"],
        "windows.csv": ["a", "b"], "no end.csv": ["a", "b"], "open.csv": ["a,b\n1,2\n"], "blank.csv": None, "mark.csv": ["é", "b"],
    }


def test_headers_as_the_dialect_has_them(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("'é, f','it\\'s'\n".encode("latin-1"))
    dialect = CsvDialect(quote="'", escape="\\", encoding="ISO-8859-1")
    for by_lines in (False, True):
        assert file_headers(spark, str(tmp_path), dialect, by_lines).first().header == ["é, f", "it's"]
    # Without multi-line records a header is one line, whatever its quotes.
    assert first_record(['"a\n', 'b"\n'], CsvDialect(multiline=False)) == ["a\n"]


def test_first_records_are_not_read_beyond_their_end(spark, tmp_path):
    taken = iter(["\n", "a,b\n", "c\n"])
    assert first_record(taken) == ["a", "b"] and next(taken) == "c\n"
    with open(tmp_path / "large.csv", "w") as out:
        out.write("a,b\n")
        out.truncate(1 << 33)  # a file with a hole of 8 GB
    assert file_headers(spark, str(tmp_path)).first().header == ["a", "b"]
    with open(tmp_path / "large.csv", "w") as out:
        out.write("x" * (MOST_CHARACTERS + 1))
    with pytest.raises(Exception, match="longer than"):
        file_headers(spark, str(tmp_path)).collect()


def test_headers_of_ten_thousand_files(spark, tmp_path):
    for i in range(10_000):
        (tmp_path / f"f{i:05}.csv").write_text("k,v\n1,2\n" if i % 100 else f"k,v,x{i}\n1,2,3\n")
    headers = file_headers(spark, str(tmp_path))
    found = layouts(headers, ["k", "v"])
    assert (found.files, found.different, found.widest, found.like_expected) == (10_000, 101, 3, 9_900)
    assert found.usual == ["k", "v"] and found.first == ["k", "v", "x0"]
    assert column_names(headers) == ["k", "v"] + [f"x{i}" for i in range(0, 10_000, 100)]
    with pytest.raises(ValueError, match="more than 50"):
        column_names(headers, most=50)
    read = read_csv_by_name(spark, str(tmp_path), CsvDialect(multiline=False))
    assert len(read.columns) == 102
    # One task per lot of files, not per file.
    assert headers.rdd.getNumPartitions() <= 10_000 // 20


def test_preflight_names_five(spark, folder):
    path = folder(**{f"f{i}": "x\n" for i in range(7)})
    row = preflight(spark, path).first()
    assert (row.observed, row.passed, row.more) == (7, True, 2)
    assert row.first_files == [f"f{i}.csv" for i in range(5)]


def test_unknown_multiline(spark, folder):
    for other in ("maybe", "records"):
        with pytest.raises(ValueError, match="multiline"):
            CsvDialect(multiline=other)


def test_lone_quotes_lose_no_rows(spark, folder):
    path = folder(a='k,v\n1,2.5" pipe\n' + "".join(f"{i},x\n" for i in range(2, 7)))
    for multiline in (True, False):
        assert read_csv_by_name(spark, path, CsvDialect(multiline=multiline)).count() == 6


def test_inferred_types(spark, folder):
    path = folder(a="i,d,s\n1,1.5,a\n2,2,b\n")
    assert read_csv_inferred(spark, path).dtypes == [("i", "int"), ("d", "double"), ("s", "string")]


def test_awkward_file_names(spark, tmp_path):
    names = ["a b.csv", "a [1] 50%.csv", "a{x}+y.csv"]
    for i, name in enumerate(names):
        (tmp_path / name).write_text(f"i,s\n{i},x\n" if i else "s,i\nx,0\n")
    path = str(tmp_path)
    # Spark cannot infer from names with wildcard characters in multi-line mode.
    for row in file_inventory(spark, path).collect():
        assert read_csv_inferred(spark, literal_path(row.file_path), CsvDialect(multiline=False)).count() == 1
    rows = rows_per_file(spark, path, T.StructType([T.StructField("i", T.StringType())]))
    assert [r.n for r in rows.collect()] == [1, 1, 1]
    named = read_csv_by_name(spark, path)
    assert sorted((r.i, r.s) for r in named.collect()) == [("0", "x"), ("1", "x"), ("2", "x")]


def test_dates(spark):
    texts = [
        "04/07/19 22:30", "4/7/19 22:30", "13/45/19 22:30", "04/07/19 22:30:15", "02/29/19 00:00",
        "04/07/19 24:00", " 04/07/19 22:30", "04/07/98 22:30", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    strict = [r[0] for r in df.select(parse_timestamp(F.col("t"), "MM/dd/yy HH:mm")).collect()]
    assert strict == [datetime.datetime(2019, 4, 7, 22, 30)] + [None] * 6 + [
        datetime.datetime(2098, 4, 7, 22, 30), None,
    ]
    both = df.select(parse_timestamp(F.col("t"), "MM/dd/yy HH:mm", "M/d/yy H:mm")).collect()
    assert both[1][0] == datetime.datetime(2019, 4, 7, 22, 30)
    with pytest.raises(ValueError):
        parse_timestamp(F.col("t"))
