"""The two jobs, end to end on small directories."""

import dataclasses
import datetime
import glob
import os
import warnings

import pyarrow.parquet as pq
import pytest

from scrubline.operators.profiling import CastTarget
from scrubline.operators.quality import QualityError
from scrubline.plans import CleanseConfig, ProfileConfig, cleanse, profile, ready
from scrubline.plans.cleansing import SALES_SCHEMA
from scrubline.plans.report import render, write_report
from scrubline.plans.scratch import scratch_path
from scrubline.sinks import partition_listing
from scrubline.sources import read_csv_dir

HEADER = "Order ID,Product,Quantity Ordered,Price Each,Order Date,Purchase Address"
JANUARY = f"""{HEADER}
1,Cable,2,11.95,01/19/19 08:46,"917 1st St, Dallas, TX 75001"
1,Cable,3,11.95,01/20/19 08:46,"917 1st St, Dallas, TX 75001"
1,Plug,1,5.0,01/19/19 08:46,x
,,,,,
,,,,,
{HEADER}
X2,Cable,1,1.0,01/19/19 08:46,x
3,Cable,0,1.0,01/19/19 08:46,x
4,Cable,1,-1.0,01/19/19 08:46,x
5,Cable,1,1.0,13/45/19 22:30,x
"""
FEBRUARY = f"""{HEADER}
6,Cable,1,7.5,02/03/19 10:00,y
6,Cable,1,7.5,02/03/19 10:00,y
7,Lamp,4,20.0,02/04/19 10:00,"two
lines"
"""


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "january.csv").write_text(JANUARY)
    (folder / "february.csv").write_text(FEBRUARY)
    return str(folder)


def records(spark, path):
    columns = ["order_id", "product", "quantity_ordered", "price_each", "order_date", "order_year", "order_month"]
    return sorted(tuple(r) for r in spark.read.parquet(path).select(*columns).collect())


EXPECTED = [
    (1, "Cable", 3, 11.95, datetime.datetime(2019, 1, 20, 8, 46), 2019, 1),
    (1, "Plug", 1, 5.0, datetime.datetime(2019, 1, 19, 8, 46), 2019, 1),
    (6, "Cable", 1, 7.5, datetime.datetime(2019, 2, 3, 10, 0), 2019, 2),
    (7, "Lamp", 4, 20.0, datetime.datetime(2019, 2, 4, 10, 0), 2019, 2),
]


@pytest.mark.parametrize("metrics", ["staged", "observed"])
@pytest.mark.parametrize("output", ["partitioned", "single"])
def test_cleanse(spark, source, tmp_path, metrics, output):
    before = spark.conf.get("spark.sql.parquet.outputTimestampType")
    target = str(tmp_path / "out")
    result = cleanse(spark, source, target, CleanseConfig(metrics=metrics, output=output))
    assert records(spark, target) == EXPECTED
    row = result.metrics.first()
    counted = {
        "input_files": 2, "initial_rows": 13, "cleaned_rows": 6, "deduplicated_rows": 4, "output_rows": 4,
        "null_field_removed": 3, "invalid_order_id_removed": 1, "non_positive_value_removed": 2,
        "bad_date_removed": 1, "removed_rows": 7, "duplicates_removed": 2, "quality_passed": True,
        "quality_issues": [], "distinct_product": 3, "distinct_order_id": 3, "total_quantity_ordered": 9,
        "min_quantity_ordered": 1, "max_quantity_ordered": 4, "min_price_each": 5.0, "max_price_each": 20.0,
        "min_date": datetime.datetime(2019, 1, 19, 8, 46), "max_date": datetime.datetime(2019, 2, 4, 10, 0),
        "output_format": "parquet", "location": target,
        "partition_count": 2 if output == "partitioned" else 0,
        "partitions": ["2019/1", "2019/2"] if output == "partitioned" else [],
    }
    assert row.asDict() == counted
    assert row.initial_rows == row.cleaned_rows + row.removed_rows
    assert result.checks.filter("not passed").isEmpty() and result.checks.count() == 8
    assert "initial rows" in result.text and "13" in result.text
    if output == "single":
        assert len(glob.glob(f"{target}/*.parquet")) == 1
    else:
        assert os.path.isdir(f"{target}/order_year=2019/order_month=2")
    file = glob.glob(f"{target}/**/*.parquet", recursive=True)[0]
    assert str(pq.read_schema(file).field("order_date").type) == "timestamp[ms, tz=UTC]"
    assert spark.conf.get("spark.sql.parquet.outputTimestampType") == before
    base = os.path.dirname(scratch_path(spark, "x"))
    assert not glob.glob(f"{base}/classified-*")


def test_source_is_listed_once(spark, source, tmp_path, monkeypatch):
    (tmp_path / "in" / "nothing.csv").write_text("")
    read, listings = type(spark.read), []
    for name in ("csv", "load", "text"):
        plain = getattr(read, name)

        def counted(self, path=None, *args, plain=plain, **options):
            if path == source:
                listings.append(path)
            return plain(self, path, *args, **options)

        monkeypatch.setattr(read, name, counted)
    assert cleanse(spark, source, str(tmp_path / "out")).metrics.first().input_files == 3
    assert len(listings) == 1


def test_malformed_records_have_a_reason_of_their_own(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = ["1,Cable,abc,1.0,01/19/19 08:46,x", "2,Cable,,1.0,01/19/19 08:46,x", "3,Cable,2", "4,Cable,2,1.0,01/19/19 08:46,x,more"]
    lines += ['5,"two\nlines",2.5,1.0,01/19/19 08:46,x', "6,Cable,2,1.0,01/19/19 08:46,x"]
    (tmp_path / "in" / "a.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    for metrics in ("staged", "observed"):
        config = CleanseConfig(malformed_column="malformed_record", metrics=metrics)
        row = cleanse(spark, str(tmp_path / "in"), str(tmp_path / metrics), config).metrics.first()
        assert (row.malformed_record_removed, row.null_field_removed, row.output_rows) == (4, 1, 1)
    plain = cleanse(spark, str(tmp_path / "in"), str(tmp_path / "plain")).metrics.first()
    assert (plain.null_field_removed, plain.output_rows) == (4, 2)
    records = read_csv_dir(spark, str(tmp_path / "in"), SALES_SCHEMA, malformed="text")
    # Whichever columns are read, the same records are malformed.
    found = [r.text for r in records.select("Order ID", "text").filter("text IS NOT NULL").collect()]
    assert [t.rstrip("\n") for t in found] == [lines[0], lines[2], lines[3], lines[4]]
    with pytest.raises(ValueError):
        read_csv_dir(spark, str(tmp_path / "in"), SALES_SCHEMA, on_header_mismatch="by_name", malformed="text")


def test_report_is_stored(spark, source, tmp_path):
    result = cleanse(spark, source, str(tmp_path / "out"))
    write_report(spark, result.metrics, str(tmp_path / "report"))
    assert spark.read.json(str(tmp_path / "report/metrics")).first().output_rows == 4
    stored = spark.read.text(str(tmp_path / "report/summary"), wholetext=True).first().value
    assert stored.strip() == result.text.strip() == render(result.metrics.first().asDict()).strip()


def test_job_stores_its_report(spark, source, tmp_path):
    cleanse(spark, source, str(tmp_path / "out"), CleanseConfig(report_to=str(tmp_path / "report")))
    assert spark.read.json(str(tmp_path / "report/metrics")).first().output_rows == 4
    assert spark.read.text(str(tmp_path / "report/summary")).count() > 1


@pytest.mark.parametrize("merge, rows", [(False, 4), (True, 2)])
def test_ids_beyond_32_bits_stay_apart(spark, tmp_path, merge, rows):
    (tmp_path / "in").mkdir()
    ids = ["99999999999", "99999999998", "099999999999", "7", "007", "123456789012345678901234567890123456789012"]
    body = "".join(f"{i},Cable,1,1.0,01/19/19 08:46,x\n" for i in ids)
    (tmp_path / "in" / "a.csv").write_text(f"{HEADER}\n{body}")
    with pytest.warns(UserWarning, match="not_null:order_id"):
        result = cleanse(spark, str(tmp_path / "in"), str(tmp_path / "out"), CleanseConfig(merge_overflow=merge))
    assert result.metrics.first().output_rows == rows
    found = [r.order_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert found.count(7) == 1 and found.count(None) == rows - 1


def test_partition_listing(spark, source, tmp_path):
    cleanse(spark, source, str(tmp_path / "out"))
    listing = partition_listing(spark, str(tmp_path / "out"), ["order_year", "order_month"])
    assert sorted(tuple(r) for r in listing.collect()) == [(2019, 1, 2), (2019, 2, 2)]


def test_nothing_left_still_reports(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(f"{HEADER}\n,,,,,\n")
    with pytest.warns(UserWarning, match="at_least:quantity_ordered"):
        result = cleanse(spark, str(tmp_path / "in"), str(tmp_path / "out"), CleanseConfig(output="single"))
    row = result.metrics.first()
    assert (row.initial_rows, row.output_rows, row.quality_passed) == (1, 0, False)
    assert row.min_date is None and "n/a" in result.text


def test_failed_check_can_raise_after_the_write(spark, tmp_path):
    (tmp_path / "in").mkdir()
    body = "99999999999,Cable,1,1.0,01/19/19 08:46,x\n8,Cable,1,NaN,01/19/19 08:46,x\n"
    (tmp_path / "in" / "a.csv").write_text(f"{HEADER}\n{body}")
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    with pytest.raises(QualityError, match="not_null:order_id"):
        cleanse(spark, source, target, CleanseConfig(on_fail="raise"))
    assert spark.read.parquet(target).count() == 2
    strict = CleanseConfig(on_fail="raise", reject_overflow=True)
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        row = cleanse(spark, source, target, strict).metrics.first()
    assert (row.overflow_order_id_removed, row.output_rows) == (1, 1)
    finite = dataclasses.replace(strict, reject_non_finite=True, on_fail="warn")
    with pytest.warns(UserWarning):
        row = cleanse(spark, source, target, finite).metrics.first()
    assert (row.non_finite_value_removed, row.output_rows) == (1, 0)


def test_wrong_header_fails_the_job(spark, source, tmp_path):
    with open(f"{source}/swapped.csv", "w") as out:
        out.write("Product,Order ID,Quantity Ordered,Price Each,Order Date,Purchase Address\nFan,9,1,3.0,02/04/19 10:00,z\n")
    with pytest.raises(Exception, match="(?i)header"):
        cleanse(spark, source, str(tmp_path / "out"))
    result = cleanse(spark, source, str(tmp_path / "named"), CleanseConfig(on_header_mismatch="by_name"))
    assert result.metrics.first().output_rows == 5
    assert (9, "Fan") in {r[:2] for r in records(spark, str(tmp_path / "named"))}


@pytest.mark.parametrize("setting", [{"output": "x"}, {"metrics": "x"}, {"on_header_mismatch": "x"}])
def test_unknown_settings(spark, source, tmp_path, setting):
    with pytest.raises(ValueError):
        cleanse(spark, source, str(tmp_path / "out"), CleanseConfig(**setting))


def test_scratch_needs_a_shared_folder_on_a_cluster(monkeypatch):
    class Conf:
        def __init__(self, settings):
            self.settings = settings

        def get(self, key, default=None):
            return self.settings.get(key, default)

    class Session:
        def __init__(self, **settings):
            self.conf = Conf({k.replace("_", "."): v for k, v in settings.items()})

    assert scratch_path(Session(spark_checkpoint_dir="s3://b/c/"), "t").startswith("s3://b/c/scrubline/t-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(spark_master="yarn"), "t")


def test_profile(spark, source, tmp_path):
    report = profile(spark, source, export_to=str(tmp_path / "found"))
    items = {(r.section, r.item): r.value for r in report.collect()}
    assert items["files", "count"] == "2" and items["headers", "consistent"] == "true"
    assert items["shape", "rows"] == "13" and items["shape", "columns"] == "6"
    assert items["nulls", "rows_with_any"] == "2" and items["nulls", "Product"] == "2"
    assert items["duplicates", "beyond_first"] == "2" and items["duplicates", "members"] == "4"
    assert items["distinct", "Order Date"] == "6" and items["distinct", "Order ID"] == "9"
    assert items["duplicates", "potential_by_Order ID"] == "4"
    assert items["castable", "Quantity Ordered"] == "true" and items["castable", "Order Date"] == "false"
    # One of the two files repeats its header line, so no number type holds all values.
    assert items["types", "Price Each"] == "string"
    assert ready(report)
    nulls = spark.read.option("header", True).csv(str(tmp_path / "found/null_rows"))
    assert nulls.count() == 2
    members = spark.read.option("header", True).csv(str(tmp_path / "found/duplicate_rows"))
    assert members.count() == 4


def test_types_hold_all_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("i,d,s,t\n1,2,1,2020-01-01\n")
    (tmp_path / "b.csv").write_text("d,i,s,t\n2.5,7,X2,2020-01-02 10:00:00\n")
    items = {r.item: r.value for r in profile(spark, str(tmp_path), ProfileConfig(key_column="i", date_column="t", cast_targets=())).collect() if r.section == "types"}
    assert items == {"i": "int", "d": "double", "s": "string", "t": "timestamp"}


def test_types_beyond_int_and_double(spark, tmp_path):
    (tmp_path / "a.csv").write_text("b,big,huge,suffix,blank,day\ntrue,3000000000,1,1d,1,2020-01-01\nFALSE,1,99999999999999999999,2,  ,2020-01-02\n")
    config = ProfileConfig(key_column="big", date_column="day", cast_targets=())
    items = {r.item: r.value for r in profile(spark, str(tmp_path), config).collect() if r.section == "types"}
    assert items == {"b": "boolean", "big": "bigint", "huge": "decimal(20,0)", "suffix": "double", "blank": "string", "day": "date"}


def test_profile_finds_date_formats_itself(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k,d\n1,25.12.2019\n2,2019-12-13\n3,01.02.2019\n")
    (tmp_path / "b.csv").write_text("k,d\n4,x\n")
    config = ProfileConfig(key_column="k", date_column="d", cast_targets=(CastTarget("d", "timestamp"),))
    items = {(r.section, r.item): r.value for r in profile(spark, str(tmp_path), config).collect()}
    assert items["formats", "d"] == "dd.MM.yyyy, yyyy-MM-dd"
    assert items["bad_values", "d"] == "1" and items["castable", "d"] == "false"


def test_profile_finds_a_differing_header(spark, source):
    with open(f"{source}/other.csv", "w") as out:
        out.write("Order ID,Product\n9,Fan\n")
    report = profile(spark, source)
    items = {(r.section, r.item): r.value for r in report.collect()}
    assert items["headers", "differing_files"] == "1" and items["shape", "rows"] == "14"
    assert not ready(report)
    expected = ProfileConfig(expected_header=("Order ID", "Product"))
    items = {(r.section, r.item): r.value for r in profile(spark, source, expected).collect()}
    assert items["headers", "differing_files"] == "2"
