"""Date formats found from values alone."""

import datetime

import pytest
from pyspark.sql import functions as F

from scrubline.functions import parse_timestamp
from scrubline.operators.dates import date_formats, likely_formats

MOMENTS = [datetime.datetime(2019, 1, 3, 4, 5, 6) + datetime.timedelta(days=17 * i, hours=5 * i, minutes=7 * i) for i in range(60)]
FORMATS = {
    "MM/dd/yy HH:mm": "%m/%d/%y %H:%M",
    "dd.MM.yyyy": "%d.%m.%Y",
    "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS": "%Y-%m-%dT%H:%M:%S.%f",
    "yyyyMMdd HH:mm": "%Y%m%d %H:%M",
    "MM/dd/yyyy hh:mm a": "%m/%d/%Y %I:%M %p",
    "dd MMM yyyy": "%d %b %Y",
    "dd-MMM-yy": "%d-%b-%y",
    "MMM dd, yyyy HH:mm": "%b %d, %Y %H:%M",
}


def column(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "t string")


@pytest.mark.parametrize("pattern", FORMATS)
def test_formats_are_found_and_parse(spark, pattern):
    texts = [m.strftime(FORMATS[pattern]) for m in MOMENTS if m.month != 5]
    df = column(spark, texts + [None])
    rows = date_formats(df, "t").collect()
    assert [(r.pattern, r.n, r.certain) for r in rows] == [(pattern, len(texts), True)]
    parsed = [r[0] for r in df.select(parse_timestamp(F.col("t"), pattern)).collect()][:-1]
    assert parsed == [datetime.datetime.strptime(t, FORMATS[pattern]) for t in texts]


def test_months_by_name_may_be_long(spark):
    df = column(spark, ["3 January 2019", "14 May 2019", "5 december 2020", "7 Jan 2019"])
    found = {r.pattern: r.n for r in date_formats(df, "t").collect()}
    assert found == {"d MMMM yyyy": 3, "d MMM yyyy": 1}
    parsed = df.select(parse_timestamp(F.col("t"), *likely_formats(df, "t"))).collect()
    assert [r[0].month for r in parsed] == [1, 5, 12, 1]


def test_two_orders_in_one_shape(spark):
    df = column(spark, ["25/01/2019"] * 3 + ["01/25/2019"] * 2 + ["02/03/2019"] * 5)
    rows = {r.pattern: (r.n, r.evidence, r.certain) for r in date_formats(df, "t").collect()}
    assert rows == {"dd/MM/yyyy": (10, 3, True), "MM/dd/yyyy": (10, 2, True)}
    assert likely_formats(df, "t") == ("dd/MM/yyyy", "MM/dd/yyyy")


@pytest.mark.parametrize("prefer, pattern", [("Mdy", "M/d/yy"), ("dMy", "d/M/yy")])
def test_no_evidence_is_not_certain(spark, prefer, pattern):
    df = column(spark, ["4/7/19", "04/07/05"])
    assert [(r.pattern, r.evidence, r.certain) for r in date_formats(df, "t", prefer).collect()] == [(pattern, 0, False)]
    with pytest.raises(ValueError):
        date_formats(df, "t", "yMd")


def test_years_come_first_if_nothing_else_fits(spark):
    assert date_formats(column(spark, ["98/12/25", "05/11/30"]), "t").first().pattern == "yy/MM/dd"
    assert date_formats(column(spark, ["2019-25-12", "2019-30-1"]), "t").first().pattern == "yyyy-dd-M"


def test_what_is_no_date(spark):
    texts = ["", "x", "12", "1/2", "1/2-2019", "2019", "123/4/2019", "Order Date", "03/04/19 1", "1.2.3.4", "9" * 50, "12:30"]
    rows = date_formats(column(spark, texts), "t").collect()
    assert [(r.shape, r.pattern, r.n, r.certain) for r in rows] == [(None, None, len(texts), False)]
    assert date_formats(column(spark, [None]), "t").count() == 0
    # Numbers that no order reads leave the shape without a proven order.
    assert not date_formats(column(spark, ["13/45/19"]), "t").first().certain
    assert likely_formats(column(spark, texts), "t") == ()


def test_any_column_has_few_shapes(spark):
    df = spark.range(20_000).selectExpr("CASE WHEN id % 2 = 0 THEN concat(id, '/', id * 7, ' ', id) ELSE md5(string(id)) END AS t")
    assert date_formats(df, "t").count() <= 8
