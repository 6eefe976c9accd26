"""Building the records: shuffles of narrow rows only, and files in the number that the SQL twins name."""

import pytest
from pyspark.sql import functions as F

from scrubline.catalogue import fixture, registry
from scrubline.sinks import write_csv

TEXT = "order_id string, product string, quantity_ordered int, price_each double, order_date string, purchase_address string"


@pytest.fixture
def own_raw(monkeypatch, spark, tmp_path):
    """Stands a table of so many files, with one product of its own, in for the records."""

    def stand_in(files, product="lamp"):
        rows = spark.range(400).selectExpr(
            "cast(id as string) order_id", f"if(id = 5, '{product}', 'cable') product", "1 quantity_ordered", "2.5D price_each",
            "'01/02/19 10:00' order_date", "'1 Main St, Town' purchase_address",
        )
        path = str(tmp_path / "raw")
        rows.repartition(files).write.parquet(path)
        monkeypatch.setattr(fixture, "raw", lambda spark, sf_dir: spark.read.schema(TEXT).parquet(path))
        return str(tmp_path)

    return stand_in


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_records_are_joined_before_they_are_wide(spark, sf_dir):
    tables = [fixture.table(spark, sf_dir, name) for name in fixture.RAW_TABLES]
    joined = fixture._joined(*tables)
    expected = spark.sql(fixture.RAW_TEMPLATE, **dict(zip(fixture.RAW_TABLES, tables)))
    assert joined.exceptAll(expected).isEmpty() and expected.exceptAll(joined).isEmpty()
    assert "RebalancePartitions" not in plan_of(joined)


@pytest.mark.parametrize("files", [3, 8, 21])
def test_as_many_files_as_named_without_a_shuffle(spark, own_raw, monkeypatch, files):
    sf_dir, plans = own_raw(files), []
    monkeypatch.setattr(fixture, "write_csv", lambda df, *args, **more: (plans.append(plan_of(df)), write_csv(df, *args, **more)))
    found = spark.read.option("header", True).csv(fixture.csv_folder(spark, sf_dir))
    assert len(found.inputFiles()) == fixture.CSV_FILES and found.count() == 400
    assert ("Repartition 8, true" in plans[0]) == (files < fixture.CSV_FILES)


def test_a_line_break_in_a_text_keeps_records_whole(spark, own_raw, monkeypatch):
    sf_dir = own_raw(9, product="two\nlines")
    monkeypatch.setattr(registry, "line_dialect", fixture.line_dialect)
    found = registry.csv_round_trip(spark, sf_dir)
    assert fixture.line_dialect(spark, sf_dir).multiline and found.count() == 400
    assert found.filter(F.col("product") == "two\nlines").count() == 1


def test_files_without_line_breaks_are_split(spark, own_raw):
    assert not fixture.line_dialect(spark, own_raw(9)).multiline
