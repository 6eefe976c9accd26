"""Figures of the messy records at sf0.01 that were worked out beforehand."""

import datetime

import pytest

from scrubline import catalogue

from conftest import TESTDATA


@pytest.fixture(scope="module")
def ask(spark):
    return lambda name: catalogue.queries()[name](spark, f"{TESTDATA}/sf0.01")


def test_rejects(ask):
    found = {r.reject_reason: r.n for r in ask("reject_summary").collect()}
    assert found == {
        "accepted": 52_182,
        "null_field": 2_853,
        "invalid_order_id": 1_246,
        "non_positive_value": 2_047,
        "bad_date": 1_672,
    }


def test_dedup(ask):
    assert tuple(ask("dedup_summary").first()) == (52_182, 50_530, 52_182 - 50_530)
    assert ask("exact_duplicate_count").first().duplicates == 1_532
    assert ask("events_latest").count() == 750


def test_job(ask):
    row = ask("cleanse_metrics").first()
    assert (row.initial_rows, row.output_rows, row.total_quantity_ordered) == (60_000, 50_530, 1_283_897)
    assert (row.distinct_product, row.distinct_order_id) == (64, 12_825 + 1)
    assert (row.min_price_each, row.max_price_each) == (900.0, 999.9)
    assert row.min_date == datetime.datetime(2015, 1, 2, 5, 20)
    assert row.max_date == datetime.datetime(2021, 11, 4, 21, 20)
    checks = {r.check_name: r.observed for r in ask("quality_checks").collect()}
    assert checks["not_null:order_id"] == 42 and not row.quality_passed
