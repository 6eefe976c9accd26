"""Every query against its SQL twin in a second engine, on whole tables."""

import os
from collections import Counter

import duckdb
import pytest

from scrubline import catalogue

QUERIES = catalogue.queries()
ORACLES = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{file}')")
    yield connection
    connection.close()


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def test_every_query_is_compared():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(name, spark, sf_dir, duck):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLES[name])
    expected_columns = [c[0] for c in expected.description]
    expected_types = {c[0]: str(c[1]) for c in expected.description}
    assert sorted(result.columns) == sorted(expected_columns)
    spark_types = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    assert {c: spark_types[t] for c, t in result.dtypes} == expected_types
    ours = bag(result.columns, [tuple(r) for r in result.collect()])
    theirs = bag(expected_columns, expected.fetchall())
    assert ours == theirs
    assert sum(ours.values()) > 0
