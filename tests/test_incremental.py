"""Growing directories and deliveries: the same results as from all rows at once, with work for the new ones only."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.operators import dedup
from scrubline.operators.quality import Check, run_checks
from scrubline.operators.states import RELATIVE_ERROR, checks_of_state, merge_states, partial_states, statistics
from scrubline.plans import deliveries
from scrubline.plans.deliveries import merge_latest
from scrubline.plans.incremental import update_states

SCHEMA = T.StructType(
    [T.StructField("Key", T.StringType()), T.StructField("Amount", T.IntegerType()), T.StructField("Price", T.DoubleType())]
)
CHECKS = [Check("not_null", "key"), Check("at_least", "amount", 1), Check("above", "price", 0), Check("has_values", "key")]


def figures(states):
    return {r.column_name: r for r in statistics(states.merged(), states.columns).collect()}


def test_only_new_files_are_read(spark, tmp_path):
    source, store = tmp_path / "in", str(tmp_path / "states")
    source.mkdir()
    (source / "a b.csv").write_text("Key,Amount,Price\n1,5,1.5\n2,,2.5\n")
    (source / "b.csv").write_text("Key,Amount,Price\n")
    first = update_states(spark, [str(source)], store, SCHEMA)
    assert first.read == 2 and figures(first)["amount"].nulls == 1
    (source / "c.csv").write_text("Key,Amount,Price\nx,-7,NaN\n,9,0.5\n")
    second = update_states(spark, [str(source)], store, SCHEMA)
    assert second.read == 1
    found = figures(second)
    assert {r.row_count for r in found.values()} == {4}
    assert (found["key"].nulls, found["key"].data_type, round(found["key"].distinct_estimate)) == (1, "string", 4)
    assert (found["amount"].low, found["amount"].high, found["amount"].total) == ("-7", "9", 7.0)
    assert update_states(spark, [str(source)], store, SCHEMA).read == 0
    # A changed file is read again, and one that is gone does not count.
    (source / "a b.csv").write_text("Key,Amount,Price\n1,5,1.5\n")
    os.unlink(source / "c.csv")
    third = update_states(spark, [str(source)], store, SCHEMA)
    assert third.read == 1 and figures(third)["key"].row_count == 1 and figures(third)["key"].data_type == "int"


def test_no_files_and_no_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    states = update_states(spark, [str(tmp_path / "in")], str(tmp_path / "states"), SCHEMA)
    found = figures(states)
    assert states.read == 0 and {(r.row_count, r.nulls, r.low, r.distinct_estimate) for r in found.values()} == {(0, 0, None, 0)}
    assert not any(r.passed for r in checks_of_state(states.merged(), CHECKS).filter("check_name <> 'not_null:key'").collect())


def test_states_of_parts_are_those_of_all(spark):
    df = spark.range(60_000).selectExpr(
        "CAST(id % 7 AS INT) AS part", "IF(id % 11 = 0, NULL, CAST(id % 20011 AS STRING)) AS key",
        "CAST(id % 100 AS INT) AS amount", "id / 3 AS price",
    )
    columns = ["key", "amount", "price"]
    merged = merge_states(partial_states(df, "part"), columns)
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in columns]).first()
    for row in statistics(merged, columns).collect():
        # NULL counts as a value.
        wanted = exact[row.column_name] + (row.nulls > 0)
        assert abs(row.distinct_estimate - wanted) <= 3 * RELATIVE_ERROR * wanted
    gate = {r.check_name: (r.observed, r.passed) for r in checks_of_state(merged, CHECKS).collect()}
    plain = {r.check_name: (r.observed, r.passed) for r in run_checks(df, CHECKS).collect()}
    assert {name: gate[name] for name in gate if "has_values" not in name} == {n: v for n, v in plain.items() if "has_values" not in n}
    assert gate["has_values:key"][1] == plain["has_values:key"][1]
    # Merging merged states changes nothing.
    twice = merge_states(merged, columns)
    assert statistics(twice, columns).collect() == statistics(merged, columns).collect()


DELIVERY = "k long, name string, at int, v int, month int"


def test_deliveries_equal_one_go(spark, tmp_path):
    rng = random.Random(3)
    target, everything = str(tmp_path / "latest"), []
    for _ in range(4):
        rows = []
        for _ in range(60):
            at = rng.randrange(100)
            key = rng.choice([None, *range(25)])
            rows.append((key, rng.choice(["a", "b"]), at, rng.randrange(5), None if at > 95 else at // 20))
        everything += rows
        touched = merge_latest(spark, spark.createDataFrame(rows, DELIVERY), target, ["k", "name"], ["at"], ["month"])
        assert touched
        whole = dedup.keep_latest(spark.createDataFrame(everything, DELIVERY), ["k", "name"], ["at"])
        found = spark.read.schema(DELIVERY).parquet(target)
        assert sorted(map(str, found.collect())) == sorted(map(str, whole.collect()))
    # The same delivery again changes nothing.
    merge_latest(spark, spark.createDataFrame(rows, DELIVERY), target, ["k", "name"], ["at"], ["month"])
    assert sorted(map(str, spark.read.schema(DELIVERY).parquet(target).collect())) == sorted(map(str, whole.collect()))


def test_only_touched_partitions_are_written(spark, tmp_path):
    target = str(tmp_path / "latest")

    def deliver(*rows):
        return merge_latest(spark, spark.createDataFrame(rows, DELIVERY), target, ["k"], ["at"], ["month"])

    def files():
        return {m: set(glob.glob(f"{target}/month={m}/*.parquet")) for m in (1, 2, 3)}

    assert deliver((1, "a", 10, 0, 1), (2, "a", 20, 0, 2), (3, "a", 21, 0, 2)) == [(1,), (2,)]
    before = files()
    # Key 1 moves from month 1, which has nothing left, to month 3; month 2 is not touched.
    assert deliver((1, "b", 30, 0, 3)) == [(1,), (3,)]
    after = files()
    assert after[2] == before[2] and not os.path.exists(f"{target}/month=1") and after[3]
    assert deliver((2, "old", 5, 0, 1)) == [(1,), (2,)]
    assert sorted((r.k, r.name) for r in spark.read.schema(DELIVERY).parquet(target).collect()) == [(1, "b"), (2, "a"), (3, "a")]
    assert merge_latest(spark, spark.createDataFrame([], DELIVERY), target, ["k"], ["at"], ["month"]) == []


@pytest.mark.parametrize("empty_first", [True, False])
def test_an_empty_delivery_makes_no_table(spark, tmp_path, empty_first):
    target = str(tmp_path / "latest")
    if empty_first:
        assert merge_latest(spark, spark.createDataFrame([], DELIVERY), target, ["k"], ["at"], ["month"]) == []
        assert not os.path.exists(target)
    assert merge_latest(spark, spark.createDataFrame([(1, "a", 1, 1, 1)], DELIVERY), target, ["k"], ["at"], ["month"]) == [(1,)]


@pytest.mark.parametrize("few", [0, 5, 1_000_000])
def test_deliveries_with_any_number_of_keys_in_common(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(deliveries, "FEW_SHARED", few)
    monkeypatch.setattr(deliveries, "MANY_FILES", 2)
    rng = random.Random(5)
    target, everything = str(tmp_path / "latest"), []
    for _ in range(5):
        # Few keys at first, then nearly all new ones.
        keys = [None, *range(len(everything), len(everything) + 40)]
        rows = [(rng.choice(keys), "a", at, rng.randrange(3), rng.choice([None, 1, 2])) for at in rng.choices(range(50), k=40)]
        rows += [(old[0], old[1], old[2] + rng.choice([-1, 0, 1]), 0, 3) for old in everything[:2]]
        everything += rows
        merge_latest(spark, spark.createDataFrame(rows, DELIVERY), target, ["k", "name"], ["at"], ["month"])
        whole = dedup.keep_latest(spark.createDataFrame(everything, DELIVERY), ["k", "name"], ["at"])
        assert sorted(map(str, spark.read.schema(DELIVERY).parquet(target).collect())) == sorted(map(str, whole.collect()))


def test_rows_without_a_common_key_are_not_shuffled(spark, tmp_path):
    """Held rows stay where they are; only their hashes and the delivery's rows move."""
    target, store = str(tmp_path / "latest"), spark.sparkContext._jsc.sc().statusStore()
    tracker = spark.sparkContext.statusTracker()

    def shuffled(first, n):
        wide = "array_join(transform(sequence(1, 16), i -> sha2(concat(id, '-', i), 256)), '') AS name"
        rows = spark.range(first, first + n).selectExpr("id AS k", wide, "1 AS at", "1 AS v", "int(id % 3) AS month")
        group = f"delivery-{first}-{n}"
        spark.sparkContext.setJobGroup(group, group)
        merge_latest(spark, rows, target, ["k"], ["at"], ["month"])
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
        return sum(store.lastStageAttempt(s).shuffleWriteBytes() for s in stages)

    assert shuffled(0, 5_000) > 2_000_000
    assert shuffled(5_000, 50) < 500_000
    assert spark.read.schema(DELIVERY).parquet(target).count() == 5_050


def test_files_of_many_deliveries_are_brought_together(spark, tmp_path):
    target = str(tmp_path / "latest")
    for i in range(2 * deliveries.MANY_FILES):
        merge_latest(spark, spark.createDataFrame([(i, "a", 1, 1, 1)], DELIVERY), target, ["k"], ["at"], ["month"])
    assert len(glob.glob(f"{target}/month=1/*.parquet")) <= deliveries.MANY_FILES + 2
    assert spark.read.schema(DELIVERY).parquet(target).count() == 2 * deliveries.MANY_FILES
