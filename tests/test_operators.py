"""Operators against brute force on small frames, and the shape of their plans."""

import datetime
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scrubline.functions import parse_int, snake_columns
from scrubline.operators import dedup, profiling, quality, rules
from scrubline.operators.profiling import CastTarget
from scrubline.operators.quality import Check, QualityError

KV = "k string, ts int, v string"
small_rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.one_of(st.none(), st.integers(0, 3)),
        st.sampled_from(["x", "y", None]),
    ),
    max_size=30,
)
few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def low(value):
    return (value is not None, value if value is not None else 0)


def low_text(value):
    return (value is not None, value or "")


@few
@given(rows=small_rows)
def test_keep_latest_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, KV).repartition(3)
    best = {}
    for row in rows:
        rank = (low(row[1]), low_text(row[2]))
        if row[0] not in best or rank > best[row[0]][0]:
            best[row[0]] = (rank, row)
    kept = dedup.keep_latest(df, ["k"], ["ts"])
    assert Counter(tuple(r) for r in kept.collect()) == Counter(row for _, row in best.values())
    assert Counter(dedup.keep_latest(kept, ["k"], ["ts"]).collect()) == Counter(kept.collect())


@few
@given(rows=small_rows, chunk=st.integers(1, 7))
def test_exact_duplicates_match_brute_force(spark, rows, chunk):
    df = spark.createDataFrame(rows, KV)
    counts = Counter(rows)
    members = Counter({row: n for row, n in counts.items() if n > 1})
    found = dedup.duplicate_members(df, chunk_rows=chunk).collect()
    assert Counter(tuple(r) for r in found) == members
    assert dedup.exact_duplicate_count(df).first().duplicates == sum(n - 1 for n in counts.values())
    assert Counter(tuple(r) for r in dedup.drop_exact(df).collect()) == Counter(counts.keys())
    keys = Counter(row[0] for row in rows)
    assert tuple(dedup.summary(df, ["k"]).first()) == (len(rows), len(keys), len(rows) - len(keys))
    sharing = dedup.key_members(df, ["k"]).collect()
    assert Counter(tuple(r) for r in sharing) == Counter(r for r in rows if keys[r[0]] > 1)


def test_ties_are_settled_by_the_other_columns(spark):
    rows = [("a", 1, "x"), ("a", 1, "z"), ("a", 1, "y"), ("a", None, "zz")]
    for partitions in (1, 4):
        df = spark.createDataFrame(rows, KV).repartition(partitions)
        assert tuple(dedup.keep_latest(df, ["k"], ["ts"]).first()) == ("a", 1, "z")


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    hot = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("ts"),
    )
    kept = dedup.keep_latest(hot, ["k"], ["ts"])
    plan = plan_of(kept)
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert plan.count("WindowGroupLimit") >= 2 and exchange < partial
    assert plan.count("Exchange hashpartitioning") == 1
    assert kept.filter("k = 'hot'").first().ts == 199_998
    assert kept.count() == 100_001


def test_hot_copies_are_put_out_by_many_tasks(spark):
    blank = spark.range(0, 100_000, numPartitions=8).select(F.lit(None).cast("string").alias("a"), F.lit(1).alias("b"))
    single = spark.createDataFrame([("x", 1), ("y", 2), ("y", 2)], "a string, b int")
    members = dedup.duplicate_members(blank.unionByName(single), chunk_rows=1_000)
    spread = members.groupBy(F.spark_partition_id().alias("p"), "a").count().collect()
    assert sum(r["count"] for r in spread) == 100_002
    blanks = [r["count"] for r in spread if r.a is None]
    assert len(blanks) == 8 and max(blanks) < 40_000


def test_hot_key_members_are_split(spark, tmp_path):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        # Spark splits what exceeds five times the median partition.
        "spark.sql.shuffle.partitions": "32",
    }
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))
    body = F.sha2(F.col("id").cast("string"), 256).alias("body")
    spark.range(0, 60_000, 1, 8).select(key.alias("k"), "id", body).write.parquet(f"{tmp_path}/t")
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        members = dedup.key_members(spark.read.parquet(f"{tmp_path}/t"), ["k"])
        assert len(members.collect()) == 20_000
        assert "SortMergeJoin(skew=true)" in plan_of(members)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_exact_duplicates_share_one_shuffle(spark, tmp_path):
    spark.range(1000).select((F.col("id") % 7).alias("a")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    members = dedup.duplicate_members(df)
    assert members.count() == 1000
    members.collect()
    ran = plan_of(members).split("== Initial Plan ==")[0]
    assert ran.count("FileScan") == 1 and ran.count("Exchange hashpartitioning") == 1
    spread = dedup.duplicate_members(df, chunk_rows=142)
    spread.collect()
    assert "ReusedExchange" in plan_of(spread)


def test_no_python_in_plans(spark, sf_dir):
    from scrubline import catalogue

    for name, query in catalogue.queries().items():
        plan = plan_of(query(spark, sf_dir))
        for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert node not in plan, (name, node)
        # Python opens files to read their headers, and does nothing else.
        assert "InArrow" not in plan or name in ("header_consistency", "csv_union_by_name"), name


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    from scrubline import catalogue

    plan = plan_of(catalogue.queries()["required_filter"](spark, sf_dir))
    assert "IsNotNull(order_id)" in plan
    assert "ReadSchema: struct<order_date:string>" in plan_of(
        catalogue.queries()["sample_values"](spark, sf_dir)
    )


# -- rules ---------------------------------------------------------------------


def sales(spark):
    rows = [
        ("1", "a", 1), ("2", None, 1), ("x", "a", 1), ("3", "a", 0), ("99999999999", "a", 2), ("4\n", "a", 1), (None, "a", None),
    ]
    return spark.createDataFrame(rows, "id string, p string, q int")


def sales_rules():
    return [rules.required(["id", "p", "q"]), rules.digits("id"), rules.positive(["q"])]


def test_first_broken_rule_wins_and_nothing_is_lost(spark):
    df = sales(spark)
    reasons = [r.reject_reason for r in rules.classify(df, sales_rules()).collect()]
    assert reasons == [None, "null_field", "invalid_id", "non_positive_value", None, None, "null_field"]
    summary = {r.reject_reason: r.n for r in rules.reject_summary(df, sales_rules()).collect()}
    assert summary == {"accepted": 3, "null_field": 2, "invalid_id": 1, "non_positive_value": 1}
    assert rules.accept(df, sales_rules()).count() == 3
    assert rules.reject(df, sales_rules()).count() == 4
    ids = [r.id for r in rules.accept(df, sales_rules()).select(parse_int(F.col("id")).alias("id")).collect()]
    assert ids == [1, None, 4]


def test_empty_input(spark):
    empty = sales(spark).limit(0)
    assert {r.n for r in rules.reject_summary(empty, sales_rules()).collect()} == {0}
    assert dedup.exact_duplicate_count(empty).first().duplicates == 0
    assert tuple(dedup.summary(empty, ["id"]).first()) == (0, 0, 0)
    assert {r.nulls for r in profiling.null_counts(empty).collect()} == {0}
    assert {r.distinct_with_null for r in profiling.distinct_counts(empty).collect()} == {0}
    checks = quality.run_checks(empty, [Check("at_least", "q", 1), Check("not_null", "q"), Check("has_values", "p")])
    assert [(r.observed, r.passed) for r in checks.collect()] == [(None, False), (0.0, True), (0.0, False)]


def test_numeric_text(spark):
    yes = ["1", "-2.5", "+3.", ".5", "1e3", " 7 ", "inf", "-Infinity"]
    no = ["", "x", "1d", "1f", "NaN", "1,000", "0x10", "--1", "e5"]
    df = spark.createDataFrame([(t,) for t in [*yes, *no, None]], "t string")
    kept = [r.t for r in rules.accept(df, [rules.numeric("t")]).collect()]
    assert kept == yes


# -- profiling and quality -----------------------------------------------------


def test_distinct_counts_treat_null_as_told(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), ("b", 1), (None, 2)], "s string, n int")
    found = {r.column_name: tuple(r)[1:] for r in profiling.distinct_counts(df).collect()}
    assert found == {"s": (3, 2), "n": (2, 2)}
    rough = {r.column_name: tuple(r)[1:] for r in profiling.distinct_counts(df, approximate=True).collect()}
    assert rough == found


def test_castability(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "04/07/19 22:30"), ("2", "x", "4/7/19 9:30"), (None, "NaN", None)], "a string, b string, c string"
    )
    strict, lenient = ("MM/dd/yy HH:mm",), ("MM/dd/yy HH:mm", "M/d/yy H:mm")
    targets = [
        CastTarget("a", "int"), CastTarget("b", "float"), CastTarget("b", "int"), CastTarget("b", "string"),
        CastTarget("c", "timestamp", strict), CastTarget("c", "timestamp", lenient),
    ]
    found = [(r.bad_values, r.passed) for r in profiling.castability(df, targets).collect()]
    assert found == [(0, True), (1, False), (3, False), (0, True), (1, False), (0, True)]
    with pytest.raises(ValueError):
        CastTarget("a", "complex").bad()


def test_all_null_columns_go(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, "x")], "a int, b string, c string")
    assert profiling.drop_all_null_columns(df).columns == ["a", "c"]
    assert profiling.any_null_rows(df).count() == 2
    assert tuple(profiling.shape(df).first()) == (2, 3)


def test_sample_and_preview(spark):
    df = spark.createDataFrame([(v,) for v in "eadcbffa"], "v string")
    assert [r.value for r in profiling.sample_values(df, "v", 3).collect()] == ["a", "b", "c"]
    assert len(df.take(3)) == 3


def test_quality_enforcement(spark):
    df = spark.createDataFrame([(1, 0.0), (None, float("nan"))], "q int, p double")
    checks = [Check("not_null", "q"), Check("at_least", "q", 1), Check("above", "p", 0)]
    rows = {r.check_name: r.passed for r in quality.run_checks(df, checks).collect()}
    assert rows == {"not_null:q": False, "at_least:q": True, "above:p": False}
    failed = [name for name, passed in rows.items() if not passed]
    with pytest.warns(UserWarning, match="not_null:q"):
        quality.enforce(failed)
    with pytest.raises(QualityError):
        quality.enforce(failed, "raise")
    quality.enforce([], "raise")
    with pytest.raises(ValueError):
        quality.enforce([], "ignore")


def test_snake_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["Order ID", "Price"])
    assert snake_columns(df).columns == ["order_id", "price"]
    with pytest.raises(ValueError, match="order_id"):
        snake_columns(spark.createDataFrame([(1, 2)], ["Order ID", "order id"]))


def test_timestamps_order_latest(spark):
    day = datetime.datetime
    df = spark.createDataFrame(
        [(1, day(2019, 1, 1)), (1, day(2019, 1, 2)), (2, None)], "k int, t timestamp"
    )
    assert sorted(tuple(r) for r in dedup.keep_latest(df, ["k"], ["t"]).collect()) == [
        (1, day(2019, 1, 2)), (2, None),
    ]


# -- wide rows -----------------------------------------------------------------


@pytest.mark.parametrize("bits, most_broadcast", [(128, 500_000), (128, 0), (3, 500_000), (0, 0)])
def test_copies_of_wide_rows_are_verified(spark, bits, most_broadcast):
    rows = [(i % 40, None if i % 3 else "x", "w" * (i % 5)) for i in range(300)] + [(None, "x", None), ("x" and None, None, "x")] * 2
    rows += [(1000 + i, "alone", "x") for i in range(50)]
    df = spark.createDataFrame(rows, "a int, b string, c string")
    found = dedup.copies_of_wide_rows(df, bits=bits, most_broadcast=most_broadcast, name="n")
    assert sorted(map(str, found.collect())) == sorted(map(str, dedup.copies(df, name="n").collect()))
    assert dedup.copies_of_wide_rows(df.limit(0), bits=bits).count() == 0


def test_wide_rows_are_not_shuffled(spark):
    store, tracker = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext.statusTracker()

    def shuffled(df, group):
        spark.sparkContext.setJobGroup(group, group)
        df().write.format("noop").mode("overwrite").save()
        stages = {s for job in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(job).stageIds}
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return sum(store.lastStageAttempt(s).shuffleWriteBytes() for s in stages)

    def rows(width):
        # Texts that do not compress.
        text = "concat_ws('', transform(sequence(1, {}), i -> sha2(concat(id % 19990, '-', i), 256))) AS text".format(width)
        return spark.range(20_000).selectExpr("id % 19990 AS id", text)

    narrow, wide = (shuffled(lambda: dedup.copies_of_wide_rows(rows(w)), f"marks-{w}") for w in (1, 20))
    assert wide < 1.3 * narrow and wide < shuffled(lambda: dedup.copies(rows(20)), "whole") / 10
