"""First-wins, insert-if-absent, and NULL-safe lookups against plain Python."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.operators.dedup import (
    absent_from,
    absent_from_large,
    first_wins,
    insert_if_absent,
)
from riskflow.operators.keys import lookup, orphans, resolve_keys, unresolved_keys

SCHEMA = "k string, at long, v string"
ROW = st.tuples(
    st.sampled_from("abc"), st.integers(0, 3), st.sampled_from(["x", "y", None])
)
QUICK = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def earliest(rows):
    """NULLs sort first, as in Spark."""
    best = {}
    for key, at, v in rows:
        rank = (at, v is not None, v or "")
        if key not in best or rank < best[key][0]:
            best[key] = (rank, (key, at, v))
    return {row for _, row in best.values()}


@QUICK
@given(st.lists(ROW, min_size=1, max_size=12))
def test_first_wins(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert {tuple(r) for r in first_wins(df, ["k"], ["at"]).collect()} == earliest(rows)


@QUICK
@given(st.lists(ROW, min_size=1, max_size=10), st.lists(ROW, max_size=10))
def test_insert_if_absent(spark, new, stored):
    known = {key for key, _, _ in stored}
    expected = earliest([row for row in new if row[0] not in known])
    frames = (spark.createDataFrame(r, SCHEMA) for r in (new, stored))
    got = insert_if_absent(*frames, ["k"], ["at"]).collect()
    assert {tuple(row) for row in got} == expected


def test_keys_alone_become_distinct(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert sorted(r.k for r in first_wins(df, ["k"], ["k"]).collect()) == ["a", "b"]


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_both_ways_to_exclude_stored_keys_agree(spark, broadcast):
    draw = random.Random(7)
    new = spark.createDataFrame([(draw.randrange(300), i) for i in range(400)], "k long, v long")
    stored = spark.createDataFrame([(draw.randrange(300),) for _ in range(200)], "k long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plain = sorted(absent_from(new, stored, ["k"]).collect())
        assert plain == sorted(absent_from_large(new, stored, ["k"]).collect())
        assert plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_hot_key_leaves_each_task_as_one_row(spark):
    """The partial aggregate runs below the exchange."""
    hot = spark.range(0, 20000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    deduplicated = first_wins(hot, ["k"], ["id"])
    plan = deduplicated._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning")
    assert deduplicated.count() == 20000 - len(range(0, 20000, 3)) + 1


FACTS = [(i, None if i % 3 else i % 7) for i in range(200)]


@pytest.mark.parametrize("kind", ["long", "int", "string"])
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_lookup_equals_a_left_join(spark, kind, broadcast):
    facts = spark.createDataFrame(FACTS, "id long, k long").withColumn("k", F.col("k").cast(kind))
    dims = spark.createDataFrame([(k, f"n{k}") for k in range(5)], "k long, name string")
    dims = dims.withColumn("k", F.col("k").cast(kind))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        plain = facts.join(dims, "k", "left").select("id", "k", "name").collect()
        assert sorted(lookup(facts, dims, "k", "id").collect(), key=str) == sorted(
            plain, key=str
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_lookup_ignores_a_key_that_equals_the_spread_value(spark):
    fact = spark.createDataFrame([(1, None)], "id long, k long")
    dims = fact.select(F.xxhash64("id").alias("k"), F.lit("wrong").alias("name"))
    assert lookup(fact, dims, "k", "id").first()["name"] is None


def test_rows_without_a_key_are_spread_over_tasks(spark):
    facts = spark.range(1000).select("id", F.when(F.col("id") < 0, F.col("id")).alias("k"))
    dims = spark.createDataFrame([(1, "a")], "k long, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = (
            lookup(facts, dims, "k", "id")
            .groupBy(F.spark_partition_id().alias("task"))
            .count()
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(row["count"] for row in sizes) < 400


def test_resolved_and_unresolved_are_complements(spark):
    rows = [("t1", 1, "m1"), ("t2", 2, "m1"), ("t3", 1, "m2"), ("t4", None, "m1"), ("t5", 3, None)]
    events = spark.createDataFrame(rows, "trans_num string, cc_num long, merchant string")
    customers = spark.createDataFrame([(1, 10), (3, 30)], "cc_num long, customer_id long")
    merchants = spark.createDataFrame([("m1", 7)], "merchant_name string, merchant_id long")
    resolved = resolve_keys(events, customers, merchants).collect()
    assert [(r.trans_num, r.customer_id, r.merchant_id) for r in resolved] == [("t1", 10, 7)]
    missing = unresolved_keys(events, customers, merchants).collect()
    assert {(r.trans_num, r.customer_missing, r.merchant_missing) for r in missing} == {
        ("t2", True, False),
        ("t3", False, True),
        ("t4", True, False),
        ("t5", False, True),
    }


def test_null_foreign_keys_are_no_orphans(spark):
    child = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "id long")
    assert [r.k for r in orphans(child, parent, "k", "id").collect()] == [2]


def test_unique_lines_are_dealt_once_for_the_join_with_orders(spark):
    from helpers import SMALL

    from riskflow.sources import cards

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = cards.transactions(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2  # lines and orders, once each
