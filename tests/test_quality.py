"""Checks must fail on bad rows, pass on good ones, and stop the gate."""

import collections

import pytest

from riskflow.operators import quality

CHECKS = [
    quality.Check("m", "k", "not_null"),
    quality.Check("m", "k", "unique"),
    quality.Check("m", "v", "accepted_values", (0, 1)),
    quality.Check("m", "v", "accepted_range", (0, 10)),
    quality.Check("m", "v", "accepted_range", (None, 4)),
]


def failures(spark, rows):
    df = spark.createDataFrame(rows, "k string, v int")
    report = quality.run_checks({"m": df}, CHECKS)
    return [row.failures for row in report.orderBy("test").collect()], report


def test_clean_rows_pass(spark):
    counts, report = failures(spark, [("a", 0), ("b", 1), ("c", None)])
    assert counts == [0] * 5
    quality.require_clean(report)


def test_every_test_counts_its_failures(spark):
    rows = [("a", 0), ("a", 5), ("b", -1), ("b", 11), (None, 1), (None, 1), ("c", 10)]
    counts, report = failures(spark, rows)
    by_test = {
        (row.column_name, row.test, row.failures) for row in report.collect()
    }
    assert by_test == {
        ("k", "not_null", 2),
        ("k", "unique", 2),
        ("v", "accepted_values", 4),
        ("v", "accepted_range", 2),
        ("v", "accepted_range", 3),
    }
    with pytest.raises(quality.QualityGateError, match="m.k unique: 2"):
        quality.require_clean(report)


def test_declared_checks():
    tests = collections.Counter(check.test for check in quality.ALL_CHECKS)
    assert tests == {
        "not_null": 27,
        "unique": 11,
        "accepted_values": 6,
        "accepted_range": 7,
    }
    sizes = [
        len(part)
        for part in (
            quality.STAGING_CHECKS,
            quality.INTERMEDIATE_CHECKS,
            quality.CORE_CHECKS,
            quality.MART_CHECKS,
        )
    ]
    assert sizes == [20, 7, 16, 8]


def test_rows_are_split_with_a_reason(spark):
    rows = [("t1", 1, "batch"), ("t2", 2, "batch"), ("t3", 0, "web"), (None, 0, "stream")]
    df = spark.createDataFrame(rows, "trans_id string, is_fraud int, source string").selectExpr(
        "*", "current_timestamp() AS trans_at", "1.00BD AS amount"
    )
    valid, rejected = quality.split_by_violation(df, quality.transaction_violation())
    assert [row.trans_id for row in valid.collect()] == ["t1"]
    assert {(row.trans_id, row._dlq_reason) for row in rejected.collect()} == {
        ("t2", "is_fraud not in (0, 1)"),
        ("t3", "source not in (batch, stream)"),
        (None, "trans_id is null"),
    }


def test_gender_constraint_lets_null_pass(spark):
    df = spark.createDataFrame([(1, "M"), (2, "X"), (3, None)], "cc_num long, gender string")
    valid, rejected = quality.split_by_violation(df, quality.customer_violation())
    assert sorted(row.cc_num for row in valid.collect()) == [1, 3]
    assert [row.cc_num for row in rejected.collect()] == [2]
