"""Declarative data checks, row-level constraints and the quality gate."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """One test of one column. ``accepted`` lists values or the two inclusive bounds."""

    model: str
    column: str
    test: str
    accepted: Sequence = field(default=())

    def broken(self) -> Column:
        """True for a row that fails; NULL passes every test but ``not_null``."""
        value = F.col(self.column)
        if self.test == "not_null":
            return value.isNull()
        if self.test == "accepted_values":
            return ~value.isin(*self.accepted)
        if self.test == "accepted_range":
            low, high = self.accepted
            bounds = [value < low] if low is not None else []
            bounds += [value > high] if high is not None else []
            return reduce(Column.__or__, bounds)
        raise ValueError(f"{self.test} is not a row test")


def _checks(model: str, **columns: Iterable) -> list[Check]:
    return [
        Check(model, column, test, tuple(accepted))
        for column, tests in columns.items()
        for test, *accepted in (t if isinstance(t, tuple) else (t,) for t in tests)
    ]


_KEY = ("not_null", "unique")
_LABEL = ("not_null", ("accepted_values", 0, 1))
_SOURCE = ("not_null", ("accepted_values", "batch", "stream"))

# The declared tests of every model.
STAGING_CHECKS = (
    _checks(
        "stg_transactions",
        trans_id=_KEY,
        amount=("not_null", ("accepted_range", 0, 50000)),
        is_fraud=_LABEL,
        source=_SOURCE,
        trans_at=("not_null",),
    )
    + _checks(
        "stg_customers",
        customer_id=_KEY,
        cc_num=_KEY,
        full_name=("not_null",),
        state=("not_null",),
    )
    + _checks(
        "stg_merchants", merchant_id=_KEY, merchant_name=_KEY, category=("not_null",)
    )
)
INTERMEDIATE_CHECKS = _checks(
    "int_transaction_stats",
    trans_id=_KEY,
    amount=("not_null", ("accepted_range", 0, None)),
    is_fraud=_LABEL,
    customer_age=(("accepted_range", 18, 110),),
)
CORE_CHECKS = (
    _checks(
        "fact_transactions",
        trans_id=_KEY,
        amount=("not_null", ("accepted_range", 0, None)),
        is_fraud=_LABEL,
        source=_SOURCE,
    )
    + _checks("dim_customer", customer_id=_KEY)
    + _checks("dim_merchant", merchant_id=_KEY)
    + _checks("dim_date", date_id=_KEY, full_date=_KEY)
)
MART_CHECKS = _checks(
    "mart_fraud_summary",
    txn_date=("not_null",),
    total_transactions=("not_null", ("accepted_range", 1, None)),
    fraud_rate_pct=(("accepted_range", 0, 100),),
) + _checks(
    "mart_customer_360",
    total_transactions=("not_null", ("accepted_range", 1, None)),
    risk_tier=("not_null", ("accepted_values", "HIGH", "MEDIUM", "LOW")),
)
ALL_CHECKS = STAGING_CHECKS + INTERMEDIATE_CHECKS + CORE_CHECKS + MART_CHECKS


def _model_tests(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All tests of one model in one pass, as one row per test.

    Rows are grouped by the first unique key, which adds up the failed row tests on the way; a further
    unique key groups once more. Counts combine on the map side, so hot keys stay cheap.
    """
    rows = [c for c in checks if c.test != "unique"]
    keys = [c for c in checks if c.test == "unique"]
    failed = [F.sum(F.when(c.broken(), 1).otherwise(0)).alias(f"r{i}") for i, c in enumerate(rows)]
    if keys:
        per_key = df.groupBy(F.col(keys[0].column).alias("key")).agg(F.count("*").alias("n"), *failed)
        repeated = F.count_if(F.col("key").isNotNull() & (F.col("n") > 1)).alias("u0")
        failed = [F.coalesce(F.sum(f"r{i}"), F.lit(0)).alias(f"r{i}") for i in range(len(rows))]
        counts = per_key.agg(repeated, *failed)
    else:
        counts = df.agg(*[F.coalesce(f, F.lit(0)).alias(f"r{i}") for i, f in enumerate(failed)])
    named = [(f"r{i}", c) for i, c in enumerate(rows)] + [("u0", c) for c in keys[:1]]
    found = _as_rows(counts, named)
    for check in keys[1:]:
        again = df.filter(F.col(check.column).isNotNull()).groupBy(check.column).count()
        repeated = again.agg(F.count_if(F.col("count") > 1).alias("u0"))
        found = found.unionByName(_as_rows(repeated, [("u0", check)]))
    return found


def _as_rows(counts: DataFrame, named: Sequence[tuple[str, Check]]) -> DataFrame:
    """The columns of a one-row result as a row for each check."""
    tests = [
        F.struct(
            F.lit(check.model).alias("model"),
            F.lit(check.column).alias("column_name"),
            F.lit(check.test).alias("test"),
            F.col(name).cast("long").alias("failures"),
        )
        for name, check in named
    ]
    return counts.select(F.explode(F.array(*tests)).alias("row")).select("row.*")


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: model, column_name, test, failures."""
    parts = [
        _model_tests(models[model], [check for check in checks if check.model == model])
        for model in dict.fromkeys(check.model for check in checks)
    ]
    return reduce(DataFrame.unionByName, parts)


class QualityGateError(RuntimeError):
    """At least one check found failures."""


def require_clean(report: DataFrame) -> None:
    """Raise when any check failed. A report has one row per declared check, never more."""
    failed = report.filter("failures > 0").collect()
    if failed:
        listing = "; ".join(
            f"{row.model}.{row.column_name} {row.test}: {row.failures}" for row in failed
        )
        raise QualityGateError(listing)


# Table constraints, applied to rows before they are stored.


def customer_violation() -> Column:
    """Why a customer row may not be stored, or NULL."""
    return (
        F.when(F.col("cc_num").isNull(), "cc_num is null")
        .when(~F.col("gender").isin("M", "F"), "gender not in (M, F)")
        .otherwise(F.lit(None).cast("string"))
    )


def merchant_violation() -> Column:
    return F.when(F.col("merchant_name").isNull(), "merchant_name is null").otherwise(
        F.lit(None).cast("string")
    )


def transaction_violation() -> Column:
    return (
        F.when(F.col("trans_id").isNull(), "trans_id is null")
        .when(F.col("trans_at").isNull(), "trans_at is null")
        .when(F.col("amount").isNull(), "amount is null")
        .when(F.col("is_fraud").isNull(), "is_fraud is null")
        .when(~F.col("is_fraud").isin(0, 1), "is_fraud not in (0, 1)")
        .when(F.col("source").isNull(), "source is null")
        .when(~F.col("source").isin("batch", "stream"), "source not in (batch, stream)")
        .otherwise(F.lit(None).cast("string"))
    )


def split_by_violation(rows: DataFrame, violation: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with a ``_dlq_reason``)."""
    judged = rows.withColumn("_dlq_reason", violation)
    valid = judged.filter(F.col("_dlq_reason").isNull()).drop("_dlq_reason")
    return valid, judged.filter(F.col("_dlq_reason").isNotNull())
