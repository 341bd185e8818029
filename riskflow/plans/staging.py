"""Staging views over the stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions import (
    completed_years,
    day_of_week,
    full_name,
    hour_of_day,
    is_weekend,
    normalised_category,
)


def stg_transactions(transactions: DataFrame) -> DataFrame:
    at = F.col("trans_at")
    return transactions.filter(F.col("trans_id").isNotNull()).select(
        "trans_id",
        "customer_id",
        "merchant_id",
        "trans_at",
        "unix_time",
        hour_of_day(at).alias("hour_of_day"),
        day_of_week(at).alias("day_of_week"),
        is_weekend(at).alias("is_weekend"),
        "amount",
        "is_fraud",
        "source",
        "ingested_at",
    )


def stg_customers(customers: DataFrame, as_of: Column | None = None) -> DataFrame:
    """``as_of`` is the day ages are counted on; today unless a repeatable run names one."""
    today = F.current_date() if as_of is None else as_of
    return customers.filter(F.col("cc_num").isNotNull()).select(
        "customer_id",
        "cc_num",
        full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "first_name",
        "last_name",
        "gender",
        "dob",
        completed_years(F.col("dob"), today).alias("age"),
        "job",
        "city",
        "state",
        "zip",
        "lat",
        "long",
        "city_pop",
    )


def stg_merchants(merchants: DataFrame) -> DataFrame:
    return merchants.filter(F.col("merchant_name").isNotNull()).select(
        "merchant_id",
        "merchant_name",
        normalised_category(F.col("category")).alias("category"),
        "merch_lat",
        "merch_long",
    )
