"""The joined intermediate view and the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.functions import (
    date_key,
    day_of_week,
    is_weekend,
    padded_day_name,
    padded_month_name,
)
from riskflow.operators.keys import lookup

# The spine of the original calendar.
SPINE_START, SPINE_END = "2019-01-01", "2021-12-31"

CUSTOMER_CONTEXT = {
    "full_name": "customer_name",
    "age": "customer_age",
    "gender": "customer_gender",
    "job": "customer_job",
    "city": "customer_city",
    "state": "customer_state",
    "city_pop": "customer_city_pop",
    "lat": "customer_lat",
    "long": "customer_long",
}


def customer_context(customers: DataFrame) -> DataFrame:
    """The customer columns of the joined view, under their joined names."""
    renamed = [F.col(old).alias(new) for old, new in CUSTOMER_CONTEXT.items()]
    return customers.select("customer_id", *renamed)


def merchant_context(merchants: DataFrame) -> DataFrame:
    return merchants.select(
        "merchant_id",
        "merchant_name",
        F.col("category").alias("merchant_category"),
        "merch_lat",
        "merch_long",
    )


def int_transaction_stats(
    transactions: DataFrame, customers: DataFrame, merchants: DataFrame
) -> DataFrame:
    """Staged transactions with customer and merchant context; stream rows keep NULL context."""
    core = transactions.select(
        "trans_id",
        "trans_at",
        "hour_of_day",
        "day_of_week",
        "is_weekend",
        "amount",
        "is_fraud",
        "source",
        "ingested_at",
        "customer_id",
        "merchant_id",
    )
    joined = lookup(core, customer_context(customers), "customer_id", "trans_id")
    joined = lookup(joined, merchant_context(merchants), "merchant_id", "trans_id")
    return joined.select(
        *core.columns[:-1],
        *CUSTOMER_CONTEXT.values(),
        "merchant_id",
        "merchant_name",
        "merchant_category",
        "merch_lat",
        "merch_long",
    )


def date_spine(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day, both bounds included."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def data_spine(transactions: DataFrame) -> DataFrame:
    """The spine over the whole calendar years that occur in the data."""
    bounds = transactions.agg(
        F.year(F.min("trans_at")).alias("first"), F.year(F.max("trans_at")).alias("last")
    )
    days = F.sequence(
        F.make_date("first", F.lit(1), F.lit(1)), F.make_date("last", F.lit(12), F.lit(31))
    )
    return bounds.select(F.explode(days).alias("full_date"))


def dim_date(spine: DataFrame) -> DataFrame:
    day = F.col("full_date")
    return spine.select(
        date_key(day).alias("date_id"),
        "full_date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day"),
        day_of_week(day).alias("day_of_week"),
        padded_day_name(day).alias("day_name"),
        padded_month_name(day).alias("month_name"),
        F.quarter(day).alias("quarter"),
        is_weekend(day).alias("is_weekend"),
    )


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "cc_num",
        "full_name",
        "gender",
        "age",
        "job",
        "city",
        "state",
        "zip",
        "city_pop",
        "lat",
        "long",
    )


def dim_merchant(merchants: DataFrame) -> DataFrame:
    return merchants.select(
        "merchant_id", "merchant_name", "category", "merch_lat", "merch_long"
    )


def fact_transactions(base: DataFrame, start: str, end: str) -> DataFrame:
    """Facts keyed to the calendar; days outside the spine get a NULL ``date_id``.

    ``base`` needs only staged transaction columns: the customer and merchant joins neither add
    nor drop rows, so the fact table skips them. How the calendar is joined is left to the
    optimizer, which knows its size.
    """
    calendar = dim_date(date_spine(base.sparkSession, start, end)).select(
        "date_id", "full_date"
    )
    return base.join(calendar, F.to_date("trans_at") == F.col("full_date"), "left").select(
        "trans_id",
        "customer_id",
        "merchant_id",
        "date_id",
        "trans_at",
        "amount",
        "is_fraud",
        "source",
        "hour_of_day",
        "is_weekend",
        "ingested_at",
    )


def star_join(
    facts: DataFrame, customers: DataFrame, merchants: DataFrame, dates: DataFrame
) -> DataFrame:
    """Facts with the descriptive columns of all three dimensions."""
    joined = lookup(
        facts,
        customers.select(
            "customer_id", "full_name", "age", "job", F.col("state").alias("customer_state")
        ),
        "customer_id",
        "trans_id",
    )
    joined = lookup(
        joined,
        merchants.select(
            "merchant_id", "merchant_name", F.col("category").alias("merchant_category")
        ),
        "merchant_id",
        "trans_id",
    )
    return joined.join(
        dates.select("date_id", "full_date", "day_name", "month_name", "quarter"),
        "date_id",
        "left",
    )
