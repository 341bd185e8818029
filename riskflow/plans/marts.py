"""The two aggregate marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions import average, percentage
from riskflow.operators.keys import lookup
from riskflow.plans.star import customer_context

# Exclusive lower bounds of the tiers, as a share of fraudulent transactions.
HIGH_TIER, MEDIUM_TIER = 0.05, 0.01


def risk_tier(fraud: Column, total: Column) -> Column:
    """Tier from the unrounded fraud share."""
    share = F.try_divide(fraud.cast("decimal(20,0)"), total.cast("decimal(20,0)"))
    return (
        F.when(share > F.lit(str(HIGH_TIER)).cast("decimal(4,2)"), "HIGH")
        .when(share > F.lit(str(MEDIUM_TIER)).cast("decimal(4,2)"), "MEDIUM")
        .otherwise("LOW")
    )


def mart_fraud_summary(stats: DataFrame) -> DataFrame:
    """Daily fraud measures by merchant category and customer state, NULL groups included.

    ``stats`` is the joined view; only the six columns used here survive pruning.
    """
    is_fraud = F.col("is_fraud") == 1
    totals = stats.groupBy(
        F.to_date("trans_at").alias("txn_date"), "merchant_category", "customer_state"
    ).agg(
        F.count("*").alias("total_transactions"),
        F.sum("amount").alias("total_amount"),
        F.count("amount").alias("_amounts"),
        F.sum("is_fraud").alias("fraud_count"),
        F.sum(F.when(is_fraud, F.col("amount"))).alias("_fraud_amount"),
        F.count(F.when(is_fraud, F.col("amount"))).alias("_fraud_amounts"),
        F.sum(F.when(F.col("source") == "stream", 1).otherwise(0)).alias("stream_count"),
        F.sum(F.when(F.col("source") == "batch", 1).otherwise(0)).alias("batch_count"),
    )
    return totals.select(
        "txn_date",
        "merchant_category",
        "customer_state",
        "total_transactions",
        "total_amount",
        average(F.col("total_amount"), F.col("_amounts")).alias("avg_amount"),
        "fraud_count",
        percentage(F.col("fraud_count"), F.col("total_transactions")).alias("fraud_rate_pct"),
        average(F.col("_fraud_amount"), F.col("_fraud_amounts")).alias("avg_fraud_amount"),
        "stream_count",
        "batch_count",
    )


def customer_state(
    transactions: DataFrame, merchants: DataFrame, resolved_only: bool = False
) -> DataFrame:
    """What the customer mart needs of its transactions, per (customer, category).

    Counts, exact sums and extremes, so that the states of two sets of transactions can be merged. The
    grouping combines on the map side: the one NULL customer of all stream rows stays small.
    """
    facts = transactions.select(
        "trans_id", "customer_id", "merchant_id", "amount", "is_fraud", "trans_at"
    )
    if resolved_only:
        facts = facts.filter(F.col("customer_id").isNotNull())
    categories = merchants.select("merchant_id", F.col("category").alias("_category"))
    return (
        lookup(facts, categories, "merchant_id", "trans_id")
        .groupBy("customer_id", "_category")
        .agg(
            F.count("*").alias("_rows"),
            F.sum("amount").alias("_spend"),
            F.count("amount").alias("_amounts"),
            F.max("amount").alias("_largest"),
            F.sum("is_fraud").alias("_fraud"),
            F.min("trans_at").alias("_first"),
            F.max("trans_at").alias("_last"),
        )
    )


def merged_states(states: DataFrame) -> DataFrame:
    """States of several sets of transactions, each transaction in one of them, as one state."""
    return states.groupBy("customer_id", "_category").agg(
        F.sum("_rows").alias("_rows"),
        F.sum("_spend").cast(states.schema["_spend"].dataType).alias("_spend"),
        F.sum("_amounts").alias("_amounts"),
        F.max("_largest").alias("_largest"),
        F.sum("_fraud").alias("_fraud"),
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )


def customer_profiles(state: DataFrame, customers: DataFrame) -> DataFrame:
    """The customer mart from a state with one row per (customer, category).

    All customer attributes depend on ``customer_id``, so grouping happens on the key alone and the
    attributes are joined to the finished groups. Ties in ``top_category`` go to the smaller name;
    NULL categories do not count.
    """
    # Negated count first: the smallest struct is the most frequent, then the smallest, category.
    rank = F.struct((-F.col("_rows")).alias("n"), F.col("_category").alias("name"))
    totals = state.groupBy("customer_id").agg(
        F.sum("_rows").alias("total_transactions"),
        F.sum("_spend").cast("decimal(22,2)").alias("total_spend"),
        F.sum("_amounts").alias("_amounts"),
        F.max("_largest").alias("max_transaction_amount"),
        F.sum("_fraud").alias("total_fraud_count"),
        F.min(F.when(F.col("_category").isNotNull(), rank)).alias("_top"),
        F.min("_first").alias("first_transaction_at"),
        F.max("_last").alias("last_transaction_at"),
    )
    fraud, total = F.col("total_fraud_count"), F.col("total_transactions")
    return totals.join(customer_context(customers), "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "customer_age",
        "customer_gender",
        "customer_job",
        "customer_state",
        "customer_city",
        "customer_city_pop",
        "total_transactions",
        "total_spend",
        average(F.col("total_spend"), F.col("_amounts")).alias("avg_transaction_amount"),
        "max_transaction_amount",
        "total_fraud_count",
        percentage(fraud, total).alias("fraud_rate_pct"),
        F.col("_top.name").alias("top_category"),
        "first_transaction_at",
        "last_transaction_at",
        risk_tier(fraud, total).alias("risk_tier"),
    )


def mart_customer_360(
    transactions: DataFrame,
    customers: DataFrame,
    merchants: DataFrame,
    resolved_only: bool = False,
) -> DataFrame:
    """Risk profile per customer from the staged tables; facts never meet customer attributes."""
    return customer_profiles(customer_state(transactions, merchants, resolved_only), customers)


def newest_first(summary: DataFrame) -> DataFrame:
    """Stored order of the daily mart; range-sorted files also let panels skip by date."""
    return summary.orderBy(
        F.desc_nulls_first("txn_date"), "merchant_category", "customer_state"
    )


def riskiest_first(profiles: DataFrame) -> DataFrame:
    """Stored order of the customer mart.

    Most customers share the rate 0; the key after it lets range partitioning split them.
    """
    return profiles.orderBy(F.desc_nulls_first("fraud_rate_pct"), "customer_id")
