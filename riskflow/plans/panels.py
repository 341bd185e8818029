"""Business panels. They read the marts (stored or lazy) and the alert table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions import percentage, threshold_band
from riskflow.functions.bands import (
    ALERT_SCORE_STEPS,
    CUSTOMER_RATE_STEPS,
    FRAUD_RATE_STEPS,
)


def _rate() -> Column:
    return percentage(F.sum("fraud_count"), F.sum("total_transactions")).alias("fraud_rate_pct")


def total_transactions(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("total_transactions").alias("total_transactions"))


def total_fraud(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("fraud_count").alias("fraud_count"))


def fraud_rate(summary: DataFrame) -> DataFrame:
    """Ratio of sums, not the mean of the group rates."""
    return summary.agg(_rate())


def average_fraud_amount(summary: DataFrame) -> DataFrame:
    """Mean of the group means, every group weighing the same."""
    groups = summary.filter(F.col("avg_fraud_amount").isNotNull())
    # Group means are summed as decimals: a double sum would depend on partition order.
    mean = F.sum(F.col("avg_fraud_amount").cast("decimal(28,10)")) / F.count("*")
    return groups.agg(F.round(mean, 2).cast("double").alias("avg_fraud_amount"))


def weighted_fraud_amount(summary: DataFrame) -> DataFrame:
    """Mean over fraudulent transactions, each group weighing its fraud count."""
    spent = F.col("avg_fraud_amount").cast("decimal(28,10)") * F.col("fraud_count")
    return summary.agg(
        F.round(F.try_divide(F.sum(spent), F.sum("fraud_count").cast("decimal(20,0)")), 2)
        .cast("double")
        .alias("weighted_fraud_amount")
    )


def stream_events(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("stream_count").alias("stream_count"))


def daily_rate(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy(F.col("txn_date").alias("time"))
        .agg(_rate())
        .orderBy("time")
    )


def daily_volume(summary: DataFrame) -> DataFrame:
    return (
        summary.groupBy(F.col("txn_date").alias("time"))
        .agg(F.sum("total_transactions").alias("total"), F.sum("fraud_count").alias("fraud"))
        .orderBy("time")
    )


def top_categories(summary: DataFrame, limit: int = 10) -> DataFrame:
    """Fraud counts per category, largest first; the NULL category is one of them."""
    return (
        summary.groupBy("merchant_category")
        .agg(F.sum("fraud_count").alias("fraud_count"))
        .orderBy(F.desc_nulls_first("fraud_count"), F.asc_nulls_last("merchant_category"))
        .limit(limit)
    )


def top_customers(profiles: DataFrame, limit: int = 10) -> DataFrame:
    return (
        profiles.orderBy(F.desc_nulls_first("fraud_rate_pct"), F.asc_nulls_last("customer_id"))
        .limit(limit)
        .select(
            "customer_name",
            "customer_state",
            "customer_job",
            "total_transactions",
            "total_fraud_count",
            "fraud_rate_pct",
            "risk_tier",
            "top_category",
        )
    )


def recent_alerts(alerts: DataFrame, limit: int = 50) -> DataFrame:
    return (
        alerts.orderBy(F.desc_nulls_first("detected_at"), "trans_id")
        .limit(limit)
        .select("detected_at", "trans_id", "risk_score", "distance_km", "alert_reason")
    )


def fraud_by_state(summary: DataFrame) -> DataFrame:
    return summary.groupBy("customer_state").agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("fraud_count").alias("fraud_count"),
        _rate(),
    )


def tier_distribution(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("risk_tier").agg(F.count("*").alias("customers"))


def rate_by_age_and_job(profiles: DataFrame) -> DataFrame:
    """Decade of age and job; customers without an age form their own group."""
    decade = (F.floor(F.col("customer_age") / 10) * 10).cast("int")
    return profiles.groupBy(decade.alias("age_group"), "customer_job").agg(
        F.sum("total_transactions").alias("total_transactions"),
        F.sum("total_fraud_count").alias("fraud_count"),
        percentage(F.sum("total_fraud_count"), F.sum("total_transactions")).alias(
            "fraud_rate_pct"
        ),
    )


def precision_recall(scored: DataFrame) -> DataFrame:
    """Confusion counts of the score rule against the label, with both rates.

    An event without a score is not flagged.
    """
    flagged = F.coalesce(F.col("risk_score") >= 0.7, F.lit(False))
    actual = F.col("is_fraud") == 1

    def count_if(condition, name):
        return F.count_if(condition).alias(name)

    counts = scored.agg(
        count_if(flagged & actual, "true_positive"),
        count_if(flagged & ~actual, "false_positive"),
        count_if(~flagged & actual, "false_negative"),
        count_if(~flagged & ~actual, "true_negative"),
    )
    hit, noise, miss = (
        F.col(name) for name in ("true_positive", "false_positive", "false_negative")
    )
    return counts.select(
        "*",
        F.try_divide(hit.cast("double"), hit + noise).alias("precision"),
        F.try_divide(hit.cast("double"), hit + miss).alias("recall"),
    )


def scored_from_stored(transactions: DataFrame, alerts: DataFrame) -> DataFrame:
    """Stored stream transactions with the score of their alert, for :func:`precision_recall`.

    Alerts carry no label and transactions no score; a transaction without an alert scored below
    the threshold.
    """
    stream = transactions.filter(F.col("source") == "stream").select("trans_id", "is_fraud")
    scores = alerts.select("trans_id", F.col("risk_score").cast("double").alias("_score"))
    joined = stream.join(scores, "trans_id", "left")
    return joined.withColumn("risk_score", F.coalesce("_score", F.lit(0.0))).drop("_score")


def daily_rate_bands(summary: DataFrame) -> DataFrame:
    rate = F.col("fraud_rate_pct")
    return daily_rate(summary).withColumn("band", threshold_band(rate, FRAUD_RATE_STEPS))


def customer_rate_bands(profiles: DataFrame) -> DataFrame:
    rate = F.col("fraud_rate_pct")
    return profiles.select(
        "customer_id",
        "fraud_rate_pct",
        threshold_band(rate, CUSTOMER_RATE_STEPS).alias("band"),
    )


def alert_score_bands(alerts: DataFrame) -> DataFrame:
    score = F.col("risk_score")
    return alerts.groupBy(threshold_band(score, ALERT_SCORE_STEPS).alias("band")).agg(
        F.count("*").alias("alerts")
    )
