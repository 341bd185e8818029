"""Pipeline health panels over the stored tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The labels of the status table.
COMPONENTS = {
    "transactions": ("OLTP transactions", "ingested_at"),
    "fraud_alerts": ("Fraud alerts", "detected_at"),
    "customers": ("Unique customers", "created_at"),
    "merchants": ("Unique merchants", "created_at"),
}


def alert_count(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("alerts"))


def source_rows(transactions: DataFrame, source: str) -> DataFrame:
    """Rows of one ingest path; ``source`` is a directory level of the stored table."""
    return transactions.filter(F.col("source") == source).agg(
        F.count("*").alias(f"{source}_rows")
    )


def all_source_rows(transactions: DataFrame) -> DataFrame:
    """Both counts from one scan."""
    return transactions.agg(
        *[F.count_if(F.col("source") == s).alias(f"{s}_rows") for s in ("batch", "stream")]
    )


def hourly(rows: DataFrame, at: str, name: str) -> DataFrame:
    return (
        rows.groupBy(F.date_trunc("hour", at).alias("time"))
        .agg(F.count("*").alias(name))
        .orderBy("time")
    )


def hourly_source_rows(transactions: DataFrame, source: str) -> DataFrame:
    return hourly(
        transactions.filter(F.col("source") == source), "ingested_at", f"{source}_rows"
    )


def hourly_alerts(alerts: DataFrame) -> DataFrame:
    return hourly(alerts, "detected_at", "alerts")


def alert_scores(alerts: DataFrame) -> DataFrame:
    """Scores in ascending order, the input of the distribution panel.

    There are few distinct scores; ordering by the id as well lets the sort split each of them.
    """
    known = alerts.filter(F.col("risk_score").isNotNull())
    return known.orderBy("risk_score", "trans_id").select("risk_score")


def score_histogram(alerts: DataFrame, buckets: int = 10) -> DataFrame:
    """Alerts per score interval of equal width; 1.0 falls into the last one.

    The scores are decimals, so interval edges are exact.
    """
    index = F.least(F.floor(F.col("risk_score") * buckets), F.lit(buckets - 1))
    return (
        alerts.filter(F.col("risk_score").isNotNull())
        .groupBy(index.cast("int").alias("bucket"))
        .agg(F.count("*").alias("alerts"))
        .orderBy("bucket")
    )


def status(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count and last change of each component."""
    parts = [
        tables[name].agg(F.count("*").alias("count"), F.max(at).alias("last_updated")).select(
            F.lit(label).alias("component"), "count", "last_updated"
        )
        for name, (label, at) in COMPONENTS.items()
    ]
    return reduce(DataFrame.unionByName, parts)
