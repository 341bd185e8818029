"""Decode, validate and enrich events. The same functions serve batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions import (
    alert_reason,
    haversine_km,
    hour_of_day,
    is_alert,
    parse_event_time,
    risk_score,
    row_as_json,
)
from riskflow.schemas import RAW_EVENT

CORRUPT = "_corrupt_record"
_DECODED = T.StructType([*RAW_EVENT.fields, T.StructField(CORRUPT, T.StringType(), True)])
AMOUNT_LIMIT = 1e10  # numeric(12,2) holds less than this


def decode(messages: DataFrame) -> DataFrame:
    """JSON ``value`` to payload columns; undecodable text is kept in ``_corrupt_record``."""
    text = F.col("value").cast("string")
    parsed = F.from_json(text, _DECODED, {"columnNameOfCorruptRecord": CORRUPT})
    return messages.select(parsed.alias("d")).select("d.*")


def rejection() -> Column:
    """Why an event cannot be scored and stored, or NULL."""
    missing_place, endless_place = F.lit(False), F.lit(False)
    for name in ("lat", "long", "merch_lat", "merch_long"):
        missing_place = missing_place | F.col(name).isNull()
        endless_place = endless_place | F.isnan(name) | (F.abs(name) == float("inf"))
    return (
        F.when(F.col(CORRUPT).isNotNull(), "malformed json")
        .when(F.col("trans_num").isNull(), "trans_num is null")
        .when(F.col("trans_at").isNull(), "trans_at is null")
        .when(F.col("amt").isNull() | F.isnan("amt"), "amount is null")
        .when(F.round(F.abs("amt"), 2) >= AMOUNT_LIMIT, "amount out of range")
        .when(missing_place, "coordinates are null")
        .when(endless_place, "coordinates are not finite")
        .when(F.col("is_fraud").isNull(), "is_fraud is null")
        .when(~F.col("is_fraud").isin(0, 1), "is_fraud not in (0, 1)")
        .otherwise(F.lit(None).cast("string"))
    )


def with_event_time(events: DataFrame) -> DataFrame:
    return events.withColumn(
        "trans_at", parse_event_time(F.col("trans_date_trans_time"))
    )


def judge(events: DataFrame) -> DataFrame:
    """Events with ``trans_at`` and a ``_dlq_reason`` that is NULL for good ones."""
    if CORRUPT not in events.columns:
        events = events.withColumn(CORRUPT, F.lit(None).cast("string"))
    return with_event_time(events).withColumn("_dlq_reason", rejection())


def _bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters read as a value.

    A filter on an ordinary projected column is rewritten in terms of its expression and moved
    down, where no common subexpressions are shared: a filter on the score would compute the
    distance many times per row. Generated columns are not rewritten.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def score(events: DataFrame, distance_type: str = "double") -> DataFrame:
    """Add ``distance_km`` and ``risk_score``; ``distance_type="float"`` narrows the distance."""
    distance = haversine_km(
        F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long")
    )
    amount = F.col("amt").cast("double")
    located = events.withColumn("distance_km", distance.cast(distance_type))
    return _bound(
        located, "risk_score", risk_score(amount, F.col("distance_km"), F.col("category"))
    )


def with_reason(scored: DataFrame) -> DataFrame:
    amount = F.col("amt").cast("double")
    return scored.withColumn(
        "alert_reason", alert_reason(amount, F.col("distance_km"), F.col("category"))
    )


def enrich(events: DataFrame) -> DataFrame:
    """Events with a transaction number, plus the five derived columns."""
    scored = score(with_event_time(events.filter(F.col("trans_num").isNotNull())))
    return with_reason(scored).withColumn("hour_of_day", hour_of_day(F.col("trans_at")))


def alerts_of(scored: DataFrame, score_type: str = "double") -> DataFrame:
    """Alerting events with their reason; the text is only built for rows that alert."""
    return with_reason(
        scored.filter(is_alert(F.col("is_fraud"), F.col("risk_score"), score_type))
    )


def staging_rows(events: DataFrame) -> DataFrame:
    """The full payload under table names."""
    return events.select(
        F.col("trans_num").alias("trans_id"),
        "cc_num",
        F.col("merchant").alias("merchant_name"),
        "category",
        "trans_at",
        "unix_time",
        F.col("amt").alias("amount"),
        "is_fraud",
        "lat",
        "long",
        "merch_lat",
        "merch_long",
        "city_pop",
        "first",
        "last",
        "gender",
        "dob",
        "job",
        "street",
        "city",
        "state",
        "zip",
        F.lit("stream").alias("source"),
    )


def transaction_columns(ingested_at: Column) -> dict[str, Column]:
    """The lean fact row; stream rows carry no resolved keys."""
    no_key = F.lit(None)
    return {
        "trans_id": F.col("trans_num"),
        "customer_id": no_key.cast("bigint"),
        "merchant_id": no_key.cast("string"),
        "trans_at": F.col("trans_at"),
        "unix_time": F.col("unix_time"),
        "amount": F.col("amt"),
        "is_fraud": F.col("is_fraud"),
        "source": F.lit("stream"),
        "ingested_at": ingested_at,
    }


def alert_columns(detected_at: Column) -> dict[str, Column]:
    return {
        "alert_id": F.md5(F.col("trans_num").cast("binary")),
        "trans_id": F.col("trans_num"),
        "detected_at": detected_at,
        "risk_score": F.col("risk_score"),
        "distance_km": F.col("distance_km"),
        "alert_reason": F.col("alert_reason"),
    }


def transaction_rows(events: DataFrame, ingested_at: Column) -> DataFrame:
    return events.select(*[c.alias(n) for n, c in transaction_columns(ingested_at).items()])


def alert_rows(alerts: DataFrame, detected_at: Column) -> DataFrame:
    return alerts.select(*[c.alias(n) for n, c in alert_columns(detected_at).items()])


def as_messages(events: DataFrame) -> DataFrame:
    """Events as (key, value) messages, keyed by transaction number."""
    return events.select(
        F.col("trans_num").alias("key"), row_as_json(*events.columns).alias("value")
    )
