"""Declared schemas of the event payload and of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# The fields of the event payload and the columns of the stored tables.
RAW_EVENT = _struct(
    trans_num=T.StringType(),
    trans_date_trans_time=T.StringType(),
    unix_time=T.LongType(),
    amt=T.DoubleType(),
    cc_num=T.LongType(),
    merchant=T.StringType(),
    category=T.StringType(),
    merch_lat=T.DoubleType(),
    merch_long=T.DoubleType(),
    lat=T.DoubleType(),
    long=T.DoubleType(),
    city_pop=T.IntegerType(),
    is_fraud=T.IntegerType(),
    first=T.StringType(),
    last=T.StringType(),
    gender=T.StringType(),
    dob=T.StringType(),
    job=T.StringType(),
    street=T.StringType(),
    city=T.StringType(),
    state=T.StringType(),
    zip=T.StringType(),
    produced_at=T.StringType(),
)

CUSTOMERS = _struct(
    customer_id=T.LongType(),
    cc_num=T.LongType(),
    first_name=T.StringType(),
    last_name=T.StringType(),
    gender=T.StringType(),
    dob=T.DateType(),
    job=T.StringType(),
    street=T.StringType(),
    city=T.StringType(),
    state=T.StringType(),
    zip=T.StringType(),
    lat=T.DoubleType(),
    long=T.DoubleType(),
    city_pop=T.IntegerType(),
    created_at=T.TimestampType(),
)

MERCHANTS = _struct(
    merchant_id=T.StringType(),
    merchant_name=T.StringType(),
    category=T.StringType(),
    merch_lat=T.DoubleType(),
    merch_long=T.DoubleType(),
    created_at=T.TimestampType(),
)

TRANSACTIONS = _struct(
    trans_id=T.StringType(),
    customer_id=T.LongType(),
    merchant_id=T.StringType(),
    trans_at=T.TimestampType(),
    unix_time=T.LongType(),
    amount=T.DecimalType(12, 2),
    is_fraud=T.IntegerType(),
    source=T.StringType(),
    ingested_at=T.TimestampType(),
)

FRAUD_ALERTS = _struct(
    alert_id=T.StringType(),
    trans_id=T.StringType(),
    detected_at=T.TimestampType(),
    risk_score=T.DecimalType(5, 4),
    distance_km=T.DecimalType(10, 2),
    alert_reason=T.StringType(),
)

STREAM_STAGING = _struct(
    trans_id=T.StringType(),
    cc_num=T.LongType(),
    merchant_name=T.StringType(),
    category=T.StringType(),
    trans_at=T.TimestampType(),
    unix_time=T.LongType(),
    amount=T.DoubleType(),
    is_fraud=T.IntegerType(),
    lat=T.DoubleType(),
    long=T.DoubleType(),
    merch_lat=T.DoubleType(),
    merch_long=T.DoubleType(),
    city_pop=T.IntegerType(),
    first=T.StringType(),
    last=T.StringType(),
    gender=T.StringType(),
    dob=T.StringType(),
    job=T.StringType(),
    street=T.StringType(),
    city=T.StringType(),
    state=T.StringType(),
    zip=T.StringType(),
    source=T.StringType(),
)

DEAD_LETTERS = _struct(
    key=T.StringType(),
    value=T.StringType(),
    _dlq_reason=T.StringType(),
    _dlq_at=T.StringType(),
)

TABLES = {
    "customers": CUSTOMERS,
    "merchants": MERCHANTS,
    "transactions": TRANSACTIONS,
    "fraud_alerts": FRAUD_ALERTS,
    "stream_staging": STREAM_STAGING,
    "dead_letters": DEAD_LETTERS,
}
