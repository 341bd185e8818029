"""Every registered query: name -> function of (session, test-data folder)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.functions import amount_band, category_band, distance_band, is_alert, sql
from riskflow.operators import quality, rates
from riskflow.operators.dedup import first_wins, insert_if_absent
from riskflow.operators.keys import orphans, resolve_keys, unresolved_keys
from riskflow.plans import health, jobs, marts, panels, staging, star
from riskflow.plans.bucketed import BucketedStar
from riskflow.plans.incremental import DailyWarehouse
from riskflow.session import configure, land, remove_dir, shuffles_removed, work_dir
from riskflow.sources import cards, files
from riskflow.sources.events import ALERT_TOPIC, DEAD_LETTER_TOPIC, ENRICHED_TOPIC, json_topics
from riskflow.sources.tables import TableStore
from riskflow.streaming import dead_letters, events, job, progress
from riskflow.streaming.writer import MicroBatchWriter

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
FILES_OF_DELIVERY = 4


def query(function: Query) -> Query:
    """Register a function under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return function


def _as_of() -> Column:
    return F.lit(cards.AS_OF).cast("date")


# Tables and models seen through the card view


def _transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cards.transactions(spark, sf_dir)


def _staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        staging.stg_transactions(_transactions(spark, sf_dir)),
        staging.stg_customers(cards.customers(spark, sf_dir), _as_of()),
        staging.stg_merchants(cards.merchants(spark, sf_dir)),
    )


def _scored(spark: SparkSession, sf_dir: str, distance_type: str = "double") -> DataFrame:
    return events.score(cards.unique_events(spark, sf_dir), distance_type)


def _alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored alert table: alerts exist for stream events only."""
    scored = events.score(
        cards.unique_events(spark, sf_dir).filter(F.col("source") == "stream")
    )
    rows = events.alert_rows(events.alerts_of(scored), F.col("ingested_at"))
    return rows.withColumns(
        {
            "risk_score": F.col("risk_score").cast("decimal(5,4)"),
            "distance_km": F.col("distance_km").cast("decimal(10,2)"),
        }
    )


# Scoring


@query
def txn_enriched(spark, sf_dir):
    enriched = events.enrich(cards.raw_fields(cards.unique_events(spark, sf_dir)))
    return enriched.select(
        "trans_num",
        "trans_at",
        "hour_of_day",
        "amt",
        "distance_km",
        "risk_score",
        "alert_reason",
    )


@query
def txn_enriched_sql(spark, sf_dir):
    """The enriched events by a SQL statement that calls the registered functions."""
    sql.register(spark)
    view = f"card_events_{uuid.uuid4().hex}"
    cards.unique_events(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(
        f"""SELECT trans_num, trans_at, hour(trans_at) AS hour_of_day, CAST(amt AS DOUBLE) AS amt, distance_km,
              risk_score(amt, distance_km, category) AS risk_score,
              alert_reason(amt, distance_km, category) AS alert_reason
            FROM (SELECT *, haversine_km(lat, long, merch_lat, merch_long) AS distance_km FROM {view})"""
    )


@query
def txn_risk_score(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return scored.select(
        "trans_num",
        amount_band(F.col("amt").cast("double")).alias("amount_band"),
        distance_band(F.col("distance_km")).alias("distance_band"),
        category_band(F.col("category")).alias("category_band"),
        "risk_score",
    )


@query
def txn_alerts(spark, sf_dir):
    alerts = events.alerts_of(_scored(spark, sf_dir))
    return alerts.select("trans_num", "is_fraud", "risk_score", "distance_km", "alert_reason")


@query
def txn_alerts_float32(spark, sf_dir):
    alerts = events.alerts_of(_scored(spark, sf_dir, "float"), "float")
    return alerts.select("trans_num", "is_fraud", "risk_score")


@query
def score_band_matrix(spark, sf_dir):
    scored = _scored(spark, sf_dir)
    return scored.groupBy(
        amount_band(F.col("amt").cast("double")).alias("amount_band"),
        distance_band(F.col("distance_km")).alias("distance_band"),
        category_band(F.col("category")).alias("category_band"),
    ).agg(
        F.min("risk_score").alias("min_score"),
        F.max("risk_score").alias("max_score"),
        F.count("*").alias("transactions"),
        F.count_if(is_alert(F.col("is_fraud"), F.col("risk_score"))).alias("alerts"),
    )


@query
def alert_reason_text(spark, sf_dir):
    reasons = events.with_reason(_scored(spark, sf_dir))
    return reasons.groupBy("alert_reason").agg(F.count("*").alias("transactions"))


# Messages


@query
def raw_json_roundtrip(spark, sf_dir):
    payload = cards.raw_fields(cards.unique_events(spark, sf_dir))
    return events.decode(files.to_messages(payload)).drop(events.CORRUPT)


def _damaged_messages(unique: DataFrame) -> DataFrame:
    """Messages of which some are cut, lack fields, or carry bad values, by hour of day."""
    hour = F.hour("trans_at")
    spoiled = unique.withColumns(
        {
            "trans_num": F.when(hour != 7, F.col("trans_num")),
            "trans_date_trans_time": F.when(hour == 8, "2001-13-45 99:00:00").otherwise(
                F.col("trans_date_trans_time")
            ),
            "amt": F.when(hour != 9, F.col("amt")),
            "merch_lat": F.when(hour != 10, F.col("merch_lat")),
            "is_fraud": F.when(hour == 11, 2).otherwise(F.col("is_fraud")),
        }
    )
    messages = files.to_messages(cards.raw_fields(spoiled))
    value = F.col("value")
    hasty = F.get_json_object("value", "$.trans_date_trans_time").like("% 12:%")
    half = F.left(value, (F.length(value) / 2).cast("int"))
    return messages.select("key", F.when(hasty, half).otherwise(value).alias("value"))


@query
def json_parse_rejects(spark, sf_dir):
    messages = _damaged_messages(cards.unique_events(spark, sf_dir))
    judged = events.judge(events.decode(messages))
    return judged.groupBy(F.coalesce("_dlq_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("events")
    )


# Deduplication and keys


EVENT_ORDER = ["unix_time", "trans_num", "produced_at", "amt", "merchant"]


@query
def txn_first_wins(spark, sf_dir):
    return cards.unique_events(spark, sf_dir).select(
        "trans_num", "trans_at", "unix_time", "amt", "is_fraud", "merchant", "source"
    )


@query
def customers_first_wins(spark, sf_dir):
    columns = ["cc_num", "first", "last", "gender", "dob", "state", "city_pop", *EVENT_ORDER]
    rows = cards.card_events(spark, sf_dir).select(*columns)
    return first_wins(rows, ["cc_num"], EVENT_ORDER)


@query
def merchants_first_wins(spark, sf_dir):
    order = [name for name in EVENT_ORDER if name != "merchant"]
    columns = ["merchant", "category", "merch_lat", "merch_long", *order]
    return first_wins(cards.card_events(spark, sf_dir).select(*columns), ["merchant"], order)


def _known_from_batch(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers and merchants that the batch path has seen."""
    batch = cards.card_events(spark, sf_dir).filter(F.col("source") == "batch")
    return (
        batch.select("cc_num", F.col("cc_num").alias("customer_id")).distinct(),
        batch.select(
            F.col("merchant").alias("merchant_name"), F.col("merchant_id")
        ).distinct(),
    )


def _keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    unique = cards.unique_events(spark, sf_dir)
    return unique.select("trans_num", "trans_at", "amt", "cc_num", "merchant", "source")


@query
def txn_key_resolved(spark, sf_dir):
    return resolve_keys(_keyless(spark, sf_dir), *_known_from_batch(spark, sf_dir)).select(
        "trans_num", "trans_at", "amt", "source", "customer_id", "merchant_id"
    )


@query
def txn_unresolved(spark, sf_dir):
    return unresolved_keys(_keyless(spark, sf_dir), *_known_from_batch(spark, sf_dir)).select(
        "trans_num", "cc_num", "merchant", "customer_missing", "merchant_missing"
    )


@query
def txn_insert_if_absent(spark, sf_dir):
    """A second load that repeats everything shipped before 1999 and brings the rest."""
    new = cards.card_events(spark, sf_dir).select(
        "trans_num", "unix_time", "produced_at", "amt", "merchant", "ingested_at"
    )
    stored = new.filter(F.col("ingested_at") < F.lit("1999-01-01").cast("timestamp"))
    order = ["unix_time", "produced_at", "amt", "merchant"]
    return insert_if_absent(new, stored, ["trans_num"], order)


# Warehouse models


@query
def stg_transactions(spark, sf_dir):
    return _staged(spark, sf_dir)[0]


@query
def stg_customers(spark, sf_dir):
    return _staged(spark, sf_dir)[1]


@query
def stg_merchants(spark, sf_dir):
    return _staged(spark, sf_dir)[2]


@query
def int_transaction_stats(spark, sf_dir):
    return star.int_transaction_stats(*_staged(spark, sf_dir))


@query
def int_transaction_stats_bucketed(spark, sf_dir):
    """The joined view over facts and customers that are stored alike."""
    txns, customers, merchants = _staged(spark, sf_dir)
    tables = BucketedStar(spark, work_dir(spark, "bucketed"), f"star_{uuid.uuid4().hex}", buckets=8)
    tables.store(txns, customers)
    joined = tables.joined(merchants)
    tables.forget()
    return joined.select(*star.int_transaction_stats(txns, customers, merchants).columns)


@query
def dim_customer(spark, sf_dir):
    return star.dim_customer(_staged(spark, sf_dir)[1])


@query
def dim_merchant(spark, sf_dir):
    return star.dim_merchant(_staged(spark, sf_dir)[2])


@query
def dim_date(spark, sf_dir):
    """The calendar of the years in which orders were placed."""
    orders = cards.table(spark, sf_dir, "orders")
    return star.dim_date(star.data_spine(orders.select(F.col("o_orderdate").alias("trans_at"))))


@query
def fact_transactions(spark, sf_dir):
    return star.fact_transactions(_staged(spark, sf_dir)[0], *cards.DATE_RANGE)


@query
def star_join(spark, sf_dir):
    txns, customers, merchants = _staged(spark, sf_dir)
    facts = star.fact_transactions(txns, *cards.DATE_RANGE)
    dates = star.dim_date(star.date_spine(spark, *cards.DATE_RANGE))
    return star.star_join(
        facts, star.dim_customer(customers), star.dim_merchant(merchants), dates
    )


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.mart_fraud_summary(star.int_transaction_stats(*_staged(spark, sf_dir)))


def _profiles(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return marts.mart_customer_360(*_staged(spark, sf_dir), **options)


@query
def mart_fraud_summary(spark, sf_dir):
    return marts.newest_first(_summary(spark, sf_dir))


@query
def mart_customer_360(spark, sf_dir):
    return marts.riskiest_first(_profiles(spark, sf_dir))


@query
def mart_customer_360_resolved(spark, sf_dir):
    return _profiles(spark, sf_dir, resolved_only=True)


# Business panels


@query
def panel_total_txn(spark, sf_dir):
    return panels.total_transactions(_summary(spark, sf_dir))


@query
def panel_total_fraud(spark, sf_dir):
    return panels.total_fraud(_summary(spark, sf_dir))


@query
def panel_fraud_rate(spark, sf_dir):
    return panels.fraud_rate(_summary(spark, sf_dir))


@query
def panel_avg_fraud_amount(spark, sf_dir):
    return panels.average_fraud_amount(_summary(spark, sf_dir))


@query
def panel_avg_fraud_amount_weighted(spark, sf_dir):
    return panels.weighted_fraud_amount(_summary(spark, sf_dir))


@query
def panel_stream_events(spark, sf_dir):
    return panels.stream_events(_summary(spark, sf_dir))


@query
def panel_daily_rate(spark, sf_dir):
    return panels.daily_rate(_summary(spark, sf_dir))


@query
def panel_daily_volume(spark, sf_dir):
    return panels.daily_volume(_summary(spark, sf_dir))


@query
def panel_top_categories(spark, sf_dir):
    return panels.top_categories(_summary(spark, sf_dir))


@query
def panel_top_customers(spark, sf_dir):
    return panels.top_customers(_profiles(spark, sf_dir))


@query
def panel_recent_alerts(spark, sf_dir):
    return panels.recent_alerts(_alerts(spark, sf_dir))


@query
def doc_precision_recall(spark, sf_dir):
    return panels.precision_recall(_scored(spark, sf_dir))


@query
def doc_precision_recall_stored(spark, sf_dir):
    stored = _transactions(spark, sf_dir), _alerts(spark, sf_dir)
    return panels.precision_recall(panels.scored_from_stored(*stored))


@query
def doc_fraud_by_state(spark, sf_dir):
    return panels.fraud_by_state(_summary(spark, sf_dir))


@query
def doc_tier_distribution(spark, sf_dir):
    return panels.tier_distribution(_profiles(spark, sf_dir))


@query
def doc_rate_by_age_job(spark, sf_dir):
    return panels.rate_by_age_and_job(_profiles(spark, sf_dir))


@query
def status_bands(spark, sf_dir):
    """How many days, customers and alerts fall into each coloured band."""

    def counted(kind: str, rows: DataFrame, count: Column) -> DataFrame:
        return rows.groupBy("band").agg(count.alias("n")).select(
            F.lit(kind).alias("kind"), "band", "n"
        )

    parts = (
        counted("day", panels.daily_rate_bands(_summary(spark, sf_dir)), F.count("*")),
        counted("customer", panels.customer_rate_bands(_profiles(spark, sf_dir)), F.count("*")),
        counted("alert", panels.alert_score_bands(_alerts(spark, sf_dir)), F.sum("alerts")),
    )
    return reduce(DataFrame.unionByName, parts)


# Health panels


@query
def health_alert_count(spark, sf_dir):
    return health.alert_count(_alerts(spark, sf_dir))


@query
def health_batch_rows(spark, sf_dir):
    return health.source_rows(_transactions(spark, sf_dir), "batch")


@query
def health_stream_rows(spark, sf_dir):
    return health.source_rows(_transactions(spark, sf_dir), "stream")


@query
def health_source_rows(spark, sf_dir):
    return health.all_source_rows(_transactions(spark, sf_dir))


@query
def health_hourly_batch(spark, sf_dir):
    return health.hourly_source_rows(_transactions(spark, sf_dir), "batch")


@query
def health_hourly_stream(spark, sf_dir):
    return health.hourly_source_rows(_transactions(spark, sf_dir), "stream")


@query
def health_hourly_alerts(spark, sf_dir):
    return health.hourly_alerts(_alerts(spark, sf_dir))


@query
def health_alert_scores(spark, sf_dir):
    return health.alert_scores(_alerts(spark, sf_dir))


@query
def health_score_histogram(spark, sf_dir):
    return health.score_histogram(_alerts(spark, sf_dir))


@query
def health_status(spark, sf_dir):
    return health.status(
        {
            "transactions": _transactions(spark, sf_dir),
            "fraud_alerts": _alerts(spark, sf_dir),
            "customers": cards.customers(spark, sf_dir),
            "merchants": cards.merchants(spark, sf_dir),
        }
    )


@query
def batch_and_stream_union(spark, sf_dir):
    """Both ingest paths in one relation; the stream side brings no key columns."""
    txns = _transactions(spark, sf_dir)
    batch = txns.filter(F.col("source") == "batch")
    stream = txns.filter(F.col("source") == "stream").drop("customer_id", "merchant_id")
    both = batch.unionByName(stream, allowMissingColumns=True)
    return both.groupBy("source").agg(
        F.count("*").alias("rows"),
        F.count("customer_id").alias("with_customer"),
        F.sum("amount").alias("amount"),
    )


# Data quality


def _models(transactions: DataFrame, spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    txns = staging.stg_transactions(transactions)
    _, customers, merchants = _staged(spark, sf_dir)
    stats = star.int_transaction_stats(txns, customers, merchants)
    return {
        "stg_transactions": txns,
        "stg_customers": customers,
        "stg_merchants": merchants,
        "int_transaction_stats": stats,
        "fact_transactions": star.fact_transactions(txns, *cards.DATE_RANGE),
        "dim_customer": star.dim_customer(customers),
        "dim_merchant": star.dim_merchant(merchants),
        "dim_date": star.dim_date(star.date_spine(spark, *cards.DATE_RANGE)),
        "mart_fraud_summary": marts.mart_fraud_summary(stats),
        "mart_customer_360": marts.mart_customer_360(txns, customers, merchants),
    }


@query
def dq_report(spark, sf_dir):
    store = TableStore(spark, work_dir(spark, "models"))
    facts = store.overwrite("transactions", _transactions(spark, sf_dir))
    models = _models(facts, spark, sf_dir)
    joined = store.overwrite("int_transaction_stats", models["int_transaction_stats"])
    models |= {"int_transaction_stats": joined, "mart_fraud_summary": marts.mart_fraud_summary(joined)}
    return quality.run_checks(models, quality.ALL_CHECKS)


@query
def dq_report_unclean(spark, sf_dir):
    """Staging checks over rows that skipped deduplication and whose amounts are not scaled."""
    rows = cards.transactions(spark, sf_dir, cards.table(spark, sf_dir, "lineitem"))
    unscaled = rows.withColumn("amount", F.col("amount") * 100)
    models = {
        "stg_transactions": staging.stg_transactions(unscaled),
        "stg_customers": _staged(spark, sf_dir)[1],
        "stg_merchants": _staged(spark, sf_dir)[2],
    }
    return quality.run_checks(models, quality.STAGING_CHECKS)


@query
def dq_orphans(spark, sf_dir):
    """Transactions of customers without a positive balance, and alerts without a transaction."""
    solvent = cards.table(spark, sf_dir, "customer").filter("c_acctbal > 0")
    txns = _transactions(spark, sf_dir)
    customer_orphans = orphans(txns, solvent, "customer_id", "c_custkey")
    merchant_orphans = orphans(txns, cards.merchants(spark, sf_dir), "merchant_id")
    alert_orphans = orphans(
        _alerts(spark, sf_dir), txns.filter("amount <= 1000"), "trans_id"
    )
    parts = [
        rows.select(F.lit(name).alias("constraint_name"), "trans_id")
        for name, rows in (
            ("transactions.customer_id", customer_orphans),
            ("transactions.merchant_id", merchant_orphans),
            ("fraud_alerts.trans_id", alert_orphans),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def dq_constraint_rejects(spark, sf_dir):
    """Rows with foreign labels and lineage tags against the table constraints."""
    lines = cards.table(spark, sf_dir, "lineitem")
    rows = lines.join(
        cards.table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey")
    ).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trans_id"),
        F.when(F.expr("l_shipdate >= o_orderdate"), F.col("l_shipdate")).alias("trans_at"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"),
        F.expr("case l_returnflag when 'R' then 1 when 'N' then 0 else 2 end").alias("is_fraud"),
        F.expr("case o_orderstatus when 'O' then 'stream' when 'F' then 'batch' else 'open' end")
        .alias("source"),
    )
    valid, rejected = quality.split_by_violation(rows, quality.transaction_violation())
    outcomes = valid.select(F.lit("accepted").alias("outcome")).unionByName(
        rejected.select(F.col("_dlq_reason").alias("outcome"))
    )
    return outcomes.groupBy("outcome").agg(F.count("*").alias("rows"))


# Monitoring


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the retained messages of two topics with three partitions each.

    Offsets count within a partition; both topics share the numbering, so theirs have gaps.
    """
    return cards.table(spark, sf_dir, "events").select(
        F.expr(
            "if(event_type = 'error', 'dlq_transactions', 'raw_transactions')"
        ).alias("topic"),
        F.expr("int(event_id % 3)").alias("partition"),
        F.expr("event_id div 3").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("props").alias("value"),
    )


@query
def event_rate_15s(spark, sf_dir):
    return rates.windowed_rate(_log(spark, sf_dir), "timestamp")


@query
def event_rate_lag(spark, sf_dir):
    return rates.sampled_rate(rates.offset_samples(_log(spark, sf_dir)))


@query
def topic_offsets(spark, sf_dir):
    return rates.offset_ranges(_log(spark, sf_dir))


@query
def dlq_depth(spark, sf_dir):
    depth = rates.topic_depth(rates.offset_ranges(_log(spark, sf_dir)))
    return depth.filter(F.col("topic") == "dlq_transactions")


@query
def dlq_action(spark, sf_dir):
    return dead_letters.depth_status(
        rates.topic_depth(rates.offset_ranges(_log(spark, sf_dir)))
    )


@query
def dlq_peek(spark, sf_dir):
    letters = _log(spark, sf_dir).filter(F.col("topic") == "dlq_transactions")
    return dead_letters.peek(letters, "offset").select("partition", "offset", "value")


# Streaming: file streams drained to the end


def _stream_payload(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Payload of the stream-path events among lines of ``lineitem``."""
    return cards.raw_fields(
        cards.card_events(spark, sf_dir, lines).filter(F.col("source") == "stream")
    )


def _stream_messages(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    return files.to_messages(_stream_payload(spark, sf_dir, lines))


def _damaged_lines(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    return _damaged_messages(cards.card_events(spark, sf_dir, lines))


def _run_stream(
    spark: SparkSession, sf_dir: str, messages: Callable[[SparkSession, str, DataFrame], DataFrame], **options
) -> TableStore:
    """Drain ``lineitem``, read as a stream, into new tables; each epoch makes the messages of its lines."""
    store = TableStore(spark, work_dir(spark, "tables"))
    lines = cards.table_stream(spark, sf_dir, "lineitem")

    def prepare(epoch: DataFrame) -> DataFrame:
        return messages(epoch.sparkSession, sf_dir, epoch)

    checkpoint = work_dir(spark, "checkpoint")
    job.drain(job.start_stream(lines, store, checkpoint, once=True, prepare=prepare, **options))
    return store


@query
def stream_alerts(spark, sf_dir):
    alerts = _run_stream(spark, sf_dir, _stream_messages).read("fraud_alerts")
    return alerts.select("trans_id", "risk_score", "distance_km", "alert_reason")


@query
def stream_transactions(spark, sf_dir):
    stored = _run_stream(spark, sf_dir, _stream_messages).read("transactions")
    return stored.select("trans_id", "trans_at", "unix_time", "amount", "is_fraud", "source")


@query
def stream_staging(spark, sf_dir):
    return _run_stream(spark, sf_dir, _stream_messages).read("stream_staging")


@query
def stream_replay(spark, sf_dir):
    """The same epoch written twice, then its events again under a later epoch."""
    batch = cards.raw_fields(
        cards.card_events(spark, sf_dir).filter(F.col("source") == "stream")
    )
    store = TableStore(spark, work_dir(spark, "tables"))
    writer = MicroBatchWriter(store, "replayed")
    for epoch in (0, 0, 1):
        writer(batch, epoch)
    counts = [
        store.read(name, with_batch_id=True)
        .groupBy("batch_id")
        .agg(F.count("*").alias("rows"))
        .select(F.lit(name).alias("table_name"), "batch_id", "rows")
        for name in ("stream_staging", "transactions", "fraud_alerts")
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def stream_dlq(spark, sf_dir):
    """Dead letters of a stream in which some messages are damaged."""
    letters = _run_stream(spark, sf_dir, _damaged_lines).read("dead_letters")
    return letters.groupBy(F.col("_dlq_reason").alias("reason")).agg(
        F.count("*").alias("letters"),
        F.count_if(
            F.get_json_object("value", "$._dlq_reason") == F.col("_dlq_reason")
        ).alias("with_reason_in_value"),
    )


@query
def stream_dedup(spark, sf_dir):
    """Transaction numbers, each stored when it is first seen."""
    lines = cards.table_stream(spark, sf_dir, "lineitem")
    numbers = _stream_payload(spark, sf_dir, lines).select("trans_num")
    store, checkpoint = TableStore(spark, work_dir(spark, "dedup")), work_dir(spark, "checkpoint")
    job.drain(job.first_seen_to(numbers, "trans_num", store, "numbers", checkpoint, once=True))
    return spark.read.schema("trans_num string").parquet(store.path("numbers")).select("trans_num")


@query
def stream_event_rate(spark, sf_dir):
    """All windows of the event stream, late events included."""
    stream = cards.table_stream(spark, sf_dir, "events")
    out, checkpoint = work_dir(spark, "rate"), work_dir(spark, "checkpoint")
    job.drain(job.rate_to(stream, "ts", out, checkpoint, once=True))
    return job.recorded_rate(spark, out)


@query
def stream_event_rate_state(spark, sf_dir):
    """All windows of the event stream, counted in streaming state."""
    stream = cards.table_stream(spark, sf_dir, "events")
    out, checkpoint = work_dir(spark, "rate"), work_dir(spark, "checkpoint")
    job.drain(job.rate_state_to(stream, "ts", out, checkpoint, once=True))
    return job.current_rate(spark, out)


@query
def stream_compacted(spark, sf_dir):
    """Three epochs of the stream path, merged; rows per batch, and what their events store once more."""
    batch = cards.raw_fields(
        cards.card_events(spark, sf_dir).filter(F.col("source") == "stream")
    )
    store = TableStore(spark, work_dir(spark, "tables"))
    writer = MicroBatchWriter(store, "closed")
    for epoch in range(3):
        writer(batch.filter(F.pmod("cc_num", F.lit(3)) == epoch), epoch)
    store.close_epochs("closed", 2)
    counts = []
    for name in ("stream_staging", "transactions", "fraud_alerts"):
        rows = store.read(name, with_batch_id=True).groupBy("batch_id")
        counts.append(rows.agg(F.count("*").alias("rows")).withColumn("table_name", F.lit(name)))
    writer(batch, 3)
    again = store.read("transactions", with_batch_id=True).filter("batch_id = 'closed-3'")
    again = again.agg(F.count("*").alias("rows"))
    counts.append(again.selectExpr("'closed-3' as batch_id", "rows", "'stored again' as table_name"))
    return reduce(DataFrame.unionByName, counts)


@query
def epoch_counters(spark, sf_dir):
    """What one epoch reports to have written, and what is stored."""
    batch = cards.raw_fields(
        cards.card_events(spark, sf_dir).filter(F.col("source") == "stream")
    )
    store = TableStore(spark, work_dir(spark, "tables"))
    writer = MicroBatchWriter(store, "counted")
    writer(batch, 0)
    return spark.createDataFrame(list(writer.last_counts.items()), "counter string, value long")


# Topics


def _topic(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = "key string, value string, batch_id string"
    return spark.read.schema(schema).json(f"{root}/{name}")


@query
def topic_messages(spark, sf_dir):
    """Enriched events and alerts as the stream sends them, read back from their topics."""
    root = work_dir(spark, "topics")
    _run_stream(spark, sf_dir, _stream_messages, topics=json_topics(root))
    found = [
        _topic(spark, root, topic).select(
            F.lit(topic).alias("topic"),
            "key",
            F.get_json_object("value", "$.trans_num").alias("trans_num"),
            F.get_json_object("value", "$.alert_reason").alias("alert_reason"),
        )
        for topic in (ENRICHED_TOPIC, ALERT_TOPIC)
    ]
    return reduce(DataFrame.unionByName, found)


@query
def dlq_pipeline(spark, sf_dir):
    """Depth and action over the dead letters that a damaged stream has sent."""
    root = work_dir(spark, "topics")
    _run_stream(spark, sf_dir, _damaged_lines, topics=json_topics(root))
    sent = _topic(spark, root, DEAD_LETTER_TOPIC)
    return dead_letters.depth_status(dead_letters.topic_depth(sent, DEAD_LETTER_TOPIC))


@query
def replay_order(spark, sf_dir):
    """Replay files as they lie: whether time ever falls within a file, and where files overlap."""
    path = work_dir(spark, "replay")
    landed = work_dir(spark, "payload")
    payload = land(cards.raw_fields(cards.card_events(spark, sf_dir)), landed)
    with shuffles_removed(spark):
        files.write_replay(payload, path, compression="gzip")
    remove_dir(spark, landed)
    return files.replay_measures(spark, path)


@query
def message_keys(spark, sf_dir):
    """Keys of messages, of which some have no transaction number: those get a hash of the row."""
    spoiled = cards.unique_events(spark, sf_dir).withColumn(
        "trans_num", F.when(F.hour("trans_at") != 7, F.col("trans_num"))
    )
    messages = files.to_messages(cards.raw_fields(spoiled))
    number = F.get_json_object("value", "$.trans_num")
    return messages.agg(
        F.count("*").alias("messages"),
        F.count_if(F.col("key") == number).alias("by_number"),
        F.count_if(number.isNull() & F.col("key").isNotNull()).alias("by_hash"),
        F.count_if(F.col("key").isNull()).alias("without_key"),
        F.count_distinct("key").alias("keys"),
    )


@query
def payload_defaults(spark, sf_dir):
    """CSV rows with absent columns, nulls and text that is no number, as payload, by outcome."""
    spoiled = cards.raw_fields(cards.unique_events(spark, sf_dir)).drop("city_pop", "produced_at")
    hour = F.expr("int(substr(trans_date_trans_time, 12, 2))")
    text = spoiled.withColumns(
        {
            "amt": F.when(hour == 3, F.lit("abc")).otherwise(F.col("amt").cast("string")),
            "lat": F.when(hour != 4, F.col("lat")).cast("string"),
        }
    )
    payload = files.to_payload(text)
    judged = events.judge(payload)
    return judged.groupBy(F.coalesce("_dlq_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count("*").alias("rows"), F.sum("city_pop").alias("city_pop")
    )


@query
def consumer_progress(spark, sf_dir):
    """Lag after each trigger of a rate-limited stream over four deliveries of ``events``."""
    inbox, log = work_dir(spark, "inbox"), work_dir(spark, "progress")
    table = cards.table(spark, sf_dir, "events").select("event_id", "ts")
    for delivery in range(4):
        rows = table.filter(F.pmod("event_id", F.lit(4)) == delivery)
        rows.repartition(FILES_OF_DELIVERY).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", FILES_OF_DELIVERY).parquet(inbox)
    listener = progress.ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        sink = stream.writeStream.format("noop").option("checkpointLocation", work_dir(spark, "checkpoint"))
        job.drain(sink.trigger(availableNow=True).start())
        progress.flush(spark)
    finally:
        spark.streams.removeListener(listener)
    available = spark.read.schema(table.schema).parquet(inbox).count()  # from the footers
    return progress.trigger_lag(progress.reports(spark, log), available).drop("id")


@query
def panel_from_store(spark, sf_dir):
    """Panels over marts that were written once."""
    store = TableStore(spark, work_dir(spark, "marts"))
    summary = store.overwrite("mart_fraud_summary", _summary(spark, sf_dir))
    profiles = store.overwrite("mart_customer_360", _profiles(spark, sf_dir))

    def one(panel: str, value: DataFrame) -> DataFrame:
        number = F.col(value.columns[0]).cast("double").alias("value")
        return value.select(F.lit(panel).alias("panel"), number)

    parts = (
        one("total_transactions", panels.total_transactions(summary)),
        one("total_fraud", panels.total_fraud(summary)),
        one("fraud_rate", panels.fraud_rate(summary)),
        one("average_fraud_amount", panels.average_fraud_amount(summary)),
        one("stream_events", panels.stream_events(summary)),
        one("customers", profiles.filter("customer_id is not null").agg(F.count("*"))),
    )
    return reduce(DataFrame.unionByName, parts)


# Batch jobs from CSV


def _load_csv(
    spark: SparkSession, sf_dir: str, gender: Column | None = None
) -> tuple[TableStore, jobs.LoadCounts]:
    path = work_dir(spark, "csv")
    batch = cards.card_events(spark, sf_dir).filter(F.col("source") == "batch")
    if gender is not None:
        batch = batch.withColumn("gender", gender)
    cards.raw_fields(batch).drop("produced_at").write.csv(path, header=True, compression="gzip")
    store = TableStore(spark, work_dir(spark, "tables"))
    now = F.lit("2002-01-01").cast("timestamp")
    return store, jobs.batch_load(store, path, "load-1", now)


@query
def load_counters(spark, sf_dir):
    _, counts = _load_csv(spark, sf_dir)
    rows = list(counts.as_dict().items())
    return spark.createDataFrame(rows, "counter string, value long")


@query
def load_unresolved(spark, sf_dir):
    """A load in which some customers are rejected, so that their transactions find none."""
    gender = F.when(F.col("cc_num") % 11 == 0, "X").otherwise(F.col("gender"))
    _, counts = _load_csv(spark, sf_dir, gender)
    return spark.createDataFrame(list(counts.as_dict().items()), "counter string, value long")


@query
def batch_load_transactions(spark, sf_dir):
    store, _ = _load_csv(spark, sf_dir)
    named = store.read("transactions").join(
        store.read("customers").select("customer_id", "cc_num"), "customer_id"
    )
    return named.select("trans_id", "cc_num", "trans_at", "amount", "is_fraud", "source")


@query
def warehouse_refresh(spark, sf_dir):
    """The gated refresh over a CSV load; returns its quality report."""
    store, _ = _load_csv(spark, sf_dir)
    warehouse = TableStore(spark, work_dir(spark, "warehouse"))
    models = jobs.refresh_warehouse(store, warehouse, _as_of(), cards.DATE_RANGE)
    return models["quality_report"]


@query
def warehouse_refresh_selected(spark, sf_dir):
    """A refresh of the daily mart alone: the models it reads are built, tested and switched, no others."""
    store, _ = _load_csv(spark, sf_dir)
    warehouse = TableStore(spark, work_dir(spark, "warehouse"))
    models = jobs.refresh_warehouse(store, warehouse, _as_of(), cards.DATE_RANGE, select=["mart_fraud_summary"])
    return models["quality_report"]


# Marts kept up to date load by load


def _loaded_daily(spark: SparkSession, sf_dir: str) -> DailyWarehouse:
    """All transactions in three loads whose years overlap, applied one after the other."""
    store = TableStore(spark, work_dir(spark, "tables"))
    store.publish("customers", cards.customers(spark, sf_dir), "load-0", "batch")
    store.publish("merchants", cards.merchants(spark, sf_dir), "load-0", "batch")
    daily = DailyWarehouse(store, work_dir(spark, "daily"), _as_of(), cards.DATE_RANGE, grain="year")
    landed = work_dir(spark, "landed")
    _transactions(spark, sf_dir).write.parquet(landed)  # once for all loads
    rows = spark.read.parquet(landed)
    share = F.pmod(F.xxhash64("trans_id"), F.lit(3))
    for load in range(3):
        part = rows.filter(share == load)
        for source in ("batch", "stream"):
            store.publish("transactions", part.filter(F.col("source") == source), f"load-{load}", source)
        daily.apply(f"load-{load}")
    return daily


@query
def mart_fraud_summary_by_load(spark, sf_dir):
    return _loaded_daily(spark, sf_dir).daily_summary()


@query
def mart_customer_360_by_load(spark, sf_dir):
    return _loaded_daily(spark, sf_dir).customer_mart()
