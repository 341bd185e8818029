"""Batch jobs: the CSV load and the warehouse refresh."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators import quality
from riskflow.operators.dedup import first_wins, insert_if_absent
from riskflow.operators.keys import resolve_keys, surrogate_key, unresolved_keys
from riskflow.plans import marts, staging, star
from riskflow.plans.models import ModelGraph
from riskflow.session import remove_dir, work_dir
from riskflow.sources import files
from riskflow.sources.tables import TableStore, show_in_database
from riskflow.sources.versions import VersionedTables
from riskflow.streaming.dead_letters import to_dead_letters

SOURCE = "batch"
UNRESOLVED = "key not resolved"
TRANSACTION_ORDER = ["unix_time", "trans_at", "amount", "is_fraud"]


@dataclass
class LoadCounts:
    """What one load did with the rows it read."""

    customers_attempted: int = 0
    customers_inserted: int = 0
    merchants_attempted: int = 0
    merchants_inserted: int = 0
    transactions_attempted: int = 0
    transactions_inserted: int = 0
    transactions_unresolved: int = 0
    rows_rejected: int = 0

    def as_dict(self) -> dict[str, int]:
        return asdict(self)


def customer_rows(events: DataFrame, created_at: Column) -> DataFrame:
    """Card-holder rows under table names, keyed by card number, with their arrival columns."""
    return events.select(
        F.col("cc_num").alias("customer_id"),
        "cc_num",
        F.col("first").alias("first_name"),
        F.col("last").alias("last_name"),
        "gender",
        "dob",
        "job",
        "street",
        "city",
        "state",
        "zip",
        "lat",
        "long",
        "city_pop",
        created_at.alias("created_at"),
        *files.ORDER_COLUMNS,
    )


def merchant_rows(events: DataFrame, created_at: Column) -> DataFrame:
    return events.select(
        surrogate_key("merchant").alias("merchant_id"),
        F.col("merchant").alias("merchant_name"),
        "category",
        "merch_lat",
        "merch_long",
        created_at.alias("created_at"),
        *files.ORDER_COLUMNS,
    )


def transaction_rows(resolved: DataFrame, ingested_at: Column) -> DataFrame:
    return resolved.select(
        F.col("trans_num").alias("trans_id"),
        "customer_id",
        "merchant_id",
        "trans_at",
        "unix_time",
        F.col("amt").alias("amount"),
        "is_fraud",
        F.lit(SOURCE).alias("source"),
        ingested_at.alias("ingested_at"),
    )


def batch_load(
    store: TableStore, csv_path: str, load_id: str, now: Column | None = None
) -> LoadCounts:
    """Customers, then merchants, then transactions of one CSV.

    The text is parsed once; each load then scans its own columns, and keys are resolved once. Stored rows always win over new
    ones, and earlier rows over later ones. Rows that break a table constraint, and transactions
    whose customer or merchant is not stored, go to the dead letters. Running the same ``load_id`` again leaves the same tables; another id for the same
    file inserts nothing.
    """
    now = F.current_timestamp() if now is None else now
    landing, resolved = work_dir(store.spark, "landing"), work_dir(store.spark, "resolved")
    try:
        events = files.land(files.read_csv_events(store.spark, csv_path), landing)
        return _load(store, events, load_id, now, resolved)
    finally:
        remove_dir(store.spark, landing)
        remove_dir(store.spark, resolved)


def _load(store: TableStore, events: DataFrame, load_id: str, now: Column, resolved: str) -> LoadCounts:
    counts = LoadCounts()
    order = list(files.ORDER_COLUMNS)

    customers, bad_customers = quality.split_by_violation(
        customer_rows(files.scan_customers(events), now), quality.customer_violation()
    )
    merchants, bad_merchants = quality.split_by_violation(
        merchant_rows(files.scan_merchants(events), now), quality.merchant_violation()
    )
    counts.customers_attempted, counts.customers_inserted = _insert(
        store, "customers", customers, ["cc_num"], order, load_id
    )
    counts.merchants_attempted, counts.merchants_inserted = _insert(
        store, "merchants", merchants, ["merchant_name"], order, load_id
    )

    scanned = files.scan_transactions(events)
    known = store.read("customers"), store.read("merchants")
    # Both joins once: the valid rows, their number and the rejected rows are read from what is stored.
    transaction_rows(resolve_keys(scanned, *known), now).write.parquet(resolved)
    valid, bad_transactions = quality.split_by_violation(
        store.spark.read.parquet(resolved), quality.transaction_violation()
    )
    counts.transactions_attempted, counts.transactions_inserted = _insert(
        store, "transactions", valid, ["trans_id"], TRANSACTION_ORDER, load_id
    )

    unresolved = unresolved_keys(scanned, *known)
    letters = [
        *map(to_dead_letters, (bad_customers, bad_merchants)),
        to_dead_letters(bad_transactions.withColumnRenamed("trans_id", "trans_num")),
        to_dead_letters(unresolved, F.lit(UNRESOLVED)),
    ]
    store.publish("dead_letters", reduce(DataFrame.unionByName, letters), load_id, SOURCE)
    stored = store.read("dead_letters", with_batch_id=True).filter(F.col("batch_id") == load_id)
    missing = F.col("_dlq_reason") == UNRESOLVED
    found = stored.agg(
        F.count_if(missing).alias("unresolved"), F.count_if(~missing).alias("rejected")
    ).first()
    counts.transactions_unresolved, counts.rows_rejected = found
    return counts


def _insert(
    store: TableStore,
    name: str,
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    load_id: str,
) -> tuple[int, int]:
    """Insert-if-absent with the number of rows attempted and inserted.

    Both are counts of what is stored (the landed rows, the rows of this load), so they hold when
    lost tasks are run again. Transactions are looked up among the stored keys, see ``TableStore.unseen``.
    """
    if name == "transactions":
        fresh = store.unseen(name, first_wins(rows, keys, order), keys[0], load_id)
    else:
        fresh = insert_if_absent(rows, store.read_others(name, load_id), keys, order)
    store.publish(name, fresh, load_id, SOURCE)
    if name == "transactions":
        own = store.spark.read.parquet(store.batch_path(name, load_id, SOURCE))
        store.publish_keys(name, own.select(keys[0]), load_id)
    return rows.count(), store.count(name, load_id, SOURCE)


def warehouse_models(
    as_of: Column | None = None, calendar: tuple[str, str] = (star.SPINE_START, star.SPINE_END)
) -> ModelGraph:
    """All models of the warehouse over the stored tables."""
    graph = ModelGraph()
    declare = graph.model
    declare("stg_transactions", "transactions", stored=False)(staging.stg_transactions)
    declare("stg_customers", "customers", stored=False)(lambda customers: staging.stg_customers(customers, as_of))
    declare("stg_merchants", "merchants", stored=False)(staging.stg_merchants)
    declare("int_transaction_stats", "stg_transactions", "stg_customers", "stg_merchants")(star.int_transaction_stats)
    declare("dim_customer", "stg_customers")(star.dim_customer)
    declare("dim_merchant", "stg_merchants")(star.dim_merchant)
    declare("dim_date", "stg_transactions")(lambda txns: star.dim_date(star.date_spine(txns.sparkSession, *calendar)))
    declare("fact_transactions", "stg_transactions")(lambda txns: star.fact_transactions(txns, *calendar))
    declare("mart_fraud_summary", "int_transaction_stats")(
        lambda stats: marts.newest_first(marts.mart_fraud_summary(stats))
    )
    declare("mart_customer_360", "stg_transactions", "stg_customers", "stg_merchants")(
        lambda *tables: marts.riskiest_first(marts.mart_customer_360(*tables))
    )
    return graph


def register_views(models: dict[str, DataFrame]) -> None:
    for name, df in models.items():
        df.createOrReplaceTempView(name)


def refresh_warehouse(
    store: TableStore,
    warehouse: TableStore,
    as_of: Column | None = None,
    calendar: tuple[str, str] = (star.SPINE_START, star.SPINE_END),
    database: str | None = None,
    select: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """Staging views, their tests, the rest of the models, all tests; stop at a failed gate.

    ``select`` names the models to refresh, which are built with all they read and nothing else. New
    versions are written beside the current ones, tested as stored, and become the current ones all at
    once when every test has passed. The staging tests are part of "all tests" but their input did not
    change, so their first report is kept. With a ``database`` its views show the current versions.
    """
    graph = warehouse_models(as_of, calendar)
    tables = VersionedTables(store.spark, warehouse.root)
    folders: dict[str, str] = {}
    reports: list[DataFrame] = []

    def keep(name: str, rows: DataFrame) -> DataFrame:
        folders[name] = tables.write(name, rows)
        return store.spark.read.parquet(folders[name])

    def staged(views: dict[str, DataFrame]) -> None:
        register_views(views)
        checks = [check for check in quality.STAGING_CHECKS if check.model in views]
        if checks:
            reports.append(_gate(warehouse, "quality_staging", views, checks))

    models = graph.build({n: store.read(n) for n in graph.sources()}, keep, select, staged)
    rest = [c for c in quality.ALL_CHECKS if c not in quality.STAGING_CHECKS and c.model in models]
    if rest:
        reports.append(_gate(warehouse, "quality_models", models, rest))
    tables.switch(folders)
    register_views({name: models[name] for name in folders})
    if database is not None:
        show_in_database(store.spark, database, folders)
    return {**models, "quality_report": reduce(DataFrame.unionByName, reports)}


def _gate(
    warehouse: TableStore, name: str, models: dict[str, DataFrame], checks: list
) -> DataFrame:
    """Run checks once, store the report, raise if it is not clean."""
    report = warehouse.overwrite(name, quality.run_checks(models, checks))
    quality.require_clean(report)
    return report
