"""CSV load and gated refresh."""

import csv
import datetime as dt
import time
from pathlib import Path

import pytest
from helpers import SMALL, event, frame
from pyspark.sql import functions as F

from riskflow import catalogue
from riskflow.operators import quality
from riskflow.plans import jobs
from riskflow.sources.tables import TableStore
from riskflow.streaming.writer import MicroBatchWriter

ROWS = [
    event("t1", unix_time=10, cc_num=1, merchant="m1", amt=10.0),
    event("t2", unix_time=11, cc_num=1, merchant="m2", amt=2000.0, is_fraud=1, first="Late"),
    event("t3", unix_time=12, cc_num=2, merchant="m1", amt=30.0, category="travel"),
    event("t1", unix_time=13, cc_num=2, merchant="m2", amt=99.0),
]


def write_csv(path, rows):
    names = [name for name in rows[0] if name != "produced_at"]
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, names, extrasaction="ignore")
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


def contents(store):
    columns = {
        "customers": ["cc_num", "first_name", "zip"],
        "merchants": ["merchant_name", "category"],
        "transactions": ["trans_id", "amount", "source"],
    }
    return {
        name: sorted(str(tuple(row)) for row in store.read(name).select(*wanted).collect())
        for name, wanted in columns.items()
    }


def test_load_keeps_first_rows(spark, store, tmp_path):
    counts = jobs.batch_load(store, write_csv(tmp_path / "a.csv", ROWS), "load-1")
    assert counts.as_dict() == {
        "customers_attempted": 4,
        "customers_inserted": 2,
        "merchants_attempted": 4,
        "merchants_inserted": 2,
        "transactions_attempted": 4,
        "transactions_inserted": 3,
        "transactions_unresolved": 0,
        "rows_rejected": 0,
    }
    assert contents(store) == {
        "customers": ["(1, 'Ada', '01234')", "(2, 'Ada', '01234')"],
        "merchants": ["('m1', 'grocery_pos')", "('m2', 'grocery_pos')"],
        "transactions": [
            "('t1', Decimal('10.00'), 'batch')",
            "('t2', Decimal('2000.00'), 'batch')",
            "('t3', Decimal('30.00'), 'batch')",
        ],
    }


def test_rows_meet_the_dimensions_once_for_rows_counts_and_rejects(spark, store, tmp_path, monkeypatch):
    """What is inserted, counted and rejected is read from resolved rows that are stored, and removed at the end."""
    read, asked, removed = [], jobs.quality.split_by_violation, []
    monkeypatch.setattr(jobs, "remove_dir", lambda s, path: removed.append(path))
    monkeypatch.setattr(
        jobs.quality, "split_by_violation", lambda rows, violation: read.append(rows) or asked(rows, violation)
    )
    counts = jobs.batch_load(store, write_csv(tmp_path / "a.csv", [*ROWS, event("t5", is_fraud=7)]), "load-1")
    assert (counts.transactions_attempted, counts.rows_rejected, counts.transactions_unresolved) == (4, 1, 0)
    (resolved,) = [p for p in removed if "resolved" in p]
    assert read[2].inputFiles() and all(resolved in f for f in read[2].inputFiles())


def test_the_queries_csv_is_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "work_dir", lambda spark, purpose: str(tmp_path / purpose))
    _, counts = catalogue._load_csv(spark, SMALL)
    assert counts.transactions_inserted and all(p.name.endswith(".csv.gz") for p in (tmp_path / "csv").glob("part-*"))


def test_repeating_a_load_changes_nothing(spark, store, tmp_path):
    path = write_csv(tmp_path / "a.csv", ROWS)
    jobs.batch_load(store, path, "load-1")
    before = contents(store)
    again = jobs.batch_load(store, path, "load-1")
    assert again.transactions_inserted == 3 and contents(store) == before
    other = jobs.batch_load(store, path, "load-2")
    assert other.transactions_inserted == other.customers_inserted == 0
    assert other.transactions_attempted == 4 and contents(store) == before


def test_stored_attributes_are_never_updated(spark, store, tmp_path):
    jobs.batch_load(store, write_csv(tmp_path / "a.csv", ROWS), "load-1")
    newer = [event("t9", unix_time=1, cc_num=1, merchant="m3", first="Newer")]
    jobs.batch_load(store, write_csv(tmp_path / "b.csv", newer), "load-2")
    names = {r.cc_num: r.first_name for r in store.read("customers").collect()}
    assert names == {1: "Ada", 2: "Ada"}
    assert store.read("transactions").count() == 4


def test_bad_rows_are_dead_lettered(spark, store, tmp_path):
    rows = [
        *ROWS,
        event("t5", cc_num=3, gender="X"),
        event("t6", cc_num=1, merchant="m1", is_fraud=4),
        event("t7", cc_num=1, merchant="m1", trans_date_trans_time="never"),
        event("t8", cc_num=1, merchant="m1", amt="abc"),
    ]
    counts = jobs.batch_load(store, write_csv(tmp_path / "a.csv", rows), "load-1")
    reasons = sorted(r._dlq_reason for r in store.read("dead_letters").collect())
    assert reasons == [
        "amount is null",
        "gender not in (M, F)",
        "is_fraud not in (0, 1)",
        "key not resolved",
        "trans_at is null",
    ]
    assert counts.rows_rejected == 4 and counts.transactions_unresolved == 1
    assert counts.transactions_inserted == 3


def test_empty_csv(spark, store, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(",".join(n for n in ROWS[0] if n != "produced_at") + "\n")
    counts = jobs.batch_load(store, str(path), "load-1")
    assert set(counts.as_dict().values()) == {0}


AS_OF = "2021-01-01"


def test_refresh_builds_marts_and_reports(spark, store, tmp_path):
    jobs.batch_load(store, write_csv(tmp_path / "a.csv", ROWS), "load-1")
    warehouse = TableStore(spark, str(tmp_path / "dw"))
    models = jobs.refresh_warehouse(store, warehouse, F.lit(AS_OF).cast("date"))
    report = models["quality_report"].collect()
    assert len(report) == 51 and all(row.failures == 0 for row in report)
    summary = models["mart_fraud_summary"].orderBy("total_transactions").collect()
    assert [(r.merchant_category, r.total_transactions) for r in summary] == [
        ("grocery_pos", 3)
    ]
    assert (summary[0].fraud_count, summary[0].fraud_rate_pct) == (1, 33.3333)
    profile = {r.customer_id: r for r in models["mart_customer_360"].collect()}
    assert sorted(r.risk_tier for r in profile.values()) == ["HIGH", "LOW"]
    assert spark.table("fact_transactions").first().date_id == 20200621
    assert spark.table("stg_customers").first().age == 40


def test_refresh_into_a_database(spark, store, tmp_path):
    jobs.batch_load(store, write_csv(tmp_path / "a.csv", ROWS), "load-1")
    warehouse = TableStore(spark, str(tmp_path / "dw"))
    as_of = F.lit(AS_OF).cast("date")
    for _ in range(2):
        jobs.refresh_warehouse(store, warehouse, as_of, database="risk_dw")
    assert spark.table("risk_dw.fact_transactions").count() == 3


def test_refresh_stops_at_the_staging_gate(spark, store, tmp_path):
    late = [event("t1", amt=60000.0), event("t2")]
    jobs.batch_load(store, write_csv(tmp_path / "a.csv", late), "load-1")
    warehouse = TableStore(spark, str(tmp_path / "dw"))
    with pytest.raises(quality.QualityGateError, match="stg_transactions.amount"):
        jobs.refresh_warehouse(store, warehouse, F.lit(AS_OF).cast("date"))
    assert not (tmp_path / "dw" / "fact_transactions").exists()


def test_refresh_checks_the_built_models(spark, store, tmp_path):
    minors = [event("t1", dob="2010-01-01")]
    jobs.batch_load(store, write_csv(tmp_path / "a.csv", minors), "load-1")
    warehouse = TableStore(spark, str(tmp_path / "dw"))
    with pytest.raises(quality.QualityGateError, match="customer_age"):
        jobs.refresh_warehouse(store, warehouse, F.lit(AS_OF).cast("date"))


def test_days_outside_the_calendar_have_no_date_id(spark):
    from riskflow.plans import star

    rows = [("a", dt.datetime(2018, 12, 31)), ("b", dt.datetime(2019, 1, 1))]
    columns = "customer_id merchant_id amount is_fraud source hour_of_day is_weekend ingested_at"
    base = spark.createDataFrame(rows, "trans_id string, trans_at timestamp").selectExpr(
        "*", *[f"NULL AS {name}" for name in columns.split()]
    )
    facts = star.fact_transactions(base, star.SPINE_START, star.SPINE_END)
    assert {r.trans_id: r.date_id for r in facts.collect()} == {"a": None, "b": 20190101}


def shuffle_files(spark) -> dict[str, int]:
    """Names and bytes."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    files = [found.apply(k) for k in range(found.size())]
    return {f.getName(): f.length() for f in files if f.getName().startswith("shuffle_")}


def shuffled_since(spark, before: dict[str, int], most: int = 0) -> int:
    """Bytes of new shuffle files, once they are ``most`` or after ten seconds."""
    for _ in range(20):
        if (left := sum(size for name, size in shuffle_files(spark).items() if name not in before)) <= most:
            break
        time.sleep(0.5)
    return left


def test_replay_leaves_no_shuffle_and_no_payload_behind(spark):
    before = shuffle_files(spark)
    root = Path(spark.conf.get("spark.checkpoint.dir"))
    result = catalogue.QUERIES["replay_order"](spark, SMALL)
    assert shuffled_since(spark, before) == 0 and not list(root.glob("payload-*"))
    assert {r.measure: r.value for r in result.collect()}["falls"] == 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_drained_stream_leaves_no_shuffle_cache_or_spool_behind(spark):
    before, root = shuffle_files(spark), Path(spark.conf.get("spark.checkpoint.dir"))
    stores, cached = set(root.glob("tables-*")), len(spark.sparkContext._jsc.sc().getRDDStorageInfo())
    result = catalogue.QUERIES["dlq_pipeline"](spark, SMALL)
    # What is left counts the rows that the epoch has stored, by table.
    assert shuffled_since(spark, before, 10_000) <= 10_000 and len(spark.sparkContext._jsc.sc().getRDDStorageInfo()) == cached
    (store,) = set(root.glob("tables-*")) - stores
    assert not list((store / "_writing").glob("*"))
    assert result.collect()[0].depth > 0


def test_spooled_and_cached_epochs_store_the_same(spark, tmp_path):
    rows = [event("a"), event("a", amt=9.0), event("b", is_fraud=1), event(None), event("c", is_fraud=3), event("d", amt=None)]
    found = {}
    for spool in (False, True):
        store = TableStore(spark, str(tmp_path / f"spool-{spool}"))
        writer = MicroBatchWriter(store, "s", spool=spool, ingested_at=F.lit("2020-01-01").cast("timestamp"))
        for epoch, part in enumerate((rows, [event("b"), event("e")], [])):
            writer(frame(spark, part), epoch)
        found[spool] = {
            name: sorted(map(str, store.read(name, with_batch_id=True).drop("_dlq_at", "value").collect()))
            for name in ("transactions", "fraud_alerts", "stream_staging", "dead_letters")
        }
    assert found[True] == found[False]
    assert len(found[True]["dead_letters"]) == 3 and len(found[True]["transactions"]) == 3
