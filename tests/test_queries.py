"""Every registered query against its SQL twin, and the plans of the main ones."""

import pytest
from compare import TABLES, difference, open_oracle
from helpers import SMALL

import __spark_entry__ as entry_module
from riskflow.catalogue import QUERIES

ORACLES = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(SMALL)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(ORACLES) and set(QUERIES) <= set(entry_module.queries())


# Queries that read a table as a stream meet both shapes of tables; the others read them alike.
STREAMS = [n for n in sorted(QUERIES) if n.startswith("stream_") or n in ("topic_messages", "dlq_pipeline")]


@pytest.mark.parametrize("name", STREAMS)
def test_query_matches_its_twin(spark, oracle, name):
    assert difference(QUERIES[name](spark, SMALL), oracle, ORACLES[name]) is None


@pytest.fixture(scope="module")
def folder_tables(spark, tmp_path_factory):
    """The same tables as folders of four part files each."""
    root = tmp_path_factory.mktemp("folders")
    for name in TABLES:
        rows = spark.read.parquet(f"{SMALL}/{name}.parquet")
        rows.repartition(4).write.parquet(f"{root}/{name}.parquet")
    return str(root)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_twin_on_folder_tables(spark, oracle, folder_tables, name):
    assert difference(QUERIES[name](spark, folder_tables), oracle, ORACLES[name]) is None


def test_rare_repeats_are_sorted_once(spark):
    plan = plan_of(QUERIES["txn_first_wins"](spark, SMALL))
    below = plan[plan.index("min(struct") :]
    lines = below[: below.index("lineitem.parquet")]
    assert lines.count("Sort [l_orderkey") == 1


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0


# stream_*, load and refresh queries run their jobs when called; their result is a table scan.
JOBS = ("stream_", "load_", "batch_load", "ware", "epoch_", "topic_messages", "dlq_pipeline", "replay_order", "consumer_progress", "panel_from_store")
LAZY = [n for n in sorted(QUERIES) if not n.startswith(JOBS)]


@pytest.mark.parametrize("name", LAZY)
def test_plans_stay_native_and_distributed(spark, name):
    """No Python workers, no cross joins, no window over the whole input, no RDD detour."""
    plan = plan_of(QUERIES[name](spark, SMALL))
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "ExistingRDD"):
        assert unwanted not in plan, unwanted
    if "Exchange SinglePartition" in plan:
        assert "Window" not in plan


def test_columns_are_pruned_at_the_scan(spark):
    """Counting rows by source reads no customer, part or supplier and two order columns."""
    plan = plan_of(QUERIES["health_batch_rows"](spark, SMALL))
    assert "customer.parquet" not in plan and "part.parquet" not in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_source_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["health_alert_count"](spark, SMALL))
    assert "EqualTo(o_orderstatus,O)" in plan or "o_orderstatus" in plan.split("PushedFilters")[1]


def test_stored_transactions_prune_by_source(spark, store):
    from riskflow.plans import health
    from riskflow.sources import cards

    rows = cards.transactions(spark, SMALL)
    store.publish("transactions", rows.filter("source = 'batch'"), "b", "batch")
    store.publish("transactions", rows.filter("source = 'stream'"), "s", "stream")
    plan = plan_of(health.source_rows(store.read("transactions"), "batch"))
    assert "PartitionFilters: [isnotnull(source" in plan
