"""The model graph, versioned tables and marts that are kept up to date load by load."""

from pathlib import Path

import pytest
from helpers import event, frame
from pyspark.sql import functions as F

from riskflow.plans import jobs, marts, staging, star
from riskflow.plans.incremental import DailyWarehouse
from riskflow.plans.models import ModelGraph
from riskflow.sources.tables import TableStore
from riskflow.sources.versions import VersionedTables


def graph(**needs):
    out = ModelGraph()
    for name, wanted in needs.items():
        out.model(name, *wanted.split())(lambda *rows: rows[0])
    return out


def names(models):
    return [m.name for m in models]


def test_models_come_after_what_they_read():
    g = graph(mart="stats dim", stats="stg", dim="stg", stg="raw", other="raw")
    order = names(g.order())
    assert set(order) == set(g.models) and g.sources() == {"raw"}
    assert all(order.index(n) < order.index(m.name) for m in g.models.values() for n in m.needs if n in g.models)


def test_selection_takes_what_is_read_and_readers_on_request():
    g = graph(mart="stats", stats="stg", dim="stg", stg="raw", other="raw")
    assert names(g.order(["stats"])) == ["stg", "stats"]
    assert set(names(g.order(["stats+"]))) == {"stg", "stats", "mart"}
    assert set(names(g.order(["dim", "other"]))) == {"stg", "dim", "other"}
    with pytest.raises(ValueError, match="no model nothing"):
        g.order(["nothing"])


def test_cycles_and_double_names_are_refused():
    g = graph(a="c", b="a", c="b")
    with pytest.raises(ValueError, match="read each other: .*->"):
        g.order()
    with pytest.raises(ValueError, match="twice"):
        g.model("a")(lambda: None)


def test_unknown_needs_are_named(spark):
    with pytest.raises(ValueError, match="a reads missing"):
        graph(a="missing").build({}, lambda name, rows: rows)


def test_views_come_first_and_stored_models_are_read_back():
    g, seen = ModelGraph(), []
    g.model("view", "raw", stored=False)(lambda raw: raw + ["view"])
    g.model("kept", "view")(lambda view: view + ["kept"])
    built = g.build({"raw": ["raw"]}, lambda name, rows: seen.append(name) or [*rows, "stored"], after=lambda v: seen.append(sorted(v)))
    assert seen == [["view"], "kept"] and built["kept"] == ["raw", "view", "kept", "stored"]


def shown(tables, name):
    return sorted(r[0] for r in tables.read(name).collect())


def test_versions_change_all_at_once(spark, tmp_path, monkeypatch):
    tables = VersionedTables(spark, str(tmp_path / "dw"))
    assert tables.current() == {}
    tables.switch({n: tables.write(n, spark.range(k, k + 2)) for n, k in (("a", 0), ("b", 10))})
    assert (shown(tables, "a"), shown(tables, "b")) == ([0, 1], [10, 11])
    before = tables.read("a")
    folders = {n: tables.write(n, spark.range(5)) for n in ("a", "b")}
    assert shown(tables, "a") == [0, 1]  # written, not current

    def stop(*_):
        raise OSError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_point", stop)
        with pytest.raises(OSError):
            tables.switch(folders)
    assert (shown(tables, "a"), shown(tables, "b")) == ([0, 1], [10, 11])
    with monkeypatch.context() as patch:
        patch.setattr(tables, "_clean", stop)  # behind the step that counts
        with pytest.raises(OSError):
            tables.switch(folders)
    assert (shown(tables, "a"), shown(tables, "b")) == ([0, 1, 2, 3, 4],) * 2
    assert before.count() == 2  # a plan made before the switch still runs
    tables.switch({"a": tables.write("a", spark.range(1))})
    assert (shown(tables, "a"), shown(tables, "b")) == ([0], [0, 1, 2, 3, 4])
    assert len(list((tmp_path / "dw" / "a").iterdir())) == 2


def load(store, events, load_id):
    """Publish events as a load of transactions with their customers and merchants."""
    rows = frame(store.spark, events)
    now = F.lit("2021-01-01").cast("timestamp")
    order = rows.withColumns({"file_name": F.lit("f"), "line": F.lit(1)})
    typed = order.withColumns({"dob": F.col("dob").cast("date"), "trans_at": F.col("trans_date_trans_time").cast("timestamp")})
    for name, build in (("customers", jobs.customer_rows), ("merchants", jobs.merchant_rows)):
        extra = {c: F.lit(None).cast("string") for c in jobs.files.ORDER_COLUMNS if c not in typed.columns}
        made = build(typed.withColumns(extra), now)
        keys = {"customers": "cc_num", "merchants": "merchant_name"}[name]
        store.publish(name, made.dropDuplicates([keys]).join(store.read(name).select(keys), keys, "left_anti"), load_id, "batch")
    resolved = jobs.resolve_keys(typed, store.read("customers"), store.read("merchants"))
    store.publish("transactions", jobs.transaction_rows(resolved, now), load_id, "batch")


LOADS = {
    "one": [event(f"a{k}", amt=10.0 * k, trans_date_trans_time=f"2020-06-{20 + k % 3} 10:00:00", category=c, merchant=c)
            for k, c in enumerate(["travel", "misc_net", "travel", "grocery_pos", "misc_net"])],
    "two": [event(f"b{k}", amt=7.5, cc_num=42 + k % 2, trans_date_trans_time="2020-06-21 23:59:59", is_fraud=k % 2,
                  category="grocery_pos", merchant="grocery_pos") for k in range(3)],
}
AS_OF = "2021-01-01"


@pytest.fixture
def daily(spark, store, tmp_path):
    return DailyWarehouse(store, str(tmp_path / "daily"), F.lit(AS_OF).cast("date"))


def sorted_rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def rebuilt(daily):
    """Facts and marts built at once from all that is stored."""
    txns = staging.stg_transactions(daily.store.read("transactions"))
    customers, merchants = daily._customers(), daily._merchants()
    stats = star.int_transaction_stats(txns, customers, merchants)
    return (
        star.fact_transactions(txns, *daily.calendar), marts.mart_fraud_summary(stats),
        marts.mart_customer_360(txns, customers, merchants),
    )


def test_loads_one_after_the_other_equal_a_rebuild(store, daily):
    for name, events in LOADS.items():
        load(store, events, name)
        daily.apply(name)
    for made, want in zip((daily.facts(), daily.daily_summary(), daily.customer_mart()), rebuilt(daily)):
        assert sorted_rows(made) == sorted_rows(want)
    # The most frequent category ties between loads and goes to the smaller name.
    assert {r.customer_id: r.top_category for r in daily.customer_mart().collect()}[42] == "grocery_pos"


def files_of(daily, name):
    return {str(p): p.stat().st_mtime_ns for p in Path(daily.root, name).rglob("*.parquet")}


def test_a_load_of_one_day_changes_that_day_only(store, daily):
    load(store, LOADS["one"], "one")
    assert [str(d) for d in daily.apply("one")] == ["2020-06-20", "2020-06-21", "2020-06-22"]
    before = {n: files_of(daily, n) for n in ("fact_transactions", "mart_fraud_summary")}
    load(store, LOADS["two"], "two")
    assert [str(d) for d in daily.apply("two")] == ["2020-06-21"]
    for name, old in before.items():
        now = files_of(daily, name)
        changed = {p.split("period=")[1][:10] for p in set(old) ^ set(now)}
        assert changed == {"2020-06-21"}, name
        assert all(now[p] == old[p] for p in set(old) & set(now)) and len(set(old) & set(now)) == 2


def test_a_load_applied_again_changes_nothing(store, daily):
    for name, events in LOADS.items():
        load(store, events, name)
        daily.apply(name)
    before = [sorted_rows(df) for df in (daily.facts(), daily.daily_summary(), daily.customer_mart())]
    daily.apply("one")
    assert before == [sorted_rows(df) for df in (daily.facts(), daily.daily_summary(), daily.customer_mart())]


def test_customer_mart_reads_no_facts(store, daily):
    load(store, LOADS["one"], "one")
    daily.apply("one")
    plan = daily.customer_mart()._jdf.queryExecution().executedPlan().toString()
    assert "customer_state" in plan and "fact_transactions" not in plan and "tables/transactions" not in plan


def test_empty_load(store, daily):
    load(store, LOADS["one"], "one")
    daily.apply("one")
    assert daily.apply("never stored") == []
    assert daily.facts().count() == len(LOADS["one"])


def test_selected_refresh_builds_only_what_is_needed(spark, store, tmp_path):
    load(store, LOADS["one"], "one")
    warehouse = TableStore(spark, str(tmp_path / "dw"))
    as_of = F.lit(AS_OF).cast("date")
    models = jobs.refresh_warehouse(store, warehouse, as_of, select=["mart_fraud_summary"])
    current = VersionedTables(spark, warehouse.root).current()
    assert set(current) == {"int_transaction_stats", "mart_fraud_summary"} and "dim_date" not in models
    jobs.refresh_warehouse(store, warehouse, as_of, select=["dim_customer"])
    after = VersionedTables(spark, warehouse.root).current()
    assert after["mart_fraud_summary"] == current["mart_fraud_summary"] and "dim_customer" in after


def test_failed_refresh_leaves_the_last_one(spark, store, tmp_path):
    load(store, LOADS["one"], "one")
    warehouse = TableStore(spark, str(tmp_path / "dw"))
    as_of = F.lit(AS_OF).cast("date")
    jobs.refresh_warehouse(store, warehouse, as_of)
    before = VersionedTables(spark, warehouse.root).current()
    load(store, [event("child", dob="2019-01-01", cc_num=77)], "two")
    with pytest.raises(jobs.quality.QualityGateError):
        jobs.refresh_warehouse(store, warehouse, as_of)
    assert VersionedTables(spark, warehouse.root).current() == before
