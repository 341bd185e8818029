"""The stream job on file streams: several epochs, restarts, replays, dead letters."""

import json
import time
from pathlib import Path

import pytest
from helpers import event, frame
from pyspark.sql import functions as F

from riskflow.schemas import RAW_EVENT
from riskflow.session import work_dir
from riskflow.sources import events as sources
from riskflow.sources import files
from riskflow.sources.key_runs import first_hashes
from riskflow.sources.tables import TableStore
from riskflow.streaming import dead_letters, events, job
from riskflow.streaming.writer import MicroBatchWriter


def drop_file(spark, folder, name, rows):
    """One file of JSON messages; text passes through as it is."""
    folder.mkdir(parents=True, exist_ok=True)
    lines = [row if isinstance(row, str) else json.dumps(row) for row in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def run(spark, store, inbox, checkpoint, **options):
    stream = sources.read_raw(spark, "text", str(inbox), maxFilesPerTrigger="1")
    job.drain(job.start_stream(stream, store, str(checkpoint), once=True, **options))


def ids(store, name, column="trans_id"):
    return sorted(str(row[0]) for row in store.read(name).select(column).collect())


def test_epochs_restart_and_duplicates(spark, store, tmp_path):
    inbox, checkpoint = tmp_path / "inbox", tmp_path / "checkpoint"
    drop_file(spark, inbox, "1.json", [event("a"), event("b", is_fraud=1), event("a", amt=9.0)])
    drop_file(spark, inbox, "2.json", [event("b"), event("c", amt=2000.0, lat=10.0)])
    run(spark, store, inbox, checkpoint)
    assert ids(store, "transactions") == ["a", "b", "c"]
    assert ids(store, "stream_staging") == ["a", "a", "b", "b", "c"]
    assert ids(store, "fraud_alerts") == ["b", "c"]
    assert ids(store, "dead_letters", "key") == []

    drop_file(spark, inbox, "3.json", [event("c"), event("d")])
    run(spark, store, inbox, checkpoint)
    assert ids(store, "transactions") == ["a", "b", "c", "d"]
    assert ids(store, "fraud_alerts") == ["b", "c"]


def test_new_checkpoint_does_not_replace_older_epochs(spark, store, tmp_path):
    drop_file(spark, tmp_path / "one", "1.json", [event("a")])
    drop_file(spark, tmp_path / "two", "1.json", [event("b")])
    run(spark, store, tmp_path / "one", tmp_path / "c1")
    run(spark, store, tmp_path / "two", tmp_path / "c2")
    assert ids(store, "transactions") == ["a", "b"]


def test_first_event_of_a_number_is_stored(spark, store):
    rows = [event("a", unix_time=5, amt=1.0), event("a", unix_time=3, amt=2.0)]
    MicroBatchWriter(store, "s")(frame(spark, rows), 0)
    stored = store.read("transactions").first()
    assert (float(stored.amount), stored.source) == (2.0, "stream")
    assert stored.customer_id is None and stored.merchant_id is None


def test_replayed_epoch_changes_nothing(spark, store):
    writer = MicroBatchWriter(store, "s")
    rows = frame(spark, [event("a", is_fraud=1), event("b"), event(None)])
    writer(rows, 0)
    counts = [store.read(name).count() for name in ("transactions", "fraud_alerts")]
    writer(rows, 0)
    assert counts == [2, 1] == [
        store.read(name).count() for name in ("transactions", "fraud_alerts")
    ]
    assert store.read("dead_letters").count() == 1
    assert writer.last_counts == {"rows": 2, "alerts": 1}


def test_empty_epoch_writes_nothing(spark, store):
    MicroBatchWriter(store, "s")(frame(spark, []), 0)
    assert store.read("transactions").count() == 0


def test_rejected_events_keep_their_reason(spark, store, tmp_path):
    bad = {
        "amount is null": event("n1", amt=None),
        "amount out of range": event("n2", amt=1e12),
        "coordinates are null": event("n3", lat=None),
        "is_fraud is null": event("n4", is_fraud=None),
        "is_fraud not in (0, 1)": event("n5", is_fraud=7),
        "trans_at is null": event("n6", trans_date_trans_time="noon"),
        "trans_num is null": event(None),
        "malformed json": '{"trans_num": "n8", "amt": ',
    }
    drop_file(spark, tmp_path / "inbox", "1.json", [*bad.values(), event("good")])
    run(spark, store, tmp_path / "inbox", tmp_path / "checkpoint")
    letters = store.read("dead_letters").collect()
    assert sorted(row._dlq_reason for row in letters) == sorted(bad)
    assert ids(store, "transactions") == ["good"]
    for row in letters:
        body = json.loads(row.value)
        assert body["_dlq_reason"] == row._dlq_reason
        assert body["_dlq_at"].endswith("+00:00")
        if row._dlq_reason == "malformed json":
            assert body[events.CORRUPT] == bad["malformed json"]


def test_numbers_that_do_not_fit_are_rejected(spark, store):
    rows = [
        event("n1", amt=9999999999.996),
        event("n2", amt=float("nan")),
        event("n3", amt=float("inf")),
        event("n4", lat=float("inf")),
        event("n5", merch_long=float("nan")),
        event("good", amt=9999999999.99),
    ]
    MicroBatchWriter(store, "s")(frame(spark, rows), 0)
    assert ids(store, "dead_letters", "key") == ["n1", "n2", "n3", "n4", "n5"]
    assert ids(store, "transactions") == ["good"]


class BrokenStore(TableStore):
    """Fails when an epoch has rows of one of its tables."""

    def __init__(self, spark, root, *broken):
        super().__init__(spark, root)
        self.broken = broken

    def publish_epoch(self, tagged, stream, epoch):
        for name in self.broken:
            if not tagged.filter(F.col("target") == name).isEmpty():
                raise OSError(f"{name} is full")
        super().publish_epoch(tagged, stream, epoch)


def test_failed_epoch_goes_to_the_dead_letters_as_a_whole(spark, tmp_path):
    store = BrokenStore(spark, str(tmp_path / "t"), "fraud_alerts")
    MicroBatchWriter(store, "s")(frame(spark, [event("a", is_fraud=1), event("b")]), 0)
    for name in ("stream_staging", "transactions", "fraud_alerts"):
        assert store.read(name).count() == 0, name
    letters = store.read("dead_letters").collect()
    assert sorted(row.key for row in letters) == ["a", "b"]
    assert {row._dlq_reason for row in letters} == {"OSError: fraud_alerts is full"}


def test_failing_dead_letters_fail_the_epoch(spark, tmp_path):
    store = BrokenStore(spark, str(tmp_path / "t"), "transactions", "dead_letters")
    with pytest.raises(OSError, match="dead_letters is full"):
        MicroBatchWriter(store, "s")(frame(spark, [event("a")]), 0)


def test_stored_batch_rows_win_over_stream_rows(spark, store):
    row = frame(spark, [event("a")])
    loaded = events.transaction_rows(events.with_event_time(row), F.current_timestamp())
    store.publish("transactions", loaded, "load-1", "batch")
    store.publish_keys("transactions", loaded.select("trans_id"), "load-1")
    MicroBatchWriter(store, "s")(frame(spark, [event("a", is_fraud=1), event("b")]), 0)
    stored = {(r.trans_id, r.source) for r in store.read("transactions").collect()}
    assert stored == {("a", "batch"), ("b", "stream")}
    assert ids(store, "fraud_alerts") == []


def test_guard_finds_a_number_that_comes_back_with_any_time(spark, store):
    writer = MicroBatchWriter(store, "s")
    writer(frame(spark, [event("a", trans_date_trans_time="2020-01-01 00:00:00")]), 0)
    writer(frame(spark, [event("a", trans_date_trans_time="2024-06-01 00:00:00"), event("b")]), 1)
    assert ids(store, "transactions") == ["a", "b"]


def bytes_read(spark, run) -> int:
    """Bytes that the tasks of ``run`` read from storage."""
    context, group = spark.sparkContext, f"read-{time.time()}"
    context.setJobGroup(group, group)
    run()
    context.setJobGroup("", "")
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    tracker, status = context.statusTracker(), context._jsc.sc().statusStore()
    stages = {k for job_id in tracker.getJobIdsForGroup(group) for k in tracker.getJobInfo(job_id).stageIds}
    return sum(status.lastStageAttempt(k).inputBytes() for k in stages)


def test_guard_reads_a_few_pages_of_ten_million_keys(spark, store):
    numbers = F.md5(F.col("id").cast("string").cast("binary"))
    store.publish_keys("transactions", spark.range(10_000_000).select(numbers.alias("trans_num")), "load-1")
    wanted = spark.range(9_999_950, 10_000_050).select(numbers.alias("trans_num")).persist()
    hashes = first_hashes(wanted, "trans_num")
    found = []
    few = bytes_read(spark, lambda: found.extend(store.unseen("transactions", wanted, "trans_num", "s-0", hashes).collect()))
    expected = spark.range(10_000_000, 10_000_050).select(numbers.alias("n")).collect()
    assert sorted(r.trans_num for r in found) == sorted(r.n for r in expected)
    stored = sum(p.stat().st_size for p in Path(store.root).rglob("*.parquet"))
    assert 0 < few < 0.05 * stored, (few, stored)
    # Without hashes one pass over all keys gives the same.
    whole = store.unseen("transactions", wanted, "trans_num", "s-0").collect()
    assert sorted(whole) == sorted(found)
    assert store.unseen("transactions", wanted, "trans_num", "load-1", hashes).count() == 100
    wanted.unpersist()


def test_lookups_of_more_keys_than_are_sent_take_one_pass(spark, store):
    rows = spark.range(5_000).select(F.col("id").cast("string").alias("trans_num"))
    store.publish_keys("transactions", rows.filter("trans_num % 2 = 0"), "load-1")
    assert first_hashes(rows, "trans_num") is None
    few = rows.filter("trans_num < 600")
    hashes = first_hashes(few, "trans_num")
    assert len(hashes) == 600 and store.unseen("transactions", few, "trans_num", "x", hashes).count() == 300
    assert store.unseen("transactions", rows, "trans_num", "x").count() == 2_500


def test_closed_epochs_keep_rows_batches_and_the_guard(spark, store):
    writer = MicroBatchWriter(store, "s")
    for epoch in range(5):
        writer(frame(spark, [event(f"t{epoch}{i}", is_fraud=i) for i in range(2)] + [event(None)]), epoch)
    MicroBatchWriter(store, "other")(frame(spark, [event("o")]), 0)
    names = ("transactions", "fraud_alerts", "stream_staging", "dead_letters")

    def stored():
        return {n: sorted(map(str, store.read(n, with_batch_id=True).collect())) for n in names}

    before = stored()
    assert len(before["transactions"]) == 11 and len(before["dead_letters"]) == 5
    for through in (1, 1, 3):  # safe to repeat
        store.close_epochs("s", through)
        assert stored() == before
    assert sorted(p.name for p in Path(store.root, "epochs/stream=s").iterdir()) == ["epoch=4"]
    writer(frame(spark, [event("t00"), event("t30"), event("t40"), event("o"), event("new")]), 9)
    assert ids(store, "transactions") == sorted(["o", "new", *(f"t{e}{i}" for e in range(5) for i in range(2))])
    writer(frame(spark, [event("late")]), 2)  # an epoch that was closed is published already
    assert "late" not in ids(store, "transactions")


def test_closing_that_stops_half_way_shows_every_row_once(spark, store, monkeypatch):
    from riskflow.sources import tables

    writer = MicroBatchWriter(store, "s")
    for epoch in range(2):
        writer(frame(spark, [event(f"t{epoch}")]), epoch)

    def fail(*_, **__):
        raise OSError("stopped")

    for broken in ("_move", "remove_dir"):  # before the merged rows appear, and before the single ones go
        with monkeypatch.context() as patch:
            patch.setattr(*((store, "_move") if broken == "_move" else (tables, broken)), fail)
            with pytest.raises(OSError):
                store.close_epochs("s", 1)
        assert ids(store, "transactions") == ["t0", "t1"]
    store.close_epochs("s", 1)
    assert ids(store, "transactions") == ["t0", "t1"] and not list(Path(store.root, "epochs/stream=s").iterdir())


def test_tables_of_an_epoch_appear_together(spark, store, monkeypatch):
    """A reader at any moment of the write sees all targets or none; one job writes them."""
    writer, seen, move = MicroBatchWriter(store, "s"), [], store._move
    names = ("transactions", "fraud_alerts", "stream_staging", "dead_letters")

    def watched(*args, **options):
        seen.append([store.read(n).count() for n in names])
        move(*args, **options)
        seen.append([store.read(n).count() for n in names])

    monkeypatch.setattr(store, "_move", watched)
    writer(frame(spark, [event("a", is_fraud=1), event("b"), event(None)]), 0)
    assert seen == [[0, 0, 0, 0], [2, 1, 2, 1]]
    writer(frame(spark, [event("a"), event("c")]), 1)
    assert seen[2:] == [[2, 1, 2, 1], [3, 1, 4, 1]]


def test_small_epoch_writes_a_file_for_each_target(spark, store):
    rows = frame(spark, [event(f"t{i}", is_fraud=i % 2) for i in range(50)] + [event(None)]).repartition(8)
    MicroBatchWriter(store, "s")(rows, 0)
    files = [p.parent.name for p in Path(store.root, "epochs").rglob("*.parquet")]
    assert sorted(files) == [f"target={n}" for n in ("_keys", "dead_letters", "fraud_alerts", "stream_staging", "transactions")]


def test_dead_letters_go_to_their_topic(spark, store, tmp_path):
    root = str(tmp_path / "topics")
    writer = MicroBatchWriter(store, "s", topics=sources.json_topics(root))
    writer(frame(spark, [event("a"), event("b", amt=None)]), 0)
    sent = spark.read.json(f"{root}/{sources.DEAD_LETTER_TOPIC}")
    assert [r.key for r in sent.collect()] == ["b"]


def test_late_events_count_in_their_window(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("inbox", "out", "checkpoint"))
    schema = "at timestamp"
    for times in (["2024-01-01 10:00:01", "2024-01-01 12:00:01"], ["2024-01-01 10:00:02"]):
        rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("at"))
        rows.coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        job.drain(job.rate_to(stream, "at", out, checkpoint, once=True))
    found = {str(r.window_start): r.events for r in job.recorded_rate(spark, out).collect()}
    assert found == {"2024-01-01 10:00:00": 2, "2024-01-01 12:00:00": 1}


def test_unguarded_writer_leaves_repeats_to_the_state(spark, store):
    writer = MicroBatchWriter(store, "s", guard_stored=False)
    for epoch in (0, 1):
        writer(frame(spark, [event("a"), event("a")]), epoch)
    assert ids(store, "transactions") == ["a", "a"]


def test_topics_receive_enriched_events_and_alerts(spark, store, tmp_path):
    root = str(tmp_path / "topics")
    writer = MicroBatchWriter(store, "s", topics=sources.json_topics(root))
    rows = frame(spark, [event("a", is_fraud=1), event("b")])
    writer(rows, 0)
    writer(rows, 0)
    enriched = spark.read.json(f"{root}/{sources.ENRICHED_TOPIC}")
    assert sorted(row.key for row in enriched.collect()) == ["a", "b"]
    alert = spark.read.json(f"{root}/{sources.ALERT_TOPIC}").first()
    assert json.loads(alert.value)["alert_reason"] == "high-risk category: grocery_pos"


@pytest.mark.parametrize("kind", ["json", "parquet"])
def test_payload_streams_need_no_decoding(spark, store, tmp_path, kind):
    inbox = str(tmp_path / "inbox")
    frame(spark, [event("a"), event("b")]).write.format(kind).save(inbox)
    stream = sources.read_raw(spark, kind, inbox)
    job.drain(job.start_stream(stream, store, str(tmp_path / "c"), once=True))
    assert ids(store, "transactions") == ["a", "b"]


def test_unknown_source_is_refused(spark):
    with pytest.raises(ValueError):
        sources.read_raw(spark, "carrier pigeon", "coop")


def test_running_query_stops_after_its_epoch(spark, store, tmp_path):
    drop_file(spark, tmp_path / "inbox", "1.json", [event("a")])
    stream = sources.read_raw(spark, "text", str(tmp_path / "inbox"))
    query = job.start_stream(stream, store, str(tmp_path / "c"), trigger_seconds=1)
    query.processAllAvailable()
    job.stop(query)
    assert not query.isActive and ids(store, "transactions") == ["a"]


def test_messages_survive_encoding_and_decoding(spark):
    rows = frame(spark, [event("a"), event("b", category=None, is_fraud=1)])
    decoded = events.decode(files.to_messages(rows)).drop(events.CORRUPT)
    assert sorted(decoded.collect(), key=str) == sorted(rows.collect(), key=str)


def test_message_keys(spark):
    keys = files.to_messages(frame(spark, [event("a"), event(None), event("")])).collect()
    assert keys[0].key == "a" and keys[1].key and keys[2].key


def test_payload_defaults(spark):
    row = spark.createDataFrame([("a", None, "x1")], "trans_num string, amt double, city_pop string")
    payload = files.to_payload(row, F.lit("now"))
    assert payload.schema.names == RAW_EVENT.names
    first = payload.first()
    assert (first.amt, first.city_pop) == (None, None)  # null, or no number
    assert (first.lat, first.cc_num, first.is_fraud, first.merchant) == (0.0, 0, 0, None)  # absent
    assert (first.zip, first.dob, first.produced_at) == ("None", "None", "now")


def test_first_seen_keys_are_remembered_across_epochs(spark, store, tmp_path):
    inbox, checkpoint = str(tmp_path / "inbox"), str(tmp_path / "checkpoint")
    for rows in ([event("a"), event("a"), event("b")], [event("b"), event("c")]):
        frame(spark, rows).coalesce(1).write.mode("append").json(inbox)
        stream = sources.read_raw(spark, "json", inbox, maxFilesPerTrigger="1")
        job.drain(job.first_seen_to(stream, "trans_num", store, "seen", checkpoint, once=True))
    kept = spark.read.parquet(store.path("seen")).collect()
    assert sorted(r.trans_num for r in kept) == list("abc")


def test_replay_files_are_in_event_order(spark, tmp_path):
    rows = [event(f"t{i}", unix_time=(i * 37) % 101) for i in range(101)]
    files.write_replay(frame(spark, rows), str(tmp_path / "replay"))
    times = []
    for part in sorted((tmp_path / "replay").glob("part-*")):
        times += [json.loads(line)["unix_time"] for line in part.read_text().splitlines()]
    assert times == sorted(times) and len(times) == 101


def test_peek_and_depth(spark):
    letters = spark.range(50).select(
        F.col("id").cast("string").alias("_dlq_at"), F.lit("k").alias("key"), F.lit("v").alias("value")
    )
    assert dead_letters.peek(letters).count() == 20
    depth = spark.createDataFrame([("a", 0), ("b", 3)], "topic string, depth long")
    rows = {r.topic: r.action for r in dead_letters.depth_status(depth).collect()}
    assert rows == {"a": "no_action", "b": "alert_team"}


def test_consumer_lag_from_progress(spark):
    progress = {
        "sources": [
            {
                "description": "KafkaV2[Subscribe[raw]]",
                "endOffset": {"raw": {"0": 10, "1": 4}},
                "latestOffset": '{"raw": {"0": 15, "1": 4}}',
            },
            {"description": "FileStreamSource", "endOffset": None, "latestOffset": None},
        ]
    }
    rows = job.consumer_lag(spark, progress).orderBy("partition").collect()
    assert [(r.topic, r.partition, r.lag) for r in rows] == [("raw", 0, 5), ("raw", 1, 0)]


def test_work_folders_are_fresh_and_shared(spark):
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    root = spark.conf.get("spark.checkpoint.dir")
    assert first != second and first.startswith(root) and second.startswith(root)


def test_topics_are_stored_compressed(spark, store, tmp_path):
    root = str(tmp_path / "topics")
    writer = MicroBatchWriter(store, "s", topics=sources.json_topics(root))
    writer(frame(spark, [event("a", is_fraud=1), event("b", amt=None)]), 0)
    found = [p for p in Path(root).rglob("part-*") if p.stat().st_size]
    assert found and all(p.name.endswith(".json.gz") for p in found)


def test_replay_files_can_be_compressed(spark, tmp_path):
    rows = [event(f"t{i}", unix_time=(i * 37) % 101) for i in range(101)]
    files.write_replay(frame(spark, rows), str(tmp_path / "replay"), compression="gzip")
    assert all(p.name.endswith(".gz") for p in (tmp_path / "replay").glob("part-*"))
    assert spark.read.text(str(tmp_path / "replay")).count() == 101


def test_large_epoch_is_written_where_it_lies(spark, store, monkeypatch):
    from riskflow.sources import key_runs, tables
    from riskflow.streaming import writer

    monkeypatch.setattr(key_runs, "MOST_SENT", 20)
    monkeypatch.setattr(tables, "LARGE_ROWS", 20)
    monkeypatch.setattr(writer, "LARGE_ROWS", 20)
    rows = frame(spark, [event(f"t{i % 40}", is_fraud=i % 2) for i in range(60)] + [event(None)])
    plans, publish = [], store.publish_epoch

    def watched(tagged, *where):
        plans.append(tagged._jdf.queryExecution().optimizedPlan().toString())
        publish(tagged, *where)

    monkeypatch.setattr(store, "publish_epoch", watched)
    MicroBatchWriter(store, "s")(rows, 0)
    assert "RebalancePartitions" not in plans[0]
    assert "Join" not in plans[0]  # nothing is stored yet
    counts = [store.read(n).count() for n in ("stream_staging", "transactions", "dead_letters")]
    assert counts == [60, 40, 1]
    MicroBatchWriter(store, "s")(frame(spark, [event(f"t{i}") for i in range(60)]), 1)
    store.close_epochs("s", 1)
    assert [store.read(n).count() for n in ("stream_staging", "transactions", "dead_letters")] == [120, 60, 1]


def test_falls_are_counted_across_days_and_overlaps_with_any_file_before(spark, tmp_path):
    """Time falls from a later day to an earlier one, over a line without time; one file spans two others."""
    day = 86400
    files_of = {"a": [1, 9 * day], "b": [3 * day + 5, 2 * day + 7, None, day], "c": [4 * day, 4 * day], "d": [10 * day]}
    for name, moments in files_of.items():
        (tmp_path / f"{name}.txt").write_text("".join(json.dumps({"unix_time": at}) + "\n" for at in moments))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "24")  # a line or two; pieces of a file in several tasks
    try:
        found = files.replay_measures(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.measure: r.value for r in found} == {"messages": 9, "falls": 2, "overlaps": 2}
    whole = files.replay_measures(spark, str(tmp_path)).collect()
    assert sorted(whole) == sorted(found)
