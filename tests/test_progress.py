"""Progress reports, lag per trigger, windowed counts as streaming state, and functions for SQL."""

import pytest
from pyspark.sql import functions as F

from riskflow.functions import alert_reason, haversine_km, is_alert, risk_score, sql
from riskflow.streaming import job, progress


@pytest.fixture
def reports(spark, tmp_path):
    listener = progress.ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    yield lambda: (progress.flush(spark), progress.reports(spark, listener.path))[1]
    spark.streams.removeListener(listener)


def drop(spark, inbox, times):
    rows = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("at"))
    rows.coalesce(1).write.mode("append").parquet(inbox)


def test_lag_of_each_trigger(spark, tmp_path, reports):
    inbox = str(tmp_path / "inbox")
    for size in (3, 1, 2):
        spark.range(size).coalesce(1).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(inbox)
    for _ in range(2):  # started again with nothing new, it reads nothing
        query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
        job.drain(query.trigger(availableNow=True).start())
    found = progress.trigger_lag(reports(), spark.read.parquet(inbox).count()).orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows, r.received, r.lag) for r in found] == [(0, 3, 3, 3), (1, 1, 4, 2), (2, 2, 6, 0)]
    assert len({r.id for r in found}) == 1


def count(spark, tmp_path, late_after="10 minutes"):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("inbox", "out", "checkpoint"))
    stream = spark.readStream.schema("at timestamp").option("maxFilesPerTrigger", 1).parquet(inbox)
    job.drain(job.rate_state_to(stream, "at", out, checkpoint, late_after=late_after, once=True))
    return {str(r.window_start): r.events for r in job.current_rate(spark, out).collect()}


def test_windows_are_kept_up_to_date_and_late_rows_counted(spark, tmp_path, reports):
    inbox = str(tmp_path / "inbox")
    drop(spark, inbox, ["2024-01-01 23:59:50", "2024-01-01 23:59:59", "2024-01-02 00:00:01"])
    assert count(spark, tmp_path) == {"2024-01-01 23:59:45": 2, "2024-01-02 00:00:00": 1}
    drop(spark, inbox, ["2024-01-01 23:59:45", "2024-01-02 12:00:00"])  # late by seconds only
    assert count(spark, tmp_path)["2024-01-01 23:59:45"] == 3
    drop(spark, inbox, ["2024-01-01 23:59:46", "2024-01-01 23:59:47", "2024-01-02 11:59:59"])  # two are half a day late
    windows = count(spark, tmp_path)
    assert windows == {
        "2024-01-01 23:59:45": 3, "2024-01-02 00:00:00": 1, "2024-01-02 12:00:00": 1, "2024-01-02 11:59:45": 1
    }
    late = progress.late_rows(reports(), job.current_rate(spark, str(tmp_path / "out"))).first()
    assert (late.received, late.counted, late.late) == (8, 6, 2)


def test_state_holds_the_windows_within_the_delay(spark, tmp_path, reports):
    """However long the stream runs: twelve hours in twelve epochs leave no more than the last ones in state."""
    for hour in range(12):
        drop(spark, str(tmp_path / "inbox"), [f"2024-01-01 {hour:02}:{minute:02}:00" for minute in range(0, 60, 10)])
    windows = count(spark, tmp_path)
    assert len(windows) == 72 and set(windows.values()) == {1}
    kept = reports().select(F.explode("stateOperators").alias("s")).agg(F.max("s.numRowsTotal")).first()[0]
    assert kept <= 6 + 6 + 2
    assert job.current_rate(spark, str(tmp_path / "out")).count() == 72


def test_replayed_epoch_of_windows_changes_nothing(spark, tmp_path):
    import shutil

    drop(spark, str(tmp_path / "inbox"), ["2024-01-01 10:00:00", "2024-01-01 10:00:01"])
    before = count(spark, tmp_path)
    commits = tmp_path / "checkpoint" / "commits"
    moved = tmp_path / "moved"
    moved.mkdir()
    for path in list(commits.iterdir()):
        shutil.copy(path, moved / path.name)
        path.unlink()  # as if the epoch had been stopped before its commit
    assert count(spark, tmp_path) == before == {"2024-01-01 10:00:00": 2}


def test_functions_in_sql_equal_the_column_functions(spark):
    sql.register(spark)
    rows = spark.createDataFrame(
        [(1.0, 2.0, 3.0, 4.0, 800.5, "\tMISC_pos", 1), (89.9, 0.0, -89.9, 180.0, 10.0, None, 0), (None, 1.0, 1.0, 1.0, None, "travel", 0)],
        "a double, b double, c double, d double, amt double, category string, label int",
    )
    km = haversine_km(*[F.col(n) for n in "abcd"])
    score = risk_score(F.col("amt"), km, F.col("category"))
    want = rows.select(km, score, alert_reason(F.col("amt"), km, F.col("category")), is_alert(F.col("label"), score)).collect()
    rows.createOrReplaceTempView("purchases")
    got = spark.sql(
        """SELECT km, risk_score(amt, km, category), alert_reason(amt, km, category), is_alert(label, risk_score(amt, km, category))
           FROM (SELECT *, haversine_km(a, b, c, d) AS km FROM purchases)"""
    )
    assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
