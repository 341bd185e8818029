"""Progress reports of running queries, kept as files, and what they say about lag and late rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from riskflow.session import file_system

REPORT = """id string, batchId long, timestamp timestamp, numInputRows long,
    sources array<struct<description: string, startOffset: string, endOffset: string,
        latestOffset: string, numInputRows: long>>,
    stateOperators array<struct<numRowsTotal: long, numRowsUpdated: long, numRowsDroppedByWatermark: long>>"""


class ProgressLog(StreamingQueryListener):
    """Stores each progress report below ``path``, one small file per query and trigger.

    A trigger that is run again replaces its report. Register it with ``spark.streams.addListener``.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        files, path = file_system(self.spark, f"{self.path}/query={progress.id}/{progress.batchId}.json")
        out = files.create(path, True)
        try:
            out.write(bytearray(progress.json.replace("\n", " "), "utf-8"))
        finally:
            out.close()


def flush(spark: SparkSession, patience_ms: int = 30_000) -> None:
    """Wait until the listeners have seen all events so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(patience_ms)


def reports(spark: SparkSession, path: str) -> DataFrame:
    """The stored reports, one row per query and trigger."""
    lines = spark.read.text(f"{path}/query=*", wholetext=True)
    return lines.select(F.from_json("value", REPORT).alias("r")).select("r.*")


def trigger_lag(found: DataFrame, available: int) -> DataFrame:
    """``id, batch_id, input_rows, received, available, lag`` of every trigger that read rows.

    ``available`` is the number of rows that the source holds. A file source reports no latest offset,
    so what is left to read is what is there less what has been received.
    """
    so_far = Window.partitionBy("id").orderBy("batchId")  # one row per trigger
    received = F.sum("numInputRows").over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    rows = found.filter("numInputRows > 0").select(
        "id",
        F.col("batchId").alias("batch_id"),
        F.col("numInputRows").alias("input_rows"),
        received.alias("received"),
        F.lit(available).cast("long").alias("available"),
    )
    return rows.withColumn("lag", F.col("available") - F.col("received"))


def late_rows(found: DataFrame, windows: DataFrame) -> DataFrame:
    """``received, counted, late``: rows a windowed count has read, counted, and left out as too late."""
    none = F.lit(0).cast("long")
    read = found.select(F.col("numInputRows").alias("received"), none.alias("counted"))
    kept = windows.select(none.alias("received"), F.col("events").alias("counted"))
    sums = read.unionByName(kept).agg(*[F.coalesce(F.sum(n), none).alias(n) for n in ("received", "counted")])
    return sums.withColumn("late", F.col("received") - F.col("counted"))
