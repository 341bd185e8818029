"""Session settings shared by every job."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings; none of them fixes a partition count, AQE sizes shuffles from their bytes.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed key is worth one more shuffle of the (already reduced) join output.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A task holds this many directories open at once, and sorts its rows only when there are more.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # Keyed state lives on local disk and is checkpointed as changes, not held in the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app_name: str = "riskflow", master: str | None = None, **extra: str
) -> SparkSession:
    """Build a session; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh directory below the shared folder named by ``spark.checkpoint.dir``.

    Only a local master, whose executor is the driver, may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="riskflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query that is put together and run within go when it ends.

    Otherwise they stay until the driver's memory is next cleared.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def land(df: DataFrame, path: str) -> DataFrame:
    """Rows as compressed Parquet, which takes a fraction of the disk that the shuffles behind them or a cache take."""
    with shuffles_removed(df.sparkSession):
        df.select("*").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that ``path`` is on, and the path as that knows it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a scratch directory on whatever file system it is."""
    files, target = file_system(spark, path)
    files.delete(target, True)
