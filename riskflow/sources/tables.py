"""Stored tables: Parquet directories whose loads and epochs can be repeated safely.

A batch load owns one ``batch_id`` directory per table (below ``source=`` for transactions) and
replaces it as a whole. A stream epoch owns one directory with the rows of all its tables, which
appears by one rename, so a reader sees all tables of an epoch or none. Epochs of a closed period are
merged into one directory whose name says through which epoch it goes; from the moment it appears
readers pass over these epochs.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators.dedup import absent_from_large
from riskflow.schemas import TABLES
from riskflow.session import file_system, remove_dir
from riskflow.sources.key_runs import hashed_keys, with_hashes, write_run

BY_SOURCE = ("transactions",)  # tables with a source= directory level
LARGE_ROWS = 1_000_000  # rows beyond which an epoch is written without being dealt into even files
KEYS = "_keys"  # the target of an epoch's transaction keys
KEY_STRUCT = T.StructType([T.StructField("h", T.LongType()), T.StructField("key", T.StringType())])


class TableStore:
    """Tables below one root folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str, with_batch_id: bool = False) -> DataFrame:
        """A stored table with its declared schema; empty when nothing was published yet."""
        batch = T.StructField("batch_id", T.StringType(), True)
        loads = self._scan(self.path(name), T.StructType([*TABLES[name].fields, batch]))
        columns = [*TABLES[name].names, "batch_id"]
        parts = [loads.select(*columns), *(part.select(*columns) for part in self._epoch_parts(name, TABLES[name]))]
        rows = reduce(DataFrame.unionByName, parts)
        return rows if with_batch_id else rows.drop("batch_id")

    def _scan(self, path: str, schema: T.StructType, base: str | None = None) -> DataFrame:
        """What is stored below ``path``; empty when nothing was published yet."""
        reader = self.spark.read.schema(schema)
        if base is not None:
            reader = reader.option("basePath", base)
        try:
            return reader.parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            # Known to be empty when a plan is made, so that joins with it and their exchanges fall away.
            return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).limit(0)

    def read_others(self, name: str, batch_id: str) -> DataFrame:
        """The table without the rows of one batch; a partition filter, not a row filter."""
        return self.read(name, with_batch_id=True).filter(F.col("batch_id") != batch_id)

    # Batch loads

    def batch_path(self, name: str, batch_id: str, source: str) -> str:
        level = f"/source={source}" if name in BY_SOURCE else ""
        return f"{self.path(name)}{level}/batch_id={batch_id}"

    def publish(self, name: str, rows: DataFrame, batch_id: str, source: str) -> None:
        """Replace what ``batch_id`` wrote before with ``rows``, even if these are empty."""
        in_path = frozenset({"source"} if name in BY_SOURCE else ())
        typed = rows.select(*typed_columns(name, in_path))
        typed.write.mode("overwrite").parquet(self.batch_path(name, batch_id, source))

    def count(self, name: str, batch_id: str, source: str) -> int:
        """Rows that a batch has stored, from the footers of its own files."""
        return self.spark.read.parquet(self.batch_path(name, batch_id, source)).count()

    # Stream epochs

    @property
    def _epochs(self) -> str:
        return f"{self.root}/epochs"

    def _epoch_path(self, stream: str, epoch: int) -> str:
        return f"{self._epochs}/stream={stream}/epoch={epoch}"

    def has_epoch(self, stream: str, epoch: int) -> bool:
        """Whether the epoch was published; a published epoch is whole."""
        files, path = file_system(self.spark, self._epoch_path(stream, epoch))
        return files.exists(path) or epoch <= self._closed().get(stream, -1)

    def publish_epoch(self, tagged: DataFrame, stream: str, epoch: int) -> None:
        """Publish the rows of all tables of an epoch at once, unless it is published already.

        ``tagged`` has a ``target`` and one struct column per table, of which that of the target is
        set. They are written aside by one job, and one rename lets them appear. On object stores,
        where a rename copies, readers may see an epoch grow. Rows are written where they are, the caller deals them out.
        """
        aside = f"{self.root}/_writing/{uuid.uuid4().hex}"
        tagged.write.partitionBy("target").parquet(aside)
        self._move(aside, self._epoch_path(stream, epoch), unless=lambda: self.has_epoch(stream, epoch))

    def _move(self, aside: str, place: str, unless) -> None:
        files, source = file_system(self.spark, aside)
        _, target = file_system(self.spark, place)
        files.mkdirs(target.getParent())
        if unless():
            files.delete(source, True)
        elif not files.rename(source, target):
            raise OSError(f"{aside} could not be renamed to {place}")

    def epoch_counts(self, stream: str, epoch: int) -> dict[str, int]:
        """Stored rows of an epoch by table, from the footers of its files."""
        rows = self._scan(self._epoch_path(stream, epoch), T.StructType([T.StructField("target", T.StringType())]))
        return {row.target: row["count"] for row in rows.groupBy("target").count().collect()}

    def _closed(self) -> dict[str, int]:
        """For each stream with merged epochs, the last of them, as the directories say."""
        out: dict[str, int] = {}
        for stream in children(self.spark, f"{self.root}/closed"):
            ends = [int(n.partition("=")[2]) for n in children(self.spark, f"{self.root}/closed/{stream}")]
            if ends:
                out[stream.partition("=")[2]] = max(ends)
        return out

    def _epoch_parts(self, name: str, fields: T.StructType) -> list[DataFrame]:
        """A table's rows in single epochs and in merged ones, with ``stream``, ``epoch`` and ``batch_id``."""
        where = [T.StructField("stream", T.StringType()), T.StructField("epoch", T.LongType())]
        held = [T.StructField(name, fields), *where, T.StructField("target", T.StringType())]
        parts, closed = [], self._closed()
        if children(self.spark, self._epochs):
            live = self._scan(f"{self._epochs}/stream=*/epoch=*/target={name}", T.StructType(held), self._epochs)
            for stream, last in closed.items():
                live = live.filter((F.col("stream") != stream) | (F.col("epoch") > last))
            parts.append(live)
        if closed:
            # Merged rows keep their epoch as a column.
            parts.append(self._scan(f"{self.root}/closed/stream=*/through=*/target={name}", T.StructType(held), f"{self.root}/closed"))
        batch = F.concat_ws("-", "stream", "epoch").alias("batch_id")
        return [part.select(f"{name}.*", "stream", "epoch", batch) for part in parts]

    def close_epochs(self, stream: str, through: int) -> None:
        """Merge the epochs up to ``through`` into few files; their keys become a sorted run.

        The rename that lets the merged directory appear is also what hides the single epochs, which
        are removed after it. Stopped anywhere, it can be run again. No epoch up to ``through`` may be
        written any more.
        """
        last = self._closed().get(stream, -1)
        if through > last:
            names = [*TABLES, KEYS]
            of_target = [T.StructField(n, TABLES.get(n, KEY_STRUCT)) for n in names]
            where = [T.StructField("target", T.StringType()), T.StructField("epoch", T.LongType())]
            path = f"{self._epochs}/stream={stream}"
            rows = self._scan(path, T.StructType([*of_target, *where]))
            rows = rows.filter(F.col("epoch").between(last + 1, through))
            aside = f"{self.root}/_writing/{uuid.uuid4().hex}"
            tables = rows.filter(F.col("target") != KEYS).drop(KEYS)
            if rows.count() <= LARGE_ROWS:  # from the footers; scans of more rows fill files as they are
                tables = tables.hint("rebalance", "target")
            tables.write.partitionBy("target").parquet(aside)
            write_run(rows.filter(F.col("target") == KEYS).select(f"{KEYS}.*"), f"{aside}/keys")
            place = f"{self.root}/closed/stream={stream}/through={through}"
            self._move(aside, place, unless=lambda: self._closed().get(stream, -1) >= through)
        for name in children(self.spark, f"{self._epochs}/stream={stream}"):
            if int(name.partition("=")[2]) <= through:
                remove_dir(self.spark, f"{self._epochs}/stream={stream}/{name}")

    # Keys: the hashed keys of a table's rows, in sorted runs and in the epochs themselves.

    def _key_path(self, name: str) -> str:
        return f"{self.root}/_keys_{name}"

    def publish_keys(self, name: str, keys: DataFrame, batch_id: str, few: bool = False) -> None:
        """Replace the keys of ``batch_id`` with the one column of ``keys``."""
        write_run(hashed_keys(keys), f"{self._key_path(name)}/batch_id={batch_id}", few)

    def stored_keys(self, name: str, other_than: str) -> DataFrame:
        """``h, key`` of the keys that other batches have stored."""
        fields = T.StructType([*KEY_STRUCT.fields, T.StructField("batch_id", T.StringType())])
        parts = [self._scan(self._key_path(name), fields)]
        if name == "transactions":
            if children(self.spark, self._epochs):
                parts.append(self._epoch_parts(KEYS, KEY_STRUCT)[0])
            if self._closed():
                merged = self._scan(f"{self.root}/closed/stream=*/through=*/keys", KEY_STRUCT)
                parts.append(merged.withColumn("batch_id", F.lit("")))
        others = [part.filter(F.col("batch_id") != other_than).select("h", "key") for part in parts]
        return reduce(DataFrame.unionByName, others)

    def unseen(self, name: str, new: DataFrame, key: str, batch_id: str, hashes: list[int] | None = None) -> DataFrame:
        """Rows of ``new`` whose key no other batch has stored.

        With the ``hashes`` of all its keys only pages that can hold them are read. Without, stored
        keys are cut down in one pass to those that occur in ``new``, which should be a batch of some size.
        """
        stored = self.stored_keys(name, batch_id)
        if hashes is not None:
            stored = with_hashes(stored, hashes) if hashes else stored.limit(0)
        keys = stored.select(F.col("key").cast(new.schema[key].dataType).alias(key))
        return absent_from_large(new, keys, [key])

    def compact_keys(self, name: str, batch_ids: list[str], period: str) -> None:
        """Merge the runs of closed batches into that of ``period``.

        Stopped half way and run again it may store a key twice, which a lookup reads as one.
        """
        fields = T.StructType([*KEY_STRUCT.fields, T.StructField("batch_id", T.StringType())])
        stored = self._scan(self._key_path(name), fields)
        merged = stored.filter(F.col("batch_id").isin(batch_ids)).select("h", "key")
        write_run(merged, f"{self._key_path(name)}/batch_id={period}")
        for batch_id in batch_ids:
            remove_dir(self.spark, f"{self._key_path(name)}/batch_id={batch_id}")

    def overwrite(self, name: str, rows: DataFrame) -> DataFrame:
        """Full rebuild of a derived table, read back from storage."""
        rows.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))


def typed_columns(name: str, without: frozenset[str] = frozenset()) -> list[Column]:
    """A table's columns, cast to their declared types."""
    fields = [f for f in TABLES[name].fields if f.name not in without]
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the directories below ``path``, none if there is no such path."""
    files, target = file_system(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target) if status.isDirectory()]


def show_in_database(spark: SparkSession, database: str, folders: dict[str, str]) -> None:
    """Views of a database over folders of Parquet files; replacing a view changes what it shows at once."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, folder in folders.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM parquet.`{folder}`")


def read_jdbc(
    spark: SparkSession, url: str, name: str, column: str, bounds: tuple, tasks: int
) -> DataFrame:
    """A database table read by ``tasks`` range queries. Needs the driver jar."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=name, partitionColumn=column, numPartitions=tasks)
        .options(lowerBound=bounds[0], upperBound=bounds[1], fetchsize=10_000)
        .load()
    )


def append_jdbc(rows: DataFrame, url: str, name: str, batch_size: int = 2_000) -> None:
    """Append to a database table with multi-row inserts. Needs the driver jar."""
    rows.write.format("jdbc").options(url=url, dbtable=name, batchsize=batch_size).mode(
        "append"
    ).save()
