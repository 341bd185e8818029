"""Shared helpers: scratch folders, text as bytes, materialised tables."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, for their Python workers."""
    context = spark.sparkContext
    if getattr(context, "_llm_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="llm-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))  # the driver serves the file
    context._llm_shipped = True


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local master that names no folder gets a temporary one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut."""
    spark, path = df.sparkSession, scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, purpose: str, **options) -> DataFrame:
    """Store ``df`` bucketed by a column, in as many buckets as shuffles have partitions.

    What is joined or grouped by that column later moves to these rows, not the rows to it. Spark keeps
    buckets for catalog tables only, so the entry is made, read once, and taken out again; the files stay.
    """
    spark, name = df.sparkSession, f"llm_{purpose}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column)
    writer.options(path=scratch(spark, purpose), **options).saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved while the entry is there
    spark.sql(f"DROP TABLE `{name}`")
    return table


def by_size(table: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """A stored table, marked for broadcast if it has ``most_rows`` narrow rows at most.

    Beyond that Spark joins it by a shuffle, with the same result.
    """
    return F.broadcast(table) if table.count() <= most_rows else table


def utf8(column: str) -> Column:
    """The column's bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def in_slices(column, most_bytes: int = 4 << 20):
    """Starts and stops of runs of rows of an Arrow column of texts, a few megabytes each."""
    return slices_of(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), most_bytes)


def slices_of(sizes: np.ndarray, most: int):
    """Starts and stops of runs of rows whose sizes add up to ``most`` at most; a larger row is alone."""
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield start, stop
        start = stop


def crc_mod(column: str, divisor: int) -> Column:
    """crc32 of the value written as text, modulo ``divisor``; null hashes as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def free_name(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores added while the (case-blind) name is taken."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted += "_"
    return wanted

