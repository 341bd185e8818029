"""Stored keys in sorted runs, of which a lookup reads only the pages that can hold its keys.

A run is one load's or one period's keys with their 64-bit hash, sorted by hash, in few files with
small pages. Parquet keeps the smallest and largest hash of each page, so a filter of single hashes
reads a page for each of them and skips the rest of the file. Equal hashes are told apart by the key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a page: some 30 KB. A dictionary would have to be read before any page.
RUN_OPTIONS = {"parquet.page.row.count.limit": 1_000, "parquet.enable.dictionary": "false"}
# Keys of a lookup that are sent to the scan; more than that touch so many pages that one pass over all is right.
MOST_SENT = 2_048
_SENT_AT_ONCE = 256


def key_hash(key: Column) -> Column:
    return F.xxhash64(key.cast("string"))


def hashed_keys(keys: DataFrame) -> DataFrame:
    """``h, key`` of the one column of ``keys``."""
    key = F.col(keys.columns[0]).cast("string")
    return keys.select(key_hash(key).alias("h"), key.alias("key"))


def write_run(hashed: DataFrame, path: str, few: bool = False) -> None:
    """Store a run; ``few`` keys make one file, others as many as their bytes need."""
    dealt = hashed.coalesce(1) if few else hashed.repartitionByRange("h")
    dealt.sortWithinPartitions("h").write.options(**RUN_OPTIONS).mode("overwrite").parquet(path)


def first_hashes(rows: DataFrame, key: str) -> list[int] | None:
    """The distinct hashes of a small batch; None if there are more than are sent to a scan."""
    found = rows.select(key_hash(F.col(key)).alias("h")).distinct().limit(MOST_SENT + 1).collect()
    return sorted(row.h for row in found) if len(found) <= MOST_SENT else None


def with_hashes(stored: DataFrame, hashes: list[int]) -> DataFrame:
    """Stored keys with one of the hashes.

    Neighbouring hashes go into one scan. An ``IN`` would reach the files as one wide range, a
    disjunction of equalities goes down to the page.
    """
    groups = [hashes[k : k + _SENT_AT_ONCE] for k in range(0, len(hashes), _SENT_AT_ONCE)]
    scans = [stored.filter(" OR ".join(f"h = {h}" for h in g)) for g in groups]
    return reduce(DataFrame.unionByName, scans)
