"""First-occurrence-wins deduplication and insert-if-absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_wins(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], *, rare_repeats: bool = False,
    deal_by: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the earliest by ``order_by``, remaining columns break ties.

    ``min`` over a struct merges on the map side, so a key holding most of the rows leaves each
    task as one candidate row. A struct has no place in a hash table of fixed width, so each task
    sorts its rows by key before it merges them, before and after the exchange. Where keys hardly
    repeat the first of these sorts is for nothing: with ``rare_repeats`` rows are exchanged as
    they are and sorted once, by ``deal_by``, a part of the key that a join after it needs as well.
    """
    if rare_repeats:
        df = df.repartition(*(deal_by or keys))
    lead = [name for name in order_by if name not in keys]
    rest = [name for name in df.columns if name not in keys and name not in lead]
    if not lead and not rest:
        return df.select(*keys).distinct()
    earliest = F.min(F.struct(*lead, *rest)).alias("_earliest")
    return (
        df.groupBy(*keys).agg(earliest).select(*keys, "_earliest.*").select(*df.columns)
    )


def absent_from(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key is not stored yet; only key columns of ``existing`` are read."""
    return new.join(existing.select(*keys), list(keys), "left_anti")


def absent_from_large(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``absent_from`` for a small ``new`` against a huge ``existing``.

    The stored keys are first cut down to those that occur in ``new``. When statistics say that
    ``new`` fits a broadcast, the huge side is filtered where it lies and is never shuffled;
    otherwise Catalyst falls back to a shuffled semi join with the same result.
    """
    clashes = existing.select(*keys).join(new.select(*keys), list(keys), "left_semi")
    return absent_from(new, clashes, keys)


def insert_if_absent(
    new: DataFrame, existing: DataFrame, keys: Sequence[str], order_by: Sequence[str]
) -> DataFrame:
    """Rows to append: first occurrence per key, and only keys that are not stored.

    Deduplication comes first: it shrinks repeated keys before the shuffle, and its output is
    already partitioned by the key the anti join needs.
    """
    return absent_from(first_wins(new, keys, order_by), existing, keys)
