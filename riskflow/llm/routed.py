"""Queries against shards of vectors: shards and query groups of bounded size meet in one task."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 4_096
QUERY_ROWS = 512


def finite_vectors(table: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``vec_id, v`` (array of double) of the rows whose id and vector are whole.

    Null vectors and vectors holding null or non-finite components take no part; empty ones neither.
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = table.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), v.alias("v"))
    return rows.filter(F.col("vec_id").isNotNull() & (F.size("v") > 0)).filter(whole)


def matrix(column: pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """List column of equal lengths as a matrix."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(lists), -1)


def best_per_query(
    candidates: DataFrame, queries: DataFrame, part: list[str], search: Callable, score_type: str, k: int,
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of ``search`` over all parts.

    ``candidates`` and ``queries`` have ``vec_id, v`` and the columns ``part``; a query may stand in
    several parts, a candidate stands in one. A part that holds many candidates is cut into shards, one
    with many queries into groups, so a task never sees more than ``shard_rows`` vectors and
    ``query_rows`` queries, give or take the evenness of a hash. ``search(ids, matrix, query ids, query
    matrix)`` returns query ids, vector ids and scores, at most k a query, which are merged by rank.
    """
    spark = candidates.sparkSession
    # As many rows as there are parts.
    shards = candidates.groupBy(*part).agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    groups = queries.groupBy(*part).agg(F.ceil(F.count("*") / query_rows).cast("int").alias("groups"))
    plan = shards.join(groups, part)

    def spread(rows: DataFrame, own: str, own_count: str, other: str, other_count: str, flag: bool) -> DataFrame:
        placed = rows.join(F.broadcast(plan), part).withColumn(own, F.pmod(F.xxhash64("vec_id", F.lit(own)), F.col(own_count)).cast("int"))
        return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1))).select(
            *part, "shard", "query_group", F.lit(flag).alias("is_query"), "vec_id", "v"
        )

    meeting = spread(candidates, "shard", "shards", "query_group", "groups", False).unionByName(
        spread(queries, "query_group", "groups", "shard", "shards", True)
    )
    kind = {"double": pa.float64(), "bigint": pa.int64()}[score_type]

    def compare(group: pa.Table) -> pa.Table:
        asked = group.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
        sides = [group.filter(pa.array(side)) for side in (~asked, asked)]
        if not all(s.num_rows for s in sides):
            found = (np.zeros(0, np.int64),) * 3
        else:
            found = search(*(x for s in sides for x in (s.column("vec_id").to_numpy(), matrix(s.column("v")))))
        types = (pa.int64(), pa.int64(), kind)
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("query_id", "vec_id", "score"), found, types)})

    found = meeting.groupBy(*part, "shard", "query_group").applyInArrow(compare, f"query_id long, vec_id long, score {score_type}")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def every(column: Column | str, n: int) -> Column:
    """True for ids divisible by n."""
    return F.col(column) % n == 0
