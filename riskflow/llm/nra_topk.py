"""Exact top-k by inner product with no random access.

For each component the vectors of a shard stand in a list, largest contribution to the query first.
The lists are read in step, from the top; a vector's lower bound counts what was read of it and the
least that the rest can give, its upper bound what the lists can still give at most. Reading stops
when few vectors are left that could be one of the k best; those left are scored in full.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.routed import best_per_query, every, finite_vectors

SCALE = 256
_EXACT = float(1 << 52)
_LONG = (1 << 63) - 1


def _rivals(vectors: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int):
    """Pairs of a query number and the positions that hold every one of its k best.

    The lists are read once for all queries of the group: a query with a positive weight has read the
    top of a list, one with a negative weight its bottom. Reading a deeper part of all lists is a
    product of the weights with the values read and, for the rest, with the value last read (upper
    bound) or the list's far end (lower bound). ``own`` marks the candidates that do not count.
    """
    n = len(vectors)
    rank = np.empty(vectors.shape, np.int64)
    order = np.argsort(-vectors, axis=0, kind="stable")
    np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
    falling = np.take_along_axis(vectors, order, axis=0)
    least, most = falling[-1], falling[0]
    waiting = np.arange(len(queries))
    for read in sorted({-(-n * part // 8) for part in (3, 5, 7, 8)}):
        top, bottom = rank < read, rank >= n - read
        up, down = np.maximum(queries[waiting], 0), np.minimum(queries[waiting], 0)
        high = up @ np.where(top, vectors, falling[read - 1]).T + down @ np.where(bottom, vectors, falling[n - read]).T
        low = up @ np.where(top, vectors, least).T + down @ np.where(bottom, vectors, most).T
        high[own[waiting]] = low[own[waiting]] = -np.inf
        take = min(k, n)
        bar = np.partition(low, n - take, axis=1)[:, n - take]
        able = (high >= bar[:, None]) & (high > -np.inf)
        done = (able.sum(axis=1) <= max(4 * k, n // 16)) | (read == n)
        for row in np.flatnonzero(done):
            yield int(waiting[row]), np.flatnonzero(able[row])
        waiting = waiting[~done]
        if not len(waiting):
            return


def search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """Query ids, vector ids and integer scores of each query's k best in one shard."""
    out: list[tuple[int, int, int]] = []
    own = query_ids[:, None] == ids[None, :]
    if np.abs(vectors).max() * np.abs(queries).max() * vectors.shape[1] < _EXACT:
        # All sums are whole numbers that a double holds.
        for q, rivals in _rivals(vectors, queries, own, k):
            score = (vectors[rivals] @ queries[q]).astype(np.int64)
            best = np.lexsort((ids[rivals], -score))[:k]
            out += [(int(query_ids[q]), int(ids[rivals[b]]), int(score[b])) for b in best]
    else:
        whole = [[int(x) for x in row] for row in vectors]
        for q, query in enumerate(queries):
            weight = [int(x) for x in query]
            scored = sorted((-sum(a * b for a, b in zip(row, weight)), int(i)) for row, i, mine in zip(whole, ids, own[q]) if not mine)
            out += [(int(query_ids[q]), i, max(-_LONG - 1, min(_LONG, -s))) for s, i in scored[:k]]
    columns = list(zip(*out)) if out else [(), (), ()]
    return tuple(np.array(c, np.int64) for c in columns)


def top_k(
    table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 5, query_every: int = 50,
    shard_rows: int = 8_192,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest integer inner products, exactly.

    Components become floor(256 x). Queries are the rows whose id is divisible by ``query_every``,
    candidates all rows but the query's own; ties go to the smaller id. Vectors null or holding null
    or non-finite components take no part, nor do rows without an id; vectors of different length are
    not compared. Scores beyond a long are cut to its range; vectors too long to scale take no part.
    Vectors repeated under other ids each count. Rows that share an id
    each take part: the id's list holds the best that its rows find, each row of another id once for each.
    """
    # From 2**53 on, doubles are integers already.
    floor = lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)
    scaled = finite_vectors(table, vec_id, vector).withColumn("v", F.transform("v", lambda x: floor(x * SCALE)))
    rows = scaled.filter(F.forall("v", lambda x: F.abs(x) != float("inf"))).withColumn("dim", F.size("v"))
    return best_per_query(
        rows, rows.filter(every("vec_id", query_every)), ["dim"],
        lambda i, m, q, n: search(i, m, q, n, k), "bigint", k, shard_rows=shard_rows,
    )
