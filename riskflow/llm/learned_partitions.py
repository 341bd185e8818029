"""Approximate nearest neighbours by learned partitions.

A neighbour graph of a bounded sample is cut into balanced parts with few edges between them, and a
small network learns which parts the neighbours of a vector lie in. Every row is indexed under its
most probable part; a query is sent to its several most probable parts and all vectors there are
scored exactly. How many parts a query visits is set on sample vectors kept from learning, for a recall
above the target.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import stored
from riskflow.llm.routed import best_per_query, every, finite_vectors, matrix

SAMPLE_ROWS = 8_192
MOST_PARTS = 256
TARGET_RECALL = 0.93
HELD_OUT = 8  # one sample vector of so many is kept from learning, to count the visits on
_BLOCK = 128


def neighbour_graph(x: np.ndarray, k: int, queries: np.ndarray | None = None) -> np.ndarray:
    """The k nearest rows by inner product of every query (every row, itself left out), a few at a time."""
    own = queries is None
    queries = x if own else queries
    k, near = min(k, len(x) - int(own)), np.empty((len(queries), min(k, len(x) - int(own))), np.int32)
    for a in range(0, len(queries), _BLOCK):
        scores = queries[a : a + _BLOCK] @ x.T
        if own:
            scores[np.arange(len(scores)), np.arange(a, a + len(scores))] = -np.inf
        near[a : a + _BLOCK] = np.argpartition(scores, len(x) - k, axis=1)[:, len(x) - k :]
    return near


def balanced_parts(x: np.ndarray, near: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.05) -> np.ndarray:
    """A part for each vertex: halved along main directions, then vertices move to the part that
    most of their neighbours are in, best gains first, while it has room."""
    label = np.zeros(len(x), np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        groups.sort(key=len)
        rows = groups.pop()
        centred = x[rows] - x[rows].mean(axis=0)
        _, axes = np.linalg.eigh(centred.T @ centred)
        order = np.argsort(centred @ axes[:, -1], kind="stable")
        groups += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    for k, rows in enumerate(groups):
        label[rows] = k
    room = int(np.ceil(slack * len(x) / parts))
    # Edges in both directions.
    a = np.r_[np.repeat(np.arange(len(x)), near.shape[1]), near.ravel()]
    b = np.r_[near.ravel(), np.repeat(np.arange(len(x)), near.shape[1])]
    for _ in range(rounds):
        votes = np.bincount(a * parts + label[b], minlength=len(x) * parts).reshape(len(x), parts)
        target, gain = votes.argmax(axis=1), votes.max(axis=1) - votes[np.arange(len(x)), label]
        size, moved = np.bincount(label, minlength=parts), 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if size[target[v]] < room:
                size[label[v]] -= 1
                size[target[v]] += 1
                label[v], moved = target[v], moved + 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """A network with one hidden layer from a vector to the probability of each part."""

    layers: tuple[np.ndarray, ...]
    visits: int

    def parts(self) -> int:
        return self.layers[2].shape[1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        return np.maximum(unit @ w1 + b1, 0) @ w2 + b2

    def visited(self, x: np.ndarray, count: int) -> np.ndarray:
        """The most probable parts of each row, ties to the lower number."""
        return np.argsort(-self.scores(x), axis=1, kind="stable")[:, :count]


def _train(x: np.ndarray, target: np.ndarray, hidden: int = 96, passes: int = 40, seed: int = 5) -> tuple[np.ndarray, ...]:
    """Cross-entropy against the shares of each vector's neighbours, by Adam."""
    rng = np.random.default_rng(seed)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    shapes = ((x.shape[1], hidden), (hidden,), (hidden, target.shape[1]), (target.shape[1],))
    layers = [rng.normal(0, np.sqrt(2 / s[0]), s) if len(s) == 2 else np.zeros(s) for s in shapes]
    first, second, t = [np.zeros(s) for s in shapes], [np.zeros(s) for s in shapes], 0
    for _ in range(passes):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
            w1, b1, w2, b2 = layers
            h = np.maximum(unit[rows] @ w1 + b1, 0)
            z = h @ w2 + b2
            p = np.exp(z - z.max(axis=1, keepdims=True))
            d = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            back = (d @ w2.T) * (h > 0)
            t += 1
            for k, g in enumerate((unit[rows].T @ back, back.sum(axis=0), h.T @ d, d.sum(axis=0))):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] = layers[k] - 0.003 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return tuple(layers)


def fit(sample: np.ndarray, parts: int, k: int = 20, target: float = TARGET_RECALL) -> Router:
    """Learn from distinct sample vectors; those held out say how many visits reach the target recall."""
    x = np.unique(sample.astype(np.float32), axis=0)
    parts = max(1, min(parts, len(x) // 8))
    if parts == 1:
        dim = sample.shape[1]
        return Router((np.zeros((dim, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1)), 1)
    out = np.random.default_rng(3).permutation(len(x)) % HELD_OUT == 0
    held, x = x[out], x[~out]
    near = neighbour_graph(x, k)
    label = balanced_parts(x, near, parts)
    share = np.stack([np.bincount(label[row], minlength=parts) for row in np.c_[near, np.arange(len(x))]])
    router = Router(_train(x, share / share.sum(axis=1, keepdims=True)), parts)
    # Every vector is indexed under the part the network finds most probable. The place, in a held-out
    # vector's visiting order, of the part that holds each of its neighbours is the visits these need.
    home = router.visited(x, 1)[:, 0]
    position = np.argsort(router.visited(held, parts), axis=1)
    needed = np.take_along_axis(position, home[neighbour_graph(x, k, held)], axis=1).ravel() + 1
    router.visits = int(np.quantile(needed, target, method="higher"))
    return router


def _search(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int):
    """The k best of a shard: a fast product finds all that may be among them, then each is summed
    in one order, so equal vectors have equal scores."""
    out = []
    rough = queries @ vectors.T
    slip = 1e-12 * np.abs(queries).sum(axis=1) * np.abs(vectors).max()
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    for q, query in enumerate(queries):
        row = rough[q]
        take = min(k, len(row))
        bar = np.partition(row, len(row) - take)[len(row) - take]
        rivals = np.flatnonzero((row >= bar - slip[q]) & (row > -np.inf)) if bar > -np.inf else np.flatnonzero(row > -np.inf)
        exact = (vectors[rivals] * query).sum(axis=1)
        best = np.lexsort((ids[rivals], -exact))[:k]
        out.append((np.full(len(best), query_ids[q]), ids[rivals][best], exact[best]))
    return tuple(np.concatenate(c) for c in zip(*out))


def nearest(
    table: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, query_every: int = 20,
    sample_rows: int = SAMPLE_ROWS, parts: int | None = None, target: float = TARGET_RECALL,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k nearest found, by inner product.

    Queries are the rows whose id is divisible by ``query_every``, candidates all rows but the query's
    own; ties go to the smaller id. Vectors null, zero or holding null or non-finite components take
    no part, nor do rows without an id. The index is learned from at most ``sample_rows`` vectors of
    the commonest length, picked by a hash; it holds every row. ``parts`` is a fourteenth of the root
    of the number of rows unless given. Vectors of any other length are
    compared with all of their own length. Vectors repeated under other ids each count. Rows that share an id
    each take part: the id's list holds the best that its rows find, each row of another id once for each.
    """
    rows = finite_vectors(table, vec_id, vector).filter(F.exists("v", lambda x: x != 0))
    rows = stored(rows.withColumn("dim", F.size("v")), "vectors")
    common = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    dim, count = (common["dim"], common["count"]) if common else (0, 0)
    usual = rows.filter(F.col("dim") == dim)
    picked = usual.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows)  # sample_rows rows
    floats = picked.select(F.col("v").cast("array<float>").alias("v")).toArrow().column("v")
    sample = matrix(floats, np.float32) if len(floats) else np.ones((1, 1), np.float32)
    # More parts for more rows, but more slowly: a query takes its k best from each part it visits.
    wanted = min(MOST_PARTS, round(count**0.5 / 14)) if parts is None else parts
    router = fit(sample, wanted, k, target)
    sent = table.sparkSession.sparkContext.broadcast(router)

    def routed(source: DataFrame, count: int) -> DataFrame:
        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    parts = sent.value.visited(matrix(batch.column(1)), count)
                    at = pa.array(np.repeat(np.arange(batch.num_rows), parts.shape[1]))
                    kept = [batch.column(c).take(at) for c in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*kept, pa.array(parts.ravel(), pa.int64())], ["vec_id", "v", "part"])

        learned = source.filter(F.col("dim") == dim).select("vec_id", "v").mapInArrow(route, "vec_id long, v array<double>, part long")
        other = source.filter(F.col("dim") != dim).select("vec_id", "v", (-F.col("dim")).cast("long").alias("part"))
        return learned.unionByName(other)

    queries = rows.filter(every("vec_id", query_every))
    return best_per_query(
        routed(rows, 1), routed(queries, router.visits), ["part"],
        lambda i, m, q, n: _search(i, m, q, n, k), "double", k, shard_rows=8_192,
    )
