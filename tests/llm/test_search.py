"""Vector searches against brute force."""

import numpy as np
import pytest

from riskflow.llm import learned_partitions as lp
from riskflow.llm.nra_topk import top_k


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, part long, v string")


def vectors(n=400, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.3, (n, dim)).astype(np.float32)
    x[n // 2 : n // 2 + n // 5] = x[0]  # one vector repeated under many ids
    rows = [(k, x[k].tolist(), 1, None, None) for k in range(n)]
    rows += [(1000, None, 1, None, None), (1050, [None] * dim, 1, None, None), (1100, [float("nan")] * dim, 1, None, None)]
    rows += [(1150, [float("inf")] * dim, 1, None, None), (1200, [0.0] * dim, None, None, None), (None, x[3].tolist(), 1, None, None)]
    rows += [(2000, [1.0, 2.0], 1, None, None), (2001, [2.0, -1.0], 1, None, None), (2050, [], 1, None, None)]
    return rows


def brute(rows, k, every, measure, zero_ok):
    ok = [(i, np.array(v, float)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    ok = [(i, v) for i, v in ok if zero_ok or v.any()]
    out = {}
    for q, a in ok:
        if q % every == 0:
            scores = [(-measure(a, b), i) for i, b in ok if i != q and len(a) == len(b)]
            out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return {q: v for q, v in out.items() if v}


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("shard_rows", [60, 8_192])
def test_top_k_is_exact(llm, shard_rows):
    rows = vectors()
    whole = lambda a, b: int(np.floor(256 * a).astype(np.int64) @ np.floor(256 * b).astype(np.int64))
    got = found(top_k(table(llm, rows), shard_rows=shard_rows))
    assert got == brute(rows, 5, 50, whole, True)


def test_top_k_of_large_components(llm):
    rows = [(0, [3e5, 1e6], 1, None, None), (1, [4e5, 1e6], 1, None, None), (2, [1e8, -1e6], 1, None, None)]
    whole = lambda a, b: sum(int(x) * int(y) for x, y in zip(np.floor(256 * a), np.floor(256 * b)))
    assert found(top_k(table(llm, rows))) == brute([(i, np.float32(v).tolist(), *r) for i, v, *r in rows], 5, 50, whole, True)


def test_nearest_reaches_the_recall_and_scores_exactly(llm):
    rows = vectors(1200, 16)
    rows = [r for r in rows if r[0] is None or r[0] < 1000 or r[0] > 1199] + rows[1000:1200]
    got = found(lp.nearest(table(llm, rows), parts=12))
    want = brute(rows, 20, 20, lambda a, b: float((a * b).sum()), False)
    assert got.keys() == want.keys()
    score = {q: dict(v) for q, v in want.items()}
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, near in got.items():
        assert [n for n in near] == sorted(near, key=lambda n: (-n[1], n[0]))
        assert all(abs(score[q][i] - s) < 1e-12 for i, s in near if i in score[q])
    assert got[2000] == [(2001, 0.0)]


def test_rows_that_share_an_id(llm):
    """A query and a candidate that stand twice, and once more with another vector."""
    rows = vectors(60)[:60]
    rows += [rows[0], (0, rows[7][1], 1, None, None), rows[5], (5, rows[9][1], 1, None, None)]
    whole = [(i, np.floor(256 * np.array(v, np.float64))) for i, v, *_ in rows]
    for query in (0, 50):
        pairs = [(int(a @ b), i) for q, a in whole if q == query for i, b in whole if i != query]
        want = [(i, s) for s, i in sorted(pairs, key=lambda p: (-p[0], p[1]))[:5]]
        assert found(top_k(table(llm, rows)))[query] == want
    near = found(lp.nearest(table(llm, rows)))
    assert set(near) == {0, 20, 40} and all(len(v) == 20 for v in near.values())


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (8, 16))
    x = np.concatenate([c + rng.normal(0, 0.1, (60, 16)) for c in centres])
    near = lp.neighbour_graph(x, 10)
    label = lp.balanced_parts(x, near, 8)
    assert np.bincount(label, minlength=8).max() <= np.ceil(1.05 * len(x) / 8) + 1
    assert (label[near] == label[:, None]).mean() > 0.8
    router = lp.fit(x, 8, 10, 0.95)
    assert router.visits < 8


def test_few_parts_are_visited_where_vectors_cluster():
    """Calibrated on vectors kept from learning: a third of the rows are scanned, and others are found."""
    rng = np.random.default_rng(2)
    x = np.concatenate([c + rng.normal(0, 0.25, (150, 24)) for c in rng.normal(0, 1, (40, 24))])
    x = x[rng.permutation(len(x))]
    router = lp.fit(x[:3000], 16)
    home, asked = router.visited(x, 1)[:, 0], x[3000:3400]
    visited = router.visited(asked, router.visits)
    near = lp.neighbour_graph(x, 20, asked)
    found = np.mean([np.isin(home[n], v).mean() for n, v in zip(near, visited)])
    scanned = np.mean([np.isin(home, v).mean() for v in visited])
    assert found >= 0.9 and scanned < 0.35, (found, scanned)


def test_neighbours_in_blocks_are_those_of_one_product():
    x = np.random.default_rng(4).normal(0, 1, (300, 9)).astype(np.float32)
    whole = x @ x.T
    np.fill_diagonal(whole, -np.inf)
    want = np.sort(np.argsort(-whole, axis=1)[:, :7], axis=1)
    assert np.array_equal(np.sort(lp.neighbour_graph(x, 7), axis=1), want)


def test_registered_query_on_the_whole_table(llm):
    from riskflow.llm import queries

    got = found(queries.QUERIES["op5_learned_partitions"](llm, "/root/testdata/sf0.1"))
    rows = llm.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()
    whole = [(r.vec_id, np.array(r.embedding, float)) for r in rows if r.embedding and None not in r.embedding]
    ids, x = np.array([i for i, _ in whole]), np.array([v for _, v in whole])
    hits = 0
    for q, near in got.items():
        scores = x @ x[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len({i for i, _ in near} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
    assert hits >= 0.9 * 20 * len(got)


def test_empty_and_tiny_tables(llm):
    for rows in ([], vectors(10)[:1], [(20, None, 1, None, None)]):
        assert top_k(table(llm, rows)).collect() == []
        assert lp.nearest(table(llm, rows)).collect() == []
