"""Exact passages, SimHash and similarity groups against brute force."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from riskflow.llm.common import stored
from riskflow.llm.components import components
from riskflow.llm.simhash_tiles import fingerprint, linked, linked_in_groups, links, near_duplicates, without_near_copies
from riskflow.llm.suffix_repeats import difference_cover, digest_of, remove_repeats, window_names


def covered(texts: list[bytes], length: int) -> list[np.ndarray]:
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                cover[i : i + length] = True
        out.append(cover)
    return out


def expected(texts: list[bytes], length: int) -> list[tuple]:
    out = []
    for t, c in zip(texts, covered(texts, length)):
        runs = int((np.diff(np.r_[False, c].astype(int)) == 1).sum())
        out.append((len(t), int(c.sum()), runs, sha256(np.frombuffer(t, np.uint8)[~c].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("period,size", [(7, 3), (21, 5), (73, 9), (273, 17)])
def test_every_difference_lies_on_the_cover(period, size):
    cover = difference_cover(period)
    assert len(cover) == size
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_names_follow_content():
    data = np.frombuffer(b"abcabcabd" * 3, np.uint8)
    names = window_names(data, np.arange(len(data) - 3), 4)
    words = [data[i : i + 4].tobytes() for i in range(len(data) - 3)]
    for a, b in zip(words, names):
        assert [x == a for x in words] == [x == b for x in names]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_texts_against_brute_force(llm, seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab ") for _ in range(rng.randint(0, 90))) for _ in range(12)]
    texts = [x[rng.randint(0, 9) :] + y[: rng.randint(0, 60)] for x in base for y in base[:4]] + base + base[:3] + ["ab" * 40]
    frame = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in digest_of(remove_repeats(frame, length=16, period=7, block_bytes=200)).collect()}
    want = dict(enumerate(expected([t.encode() for t in texts], 16)))
    assert got == want


def test_odd_rows_and_clashing_names(llm, odd):
    rows = remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    assert rows[0]["row"].asDict().keys() == set(odd.columns) - {"text"}
    want = sorted(expected([(r["text"] or "").encode() for r in odd.collect()], 400))
    got = sorted(tuple(r[1:]) for r in digest_of(remove_repeats(odd)).collect())
    assert got == want


def test_whole_characters_stay_readable(llm):
    text = "é" * 300 + "日" * 200
    frame = llm.createDataFrame([(1, "a" + text + "b"), (2, "zz" + text[1:] + "c")], "doc_id long, text string")
    for row in remove_repeats(frame, whole_characters=True).collect():
        row["kept"].decode("utf-8")
        assert sum(s["stop"] - s["start"] for s in row["spans"]) > 1000


def test_empty_table(llm):
    empty = llm.createDataFrame([], "doc_id long, text string, source string")
    assert digest_of(remove_repeats(empty)).collect() == []
    assert near_duplicates(empty).collect() == []
    assert without_near_copies(empty).collect() == []


def brute_fingerprint(text: str) -> int:
    import re

    import xxhash

    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("group_rows", [5, 16_384])
def test_fingerprints_and_components_against_brute_force(llm, odd, group_rows):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(40)]
    texts = []
    for _ in range(40):
        own = [rng.choice(words) for _ in range(rng.randint(1, 200))]
        texts += [" ".join(own), " ".join(own[:-1] + ["W1"]), " ".join(own).upper()]
    rows = list(enumerate(texts)) + [(r["doc_id"], r["text"]) for r in odd.collect()]
    frame = llm.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(frame, group_rows=group_rows).collect()
    prints = [(i, brute_fingerprint(t or "")) for i, t in rows]
    assert Counter((r["doc_id"], r["fingerprint"]) for r in got) == Counter((i, f"{f:016x}") for i, f in prints)
    root = roots({f for _, f in prints})
    lowest = {}
    for i, f in prints:
        if i is not None:
            lowest[root[f]] = min(i, lowest.get(root[f], i))
    want = Counter((i, lowest.get(root[f])) for i, f in prints)
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == want


def roots(prints):
    """Fingerprint -> a name of its component, by comparing all pairs."""
    parent = {f: f for f in prints}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in prints:
        for b in prints:
            if a < b and bin(a ^ b).count("1") <= 3:
                parent[root(a)] = root(b)
    return {f: root(f) for f in prints}


def planted(rng, count):
    """Fingerprints of which many are near others, and many share words of bits."""
    out = set()
    while len(out) < count:
        f = rng.getrandbits(64) if rng.random() < 0.5 else rng.getrandbits(20) | 0xABCD << 40
        out.add(f)
        for _ in range(rng.randint(0, 3)):
            f ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            out.add(f)
    return sorted(out)


@pytest.mark.parametrize("group_rows", [3, 40, 16_384])
def test_groups_meet_every_link(llm, group_rows):
    prints = planted(random.Random(6), 500)
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    frame = llm.createDataFrame([(f,) for f in signed], "print long")
    edges = links(frame, "print", 3, group_rows).collect()
    assert all(((e["u"] ^ e["v"]) & (1 << 64) - 1).bit_count() for e in edges)
    label = {f: f for f in signed}
    label.update({r["node"]: r["label"] for r in components(stored(llm.createDataFrame(edges, "u long, v long"), "e")).collect()})
    root = roots(set(prints))
    of = dict(zip(signed, prints))
    found, want = {}, {}
    for f in signed:
        found.setdefault(label[f], set()).add(f)
        want.setdefault(root[of[f]], set()).add(f)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))


def test_short_and_long_groups():
    rng = random.Random(3)
    groups, prints = [], []
    for k, size in enumerate([1, 2, 47, 48, 49, 200, 1, 130]):
        own = planted(rng, size)[:size]
        groups += [k] * len(own)
        prints += own
    u, v = linked_in_groups(np.array(groups), np.array(prints, np.uint64), 3)
    assert all((int(a) ^ int(b)).bit_count() <= 64 for a, b in zip(u, v))
    for k in set(groups):
        own = [f for g, f in zip(groups, prints) if g == k]
        root, parent = roots(set(own)), {f: f for f in own}

        def top(f, parent=parent):
            while parent[f] != f:
                f = parent[f]
            return f

        for a, b in zip(u.tolist(), v.tolist()):
            if a in parent and b in parent and root.get(a) == root.get(b):
                parent[top(a)] = top(b)
        assert len({top(f) for f in own}) == len(set(root.values()))


def test_tiles_find_every_link():
    rng = np.random.default_rng(0)
    prints = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = prints[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64)) ^ np.uint64(3)
    prints = np.unique(np.r_[prints, near])
    u, v = linked(prints, None, 3)
    pairs = (np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3).sum() - len(prints)
    assert len(u) >= 95 and pairs // 2 >= len(u)
    a, b = prints[::2], prints[1::2]
    u, v = linked(a, b, 3)
    assert all(int(x ^ y).bit_count() <= 64 for x, y in zip(u, v)) and len(u) == len(v)


def test_components_of_a_long_chain_and_a_star(llm):
    edges = [(k, k + 1) for k in range(60)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5, 5)]
    frame = llm.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["label"] for r in components(stored(frame, "test-edges")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1300), 1000)}


def test_one_of_each_component_stays(llm, odd):
    """The smallest id of each component, one row of those without ids; repeated rows are copies."""
    rng = random.Random(8)
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    for k in range(100, 160, 3):
        own = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(100, 300))]
        rows += [(k + 2, " ".join(own)), (k, " ".join(own[:-1])), (None, " ".join(own).upper())]
    kept = without_near_copies(llm.createDataFrame(rows, "doc_id long, text string")).collect()
    prints = [brute_fingerprint(t or "") for _, t in rows]
    root, want = roots(set(prints)), {}
    for (i, _), f in zip(rows, prints):
        want.setdefault(root[f], []).append(i)
    expected_ids = sorted((min((i for i in ids if i is not None), default=None) for ids in want.values()), key=str)
    assert sorted((r["doc_id"] for r in kept), key=str) == expected_ids
    again = without_near_copies(odd)
    assert again.columns == odd.columns and {tuple(r) for r in again.collect()} <= {tuple(r) for r in odd.collect()}


def test_fingerprint_of_no_words():
    assert fingerprint(b"") == fingerprint(b" \n") == 0
