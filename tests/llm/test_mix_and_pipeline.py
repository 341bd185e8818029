"""Pfair order against its definition, the pipeline's stages against brute force, and the registry."""

import random
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from riskflow.llm import pfair, queries
from riskflow.llm.simhash_tiles import fingerprint


def covered(texts, length):
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        cover = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                cover[i : i + length] = True
        out.append(cover)
    return out


SMALL = "/root/testdata/sf0.001"


def brute_schedule(weights, blocks):
    """Earliest deadline first, slot by slot; the weights of sources that have run out are shared."""
    left, out, used = {s: n for s, n in blocks.items() if n}, [], Counter()
    while left:
        total, begun = sum(weights[s] for s in left), len(out)
        served = Counter()
        while True:
            t = len(out) - begun
            ready = [(-(-(served[s] + 1) * total // weights[s]), s) for s in left if served[s] * total // weights[s] <= t]
            due, s = min(ready)
            assert due > t
            if not left[s]:
                break
            out.append((s, used[s]))
            served[s] += 1
            used[s] += 1
            left[s] -= 1
            for r in left:
                assert abs(served[r] - weights[r] * (t + 1) / total) < 1
        left = {s: n for s, n in left.items() if n}
    return {block: slot for slot, block in enumerate(out)}


@pytest.mark.parametrize("seed", range(4))
def test_slots_against_earliest_deadline_first(llm, seed):
    rng = random.Random(seed)
    names = [f"s{k}" for k in range(rng.randint(1, 6))]
    weights = {n: rng.randint(1, 9) for n in names}
    rows = [(k, rng.choice(names)) for k in range(500)] + [(9999, None), (None, names[0]), (3, names[0]), (3, names[0])]
    frame = llm.createDataFrame(rows, "doc_id long, source string").selectExpr("*", "source as name", "doc_id as slot", "1 as n")
    got = pfair.mixed(frame, weights, block_rows=7, bucket_rows=50).collect()
    assert Counter((r["row"]["doc_id"], r["source"]) for r in got) == Counter(rows)
    blocks = {n: -(-c // 7) for n, c in Counter(s for _, s in rows).items()}
    want = brute_schedule({**{f"s{n}": w for n, w in weights.items()}, "n": 1}, {"n" if n is None else f"s{n}": c for n, c in blocks.items()})
    for r in got:
        assert want["n" if r["source"] is None else f"s{r['source']}", r["block"]] == r["slot"]
    assert max(Counter((r["slot"], r["in_block"]) for r in got).values()) == 1
    assert max(r["in_block"] for r in got) <= 6


def test_mix_of_nothing_and_bad_weights(llm):
    empty = llm.createDataFrame([], "doc_id long, source string")
    assert pfair.mixed(empty, {"a": 1}).collect() == []
    with pytest.raises(ValueError):
        pfair.mixed(empty, {"a": 0})


@pytest.fixture(scope="module")
def stages(llm):
    docs, out = llm.read.parquet(f"{SMALL}/documents.parquet"), []
    from riskflow.llm.common import stored

    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(llm, docs, SMALL), name)
        out.append((name, docs, after))
        docs = after
    return {name: (before.toPandas(), after.toPandas()) for name, before, after in out}


def test_stages_keep_the_columns_of_documents(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert list(after.columns) == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert set(after.doc_id) <= set(before.doc_id)


def test_toxic_documents_go_and_others_stay(llm):
    larger = SMALL.replace("0.001", "0.01")
    docs = llm.read.parquet(f"{larger}/documents.parquet")
    before, after = docs.toPandas(), corpus_pipeline.toxicity(llm, docs, larger).toPandas()
    labels = llm.read.parquet(f"{larger}/labels.parquet").toPandas().set_index("doc_id").toxic
    gone = set(before.doc_id) - set(after.doc_id)
    clean = set(labels[labels == 0].index)
    assert len(gone & clean) <= 0.02 * len(clean)
    english = before[before.lang == "en"].doc_id
    toxic = set(labels[labels == 1].index) & set(english)
    assert len(gone & toxic) >= 0.8 * len(toxic)


def test_toxic_documents_of_every_language_go_and_clean_ones_stay(llm):
    larger = SMALL.replace("0.001", "0.1")
    docs = llm.read.parquet(f"{larger}/documents.parquet")
    before, after = docs.select("doc_id", "lang").toPandas(), corpus_pipeline.toxicity(llm, docs, larger).select("doc_id").toPandas()
    labels = llm.read.parquet(f"{larger}/labels.parquet").toPandas().set_index("doc_id").toxic
    gone = set(before.doc_id) - set(after.doc_id)
    for lang in ("en", "de", "fr", "es"):
        toxic = set(labels[labels == 1].index) & set(before[before.lang == lang].doc_id)
        assert toxic and len(gone & toxic) >= 0.8 * len(toxic), lang
        clean = set(labels[labels == 0].index) & set(before[before.lang == lang].doc_id)
        assert clean and len(gone & clean) <= 0.025 * len(clean), lang


def test_one_of_each_group_of_near_copies_stays(stages):
    before, after = stages["near_copies"]
    prints = {i: fingerprint((t or "").encode()) for i, t in zip(before.doc_id, before.text)}
    parent = {i: i for i in prints}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                parent[root(a)] = root(b)
    assert set(after.doc_id) == {min(i for i in ids if root(i) == r) for r in {root(i) for i in ids}}


def without_passages(texts: list[bytes]) -> list[bytes]:
    """Texts without the runs of 50 words or more of bytes that repeated strings of 150 bytes cover."""
    out = []
    for text, cover in zip(texts, covered(texts, corpus_pipeline.PASSAGE_BYTES)):
        edges = np.flatnonzero(np.diff(np.r_[False, cover, False])).reshape(-1, 2)
        keep = np.ones(len(text), bool)
        for a, b in edges:
            if len(text[a:b].split()) >= 50:
                keep[a:b] = False
        out.append(np.frombuffer(text, np.uint8)[keep].tobytes())
    return out


def test_repeated_passages_go(stages):
    before, after = stages["repeated_passages"]
    kept = dict(zip(after.doc_id, after.text))
    assert len(after) == len(before)
    texts = [t.encode() for t in before.text]
    for i, text, left in zip(before.doc_id, texts, without_passages(texts)):
        if left == text:
            assert kept[i].encode() == text
        else:  # characters are not cut
            assert 0 <= len(kept[i].encode()) - len(left) <= 6 * (len(text) - len(left)) // 150 + 6


def test_passages_of_over_fifty_short_words_go(llm):
    """51 words of two letters that stand in two texts, and 40 that do."""
    rng = random.Random(2)

    def words(n, letters="abcdefghijklmnopqrstuvwxyz"):
        return " ".join(rng.choice(letters) + rng.choice(letters) for _ in range(n))

    long, short = words(51), words(40) + " " + words(9, "é日")
    texts = [f"{words(70)} {long} {words(30)}", f"{words(20)} {long} {words(90)}", f"{words(60)} {short} {words(9)}", f"{short} {words(60)}"]
    texts += [words(200), "", None]
    docs = llm.createDataFrame([(k, t, "en", "src0", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r.doc_id: r.text for r in corpus_pipeline.repeated_passages(llm, docs, SMALL).collect()}
    assert all(long[4:-4] not in kept[k] and len(kept[k]) > 50 for k in (0, 1))
    assert [kept[k] for k in (2, 3, 4, 5, 6)] == [*texts[2:6], ""]


DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_odd_rows_and_no_rows(llm, odd):
    """Nulls in any column, repeated rows and ids, empty and long texts; and an empty table."""
    docs = odd.select(*DOCUMENTS)
    rows = Counter(map(tuple, docs.collect()))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, SMALL)
        found = out.select(*DOCUMENTS).collect()
        if name in ("mix", "encode"):
            assert Counter(map(tuple, found)) == rows, name
        elif name == "repeated_passages":
            assert len(found) == sum(rows.values()), name
        else:
            assert not Counter(map(tuple, found)) - rows, name
        none = stage(llm, docs.limit(0), SMALL)
        assert none.columns == out.columns and none.collect() == [], name


def test_run_on_an_empty_table(llm, tmp_path):
    llm.read.parquet(f"{SMALL}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    llm.read.parquet(f"{SMALL}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(llm, str(tmp_path)).collect() == []


def test_mix_keeps_every_document(stages):
    before, after = stages["mix"]
    assert Counter(before.doc_id) == Counter(after.doc_id)
    blocks = Counter(before.source)
    assert len(set(after.source[: pfair.BLOCK_ROWS])) == 1 or min(blocks.values()) < pfair.BLOCK_ROWS


def test_last_stage_decodes(stages):
    from riskflow.llm.viterbi import load

    pieces, (before, after) = load(), stages["encode"]
    for text, ids in zip(after.text, after.ids):
        assert b"".join(pieces.texts[i] for i in ids)[1:] == text.encode()


def test_registry_has_each_operator_once():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(queries.QUERIES) <= names


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(llm, name):
    import duckdb
    from compare import difference

    oracle = duckdb.connect()
    oracle.execute("SET TimeZone = 'UTC'")
    for table in ("conversations", "documents", "embeddings"):
        oracle.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    assert difference(queries.QUERIES[name](llm, SMALL), oracle, queries.ORACLES[name]) is None
