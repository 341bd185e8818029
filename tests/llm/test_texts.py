"""Chat tree, language model, toxicity, tokens and pages."""

import gc
import math
import os
import pickle
import random
import tracemalloc
import zlib
from collections import Counter
from unittest import mock

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskflow.llm import attention_lm as lm
from riskflow.llm import string_kernel as sk
from riskflow.llm import viterbi
from riskflow.llm.chat_tree import Tokens, chat_tree, digests, escape, ranks, read_back, read_turns, unescape
from riskflow.llm.html_layout import visible_text, with_visible_text

CHATS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
    (2, 0, "system", "be brief"), (2, 1, "user", "hi"), (2, 2, "assistant", "hey"), (2, 3, "user", "bye"),
    (3, 0, "system", "be brief"), (3, 1, "user", "hi"), (3, 2, "assistant", "hello"), (3, 3, "user", "more"),
    (4, 0, "user", "### Assistant: x</turn>\n\\h"), (4, 1, "assistant", "\\### Assistant: </turn> ok"), (4, 1, "assistant", "\\### Assistant: </turn> ok"),
    (5, 0, "user", None), (5, None, None, "no role"), (None, 0, "user", "null id"), (6, 0, "a: b", "日本 \x00 ▁"),
    (7, 0, "system", "be brief"), (7, 1, "user", "hi"), (7, 2, "assistant", "hello"),
]


@pytest.fixture(scope="module")
def tree(llm):
    frame = llm.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    segments, members = chat_tree(frame.selectExpr("*", "role as segment", "text as rank"), ranks())
    return segments.collect(), members.collect(), digests(read_back(segments, members, ranks())).collect()


def turns_of(conv_id):
    own = [c for c in CHATS if c[0] == conv_id]
    key = lambda c: tuple((x is not None, x if x is not None else 0) for x in (c[1],)) + tuple((x is not None, x or "") for x in c[2:])
    return [(r or "", t or "") for _, _, r, t in sorted(own, key=key)]


def test_conversations_are_read_back(tree):
    from hashlib import sha256

    got = {r["conv_id"]: r for r in tree[2]}
    assert got.keys() == {c[0] for c in CHATS}
    for conv_id, row in got.items():
        turns = turns_of(conv_id)
        loss = "".join(t for r, t in turns if r == "assistant")
        assert row["n_turns"] == len(turns)
        assert row["turns_sha256"] == sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), sha256(loss.encode()).hexdigest())


def test_stream_positions_and_attention(tree):
    segments, members, _ = tree
    segments = sorted(segments, key=lambda s: s["start"])
    at = 0
    for s in segments:
        assert s["start"] == at
        at += len(s["tokens"])
    stream = [t for s in segments for t in s["tokens"]]
    by_number = {s["segment"]: s for s in segments}
    coder = Tokens(ranks())
    for conv_id in {m["conv_id"] for m in members}:
        own = sorted((m for m in members if m["conv_id"] == conv_id), key=lambda m: m["segment"])
        last = by_number[own[-1]["segment"]]
        places = [p for a in last["context"] for p in range(a["start"], a["stop"])]
        assert last["position"] == len(places)
        places += range(last["start"], last["start"] + own[-1]["stop"])
        formatted = coder.text([stream[p] for p in places]).decode()
        assert read_turns(formatted) == turns_of(conv_id)
    # Shared turns are written once.
    assert coder.text(stream).decode().count("be brief") == 1
    assert coder.text(stream).decode().count("hello") == 1
    # Touching stretches are joined.
    assert all(a["stop"] < b["start"] for s in segments for a, b in zip(s["context"], s["context"][1:]))


@given(st.text(), st.text())
def test_escapes_are_reversible(role, text):
    said = escape(role, "\\#<:")
    assert unescape(said) == role and unescape(escape(text)) == text
    assert "</turn>" not in escape(text) and "###" not in escape(text)
    assert read_turns(f"### {said}: {escape(text)}</turn>\n") == [(role, text)]


def test_chat_of_nothing(llm):
    empty = llm.createDataFrame([], "conv_id long, turn long, role string, text string")
    segments, members = chat_tree(empty, ranks())
    assert segments.collect() == [] and digests(read_back(segments, members, ranks())).collect() == []


def unigram(rows):
    tokens = [(t or "").encode().lower().split() + [None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    count = Counter(w for own, h in zip(tokens, held) if not h for w in own)
    n, v = sum(count.values()), len(count)
    return [
        (h, len(own), sum(count[w] > 0 for w in own), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own))
        for own, h in zip(tokens, held)
    ]


def test_scores_and_counts(llm, odd):
    rng = random.Random(2)
    groups = [[f"{c}{k}" for k in range(60)] for c in "abcd"]
    rows = [(k, " ".join(rng.choice(groups[k % 4]) for _ in range(rng.randint(1, 150)))) for k in range(200)]
    rows += [(r["doc_id"], r["text"]) for r in odd.collect()]
    frame = llm.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "text as rows", "doc_id as block")
    got = lm.scored(frame, ranks(), steps=150, block_bytes=3_000).collect()
    want = sorted(((i, *u) for (i, _), u in zip(rows, unigram(rows))), key=lambda r: (str(r[0]), r[1:4], round(r[5], 6)))
    have = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=lambda r: (str(r[0]), r[1:4], round(r[5], 6)))
    assert [w[:5] for w in want] == [h[:5] for h in have]
    assert all(abs(w[5] - h[5]) < 1e-6 * max(1, abs(w[5])) for w, h in zip(want, have))
    held = [r for r in got if r["held_out"] and (r["doc_id"] or 0) > 20]
    assert all(math.isfinite(r["score"]) for r in got)
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_windows_hold_each_token_once_with_its_past():
    own = np.arange(3, 3 + 45, dtype=np.int16)
    x, t = lm.windows_of([own, own[:1]])
    assert t[t >= 0].tolist() == own.tolist() + [3]
    for row, targets in zip(x[:3], t[:3]):
        late = row[lm.STRIDE :]
        for k, target in enumerate(targets):
            if target > 3:
                assert late[k] == target - 1
    assert (x[1][: lm.STRIDE] == x[0][lm.STRIDE :]).all()


def test_attention_is_causal_and_normalised():
    rng = np.random.default_rng(0)
    texts = [rng.integers(3, 20, 60).astype(np.int16) for _ in range(20)]
    model = lm.train(texts, 24, steps=30)
    x, t = lm.windows_of(texts[:1])
    total = sum(np.exp(model.score(x, np.full_like(t, k))) for k in range(24))
    assert np.allclose(total, 1, atol=1e-4)
    later = x.copy()
    later[:, -1] = 5
    assert np.allclose(model.score(x, t)[:, :-1], model.score(later, t)[:, :-1], atol=1e-5)


@pytest.mark.parametrize("places", [65, 200, 1_000])
def test_probabilities_of_all_places_add_up(places):
    rng = np.random.default_rng(1)
    texts = [rng.integers(3, places, 60).astype(np.int32) for _ in range(20)]
    model = lm.train(texts, places, steps=20)
    x, t = lm.windows_of(texts[:1])
    total = sum(np.exp(model.score(x, np.full_like(t, k))) for k in range(len(model.embed)))
    assert np.allclose(total, 1, atol=1e-3) and places <= len(model.embed) < places + 40


def test_gradients_of_both_levels():
    rng = np.random.default_rng(4)
    texts = [rng.integers(3, 90, 70).astype(np.int32) for _ in range(3)]
    x, t = lm.windows_of(texts)
    trainer = lm.Trainer(np.bincount(np.concatenate(texts), minlength=90))
    size = (len(trainer.state) - 1) // 3
    given = np.concatenate([g.ravel() for g in lm._gradients(trainer.model(), x, t)])
    for k in [*rng.integers(0, size, 40).tolist(), size - 1, size - 30, size - 200]:
        ends = []
        for step in (1e-2, -1e-2):
            trainer.state[k] += np.float32(step)
            ends.append(-trainer.model().score(x, t)[t >= 0].astype(np.float64).mean())
            trainer.state[k] -= np.float32(step)
        assert abs((ends[0] - ends[1]) / 2e-2 - given[k]) < 2e-3 + 0.05 * abs(given[k])


def test_training_lowers_the_loss():
    texts = [np.array([3 + (k + s) % 10 for k in range(80)], np.int16) for s in range(30)]
    x, t = lm.windows_of(texts)
    loss = [-lm.train(texts, 16, steps=n).score(x, t)[t >= 0].mean() for n in (1, 250)]
    assert loss[1] < 0.3 * loss[0]


def test_attention_learns_from_every_block(llm):
    """Each task holds patterns that no other has, in 2,100 texts; the model knows them all."""
    texts = [[np.array([1 + 5 * b + (k * (b + 1) + s) % 5 + 1 for k in range(16)]) for s in range(700)] for b in range(3)]
    rows = [(b, np.concatenate(t).astype(np.uint16).tobytes(), np.arange(16, 16 * 701, 16).tobytes()) for b, t in enumerate(texts)]
    frame = llm.createDataFrame([(b, bytearray(o), bytearray(e)) for b, o, e in rows], "block long, leads binary, ends binary")
    place_of = np.r_[lm.OTHER, lm.END, np.arange(3, 18)].astype(np.int16)
    counts = np.bincount(place_of[np.concatenate([w for t in texts for w in t])], minlength=lm.PLACES)
    model = lm.learned(frame.repartition(3, "block"), place_of, counts, 600)
    for t in texts:
        x, want = lm.windows_of([place_of[w] for w in t])
        assert -model.score(x, want).mean() < 0.7 * math.log(15)


def test_rare_ids_are_known_apart(llm):
    """180 words, each follows one other: more than the commonest sixty-one have to be told apart."""
    words = [w[1:].decode() for w, _ in sorted(ranks().items(), key=lambda r: r[1]) if w[:1] == b" " and w[1:].isalpha() and w[1:].islower() and len(w) > 7]
    words = words[:180]
    rows = [(k, " ".join(words[(7 * k + j) % 180] for j in range(60))) for k in range(400)]
    got = lm.scored(llm.createDataFrame(rows, "doc_id long, text string"), ranks(), steps=4_000).collect()
    held = [r for r in got if r["held_out"]]
    # With a place for each of the commonest sixty-one ids and one for all others it was -1.25.
    assert held and sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held) > -0.6


def test_words_are_spelt_by_all_their_ids(odd):
    vocabulary = ranks()
    bytes_of = {k + 2: piece for piece, k in vocabulary.items()}
    texts = [(r["text"] or "").encode() for r in odd.collect()] + [b"", b"a", b"Unhappiness xqzt!? \xff\xfe", b"z" * 300]
    names, flat, sizes = lm.words_of(pa.py_buffer(b"".join(texts)), np.array([len(t) for t in texts]))
    ids, own = lm.Pieces(vocabulary).spelt(names, flat, sizes)
    for part, text in zip(np.split(ids, np.cumsum(own)[:-1]), texts):
        assert part[-1] == 1 and b"".join(bytes_of[k] for k in part[:-1]) == b"".join(b" " + w for w in text.lower().split())
    few = lm.Pieces({b" a": 0, b"b": 1, b"bc": 2})
    assert np.frombuffer(few.of(b"abcbx"), np.int32).tolist() == [2, 4, 3, 0]
    assert np.frombuffer(few.of(b"xb"), np.int32).tolist() == [0, 0, 3]
    none = few.spelt([], np.zeros(0, np.int64), np.zeros(0, np.int64))
    assert [len(n) for n in none] == [0, 0]


def test_every_id_of_a_word_counts(llm):
    """Texts that differ behind the leading piece of a word that no training text has."""
    held = [k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2][:3]
    rows = [(k, "the king and the queen went home again") for k in range(100) if k not in held]
    rows += [(held[0], "the kingqx"), (held[1], "the kingqxqxqxqxqx"), (held[2], "the kingqueen")]
    got = {r["doc_id"]: r for r in lm.scored(llm.createDataFrame(rows, "doc_id long, text string"), ranks(), steps=200).collect()}
    scores = [got[k]["score"] for k in held]
    assert scores[1] < scores[0] - 4 and scores[1] < scores[2] - 4
    assert len({got[k]["base_score"] for k in held}) == 1


def test_words_are_those_of_bytes(odd):
    texts = [(r["text"] or "").encode() for r in odd.collect()] + [b"", b" A\x1cb \x0b\x0cB\xff ", b"\t"]
    names, flat, sizes = lm.words_of(pa.py_buffer(b"".join(texts)), np.array([len(t) for t in texts]))
    assert len(set(names)) == len(names) and sizes.sum() == len(flat)
    parts = np.split(flat, np.cumsum(sizes)[:-1])
    assert [[names[k] for k in p[:-1]] for p in parts] == [t.lower().split() for t in texts]
    assert all(p[-1] == len(names) for p in parts)


def brute_kernel(a, b):
    def features(w):
        out = Counter()
        for i in range(len(w)):
            for k in range(i + 2, min(len(w), i + sk.SPAN)):
                for j in range(i + 1, k):
                    out[w[i], w[j], w[k]] += sk.DECAY ** (k - i - 2)
        return out

    x, y = features(a), features(b)
    dot = lambda p, q: sum(p[f] * q[f] for f in p)
    return dot(x, y) / math.sqrt(dot(x, x) * dot(y, y))


def test_kernel_against_its_definition():
    words = ["idiot", "idxiot", "banana", "aaaa", "abc", "trashy", "idiotidiot"]
    got = sk.kernel(words, words)
    want = [[brute_kernel(a, b) for b in words] for a in words]
    assert np.allclose(got, want, atol=1e-5)


def test_units_see_through_signs_and_gaps():
    assert {"idiot", "you"} <= sk.units("you i d i o t !")
    assert "loser" in sk.units("what a l.o.s.e.r")
    assert sk.units("") == sk.units("a b") == set()
    assert all(len(u) <= sk.WINDOW for u in sk.units("y" * 1000 + " z"))


def test_the_machine_holds_no_second_copy_of_its_rows():
    """The driver's peak, in matrices of the normal equations: 3.9 when rows and ridge were whole."""
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(1100, 1200)).astype(np.float32), np.sign(rng.normal(size=1100))
    blocks = []
    for part in (x[:700], x[700:705], x[705:]):
        sk._added(blocks, part)
    assert np.array_equal(np.concatenate(blocks), x) and [len(b) for b in blocks] == [512, 512, 76]
    tracemalloc.start()
    weights, bias = sk._machine(blocks, y, np.ones(1100))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3.5 * 1201**2 * 8
    slack = np.maximum(0, 1 - y * (x @ weights + bias))
    pull = np.r_[x.T.astype(float) @ (slack * y), (slack * y).sum()] / 1100
    assert np.allclose(pull, np.r_[1e-5 * weights, 1e-6 * bias], atol=1e-5)


def test_toxicity_of_held_out_rows(llm, odd):
    rng = random.Random(1)
    plain = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 9))) for _ in range(400)]
    bad = ["grumzol", "vexhort", "plinkard"]
    rows, labels = [], []
    for k in range(600):
        own = [rng.choice(plain) for _ in range(40)]
        toxic = int(k % 4 == 0)
        if toxic:
            own[rng.randrange(40)] = rng.choice(bad)
        rows.append((k, " ".join(own)))
        labels.append((k, toxic))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    known = llm.createDataFrame(labels + [(None, 1), (7, None), (10_000, 1)], "doc_id long, toxic int")
    model = sk.fit(docs, known.filter(~sk.held_out()))
    truth = dict(labels)
    got = sk.with_score(docs, model).withColumn("held", sk.held_out()).filter("held").collect()
    assert got and sum((r["score"] >= 0.5) == truth[r["doc_id"]] for r in got) >= 0.97 * len(got)
    hidden = model.scores(["grumzol here", "well g r u m z o l", "gru.mzol", "grumxzol", "nothing of it", ""])
    assert (hidden[:4] > 0.5).all() and (hidden[4:] < 0.5).all()
    scored = sk.with_score(odd, model)
    assert scored.count() == odd.count() and scored.columns == [*odd.columns, "score"]
    assert all(0 <= r["score"] <= 1 for r in scored.collect())
    flat = sk.fit(docs, known.filter("false"))
    assert {r["score"] for r in sk.with_score(docs.limit(3), flat).collect()} == {0.5}


@pytest.mark.parametrize("round_rows", [1_000, 20])
def test_landmarks_cover_a_rare_language(llm, round_rows):
    rng = random.Random(5)
    plain = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(3, 9))) for _ in range(300)]
    forms = ["quaxwyk" + "".join(rng.choice("abcdefghilmnoprstu") for _ in range(3)) for _ in range(100)]
    rows, labels = [], []
    for k in range(900):
        own = [rng.choice(plain) for _ in range(15)]
        if k % 5 == 0:
            own += ["zyzkov"] if k % 50 == 0 else rng.sample(forms, 15)
        rows.append((k, " ".join(own)))
        labels.append((k, int(k % 5 == 0)))
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    model = sk.fit(docs, llm.createDataFrame(labels, "doc_id long, toxic int"), round_rows=round_rows)
    assert "zyzkov" in model.landmarks
    near = sk.kernel([*forms, "zyzkov"], model.landmarks)
    assert (near.max(axis=1) >= sk.COVERED - 1e-6).all()
    assert (model.scores([*forms, "zyzkov here", "z y z k o v"]) > 0.5).all()
    assert (model.scores(plain) > 0.5).sum() <= 3


PIECES = viterbi.load()
ENCODER = viterbi.Encoder(PIECES)


def brute_ids(text):
    """All boundaries, kept whole: the classical search."""
    best = [(0.0, None, None)]
    for end in range(1, len(text) + 1):
        top = None
        for start in range(max(0, end - PIECES.longest), end):
            piece = PIECES.known.get(text[start:end])
            if piece and (top is None or best[start][0] + piece[1] > top[0]):
                top = (best[start][0] + piece[1], start, [piece[0]])
        if text[end - 1] not in PIECES.known:
            score = best[end - 1][0] + PIECES.unknown_score
            if top is None or score > top[0]:
                top = (score, end - 1, [PIECES.byte_ids[b] for b in text[end - 1].encode("utf-8", "surrogateescape")])
        best.append(top)
    out, end = [], len(text)
    while end:
        _, start, ids = best[end]
        out, end = ids + out, start
    return out


TEXTS = st.text(st.sampled_from("abcdeinorst ▁.,é日😀\n\x00 A0"), max_size=80)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_stream_equals_the_whole_search_and_decodes(text):
    marked = "▁" + text.replace(" ", "▁")
    assert sum(viterbi.stream(marked, PIECES), []) == brute_ids(marked)
    ids = np.frombuffer(ENCODER.encode(text.encode()), np.int32).tolist()
    assert b"".join(PIECES.texts[i] for i in ids)[1:] == text.encode()
    if "▁" not in text:
        assert ids == (brute_ids(marked) if text else [])


@pytest.mark.parametrize("step", [1, 7, 1600])
def test_stream_commits_early(step):
    text = "▁the▁cat" * 200
    parts = list(viterbi.stream((text[k : k + step] for k in range(0, len(text), step)), PIECES))
    assert len(parts) > 20 and sum(parts, []) == brute_ids(text)


def test_stream_holds_a_window_only():
    """Of a long text that comes in slowly, ids come out after a few lengths of the longest piece."""
    given, out, behind = [], 0, 0
    text = "▁the▁quick▁brown" * 300

    def slowly():
        for character in text:
            given.append(character)
            yield character

    for ids in viterbi.stream(slowly(), PIECES):
        out += len(b"".join(PIECES.texts[i] for i in ids).decode())
        behind = max(behind, len(given) - out)
    assert out == len(text) and behind <= 6 * PIECES.longest


def test_every_span_goes_through_the_streaming_search(monkeypatch):
    """The registered path: what is not remembered is searched by ``stream``, short spans too."""
    seen, search = [], viterbi.stream
    monkeypatch.setattr(viterbi, "stream", lambda text, pieces: seen.append("".join(kept := list(text))) or search(kept, pieces))
    viterbi.Encoder(PIECES).encode(b"short words and " + b"x" * 300 + b" short")
    assert "".join(dict.fromkeys(seen)).count("x") == 300 and any(len(s) < 8 for s in seen)


def test_ids_of_odd_rows(llm, odd):
    coded = viterbi.with_ids(odd, PIECES)
    assert coded.columns == [*odd.columns, "ids"]
    for r in viterbi.with_decoded(coded, PIECES).collect():
        assert r["decoded"] == (r["text"] or "").encode()


def decoding_of(columns):
    """The function that ``with_decoded`` gives to Spark, for rows of the named columns."""
    frame = mock.MagicMock(columns=columns)
    frame.sparkSession.sparkContext.broadcast = lambda value: mock.Mock(value=value)
    frame.mapInArrow = lambda function, schema: function
    with mock.patch.object(viterbi, "F"):
        return viterbi.with_decoded(frame, PIECES)


def test_decoding_takes_a_bounded_number_of_ids_at_a_time():
    """A batch of thousands of rows was spelt out as a whole, with 64-bit offsets for each of its ids."""
    own = np.frombuffer(viterbi.Encoder(PIECES).encode(b"some words of a text " * 40), np.int32).tolist()
    lists = [own, None, [], own * 2000, *[own] * 3000]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], ["ids"])
    parts = list(decoding_of(["ids"])(iter([batch])))
    sizes = [[len(i or ()) for i in p.column(0).to_pylist()] for p in parts]
    assert all(sum(n) <= 1 << 18 or len(n) == 1 for n in sizes) and sum(map(len, sizes)) == len(lists)
    spelt = [t for p in parts for t in p.column(1).to_pylist()]
    text = b"some words of a text " * 40
    assert spelt[1:3] == [b"", b""] and set(spelt[4:]) == {text} and spelt[0] == text


def test_the_vocabulary_is_sent_without_what_is_made_from_it():
    pieces = viterbi.load()
    assert pieces.begins and "begins" not in vars(pickle.loads(pickle.dumps(viterbi.load())))


def encoders_held(frame, sent=None):
    """Process and number of the encoders in it, for each batch of a query to which ``sent`` belongs."""

    def count(batches):
        held = sum(type(x).__name__ == "Encoder" for x in gc.get_objects()) if sent is None or sent.value else 0
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([os.getpid()]), pa.array([held])], ["process", "held"])

    return frame.mapInArrow(count, "process long, held long").collect()


def test_workers_let_go_of_the_spans_with_the_query(llm):
    """The spans a worker remembered stayed in it for good, beside all that later queries took."""
    docs = llm.range(64).selectExpr("id as doc_id", "concat('word', id, ' and more') as text").repartition(16)
    pieces = viterbi.load()
    coded = viterbi.with_ids(docs, pieces)
    assert all(bytes(r["decoded"]) == r["text"].encode() for r in viterbi.with_decoded(coded, pieces).collect())
    during = encoders_held(docs, pieces.sent(llm))  # as a decoding task, which takes turns with encoding ones
    having = {r["process"] for r in during if r["held"]}
    assert having  # kept from task to task
    after = encoders_held(docs)
    assert having & {r["process"] for r in after}
    assert sum(r["held"] for r in after) == 0


PAGES = {
    "<p>one<p>two": "one\n\ntwo",
    "<ul><li>a<li>b<ol start=9><li>x<li>y</ol></ul>": "- a\n- b\n  9. x\n  10. y",
    "<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td>kiwi long<td>12</table>after": "Name       Qty\napple      3\nkiwi long  12\n\nafter",
    "<table><tr><td rowspan=2>a<td>b<tr><td>c</table>": "a  b\n   c",
    "<style>.q,#z{display:none}</style><p class='x q'>no</p><b id=z>no</b><i hidden>no</i>yes": "yes",
    "<div style='display: none'>no<p>no</div><span style=\"visibility:hidden\">no</span> yes": "yes",
    "<title>no</title><script>if(a<b)'</p>'</script>a &amp; b &lt;c": "a & b <c",
    "a  b\n c<br>d": "a b c\nd",
    "<pre>\n  k\n   v</pre>x": "  k\n   v\n\nx",
    "<!-- no --><p>a<!-- no": "a",
    "3 < 4 and <b>5</b>": "3 < 4 and 5",
    "<dl><dt>t<dd>d<dt>u<dd>e</dl>": "t\n  d\nu\n  e",
    "<blockquote>q<br>r</blockquote>": "> q\n> r",
    "</p></table></li>ok": "ok",
    "<a title='>'>in</a>": "in",
    "": "",
}


@pytest.mark.parametrize("html", PAGES)
def test_layout(html):
    assert visible_text(html) == PAGES[html]


def test_deep_and_long_pages():
    assert visible_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert visible_text("<b>x " * 3000).split() == ["x"] * 3000
    assert visible_text("<table><tr><td>" * 300 + "in").split() == ["in"]
    assert visible_text("<" * 5000) == "<" * 5000
    assert visible_text("<a '" * 2000).count("a") <= 2000


def test_long_and_stray_quotes_end_with_their_tag():
    long = "x>" * 5000
    for q in "\"'":
        assert visible_text(f"<img src={q}data:{long}{q}>text <a href={q}x{q}>more</a>") == "text more"
        assert visible_text(f"<p data-a={q}{long}{q} hidden>no</p><p title={q}x{q}>yes") == "yes"
    assert visible_text("<a title=it's>one</a> it's <b>two</b>") == "one it's two"
    assert visible_text("<p title=\"x>one</p>two") == "one\n\ntwo"
    for page in ("<a x='>' " * 20_000, "<a x=\"" * 20_000 + ">", "<a " * 20_000, "<a b='" * 20_000):
        visible_text(page)


@pytest.mark.parametrize("sheet, seen", {
    "@media print{.a{display:none}}": True,
    "@media print{p{color:red} .b{x:y}} .a{display:none}": False,
    "@media (max-width: 600px){.a{display:none}}": True,
    "@media only screen and (max-width:600px), print{.a{display:none}}": True,
    "@media (min-width: 768px){.a{display:none}}": False,
    "@media screen{@media print{.a{display:none}}}": True,
    "@media not print{.a{display:none}}": False,
    "@media (400px <= width < 1000px){.a{display:none}}": True,
    "@media (width >= 40em){.a{display:none}}": False,
    "@media (prefers-color-scheme: dark){.a{display:none}}": True,
    "@media (made-up: 3){.a{display:none}}": True,
    "@supports not (display:grid){.a{display:none}}": True,
    "@supports (display:grid){@layer x{.a{display:none}}}": False,
    "@charset 'x{'; /* } */ .a{content:'}';display:none": False,
    ".b{.a{display:none}}": True,
    ".a{@media print{display:none}}": True,
    ".a{color:red;@media screen{display:none}}": False,
}.items())
def test_conditions_of_style_rules(sheet, seen):
    assert visible_text(f"<style>{sheet}</style><p class=a>text") == ("text" if seen else "")
    assert visible_text("<style media=print>.a{display:none}</style><p class=a>text") == "text"


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("<>/ abpulitdr'\"=&;!-\n"), max_size=120))
def test_any_source_renders(html):
    visible_text(html)


def test_pages_with_odd_rows(llm):
    rows = [(1, "<p>x", "u"), (1, "<p>x", "u"), (2, None, None), (None, "", "v")]
    frame = llm.createDataFrame(rows, "page_id long, html string, body string")
    got = with_visible_text(frame).collect()
    assert sorted(r["text"] for r in got) == ["", "", "x", "x"]
    assert with_visible_text(frame.limit(0)).collect() == []
