"""Spelling variants: the automata, the parts, and the whole operator against plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.llm.acceptor import Acceptor, one_edit_pairs
from riskflow.llm.spelling_variants import near_pairs, parts, runs, spelling_variants, with_forms


def near(a: str, b: str) -> bool:
    """One inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    return {frozenset((a, b)) for a in words for b in words if a < b and near(a, b)}


def accepted(acceptor):
    """All words in order, by walking the arcs."""
    out, todo = [], [(acceptor.initial, "")]
    while todo:
        state, word = todo.pop()
        if acceptor.final[state]:
            out.append(word)
        todo += [(t, word + label) for label, t, _ in reversed(acceptor.arcs[state])]
    return out


WORDS = st.lists(st.text("abé", max_size=6), max_size=25, unique=True).map(sorted)


@settings(max_examples=150, deadline=None)
@given(WORDS)
def test_acceptor_is_exact_and_minimal(words):
    acceptor = Acceptor(words)
    assert accepted(acceptor) == words
    rests = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert len(acceptor.arcs) == max(1, len(rests))


@settings(max_examples=150, deadline=None)
@given(WORDS)
def test_composition_accepts_the_pairs_one_edit_apart(words):
    found = one_edit_pairs(words)
    assert {frozenset((words[i], words[j])) for i, j in found} == brute(words)
    assert all((len(words[i]), words[i]) < (len(words[j]), words[j]) for i, j in found)


def test_very_long_words():
    words = sorted(["x" * 9000, "x" * 9001, "x" * 4000 + "y" + "x" * 4999, "y" * 9000])
    found = {frozenset((len(words[i]), len(words[j]), words[i][4000], words[j][4000])) for i, j in one_edit_pairs(words)}
    assert len(one_edit_pairs(words)) == 2 and found == {frozenset((9000, "x", "y")), frozenset((9000, 9001, "x"))}


def vocabulary(seed, count):
    rng = random.Random(seed)
    words = set()
    while len(words) < count:
        word = "".join(rng.choice("abcé") for _ in range(rng.randint(1, 9)))
        words |= {word, word[:-1] + "a" * rng.randint(0, 3)}
    return sorted(words - {""}) + ["", "aaaaaaaaaaaaa", "aaaaaaaaaaaa"]


@pytest.mark.parametrize("part_words", [20_000, 6])
def test_parts_meet_every_pair_once(llm, part_words):
    words = sorted(set(vocabulary(3, 700)))
    frame = llm.createDataFrame([(w, len(w) + 1) for w in words], "word string, n long")
    found = near_pairs(frame, part_words).collect()
    pairs = [frozenset((r.a, r.b)) for r in found]
    assert len(pairs) == len(set(pairs)) and set(pairs) == brute(words)
    assert all((r.a_n, r.b_n) == (len(r.a) + 1, len(r.b) + 1) for r in found)


def test_large_parts_are_split(llm):
    words = [f"same{a}{b}{c}{d}" for a in "abcdef" for b in "abcdef" for c in "abcdef" for d in "abcdef"]
    frame = llm.createDataFrame([(w, 1) for w in words], "word string, n long")
    most = parts(frame, 50).filter("m >= 2").groupBy("m", "state").count().agg(F.max("count")).first()[0]
    assert most <= 50


def expected(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    around = {w: [] for w in words}
    for a, b in map(tuple, brute(words)):
        around[a].append(b)
        around[b].append(a)
    form = {}
    for w, others in around.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(around[w]), form[w], form[w] and words[form[w]], root))
    return sorted(out)


def test_whole_operator(llm):
    rng = random.Random(5)
    rows = []
    for k in range(400):
        text = " ".join(rng.choice(["Garantie", "garantía", "Straßenbahn", "ÉCOLESÀB", "variants", "variant"]) for _ in range(60))
        text += " Variantss" * (k % 20 == 0) + " variantsss" * (k in (3, 7))
        rows.append((k, text))
    rows += [(None, "garantie garantie"), (None, None), (5, ""), (6, "variants" * 2000), rows[0]]
    docs = llm.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("w")).withColumn("n", F.lit(1))
    found = sorted(map(tuple, spelling_variants(docs).select("word", "n", "n_near", "form", "form_n", "root").collect()))
    assert found == expected(rows)
    roots = {r[0]: r[5] for r in found}
    assert roots["variantsss"] == roots["variantss"] == "variants"  # by a chain of forms


def test_chain_of_forms(llm):
    words = llm.createDataFrame([(f"chainin{'g' * k}", 10 ** (6 - k)) for k in range(7)], "word string, n long")
    found = with_forms(words, near_pairs(words)).collect()
    assert {r.root for r in found} == {"chainin"} and sum(r.form is None for r in found) == 1


def test_odd_rows_and_empty_table(odd, llm):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    found = spelling_variants(odd).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert sorted(map(tuple, found)) == expected(rows)
    empty = llm.createDataFrame([], "doc_id long, text string")
    assert spelling_variants(empty).count() == 0 and runs(empty).count() == 0
