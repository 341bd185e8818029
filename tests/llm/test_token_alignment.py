"""Cross-tokenizer alignment against a plain loop over the two libraries' own encoders."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskflow.llm import queries
from riskflow.llm.token_alignment import BYTE_BPE, PIECES, aligned_slices, load_byte_bpe, load_pieces, with_alignment

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(BYTE_BPE)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    return (
        lambda t: first.encode(" " + t, add_special_tokens=False).ids, load_byte_bpe()[1],
        lambda t: second.encode(t), load_pieces()[1],
    )


def ends_of(ids, texts):
    out, at = [], 0
    for k in ids:
        at += len(texts[k])
        out.append(at)
    return out


def expected(rows, encoders):
    encode_a, bytes_a, encode_b, bytes_b = encoders
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a, b = (encode_a(text), encode_b(text)) if text else ([], [])
        want = (" " + (text or "")).encode() if text else b""
        if b"".join(bytes_a[k] for k in a) != want or b"".join(bytes_b[k] for k in b) != want:
            a, b = [], []
        ends_a, ends_b = ends_of(a, bytes_a), ends_of(b, bytes_b)
        both = sorted(set(ends_a) & set(ends_b))
        groups, start = [], 0
        for end in both:
            parts = [[k for k, e in zip(ids, ends) if start < e <= end] for ids, ends in ((a, ends_a), (b, ends_b))]
            groups.append("|".join(",".join(map(str, p)) for p in parts))
            start = end
        links = [(k, m) for k, e in zip(a, ends_a) for m, f in zip(b, ends_b) if e == f]
        counts.update(links)
        docs.append((doc_id, len(a), len(b), len(both), links, ";".join(groups)))
    best = Counter()
    for (_, m), n in counts.items():
        best[m] = max(best[m], n)
    return sorted(
        (
            (d, n_a, n_b, n_groups, len(links), sum(counts[l] == best[l[1]] for l in links), sum(counts[l] for l in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "")
            for d, n_a, n_b, n_groups, links, g in docs
        ),
        key=repr,
    )


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [
    "Hello world, hello  tokens", "", None, "a ▁ b", "<|endoftext|> and <s> </s> <unk> <0x41>", "naïve café — 日本語 😀😀",
    "tabs\tand\nnew\r\n\r\nlines   end ", " leading space", "x" * 5000, "  ", "\x00\x01\x7f", "don't we'll I'M", "12345 678",
    "a b　c​d\x85e", "ʼn ﬁ Ⅷ ½ ᠎", "word " * 2000, "Hello world, hello  tokens",
]


def found(frame, key="row.doc_id"):
    return sorted((tuple(r) for r in frame.select(key, *COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("slice_bytes", [4 << 20, 40])
def test_texts_of_all_kinds(llm, encoders, slice_bytes):
    rows = list(enumerate(TEXTS))
    docs = llm.createDataFrame(rows, "doc_id long, text string").withColumn("slice", F.lit("s")).withColumn("pair", F.lit(1))
    marked = with_alignment(docs.repartition(3), slice_bytes=slice_bytes)
    assert found(marked) == expected(rows, encoders)
    assert set(marked.select("row.*").columns) == {"doc_id", "slice", "pair"}


def test_cuts_before_spaces_change_nothing(llm, encoders):
    """White space of all kinds, in runs, and signs next to it."""
    rng = random.Random(11)
    signs = ["a", "Bc", "é", "日", "1", "!", "'s", "▁", " ", " ", "  ", "\n", "\t", "\x1c", "\x85", "\u3000", "\u200b", "²", "_"]
    rows = [(k, "".join(rng.choice(signs) for _ in range(rng.randint(1, 40)))) for k in range(600)]
    assert found(with_alignment(llm.createDataFrame(rows, "doc_id long, text string"))) == expected(rows, encoders)


def test_odd_rows_and_empty_table(odd, llm, encoders):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(with_alignment(odd)) == expected(rows, encoders)
    assert with_alignment(llm.createDataFrame([], "doc_id long, text string")).count() == 0
    only = llm.createDataFrame([("a b",)], "text string")
    assert with_alignment(only).first().n_a > 0


def test_registered_query_on_whole_documents(llm, encoders):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    result = queries.QUERIES["op11_token_alignment"](llm, SMALL)
    assert found(result, "doc_id") == expected([tuple(r) for r in docs], encoders)


def test_files_whose_split_pattern_is_unknown_are_refused(llm, tmp_path):
    other = tmp_path / "other.json"
    other.write_text('{"pre_tokenizer": {"type": "Whitespace"}, "model": {"type": "BPE", "vocab": {"a": 0}}, "added_tokens": []}')
    with pytest.raises(ValueError):
        with_alignment(llm.createDataFrame([("a",)], "text string"), byte_bpe=str(other))


def test_rows_of_slices_stay_small(llm):
    """A slice is one row, held whole by a worker and by the JVM that sorts it: bounded, whatever the table."""
    rows = [(k, " ".join(f"w{k}x{n}" for n in range(1500))) for k in range(80)]
    slices = aligned_slices(llm.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    most = max(sum(len(rows[r.doc_id][1]) for r in s.rows) for s in slices.select("rows").collect())
    assert sum(len(t) for _, t in rows) > 1 << 19 and most <= 1 << 18
    lists = [F.length(c) for c in ("doc", "doc_pair", "doc_n")]  # packed: four bytes a number
    assert all(a == b == c and a % 4 == 0 for a, b, c in slices.select(*lists).collect())
