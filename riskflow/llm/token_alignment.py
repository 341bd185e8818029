"""Alignment of two tokenizers' tokens by the byte offsets where both end.

Texts are tokenised in slices of a quarter of a megabyte, and each slice is worked on as Arrow tables. The lists
of ids are flattened with the indices of their documents, running sums of token bytes, started anew at
each document, give the ends of tokens, and a hash join on (document, end) finds the links and the
places where both cut. ``Table.group_by`` counts the linked id pairs of a slice; Spark merges these
counts. Each slice then gets back the counts of the pairs it holds, one row a pair, so neither the
table of all pairs nor a token goes anywhere as a whole.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import bucketed, in_slices

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
SLICE_BYTES = 1 << 18  # a slice is one row, in the worker and in the JVM
REMEMBERED = 100_000  # parts of texts of which a worker keeps the ids
SPACE_MARK = "▁"
# Before a space behind what is surely no white space; no piece of a model may hold a space behind other text.
# A single space at the end stays with its word, as nothing gets no space in front.
_CUT = re.compile(r"(?<=[\w!-~])(?= .)", re.DOTALL)
_SHIFT = 20  # an id pair as one number: a << 20 | b


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def load_byte_bpe(path: str = BYTE_BPE) -> tuple[str, list[bytes], set[int]]:
    """The tokenizer file as text, the bytes of each id, and the ids of special tokens."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    told, byte_of = json.loads(text), _byte_of()
    special = {t["id"] for t in told["added_tokens"] if t["special"]}
    entries = told["model"]["vocab"]
    texts = [b""] * (1 + max(entries.values()))
    for entry, k in entries.items():
        texts[k] = b"" if k in special else bytes(byte_of[c] for c in entry)
    return text, texts, special


def load_pieces(path: str = PIECES) -> tuple[bytes, list[bytes]]:
    """The model file and the bytes of each id; control pieces have none."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    texts = []
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            texts.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            texts.append(b"")
        else:
            texts.append(piece.replace(SPACE_MARK, " ").encode())
    if any(b" " in t.lstrip(b" ") for t in texts):
        raise ValueError("texts cannot be cut before spaces: a piece holds one behind other text")
    with open(path, "rb") as file:
        return file.read(), texts


class _Tokens:
    """One tokenizer in a worker: how it encodes, and its ids' bytes as Arrow arrays.

    ``cut`` says that texts are cut before encoding, and parts met first, the common ones, remembered.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], texts: list[bytes], cut: bool):
        self.encode, self.cut = encode, cut
        self.known: dict[str, bytes] = {}
        self.bytes = pa.array(texts, pa.binary())
        self.sizes = pa.array([len(t) for t in texts], pa.int64())
        ids = [str(k) for k in range(len(texts))]
        # An id in front of another of its group, of the other side or of the next group, or of nothing.
        self.written = pa.array([k + sign for sign in (",", "|", ";", "") for k in ids], pa.large_string())

    def lists(self, texts: list[str]) -> tuple[pa.ListArray, np.ndarray]:
        """Lists of ids, and the text that each is of. Texts begin with a space, or are empty."""
        if not self.cut:
            coded = self.encode(texts)
            ends = np.cumsum([0, *map(len, coded)])
            flat = np.fromiter(itertools.chain.from_iterable(coded), np.int32, int(ends[-1]))
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)), np.arange(len(texts))
        cut = [_CUT.split(t) if t else [] for t in texts]
        parts = pa.array(list(itertools.chain.from_iterable(cut)), pa.large_string()).dictionary_encode()
        distinct, known = parts.dictionary.to_pylist(), self.known
        new = [p for p in distinct if p not in known]
        found = {p: struct.pack(f"<{len(ids)}i", *ids) for p, ids in zip(new, self.encode(new))}
        coded = [known.get(p) or found.get(p, b"") for p in distinct]
        known.update(itertools.islice(((p, c) for p, c in found.items() if len(p) < 64), max(0, REMEMBERED - len(known))))
        ends = np.cumsum([0, *map(len, coded)]) // 4
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), np.int32)))
        return lists.take(parts.indices), np.repeat(np.arange(len(texts)), [len(c) for c in cut])


_CACHED: dict[str, tuple[_Tokens, _Tokens]] = {}


def _tokenizers(sent, name: str) -> tuple[_Tokens, _Tokens]:
    """Both tokenizers of the process, kept from task to task; ``name`` tells one pair of files from another."""
    if name not in _CACHED:
        import tiktoken
        from sentencepiece import SentencePieceProcessor

        pattern, byte_texts, special, model, piece_texts = sent.value
        ranks = {t: k for k, t in enumerate(byte_texts) if t and k not in special}
        bpe = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        pieces = SentencePieceProcessor(model_proto=model)
        _CACHED.clear()
        # The second puts a space in front itself.
        _CACHED[name] = (
            _Tokens(lambda texts: [bpe.encode_ordinary(t) for t in texts], byte_texts, cut=False),
            _Tokens(lambda parts: pieces.encode([t[1:] for t in parts], num_threads=1), piece_texts, cut=True),
        )
    return _CACHED[name]


def _table(texts: pa.Array, tokens: _Tokens) -> tuple[pa.Table, np.ndarray]:
    """``doc, key, id`` of all tokens in order, and which documents' bytes the tokens spell.

    ``texts`` have their leading space; a key is the document and the byte offset in it where the token ends.
    """
    lists, of = tokens.lists(texts.to_pylist())
    token, doc = pc.list_flatten(lists), pc.take(pa.array(of), pc.list_parent_indices(lists))
    reached = pa.concat_arrays([pa.array([0], pa.int64()), pc.cumulative_sum(pc.take(tokens.sizes, token))])
    firsts = np.searchsorted(doc.to_numpy(), np.arange(len(texts) + 1))
    before = pc.take(reached, pa.array(firsts))  # bytes of all documents before, and of all
    end = pc.subtract(reached.slice(1), pc.take(before, doc))
    spelt = _spells(pc.take(tokens.bytes, token), before.to_numpy(), texts)
    key = pc.bit_wise_or(pc.shift_left(doc, 40), end)
    return pa.table({"doc": doc, "key": key, "id": token}), spelt


def _joined(values: pa.Array) -> memoryview:
    """The bytes of all values in turn."""
    wide = values.cast(pa.large_binary())
    if not len(wide):
        return memoryview(b"")
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    return memoryview(wide.buffers()[2] or b"")[offsets[0] : offsets[-1]]


def _spells(pieces: pa.Array, before: np.ndarray, texts: pa.Array) -> np.ndarray:
    """Documents of which the pieces, joined, are the text."""
    have, want = _joined(pieces), _joined(texts)
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    same = np.diff(before) == sizes
    if same.all() and have == want:
        return same
    for k in np.flatnonzero(same):
        same[k] = have[before[k] : before[k + 1]] == want[starts[k] : starts[k + 1]]
    return same


def _flags(links: pa.Table, column: str, count: int) -> np.ndarray:
    out = np.zeros(count, bool)
    out[links.column(column).to_numpy()] = True
    return out


def _groups_text(a: pa.Table, b: pa.Table, cut_a: np.ndarray, cut_b: np.ndarray, docs: int, tokens) -> tuple[memoryview, np.ndarray]:
    """All documents' groups as written (``a1,a2|b1;a3|b2,b3``), in turn, and where each document's begin and end."""
    group_a, group_b = (np.cumsum(cut) - cut for cut in (cut_a, cut_b))  # of each token; they run on over documents
    groups = int(cut_a.sum())
    # Behind the tokens of A up to a group's end stand those of B in the groups before it, and the reverse.
    place_a = np.arange(len(group_a)) + np.searchsorted(group_b, group_a, "left")
    place_b = np.arange(len(group_b)) + np.searchsorted(group_a, group_b, "right")
    doc_a, doc_b = (t.column("doc").to_numpy() for t in (a, b))
    last = np.zeros(len(doc_b), bool)
    if len(doc_b):
        last[:-1], last[-1] = doc_b[1:] != doc_b[:-1], True
    entries = len(tokens[0].bytes), len(tokens[1].bytes)
    sign_a, sign_b = np.where(cut_a, 1, 0), np.where(last, 3, np.where(cut_b, 2, 0))
    index = np.empty(len(group_a) + len(group_b), np.int64)
    index[place_a] = a.column("id").to_numpy() + sign_a * entries[0]
    index[place_b] = 4 * entries[0] + b.column("id").to_numpy() + sign_b * entries[1]
    written = pc.take(pa.concat_arrays([t.written for t in tokens]), pa.array(index))
    assert groups == int(cut_b.sum())
    in_doc = np.bincount(doc_a, minlength=docs) + np.bincount(doc_b, minlength=docs)
    sizes = np.r_[0, np.cumsum(pc.binary_length(written).to_numpy(zero_copy_only=False))].astype(np.int64)
    return _joined(written), sizes[np.r_[0, np.cumsum(in_doc)]]


def _align(texts: pa.Array, tokens: tuple[_Tokens, _Tokens]) -> dict:
    """Counts per document, and counts of the linked pairs per document and of the slice."""
    docs = len(texts)
    strings = [t.as_py() or "" for t in texts]
    spaced = pa.array([f" {t}" if t else "" for t in strings], pa.large_string())
    (a, spelt_a), (b, spelt_b) = (_table(spaced, t) for t in tokens)
    whole = pa.array(spelt_a & spelt_b)
    a, b = (t.filter(pc.take(whole, t.column("doc"))) for t in (a, b))
    a, b = (t.append_column("at", pa.array(np.arange(len(t)))) for t in (a, b))
    links = a.select(["key", "at"]).join(b.select(["key", "at"]), "key", join_type="inner", right_suffix="_b", use_threads=False)
    links = pa.table({"at_a": links.column("at"), "at_b": links.column("at_b")})
    doc_of_link, id_a = (pc.take(a.column(n), links.column("at_a")) for n in ("doc", "id"))
    id_b = pc.take(b.column("id"), links.column("at_b"))
    pair = pc.bit_wise_or(pc.shift_left(id_a.cast(pa.int64()), _SHIFT), id_b.cast(pa.int64()))
    linked = pa.table({"doc": doc_of_link, "pair": pair})
    in_doc = linked.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
    in_doc = in_doc.rename_columns(["doc", "pair", "n"])
    in_slice = in_doc.group_by("pair", use_threads=False).aggregate([("n", "sum")]).rename_columns(["pair", "n"])
    in_slice = in_slice.sort_by("pair")
    place = np.searchsorted(in_slice.column("pair").to_numpy(), in_doc.column("pair").to_numpy())
    cut_a, cut_b = _flags(links, "at_a", len(a)), _flags(links, "at_b", len(b))
    text, ends = _groups_text(a, b, cut_a, cut_b, docs, tokens)
    doc_a, doc_b, doc_l = (t.column("doc").to_numpy() for t in (a, b, linked))
    counted = lambda doc: np.bincount(doc, minlength=docs).astype(np.int64)
    return {
        "n_a": counted(doc_a),
        "n_b": counted(doc_b),
        "n_groups": counted(doc_a[cut_a]),
        "n_links": counted(doc_l),
        "sha": [hashlib.sha256(text[s:e]).hexdigest() if e > s else "" for s, e in zip(ends, ends[1:])],
        "doc": in_doc.column("doc"),
        "doc_pair": pa.array(place),
        "doc_n": in_doc.column("n"),
        "pair": in_slice.column("pair"),
        "n": in_slice.column("n"),
    }


def _one_row(columns: dict[str, pa.Array]) -> list[pa.Array]:
    """Each array as the one list of a row."""
    return [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in columns.values()]


def _flat(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else pa.array(column)


_LISTS = {
    **{name: pa.int64() for name in ("n_a", "n_b", "n_groups", "n_links")}, "sha": pa.string(), "pair": pa.int64(), "n": pa.int64(),
}
_PACKED = ("doc", "doc_pair", "doc_n")  # read in Python only: 32-bit numbers in one binary value, a few per token
_SPARK = {pa.int64(): "long", pa.string(): "string"}


def _packed(column) -> pa.Array:
    return pa.array([_flat(column).to_numpy(zero_copy_only=False).astype(np.int32).tobytes()], pa.binary())


def aligned_slices(
    docs: DataFrame, text: str = "text", *, byte_bpe: str = BYTE_BPE, pieces: str = PIECES, slice_bytes: int = SLICE_BYTES
) -> DataFrame:
    """One row per slice of documents, in a table bucketed by slice.

    ``rows`` has the other columns of each document, ``n_a`` to ``sha`` its counts and digest; ``pair, n``
    count the linked pairs of the slice, ``doc, doc_pair, doc_n`` (packed) those of each document (places
    in the slice and among its pairs). A document longer than a slice has one of its own.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("int").alias("none")]
    source = docs.select(F.struct(*others).alias("row"), F.col(f"`{text}`").alias("body"))
    file, byte_texts, special = load_byte_bpe(byte_bpe)
    model, piece_texts = load_pieces(pieces)
    name = hashlib.sha256(file.encode() + model).hexdigest()
    sent = docs.sparkSession.sparkContext.broadcast((_pattern(file), byte_texts, special, model, piece_texts))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, number = _tokenizers(sent, name), TaskContext.get().partitionId() << 32
        for batch in batches:
            for start, stop in in_slices(batch.column(1), slice_bytes):
                part = batch.slice(start, stop - start)
                found = _align(part.column(1), tokens)
                lists = {"rows": pa.concat_arrays([part.column(0)]), **{k: _flat(found[k]).cast(t) for k, t in _LISTS.items()}}
                packed = [_packed(found[k]) for k in _PACKED]
                yield pa.RecordBatch.from_arrays([pa.array([number]), *_one_row(lists), *packed], ["slice", *lists, *_PACKED])
                number += 1

    row_type = source.schema["row"].dataType.simpleString()
    shape = ", ".join([*(f"{name} array<{_SPARK[kind]}>" for name, kind in _LISTS.items()), *(f"{name} binary" for name in _PACKED)])
    rows = source.mapInArrow(align, f"slice long, rows array<{row_type}>, {shape}")
    return bucketed(rows, "slice", "aligned", **{"parquet.block.size": 16 << 20})


def _pattern(file: str) -> str:
    """The split pattern that belongs to the file's byte-level pre-tokenizer."""
    told = json.loads(file)
    kind, merges = told["pre_tokenizer"], told["model"]
    if kind["type"] != "ByteLevel" or not kind["use_regex"] or kind["add_prefix_space"] or merges["type"] != "BPE":
        raise ValueError("a byte-level BPE file with its usual split pattern is needed")
    # Fixed value: the pattern of byte-level pre-tokenizers.
    return r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def pair_counts(slices: DataFrame) -> DataFrame:
    """``pair, links, best``: links of each id pair, and whether no pair of its B id has more."""
    counts = slices.select(F.inline(F.arrays_zip("pair", "n"))).groupBy("pair").agg(F.sum("n").alias("links"))
    b = F.col("pair").bitwiseAND(F.lit((1 << _SHIFT) - 1))
    most = counts.groupBy(b.alias("b")).agg(F.max("links").alias("most"))
    joined = counts.withColumn("b", b).join(most, "b")
    return joined.select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def with_alignment(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each document.

    ``row`` is a struct of all other columns of ``docs``, so that no name clashes. Null and empty texts,
    and texts whose tokens of either kind do not spell them with a space in front, have no tokens: zeros
    and an empty digest. Repeated rows each count. An empty table gives an empty result.
    """
    slices = aligned_slices(docs, text, **options)
    told = slices.select("slice", F.explode("pair").alias("pair")).join(pair_counts(slices), "pair")
    answers = told.groupBy("slice").agg(
        F.collect_list(F.struct("pair", "links", "best")).alias("answers")  # as many as pairs of the slice
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield _summed({n: c[k] for n, c in zip(batch.schema.names, batch.columns)})

    row_type = slices.schema["rows"].dataType.elementType.simpleString()
    columns = ["slice", "rows", "n_a", "n_b", "n_groups", "n_links", "sha", "doc", "doc_pair", "doc_n", "pair"]
    joined = slices.select(*columns).join(answers, "slice", "left")
    shape = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return joined.mapInArrow(summed, f"row {row_type}, {shape}")


def _summed(slice_row: dict) -> pa.RecordBatch:
    """The documents of a slice with their sums over pair counts."""
    rows = slice_row["rows"].values
    n_best, count_sum = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    doc, at_pair, n = (pa.array(np.frombuffer(slice_row[name].as_buffer(), np.int32)) for name in _PACKED)
    if len(doc):
        # Every pair of the slice has its answer, and in order of pairs they stand as the pairs do.
        told = pa.table(slice_row["answers"].values.flatten(), names=["pair", "links", "best"]).sort_by("pair")
        assert told.column("pair").combine_chunks().equals(slice_row["pair"].values)
        n, links, best = n.cast(pa.int64()), pc.take(told.column("links"), at_pair), pc.take(told.column("best"), at_pair)
        sums = pa.table({"doc": doc, "best": pc.multiply(n, best.cast(pa.int64())), "total": pc.multiply(n, links)})
        sums = sums.group_by("doc", use_threads=False).aggregate([("best", "sum"), ("total", "sum")])
        at = sums.column("doc").to_numpy()
        n_best[at], count_sum[at] = sums.column("best_sum").to_numpy(), sums.column("total_sum").to_numpy()
    columns = [slice_row[n].values for n in ("n_a", "n_b", "n_groups", "n_links")]
    columns += [pa.array(n_best), pa.array(count_sum), slice_row["sha"].values]
    names = ["row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.RecordBatch.from_arrays([rows, *columns], names)
