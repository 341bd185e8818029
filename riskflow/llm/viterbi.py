"""SentencePiece encoding by a streaming Viterbi search, and exact decoding.

The best segmentation under the piece scores is found from left to right. Scores are kept for a
window of the longest piece only; identifiers are given out as soon as all paths that are still alive
run through one boundary. Characters that no longer piece contains, the change from a letter to a space
mark, and letters that stand side by side in no piece, are such boundaries for certain, so a text is
searched span by span; the ids of common spans are remembered.
"""

from __future__ import annotations

import itertools
import math
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.common import in_slices, slices_of

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_REMEMBERED, _LONG = 400_000, 64  # spans whose ids are kept, and how long they are at most
_DECODED = 1 << 18  # ids that are decoded at once; a row of more goes alone


@dataclass
class Pieces:
    """Vocabulary: piece -> (id, score), the ids of the 256 byte pieces, and the text of every id."""

    known: dict[str, tuple[int, float]]
    byte_ids: list[int]
    texts: list[bytes]
    longest: int = field(init=False)
    unknown_score: float = field(init=False)

    def __post_init__(self):
        self.longest = max(map(len, self.known), default=1)
        self.unknown_score = min((s for _, s in self.known.values()), default=0.0) - 10.0

    def __getstate__(self) -> dict:
        """What is worked out from the vocabulary is made where it is used, not sent along."""
        return {k: v for k, v in vars(self).items() if k not in ("begins", "encoder", "broadcast")}

    @cached_property
    def begins(self) -> dict[str, tuple]:
        """Every beginning of a piece; those that are no piece themselves have nothing to give."""
        return {p[:k]: () for p in self.known for k in range(1, len(p))} | self.known

    @cached_property
    def encoder(self) -> Encoder:
        """An encoder, kept from task to task for the spans it remembers.

        It lives as long as these pieces. A kept worker holds those that were sent to it while its tasks
        use them, and lets go of both with the first task that does not. The encoder's own copy makes no cycle.
        """
        return Encoder(replace(self))

    def sent(self, spark: SparkSession) -> Broadcast:
        """The pieces, sent once: a worker that encodes in one task and decodes in the next keeps them."""
        context, sent = vars(self).get("broadcast", (None, None))
        if context is not spark.sparkContext:
            self.broadcast = spark.sparkContext, (sent := spark.sparkContext.broadcast(self))
        return sent


def load(path: str = MODEL) -> Pieces:
    """Read a model file with byte pieces.

    The scores of a byte-pair model are merge ranks, whose sums would favour many short pieces.
    Viterbi needs log probabilities, so a piece has the one that Zipf's law gives its rank.
    """
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    known, byte_ids, texts = {}, [-1] * 256, []
    scale = math.log(math.log(model.get_piece_size()) + 0.5772156649)
    for k in range(model.get_piece_size()):
        piece = model.id_to_piece(k)
        if model.is_byte(k):
            value = int(piece[3:5], 16)
            byte_ids[value] = k
            texts.append(bytes([value]))
        elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
            texts.append(b"")
        else:
            known[piece] = (k, -scale - math.log(len(known) + 1))
            texts.append(piece.replace(SPACE, " ").encode())
    if -1 in byte_ids:
        raise ValueError("the model has no piece for some byte")
    return Pieces(known, byte_ids, texts)


def stream(text: Iterable[str], pieces: Pieces) -> Iterator[list[int]]:
    """Lists of ids, each as soon as it is certain, of a text given a few characters at a time.

    Pieces are tried from each boundary on, once the longest of them is there. What is kept is the text,
    the scores and the ways back since the last certain boundary; where paths keep converging that is a
    few times the longest piece. Of equally good segmentations the one whose last piece is longest wins. A
    character in no piece costs ten more than the worst piece and comes out as its bytes.
    """
    longest, begins, known, unknown = pieces.longest, pieces.begins, pieces.known, pieces.unknown_score
    held, start = "", 0  # the text since the last certain boundary, and the next boundary to go on from
    check = 2 * longest  # where to look next whether paths have met
    best, back, last = [0.0], [0], [None]  # of each boundary in it: score, previous boundary, piece between
    for more in itertools.chain(text, (None,)):
        if more is not None:
            held += more
            best += [-math.inf] * len(more)
            back += [0] * len(more)
            last += [None] * len(more)
        while start < (ready := len(held) - longest + 1 if more is not None else len(held)):
            n = len(held)
            for start in range(start, min(ready, check)):
                base, end = best[start], start + 1
                while end <= n and (found := begins.get(held[start:end])) is not None:
                    if found and base + found[1] > best[end]:
                        best[end], back[end], last[end] = base + found[1], start, found[0]
                    end += 1
                if held[start] not in known and base + unknown > best[start + 1]:
                    best[start + 1], back[start + 1], last[start + 1] = base + unknown, start, held[start]
            start += 1
            if start < check:
                continue
            if start < n and (met := _met(best, back, start, min(n, start + longest - 1))):
                yield _path(back, last, met, pieces)
                held, best, back, last = held[met:], best[met:], [p - met for p in back[met:]], last[met:]
                start -= met
                lowest = best[start]
                best = [b - lowest for b in best]  # only differences matter
            check = start + longest
    if held:
        yield _path(back, last, len(held), pieces)


def _met(best: list[float], back: list[int], start: int, stop: int) -> int:
    """The boundary that the best ways to all reached boundaries from ``start`` to ``stop`` run through; 0 if none."""
    alive = {k for k in range(start, stop + 1) if best[k] > -math.inf}
    while len(alive) > 1:
        end = max(alive)
        alive.remove(end)
        alive.add(back[end])
    return alive.pop()


def _path(back: list[int], last: list, end: int, pieces: Pieces) -> list[int]:
    """Ids of the best way to ``end``; a character in no piece gives those of its bytes."""
    out: list[int] = []
    while end:
        piece = last[end]
        if isinstance(piece, int):
            out.append(piece)
        else:
            out += [pieces.byte_ids[b] for b in reversed(piece.encode("utf-8", "surrogateescape"))]
        end = back[end]
    return out[::-1]


class Encoder(dict):
    """Span -> bytes of its 32-bit ids; spans end where every path has a boundary."""

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces
        self.pairs = {pair for p in pieces.known for pair in zip(p, p[1:])}
        self.parts: dict[str, bytes] = {}
        joined = {c for p in pieces.known if len(p) > 1 for c in p}
        if any(SPACE in p.lstrip(SPACE) for p in pieces.known):
            self.spans = re.compile(f"[{_class(joined)}]+|.", re.DOTALL) if joined else re.compile(".", re.DOTALL)
        else:
            joined.discard(SPACE)
            letters = f"{SPACE}*[{_class(joined)}]+|" if joined else ""
            self.spans = re.compile(f"{letters}{SPACE}+|.", re.DOTALL)

    def __missing__(self, span: str) -> bytes:
        found = b"".join(map(self._part, self._parts(span)))
        if len(self) < _REMEMBERED and len(span) <= _LONG:
            self[span] = found  # common spans come early
        return found

    def _parts(self, span: str) -> list[str]:
        """The span cut between any two letters that stand side by side in no piece."""
        pairs = self.pairs
        cuts = [k for k, pair in enumerate(zip(span, span[1:]), 1) if pair not in pairs]
        return [span[a:b] for a, b in zip([0, *cuts], [*cuts, len(span)])] if cuts else [span]

    def _part(self, part: str) -> bytes:
        """Ids of a part by the streaming search; a long part goes through it a piece's length at a time."""
        found = self.parts.get(part)
        if found is None:
            chunks = (part,) if len(part) <= _LONG else (part[k : k + _LONG] for k in range(0, len(part), _LONG))
            ids = list(itertools.chain.from_iterable(stream(chunks, self.pieces)))
            found = struct.pack(f"<{len(ids)}i", *ids)
            if len(self.parts) < _REMEMBERED and len(part) <= _LONG:
                self.parts[part] = found
        return found

    def encode(self, text: bytes) -> bytes:
        """Ids of one text; bytes that are not UTF-8, and a space mark in the text, become byte pieces."""
        if not text:
            return b""
        marked = " " + text.decode("utf-8", "surrogateescape")
        if SPACE in marked:
            parts = marked.split(SPACE)
            mark = np.array([self.pieces.byte_ids[b] for b in SPACE.encode()], np.int32).tobytes()
            return mark.join(b"".join(map(self.__getitem__, self._cut(p))) for p in parts)
        return b"".join(map(self.__getitem__, self._cut(marked)))

    def _cut(self, text: str) -> list[str]:
        return self.spans.findall(text.replace(" ", SPACE))


def _class(characters: set[str]) -> str:
    return "".join(map(re.escape, sorted(characters)))


def with_ids(docs: DataFrame, pieces: Pieces, text: str = "text", name: str = "ids") -> DataFrame:
    """All columns of ``docs`` and the ids of each whole text, as an array of int.

    Null and empty texts have no ids. The vocabulary goes along with the function; its size is that
    of the model file. The name must be free; repeated rows get equal ids.
    """
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"there is a column {name} already")
    at = docs.columns.index(text)
    sent = pieces.sent(docs.sparkSession)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = sent.value.encoder
        for batch in batches:
            for start, stop in in_slices(batch.column(at)):
                part = batch.slice(start, stop - start)
                coded = [encoder.encode(t.as_py() or b"") for t in part.column(at).cast(pa.binary())]
                ends = np.cumsum([0, *(len(c) // 4 for c in coded)])
                ids = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), np.int32))
                )
                yield pa.RecordBatch.from_arrays([*part.columns, ids], [*batch.schema.names, name])

    return docs.mapInArrow(encode, docs.withColumn(name, F.array(F.lit(0))).schema)


def with_decoded(coded: DataFrame, pieces: Pieces, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """All columns and the bytes that the ids stand for; null ids count as none."""
    at = coded.columns.index(ids)
    sent = pieces.sent(coded.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array(sent.value.texts, pa.large_binary())
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
            # A batch holds thousands of rows, whose ids as text with 64-bit offsets take many times the texts.
            for start, stop in slices_of(sizes, _DECODED):
                part = batch.slice(start, stop - start)
                spelt = table.take(part.column(at).flatten())
                ends = np.r_[0, np.cumsum(pc.binary_length(spelt).to_numpy(zero_copy_only=False), dtype=np.int64)]
                data, cuts = memoryview(spelt.buffers()[2] or b""), ends[np.r_[0, np.cumsum(sizes[start:stop])]]
                # The space in front of a text is not part of it.
                texts = [bytes(data[a + 1 : b]) for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*batch.schema.names, name])

    return coded.mapInArrow(decode, coded.withColumn(name, F.lit(b"")).schema)
