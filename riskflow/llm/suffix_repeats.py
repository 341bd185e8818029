"""Exact removal of long repeated passages with a difference-cover sample of suffixes.

Suffixes are sorted only as deep as a passage has to be long, which bounds the recursion. With a
cover D of the residues modulo v, any two positions i and j have an offset k < v for which both
i + k and j + k lie on D. So:

1. whole copies are found by digest, and one of each is sampled;
2. the sampled suffixes (positions on D) are named by their first ``length - v + 1`` bytes; names are
   sorted, and only names held by several suffixes can lie in a repeat. As names already reach as
   deep as the order is needed, the recursion on names ends at its first level;
3. the remaining suffixes that reach such a sample within v bytes are named by a sampled suffix and
   the bytes before it, that is by their first ``length`` bytes, sorted, and adjacent equal prefixes
   are the repeats.

Names are 64-bit polynomial hashes of the bytes; sorting and comparing happens per bucket of names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import blocks
from riskflow.llm.common import stored

PERIOD = 273  # 16 * 16 + 16 + 1: a perfect difference set of 17 residues exists
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLICE = 1 << 20


@lru_cache(maxsize=4)
def difference_cover(period: int = PERIOD, base: int = 2) -> tuple[int, ...]:
    """Residues whose differences meet every residue exactly once.

    For a perfect difference set with multiplier ``base`` the set is a union of orbits of
    multiplication by it, which leaves few candidates.
    """
    left, orbits = set(range(period)), []
    while left:
        x = min(left)
        orbit = {x}
        while (x := x * base % period) not in orbit:
            orbit.add(x)
        orbits.append(orbit)
        left -= orbit
    size = round(period**0.5)
    size = next(k for k in (size, size + 1) if k * (k - 1) == period - 1)
    for n in range(1, 5):
        for chosen in itertools.combinations(orbits, n):
            cover = sorted(set().union(*chosen))
            if len(cover) == size and len({(a - b) % period for a in cover for b in cover}) == period:
                return tuple(cover)
    raise ValueError(f"no perfect difference set modulo {period}")


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random value per byte, and powers of the base and of its inverse."""
    of_byte = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.r_[np.uint64(1), np.full(_SLICE + (1 << 16), _BASE)])
        inverses = np.cumprod(np.r_[np.uint64(1), np.full(_SLICE, inverse)])
    return of_byte, powers, inverses


def window_names(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Hashes of ``data[p : p + width]`` for ascending positions p, computed slice by slice."""
    of_byte, powers, inverses = _tables()
    out = np.empty(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(data), _SLICE):
            a, b = np.searchsorted(at, [start, start + _SLICE])
            if a == b:
                continue
            piece = data[start : start + _SLICE + width]
            sums = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum(of_byte[piece] * powers[: len(piece)], out=sums[1:])
            p = at[a:b] - start
            h = (sums[p + width] - sums[p]) * inverses[p]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
            out[a:b] = h ^ (h >> np.uint64(29))
    return out


def _digest(text: memoryview) -> int:
    return int.from_bytes(blake2b(text, digest_size=8).digest(), "little", signed=True)


class _Block:
    """One block with the answers that have come back so far."""

    def __init__(self, row: dict, length: int, buckets: int):
        self.length, self.buckets, self.answers = length, buckets, row.get("answers")
        self.sizes = np.array(row["sizes"], np.int64)
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.data = np.frombuffer(row["blob"], np.uint8) if row.get("blob") is not None else None
        # Whole copies.
        long = np.flatnonzero(self.sizes >= length)
        digests = np.array(row["digests"], np.int64)[long].view(np.uint64)
        self.copy_keys, first, where, count = np.unique(
            digests, return_index=True, return_inverse=True, return_counts=True
        )
        self.copies_here = count
        found = blocks.of_kind(self.answers, "copy")
        copied = blocks.bits(found, self.copy_keys, buckets)
        lead = blocks.bits(found, self.copy_keys, buckets, 1)
        self.is_copy = np.zeros(len(self.sizes), bool)
        self.is_copy[long] = copied[where]
        self.active = long[first[~copied | lead]]
        self.active.sort()

    def samples(self, period: int) -> tuple[np.ndarray, np.ndarray]:
        """Sampled positions and their names."""
        width = self.length - period + 1
        cover = np.array(difference_cover(period))
        most = int(self.sizes.max(initial=0))
        grid = (np.arange(0, most + period, period)[:, None] + cover).ravel()
        at = [self.starts[d] + grid[: np.searchsorted(grid, self.sizes[d] - width + 1)] for d in self.active]
        at = np.concatenate(at) if at else np.zeros(0, np.int64)
        return at, window_names(self.data, at, width)

    def starts_near(self, period: int) -> tuple[np.ndarray, np.ndarray]:
        """Passage starts that reach a repeated sample, and the names of their passages."""
        at, names = self.samples(period)
        keys, where = np.unique(names, return_inverse=True)
        hit = at[blocks.bits(blocks.of_kind(self.answers, "name"), keys, self.buckets)[where]]
        doc = np.searchsorted(self.starts, hit, "right") - 1
        low = np.maximum(self.starts[doc], hit - (period - 1))
        high = np.minimum(hit, self.starts[doc + 1] - self.length)
        edge = np.bincount(low, minlength=len(self.data) + 1) - np.bincount(high + 1, minlength=len(self.data) + 1)
        near = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        return near, window_names(self.data, near, self.length)

    def covered(self, period: int) -> np.ndarray:
        """True for each byte to remove."""
        near, names = self.starts_near(period)
        keys, where = np.unique(names, return_inverse=True)
        starts = near[blocks.bits(blocks.of_kind(self.answers, "passage"), keys, self.buckets)[where]]
        edge = np.bincount(starts, minlength=len(self.data) + 1)
        edge -= np.bincount(starts + self.length, minlength=len(self.data) + 1)
        cover = np.cumsum(edge[:-1]) > 0
        for d in np.flatnonzero(self.is_copy):
            cover[self.starts[d] : self.starts[d + 1]] = True
        return cover


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            row = {n: c[k] for n, c in zip(batch.schema.names, batch.columns)}
            yield {n: v if n == "rows" else v.as_py() for n, v in row.items()}


def _of_words(text: np.ndarray, cover: np.ndarray, edges: np.ndarray, least: int) -> np.ndarray:
    """The runs ``start, stop`` that hold enough words; the others are no longer covered."""
    kept = []
    for start, stop in edges.reshape(-1, 2).tolist():
        if len(text[start:stop].tobytes().split()) >= least:
            kept += [start, stop]
        else:
            cover[start:stop] = False
    return np.array(kept, np.int64)


def remove_repeats(
    docs: DataFrame, text: str = "text", *, length: int = 400, period: int = PERIOD,
    block_bytes: int = blocks.BLOCK_BYTES, whole_characters: bool = False, least_words: int = 0,
) -> DataFrame:
    """``row, n_bytes, spans, kept``: what is left of each text.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the
    same document or another; passages never cross documents. ``row`` is a struct of all other
    columns of ``docs``, so that no name clashes; ``spans`` are the maximal removed runs
    ``start, stop``, ``kept`` the remaining bytes in turn. With ``whole_characters`` the bytes of a
    character of UTF-8 go only together, so that what is kept remains UTF-8. Of the maximal runs only those
    with ``least_words`` words or more go, so that short strings which repeat by nature can stay.

    Null text counts as empty. Texts shorter than ``length`` stay whole. Repeated rows are copies of
    one another and, if long enough, lose every byte. An empty table gives an empty result.
    """
    if length < period + 8:
        raise ValueError("length must exceed the period by 8 at least")
    packed = blocks.pack(docs, text, _digest, block_bytes)
    buckets = blocks.bucket_count(packed, block_bytes)

    def asked(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = _Block(row, length, buckets)
            if kind == "copy":
                keys, count = block.copy_keys, block.copies_here
            else:
                _, names = block.samples(period) if kind == "name" else block.starts_near(period)
                keys, count = np.unique(names, return_counts=True)
            many = (count > 1).astype(np.uint8)
            yield blocks.batch_of(blocks.question(row["block"], kind, keys, many, buckets))

    def answered(source: DataFrame, kind: str) -> DataFrame:
        questions = source.mapInArrow(lambda batches: asked(batches, kind), blocks.QUESTION)
        return stored(questions.groupBy("bucket").applyInArrow(blocks.repeated, blocks.ANSWER), f"{kind}-answers")

    def told(answers: list[DataFrame], *columns: str) -> DataFrame:
        return packed.select("block", *columns).join(blocks.by_block(answers), "block", "left")

    copies = answered(packed.select("block", "sizes", "digests"), "copy")
    names = answered(told([copies], "sizes", "digests", "blob"), "name")
    passages = answered(told([copies, names], "sizes", "digests", "blob"), "passage")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = _Block(row, length, buckets)
            cover, spans, kept = block.covered(period), [], []
            if whole_characters:
                inner = (block.data & 0xC0) == 0x80
                inner[block.starts[:-1][block.sizes > 0]] = False
                of = np.cumsum(~inner) - 1
                cover = np.bincount(of, ~cover, of[-1] + 1)[of] == 0 if len(of) else cover
            for a, b in zip(block.starts, block.starts[1:]):
                edges = np.flatnonzero(np.diff(np.r_[False, cover[a:b], False]))
                if least_words:
                    edges = _of_words(block.data[a:b], cover[a:b], edges, least_words)
                spans.append([{"start": s, "stop": e} for s, e in edges.reshape(-1, 2).tolist()])
                kept.append(block.data[a:b][~cover[a:b]].tobytes())
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            columns = [row["rows"].values, pa.array(block.sizes), pa.array(spans, span), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_bytes", "spans", "kept"])

    row_type = packed.schema["rows"].dataType.elementType.simpleString()
    shape = f"row {row_type}, n_bytes long, spans array<struct<start: bigint, stop: bigint>>, kept binary"
    everything = told([copies, names, passages], "rows", "sizes", "digests", "blob")
    return everything.mapInArrow(cut, shape)


def digest_of(result: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts and hash of what ``remove_repeats`` kept."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return result.select(
        F.col(f"row.`{doc_id}`").alias("doc_id"),
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
