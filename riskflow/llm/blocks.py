"""Texts packed into blocks, and questions that blocks ask of the whole corpus.

Hashing every byte position of a corpus gives far more keys than Spark has use for as rows. Here a
block holds a few megabytes of whole texts in one row. A question is a sorted set of 64-bit keys
per block; the keys are cut into buckets by value, one row per block and bucket, already unique
within their block, so a key that every document holds arrives once per block. Each bucket is
answered on its own and the answers return to their blocks. The block table is bucketed by block
number, so joining answers to texts does not move the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import bucketed, utf8

BLOCK_BYTES, BUCKET_BYTES = 2 << 20, 4 << 20


def bucket_count(packed: DataFrame, block_bytes: int = BLOCK_BYTES) -> int:
    """Buckets of keys: one for every four megabytes of packed texts, 256 at least."""
    return max(256, packed.count() * block_bytes // BUCKET_BYTES)  # counted from the footers


def pack(docs: DataFrame, text: str, digest: Callable[[bytes], int], block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``block, rows, sizes, digests, blob`` in a table bucketed by block.

    ``rows`` has the other columns of each document, ``sizes`` its bytes, ``blob`` all texts in turn.
    A document longer than ``block_bytes`` has a block of its own. Null text is empty.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("int").alias("none")]
    source = docs.select(F.struct(*others).alias("row"), utf8(text).alias("body"))
    row_type = source.schema["row"].dataType.simpleString()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            body = batch.column(1)
            offsets = np.frombuffer(body.buffers()[1], np.int32)[body.offset : body.offset + len(body) + 1]
            data = body.buffers()[2] or pa.py_buffer(b"")
            sizes = np.diff(offsets).astype(np.int64)
            before = offsets[:-1].astype(np.int64) - offsets[0]
            cuts, at = [0], 0
            while at < len(sizes):
                at = max(at + 1, int(np.searchsorted(before + sizes, before[at] + block_bytes, "right")))
                cuts.append(min(at, len(sizes)))
            view = memoryview(data)
            digests = [digest(view[a:b]) for a, b in zip(offsets, offsets[1:])]
            ends = pa.array(cuts, pa.int32())
            blobs = pa.py_buffer(np.ascontiguousarray(offsets[cuts]))
            count = len(cuts) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(number, number + count)),
                    pa.ListArray.from_arrays(ends, batch.column(0)),
                    pa.ListArray.from_arrays(ends, pa.array(sizes)),
                    pa.ListArray.from_arrays(ends, pa.array(digests, pa.int64())),
                    pa.Array.from_buffers(pa.binary(), count, [None, blobs, data]),
                ],
                ["block", "rows", "sizes", "digests", "blob"],
            )
            number += count

    shape = f"block long, rows array<{row_type}>, sizes array<long>, digests array<long>, blob binary"
    return bucketed(source.mapInArrow(packed, shape), "block", "blocks", **{"parquet.block.size": 16 << 20})


def ask(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Bucket numbers and slices of sorted unique keys."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
    cuts = np.r_[0, np.searchsorted(keys, edges), len(keys)]
    for b in np.flatnonzero(np.diff(cuts)):
        yield int(b), slice(int(cuts[b]), int(cuts[b + 1]))


QUESTION = "block long, kind string, bucket int, keys binary, extra binary"
ANSWER = "block long, kind string, bucket int, reply binary, lead binary"


def question(block: int, kind: str, keys: np.ndarray, extra: np.ndarray, buckets: int) -> list[tuple]:
    """Rows of QUESTION; ``extra`` goes with the keys, one element each."""
    return [(block, kind, b, keys[s].tobytes(), extra[s].tobytes()) for b, s in ask(keys, buckets)]


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 5
    types = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types)], ["block", "kind", "bucket", "keys", "extra"]
    )


def repeated(asked: pa.Table) -> pa.Table:
    """For each key, a bit if it occurs elsewhere too, and a bit at its first block.

    ``extra`` holds one byte per key: 1 if the block itself has it more than once. Blocks none of
    whose keys are repeated get no answer.
    """
    asked = asked.sort_by("block")
    parts = [np.frombuffer(b.as_py(), np.uint64) for b in asked.column("keys")]
    many = np.concatenate([np.frombuffer(b.as_py(), np.uint8) for b in asked.column("extra")])
    _, first, where, count = np.unique(
        np.concatenate(parts), return_index=True, return_inverse=True, return_counts=True
    )
    hit = count > 1
    hit[where[many > 0]] = True
    flags, lead = hit[where], np.zeros(len(where), bool)
    lead[first] = True
    cuts = np.r_[0, np.cumsum([len(p) for p in parts])]
    rows = [
        (block.as_py(), kind.as_py(), bucket.as_py(), np.packbits(flags[a:b]).tobytes(), np.packbits(lead[a:b]).tobytes())
        for block, kind, bucket, a, b in zip(asked.column("block"), asked.column("kind"), asked.column("bucket"), cuts, cuts[1:])
        if flags[a:b].any()
    ]
    types = (pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.binary())
    columns = list(zip(*rows)) if rows else [()] * 5
    return pa.table(dict(zip(("block", "kind", "bucket", "reply", "lead"), (pa.array(c, t) for c, t in zip(columns, types)))))


def bits(answers: dict[int, tuple[bytes, bytes]], keys: np.ndarray, buckets: int, part: int = 0) -> np.ndarray:
    """The answered bit of each key; False where no answer came."""
    flags = np.zeros(len(keys), bool)
    for b, s in ask(keys, buckets):
        if b in answers:
            flags[s] = np.unpackbits(np.frombuffer(answers[b][part], np.uint8), count=s.stop - s.start)
    return flags


def by_block(answers: list[DataFrame]) -> DataFrame:
    """``block, answers``: all answers to one block, as many as kinds times buckets."""
    every = answers[0]
    for more in answers[1:]:
        every = every.unionByName(more)
    return every.groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "reply", "lead")).alias("answers"))


def of_kind(answers: list[dict] | None, kind: str) -> dict[int, tuple[bytes, bytes]]:
    return {a["bucket"]: (a["reply"], a["lead"]) for a in answers or () if a["kind"] == kind}
