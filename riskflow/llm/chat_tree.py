"""Chat formatting over a prefix tree.

Conversations that begin with the same turns share them: each distinct turn-in-context is a node, and
its tokens are written once, depth first. A conversation, in the order of its path, owns the nodes
that no conversation before it has; these lie in one row (a segment) of the token stream. The segment
has its place in the stream, the position of its first token in the conversation, a loss mask, and the
stretches of the stream that its tokens attend to besides the earlier ones of the segment: those of
its ancestors, joined where they touch.

A turn reads ``### role: text</turn>``. Inside roles and texts the backslash, ``#``, ``<`` and, in roles, ``:``
are written with a backslash and a letter, so neither mark can occur there.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import stored

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SPLIT = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
OPEN, CLOSE = "### ", "</turn>\n"
LOSS_ROLE = "assistant"
_PIECE = 20_000

_CODES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c"}
_PLAIN = {code[1]: sign for sign, code in _CODES.items()}
_TURN = re.compile(r"### ([^:]*): ([^<]*)</turn>\n")


def escape(text: str, signs: str = "\\#<") -> str:
    return re.sub("[" + re.escape(signs) + "]", lambda m: _CODES[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text, flags=re.DOTALL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at = [], 0
    for found in _TURN.finditer(formatted):
        if found.start() != at:
            break
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return turns


def ranks(path: str = RANKS) -> dict[bytes, int]:
    """The vocabulary file, as bytes and ids."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Tokens:
    """Byte-level tokens of a vocabulary; long texts are cut first, so no piece takes long to merge."""

    def __init__(self, vocabulary: dict[bytes, int]):
        import tiktoken

        self.coder = tiktoken.Encoding("given", pat_str=SPLIT, mergeable_ranks=vocabulary, special_tokens={})

    def ids(self, text: str) -> list[int]:
        found: list[int] = []
        for at in range(0, len(text), _PIECE):
            found += self.coder.encode_ordinary(text[at : at + _PIECE])
        return found

    def text(self, ids) -> bytes:
        return self.coder.decode_bytes(ids)


def _plain(value: bytes | None) -> str:
    return (value or b"").decode("utf-8", "replace")


_TURNS = "conv_id long, seq long, node binary, role string, text string, n_turns long, path binary"


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the turns of each conversation and names each by all turns up to it.

    Rows come sorted by conversation and turn. The last turn of a conversation carries its length and
    its path, eight bytes of each name.
    """
    types = (pa.int64(), pa.int64(), pa.binary(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = [field.split()[0] for field in _TURNS.split(", ")]
    rows: list[list] = []
    conversation, begun, path, node = None, False, bytearray(), b""

    def batch(of: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*of), types)], names)

    for part in batches:
        for conv_id, role, text in zip(*(c.to_pylist() for c in part.columns)):
            if not begun or conv_id != conversation:
                if begun:
                    rows[-1][5:] = rows[-1][1] + 1, bytes(path)
                conversation, begun, path, node, seq = conv_id, True, bytearray(), b"", 0
            role, text = _plain(role), _plain(text)
            parts = (node, role.encode(), text.encode())
            node = blake2b(b"".join(len(p).to_bytes(8, "little") + p for p in parts), digest_size=16).digest()
            path += node[:8]
            rows.append([conv_id, seq, node, role, text, None, None])
            seq += 1
        if len(rows) > 1:
            yield batch(rows[:-1])
            del rows[:-1]
    if rows:
        rows[-1][5:] = rows[-1][1] + 1, bytes(path)
        yield batch(rows)


def chat_tree(conversations: DataFrame, vocabulary: dict[bytes, int], loss_role: str = LOSS_ROLE) -> tuple[DataFrame, DataFrame]:
    """Segments and members.

    Segments: ``segment, start, position, tokens, loss, context``. Token k of a segment has place
    ``start + k`` in the stream and position id ``position + k``; it attends to ``context`` (stretches
    ``start, stop`` of the stream) and to the segment up to itself. ``loss`` marks the text of turns of
    ``loss_role``. Members: ``conv_id, n_turns, segment, stop``: a conversation is, in the order of its
    segments, the first ``stop`` tokens of each.

    Turns are ordered by ``turn``, then role and text, nulls first; repeated rows are turns of their own.
    Null texts and roles count as empty, the rows of null ``conv_id`` as one conversation. An empty table
    gives two empty results. Other columns are not read.
    """
    spark = conversations.sparkSession
    sent = spark.sparkContext.broadcast(vocabulary)  # the size of the vocabulary file
    raw = [F.col(c).cast("binary").alias(c) for c in ("role", "text")]
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *raw)
    sorted_rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    turns = stored(sorted_rows.select("conv_id", "role", "text").mapInArrow(_chain, _TURNS), "turns")
    whole = turns.filter("path is not null").orderBy("path", "conv_id")
    ranked = stored(whole.select(F.col("conv_id").alias("c"), F.col("n_turns").alias("length"), F.monotonically_increasing_id().alias("rank")), "ranks")
    placed = turns.drop("n_turns", "path").join(ranked, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    owners = placed.groupBy("node").agg(F.min("rank").alias("owner"))
    owned = stored(placed.select("conv_id", "length", "rank", "seq", "node").join(owners, "node").drop("node"), "owners")

    own = placed.select("rank", "seq", "node", "role", "text").join(owners, "node").filter("rank = owner")
    own = own.select("rank", "seq", "role", "text").repartition("rank").sortWithinPartitions("rank", "seq")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Tokens(sent.value)
        now, first, ids, loss, ends = None, 0, [], [], []
        types = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.list_(pa.int64()))
        names = ["segment", "first_seq", "tokens", "loss", "ends"]
        done: list[tuple] = []

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)

        for part in batches:
            for rank, seq, role, text in zip(*(c.to_pylist() for c in part.columns)):
                if rank != now:
                    if now is not None:
                        done.append((now, first, ids, loss, ends))
                    now, first, ids, loss, ends = rank, seq, [], [], []
                head = coder.ids(f"{OPEN}{escape(role, _SIGNS_OF_ROLES)}: ")
                body, tail = coder.ids(escape(text)), coder.ids(CLOSE)
                ids += head + body + tail
                loss += [False] * len(head) + [role == loss_role] * len(body) + [False] * len(tail)
                ends.append(len(ids))
            if done:
                yield batch()
                done.clear()
        if now is not None:
            done.append((now, first, ids, loss, ends))
            yield batch()

    shape = "segment long, first_seq long, tokens array<int>, loss array<boolean>, ends array<long>"
    written = stored(own.mapInArrow(write, shape), "segments")
    # Places in the stream: sums over the sorted partitions, then within each.
    sizes = written.select("segment", "first_seq", "ends", F.shiftright("segment", 33).alias("piece"), F.size("tokens").cast("long").alias("n"))
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    pieces = sizes.groupBy("piece").agg(F.sum("n").alias("n"))  # one row for each sorted partition
    offsets = pieces.select("piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("piece").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(offsets, "piece").select(
        "segment", "first_seq", "ends", (F.col("offset") + F.coalesce(F.sum("n").over(within), F.lit(0))).alias("start")
    )
    starts = stored(starts, "starts")
    used = owned.groupBy("conv_id", "length", "rank", "owner").agg(F.max("seq").alias("last"))
    parts = used.join(starts.withColumnRenamed("segment", "owner"), "owner").select(
        "conv_id", "length", "rank", "owner", "start", F.element_at("ends", (F.col("last") - F.col("first_seq") + 1).cast("int")).alias("stop")
    )
    parts = stored(parts, "parts")
    stretch = F.struct("start", (F.col("start") + F.col("stop")).alias("stop"))
    above = parts.filter("owner < rank").groupBy(F.col("rank").alias("segment")).agg(
        F.array_sort(F.collect_list(stretch)).alias("stretches"), F.sum("stop").alias("position")
    )
    touching = F.aggregate(
        "stretches", F.expr("cast(array() as array<struct<start: bigint, stop: bigint>>)"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["stop"] == s["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(F.struct(F.try_element_at(done, F.lit(-1))["start"].alias("start"), s["stop"].alias("stop"))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    segments = written.join(starts.select("segment", "start"), "segment").join(above, "segment", "left").select(
        "segment", "start", F.coalesce("position", F.lit(0)).alias("position"), "tokens", "loss",
        F.when(F.col("stretches").isNull(), F.expr("cast(array() as array<struct<start: bigint, stop: bigint>>)")).otherwise(touching).alias("context"),
    )
    members = parts.select("conv_id", F.col("length").alias("n_turns"), F.col("owner").alias("segment"), "stop")
    return segments, members


_SIGNS_OF_ROLES = "\\#<:"


def read_back(segments: DataFrame, members: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``conv_id, formatted, loss_text``: each conversation's text, and all text under its loss mask."""
    sent = segments.sparkSession.sparkContext.broadcast(vocabulary)
    stop = F.col("stop").cast("int")
    slices = members.join(segments.select("segment", "tokens", "loss"), "segment").select(
        "conv_id", "segment", F.slice("tokens", F.lit(1), stop).alias("tokens"), F.slice("loss", F.lit(1), stop).alias("loss")
    )
    ordered = slices.repartition("conv_id").sortWithinPartitions("conv_id", "segment").drop("segment")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Tokens(sent.value)
        now, begun, ids, loss = None, False, [], []

        def row() -> pa.RecordBatch:
            tokens, mask = np.concatenate(ids), np.concatenate(loss)
            texts = (coder.text(t.tolist()).decode() for t in (tokens, tokens[mask]))
            columns = [pa.array([now], pa.int64()), *(pa.array([t], pa.string()) for t in texts)]
            return pa.RecordBatch.from_arrays(columns, ["conv_id", "formatted", "loss_text"])

        for part in batches:
            for k, conv_id in enumerate(part.column(0).to_pylist()):
                if not begun or conv_id != now:
                    if begun:
                        yield row()
                    now, begun, ids, loss = conv_id, True, [], []
                ids.append(part.column(1)[k].values.to_numpy())
                loss.append(part.column(2)[k].values.to_numpy(zero_copy_only=False).astype(bool))
        if begun:
            yield row()

    return ordered.mapInArrow(decode, "conv_id long, formatted string, loss_text string")


def digests(texts: DataFrame) -> DataFrame:
    """Counts and hashes of what ``read_back`` returns."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv_id, formatted, masked in zip(*(c.to_pylist() for c in batch.columns)):
                turns, loss = read_turns(formatted), unescape(masked)
                said = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((conv_id, len(turns), sha256(said.encode()).hexdigest(), len(loss), sha256(loss.encode()).hexdigest(), len(formatted)))
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _DIGESTS)

    shape = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return texts.mapInArrow(digest, shape)


_DIGESTS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
