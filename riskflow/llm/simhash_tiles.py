"""SimHash near-duplicates by tiled exact comparison.

Every text gets a 64-bit fingerprint. Equal fingerprints are merged first, so copies cost one row. Two
fingerprints within a radius of three bits agree in one of their four 16-bit words at least, so each
distinct one is dealt to four groups, one for each word's value, and compared inside them only. A group
that is too large is split by the same rule, applied to the bits that are left. Inside a group, tiles of
equal population counts (of the four words) are compared by exclusive-or and bit counts over numpy
arrays; pairs of tiles whose counts differ by more than the radius are skipped. A task returns spanning
forests of its links, never the links themselves, and these are joined into components on Spark.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import by_size, free_name, stored, utf8
from riskflow.llm.components import components

SEED = 42
GROUP_ROWS = 16_384
_SLICE, _SHORT = 1 << 15, 48


def fingerprint(text: bytes, width: int = 3) -> int:
    """Majority of the XXH64 bits of all shingles of ``width`` words; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[k:] for k in range(width)))))
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(shingles), _SLICE):
        h = np.array([digest(s, SEED) for s in shingles[at : at + _SLICE]], dtype="<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    majority = (2 * ones > len(shingles)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str, name: str, width: int = 3) -> DataFrame:
    """All columns but the text, and the fingerprint as a signed long."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c != text]
    body = free_name(docs.columns, "body")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            prints = np.array([fingerprint(t.as_py(), width) for t in texts], dtype=np.uint64)
            columns = [*batch.columns[:-1], pa.array(prints.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], name])

    source = docs.select(*kept, utf8(text).alias(body))
    schema = source.drop(body).withColumn(name, F.lit(0).cast("long")).schema
    return source.mapInArrow(score, schema)


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of linked positions; labels point to lower positions."""
    while True:
        la, lb = labels[a], labels[b]
        differ = la != lb
        if not differ.any():
            return
        low, high = np.minimum(la, lb)[differ], np.maximum(la, lb)[differ]
        np.minimum.at(labels, high, low)
        while True:
            flat = labels[labels]
            if np.array_equal(flat, labels):
                break
            labels[:] = flat
        a, b = a[differ], b[differ]


def _subtiles(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by the word counts, the starts of equal counts, and those counts."""
    counts = np.bitwise_count(np.ascontiguousarray(prints).view(np.uint16).reshape(-1, 4)).astype(np.int16)
    key = counts @ np.array([4913, 289, 17, 1], dtype=np.int64)
    order = np.argsort(key, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(key[order]) != 0])
    return order, np.r_[starts, len(prints)], counts[order][starts]


def linked(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of the components among ``left`` (and ``right``) within ``radius`` bits."""
    everything = left if right is None else np.concatenate([left, right])
    labels = np.arange(len(everything))
    orders, cuts, counts = zip(*map(_subtiles, [left] if right is None else [left, right]))
    shift = 0 if right is None else len(left)
    sorted_left, sorted_right = left[orders[0]], everything[shift + orders[-1]]
    step = 2048
    for i in range(len(counts[0])):
        gaps = np.abs(counts[-1] - counts[0][i]).sum(axis=1)
        for j in np.flatnonzero(gaps <= radius):
            if right is None and j < i:
                continue
            for p in range(cuts[0][i], cuts[0][i + 1], step):
                p_end = min(p + step, cuts[0][i + 1])
                for q in range(cuts[-1][j], cuts[-1][j + 1], step):
                    q_end = min(q + step, cuts[-1][j + 1])
                    apart = sorted_left[p:p_end, None] ^ sorted_right[None, q:q_end]
                    a, b = np.nonzero(np.bitwise_count(apart) <= radius)
                    if len(a) > (p_end - p if right is None and i == j and p == q else 0):
                        _merge(labels, orders[0][p + a], shift + orders[-1][q + b])
    away = np.flatnonzero(labels != np.arange(len(labels)))
    return everything[away], everything[labels[away]]


def linked_in_groups(groups: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges of the components inside groups; rows of a group stand together.

    Short groups are compared side by side, all rows with the next, then with the one after that.
    """
    ends = np.r_[0, np.flatnonzero(np.diff(groups)) + 1, len(groups)] if len(groups) else np.zeros(1, int)
    sizes = np.diff(ends)
    labels = np.arange(len(groups))
    left = np.flatnonzero(np.repeat(sizes <= _SHORT, sizes))
    for apart in range(1, min(_SHORT, sizes.max(initial=0))):
        left = left[left + apart < len(groups)]
        left = left[groups[left] == groups[left + apart]]
        near = left[np.bitwise_count(prints[left] ^ prints[left + apart]) <= radius]
        _merge(labels, near, near + apart)
    away = np.flatnonzero(labels != np.arange(len(labels)))
    found = [(prints[away], prints[labels[away]])]
    for k in np.flatnonzero(sizes > _SHORT):
        found.append(linked(prints[ends[k] : ends[k + 1]], None, radius))
    return tuple(np.concatenate(side) for side in zip(*found))


def _dealt(radius: int) -> Column:
    """The groups of a row: for each word of its remaining bits, one with that word's value.

    ``part`` names the group, ``rest`` are the bits without that word, ``bits`` is their number.
    """
    words = radius + 1
    width = F.expr(f"bits div {words}")
    of = []
    for k in range(words):
        low = (width * k).cast("int")
        # The last word takes what the division leaves over.
        high = (width * (k + 1)).cast("int") if k + 1 < words else F.col("bits")
        below = F.call_function("shiftleft", F.lit(1).cast("long"), low) - 1
        above = F.when(high >= 64, F.lit(0).cast("long")).otherwise(
            F.call_function("shiftleft", F.call_function("shiftrightunsigned", F.col("rest"), high), low)
        )
        word = F.call_function("shiftrightunsigned", F.col("rest"), low)
        size = (high - low).cast("int")
        word = word.bitwiseAND(F.when(size >= 64, F.lit(-1).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), size) - 1))
        name = F.concat_ws(".", "part", F.lit(str(k)), F.hex(word))
        kept = F.col("rest").bitwiseAND(below).bitwiseOR(above)
        of.append(F.struct(name.alias("part"), kept.alias("rest"), (F.col("bits") - size).alias("bits"), F.col("f").alias("f")))
    return F.array(*of)


def links(distinct: DataFrame, name: str, radius: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Forest edges ``u, v`` among the distinct fingerprints in column ``name``.

    Each fingerprint has a row in ``radius + 1`` groups, whatever their number; one in a group of more
    than ``group_rows`` has as many in the next smaller groups instead.
    """
    f = F.col(f"`{name}`").cast("long")
    whole = distinct.select(F.lit("").alias("part"), f.alias("rest"), F.lit(64).alias("bits"), f.alias("f"))
    rows, small = stored(whole.select(F.inline(_dealt(radius))), "groups"), []
    while True:
        # A group whose bits cannot be cut again has few enough values left for one task.
        large = rows.groupBy("part").agg(F.count("*").alias("n"), F.first("bits").alias("bits"))
        large = stored(large.filter((F.col("n") > group_rows) & (F.col("bits") > 2 * radius + 2)).select("part"), "large-groups")
        if large.isEmpty():
            break
        small.append(rows.join(large, "part", "left_anti"))
        rows = stored(rows.join(large, "part", "left_semi").select(F.inline(_dealt(radius))), "groups")
    for more in small:
        rows = rows.unionByName(more)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, prints = np.zeros(0, object), np.zeros(0, np.uint64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                part = np.concatenate([part, batch.column(0).to_numpy(zero_copy_only=False)])
                prints = np.concatenate([prints, batch.column(1).to_numpy().view(np.uint64)])
            # The last group may go on in the next batch.
            done = len(part) if batch is None else int(np.searchsorted(part, part[-1], "left")) if len(part) else 0
            _, number = np.unique(part[:done], return_inverse=True)
            u, v = linked_in_groups(number, prints[:done], radius)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])
            part, prints = part[done:], prints[done:]

    dealt = rows.select("part", "f").repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(compare, "u long, v long")


def _labelled(prints: DataFrame, radius: int, group_rows: int) -> DataFrame:
    """``f, label``: the component of each fingerprint of ``prints.f``."""
    distinct = prints.select("f").distinct()
    classes = components(links(distinct, "f", radius, group_rows))
    named = distinct.join(classes.withColumnRenamed("node", "f"), "f", "left")
    return named.select("f", F.coalesce("label", "f").alias("label"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, width: int = 3, radius: int = 3,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per document.

    Fingerprints link at ``radius`` or fewer differing bits; ``component_id`` is the smallest id
    that can be reached over links, the document's own included.

    Null and empty texts, and texts of white space, have fingerprint zero and are linked like any
    other. Repeated rows stay repeated. A row whose id is null gets a component all the same; null
    is its name only if no member has an id. An empty table gives an empty result. Other columns
    of ``docs`` are not read.
    """
    ids = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = stored(with_fingerprints(ids, "text", "f", width), "fingerprints")
    distinct = prints.groupBy("f").agg(F.min("doc_id").alias("lowest"))
    named = stored(_labelled(prints, radius, group_rows), "labels").join(distinct, "f")
    lowest = named.groupBy("label").agg(F.min("lowest").alias("component_id"))
    by_print = named.join(lowest, "label").select("f", "component_id")
    digits = F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint")
    return prints.join(by_print, "f").select("doc_id", digits, "component_id")


def without_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", *, width: int = 3, radius: int = 3,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The rows of ``docs`` less all but one of each component of :func:`near_duplicates`, columns unchanged.

    The row with the smallest id stays, then the first as stored; rows whose id is null come last.
    Repeated rows are copies of each other, and so are all rows without words. An empty table gives an
    empty result.
    """
    number = free_name(docs.columns, "number")
    # A row's number is fixed by being stored with the row.
    rows = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    ids = rows.select(F.col(number).alias("number"), F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    prints = stored(with_fingerprints(ids, "text", "f", width), "fingerprints")
    best = F.struct(F.col("id").isNull().alias("none"), "id", "number")
    firsts = prints.groupBy("f").agg(F.min(best).alias("best"))
    labels = _labelled(prints, radius, group_rows)
    kept = firsts.join(labels, "f").groupBy("label").agg(F.min("best").alias("best"))
    kept = stored(kept.select(F.col("best.number").alias(number)), "kept")
    return rows.join(by_size(kept), number, "left_semi").drop(number)
