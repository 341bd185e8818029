"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are cut into blocks. With weight w out of W, block k of a source is
released at slot floor(k W / w) and due by slot ceil((k + 1) W / w); in each slot the released block
that is due first goes next. Up to any slot, every source then differs from its share by less than
one block. The schedule repeats after W slots, so only one period is worked out on the driver; where
each block goes follows from it on Spark. When a source runs out, the weights of the others share
its part and a new period begins: no document is dropped or repeated.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 64
BUCKET_ROWS = 8_192


def period(weights: dict[str, int]) -> list[str]:
    """Which source each of the sum(weights) slots belongs to."""
    total, slots = sum(weights.values()), []
    waiting = [(0, -(-total // w), source, 0) for source, w in sorted(weights.items())]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, due, source, k = heapq.heappop(waiting)
            heapq.heappush(ready, (due, source, k))
        _, source, k = heapq.heappop(ready)
        slots.append(source)
        w = weights[source]
        heapq.heappush(waiting, ((k + 1) * total // w, -(-(k + 2) * total // w), source, k + 1))
    return slots


def phases(weights: dict[str, int], blocks: dict[str, int]) -> list[tuple[str, int, int, int, int, list[int]]]:
    """``source, first block, first slot, weight, period, slots in the period``: one row for each
    source and phase. A phase ends when it is the turn of a source with no block left; there are at
    most as many as sources."""
    left, used, start, rows = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, []
    while left:
        now = {s: weights[s] for s in left}
        slots = period(now)
        own: dict[str, list[int]] = {s: [] for s in left}
        for slot, source in enumerate(slots):
            own[source].append(slot)
        rows += [(s, used[s], start, now[s], len(slots), own[s]) for s in sorted(left)]
        whole = min(n // now[s] for s, n in left.items())
        for s in left:
            left[s] -= whole * now[s]
            used[s] += whole * now[s]
        start += whole * len(slots)
        for source in slots:
            if not left[source]:
                break
            left[source] -= 1
            used[source] += 1
            start += 1
        left = {s: n for s, n in left.items() if n}
    return rows


def mixed(
    docs: DataFrame, weights: dict[str, int], *, source: str = "source", doc_id: str = "doc_id",
    block_rows: int = BLOCK_ROWS, default_weight: int = 1, bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``row, source, block, slot, in_block``: where each document stands in the mix.

    ``row`` is a struct of all columns of ``docs``, so that no name clashes; sort by ``slot, in_block``
    to read the mix. Sources without a weight have ``default_weight``; null is a source of its own and
    has that weight. Weights must be positive integers; their sum is the length of the period. Inside
    a source, documents stand in the order of a hash of their id. Repeated rows stay; an empty table
    gives an empty result. The number of sources must be one that the driver can hold.
    """
    if default_weight < 1 or any(w < 1 for w in weights.values()):
        raise ValueError("weights must be positive integers")
    spark = docs.sparkSession
    # Null sources are named apart from every string: "n" against "s" and the name.
    name = F.when(F.col(f"`{source}`").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(f"`{source}`").cast("string")))
    rows = docs.select(name.alias("name"), F.xxhash64(F.col(f"`{doc_id}`")).alias("place"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    sizes = {r["name"]: r["count"] for r in rows.groupBy("name").count().collect()}
    shares = {n: weights.get(n[1:], default_weight) if n != "n" else default_weight for n in sizes}
    plan = phases(shares, {n: -(-c // block_rows) for n, c in sizes.items()})
    shape = "name string, first_block long, first_slot long, weight long, period long, slots array<int>"
    steps = F.struct("first_block", "first_slot", "weight", "period", "slots")
    # One row for each source.
    by_source = F.broadcast(
        spark.createDataFrame(plan, shape).groupBy("name").agg(F.array_sort(F.collect_list(steps)).alias("steps"))
    )
    # A source may hold most rows: number its documents within buckets of bounded size.
    buckets = max(1, -(-sum(sizes.values()) // bucket_rows))
    placed = rows.withColumn("bucket", F.pmod("place", F.lit(buckets)))
    full = placed.groupBy("name", "bucket").count()
    before = Window.partitionBy("name").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = full.select("name", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("name", "bucket").orderBy("place", F.col(f"row.`{doc_id}`"), F.hash("row"))
    ranked = placed.withColumn("n", F.row_number().over(within)).join(offsets, ["name", "bucket"])
    number = F.col("before") + F.col("n") - 1
    numbered = ranked.select("row", "name", (number / block_rows).cast("long").alias("block"), (number % block_rows).alias("in_block"))
    step = F.element_at(F.filter("steps", lambda s: s["first_block"] <= F.col("block")), -1)
    found = numbered.join(by_source, "name").withColumn("step", step)
    k = F.col("block") - F.col("step.first_block")
    slot = (
        F.col("step.first_slot")
        + F.floor(k / F.col("step.weight")) * F.col("step.period")
        + F.element_at("step.slots", (k % F.col("step.weight") + 1).cast("int"))
    )
    return found.select("row", F.col("row")[source].alias("source"), "block", slot.alias("slot"), "in_block")
