"""Exact deduplication in which a Bloom filter of repeated cells decides what is shuffled.

Texts stay where they are; their SHA-256 is what is compared.

1. Each hash falls into a few cells of a filter. The cells are counted, added up where the rows lie
   first, and those met more than once form a second filter, of bits only.
2. A row is possibly repeated if all its cells are in that filter; no repeated hash is missed. Only
   such rows are grouped by hash. The others are the only ones of their text and pass straight
   through.

A filter holds ``FILTER_ROWS`` hashes, so the copy sent to every executor has a fixed size however
many rows there are: the hashes are dealt into ranges and one filter after the other is used. All of
it is DataFrame functions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import scratch, stored

WHITE = r"[\x20\x09-\x0D]+"
FILTER_ROWS = 4 << 20  # hashes in one filter: 8 MB of bits at 16 a row
CELLS_A_ROW, CELLS_TRIED = 16, 2
_BITMAP = 32_768  # bits of one bitmap of Spark's functions
HOT_SHARE = 1_000  # a group with more than this part of the rows is hot; fewer than that many are


def normalised(text: str) -> Column:
    """The text with each run of ASCII white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ")


def _cell(row_hash: Column, which: int, cells: int) -> Column:
    """The cell, from 0, that the hash has in the filter for its ``which``-th try."""
    return F.pmod(F.xxhash64(row_hash, F.lit(which)), F.lit(cells))


def _bit(bitmap: str, cell: str) -> Column:
    """Whether the cell's bit is set in its bitmap; a missing bitmap has none."""
    octet = f"int(conv(hex(substring({bitmap}, int({cell} % {_BITMAP} div 8) + 1, 1)), 16, 10))"
    return F.expr(f"coalesce(getbit({octet}, int({cell} % 8)) = 1, false)")


def repeated_cells(hashes: DataFrame, cells: int) -> DataFrame:
    """``bucket, bits``: bitmaps of the cells that more than one hash of ``hashes.h`` falls into.

    Counting merges cells on the map side, so a hash that many rows share leaves each task once.
    """
    tried = F.explode(F.array(*[_cell(F.col("h"), k, cells) for k in range(CELLS_TRIED)]))
    met = hashes.select(tried.alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    bucket, bit = F.expr(f"cell div {_BITMAP}"), F.expr(f"cell % {_BITMAP}")
    return met.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits"))


def possibly_repeated(rows: DataFrame, filtered: DataFrame, cells: int) -> DataFrame:
    """``rows`` and ``maybe``: whether every cell of ``h`` is in the filter. Rows do not move."""
    columns, hit = rows.columns, F.lit(True)
    for k in range(CELLS_TRIED):
        # A bitmap for each 32,768 cells, of which there are FILTER_ROWS * CELLS_A_ROW at most.
        bits = F.broadcast(filtered.select(F.col("bucket").alias("_bucket"), F.col("bits").alias(f"_bits{k}")))
        rows = rows.withColumn(f"_cell{k}", _cell(F.col("h"), k, cells))
        rows = rows.join(bits, F.expr(f"_cell{k} div {_BITMAP}") == F.col("_bucket"), "left").drop("_bucket")
        hit = hit & _bit(f"_bits{k}", f"_cell{k}")
    return rows.select(*columns, hit.alias("maybe"))


def _grouped(maybe: DataFrame) -> DataFrame:
    """``sha, keep, group_size``: first row (``no_id, id, at``) and size of each group of equal hashes."""
    return maybe.groupBy("sha").agg(
        F.min(F.struct("no_id", "id", "at")).alias("keep"), F.count("*").alias("group_size")
    )


def with_copies_marked(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, carry: list[str] | None = None,
    filter_rows: int = FILTER_ROWS,
) -> DataFrame:
    """``row, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    ``row`` is a struct of the columns named in ``carry`` (all, if none are), so that no name clashes.
    Texts are equal if they are after white space is normalised. Of equal texts the row with the
    smallest id is kept, the null id counting as the largest; of rows that also share their id one is
    kept, the first as stored. Null text is empty, and empty texts are copies of one another. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    carried = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]
    # A row's number is fixed by being stored: tasks that run again later read the same one.
    hashed = stored(
        docs.select(
            F.struct(*carried).alias("row"),
            F.col(f"`{doc_id}`").alias("id"),
            F.unhex(F.sha2(normalised(text).cast("binary"), 256)).alias("sha"),
        ).select(
            "*",
            F.col("id").isNull().alias("no_id"),
            F.xxhash64("sha").alias("h"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "hashes",
    )
    total = hashed.count()  # from the footers
    ranges = max(1, -(-total // filter_rows))
    cells = max(_BITMAP, filter_rows * CELLS_A_ROW if ranges > 1 else total * CELLS_A_ROW)
    sure, maybe = [], []
    for k in range(ranges):
        part = hashed.filter(F.pmod(F.xxhash64("h"), F.lit(ranges)) == k) if ranges > 1 else hashed
        filtered = stored(repeated_cells(part.select("h"), cells), "filter")
        path = scratch(spark, "possibly")
        possibly = possibly_repeated(part, filtered, cells)
        possibly.write.partitionBy("maybe").parquet(path)
        told = spark.read.schema(hashed.withColumn("maybe", F.lit(True)).schema).parquet(path)
        sure.append(told.filter("not maybe").drop("maybe"))
        maybe.append(told.filter("maybe").drop("maybe"))
    alone, asked = (reduce(DataFrame.unionByName, parts) for parts in (sure, maybe))

    groups = stored(_grouped(asked), "groups")
    # Groups with a thousandth of the rows in question are a thousand at most; their rows are answered
    # where they lie. No key of the shuffled rest is larger than that.
    least = max(1_000, asked.count() // HOT_SHARE)
    hot = F.broadcast(groups.filter(F.col("group_size") > least))
    cold = asked.join(hot.select("sha"), "sha", "left_anti").join(groups, "sha")
    answered = asked.join(hot, "sha").unionByName(cold)
    first = (F.col("keep.at") == F.col("at")).alias("kept")
    digest = F.lower(F.hex("sha")).alias("text_sha256")
    return alone.select(
        "row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest
    ).unionByName(answered.select("row", F.col("keep.id").alias("keep_id"), "group_size", first, digest))


def without_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stay, whole."""
    return with_copies_marked(docs, text, doc_id, **options).filter("kept").select("row.*")
