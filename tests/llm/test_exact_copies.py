"""Exact deduplication against plain Python, over ranges, ties and odd rows."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from riskflow.llm import bloom_dedup
from riskflow.llm.bloom_dedup import possibly_repeated, repeated_cells, with_copies_marked, without_copies


def digest(text):
    return hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", text or "").encode()).hexdigest()


def expected(rows):
    """(doc_id, keep_id, size, kept, sha) of (doc_id, text) rows, sorted; one row of equal ones is kept."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[digest(text)].append(doc_id)
    out = []
    for sha, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


def found(marked):
    rows = marked.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("filter_rows", [bloom_dedup.FILTER_ROWS, 3])
def test_odd_rows(odd, filter_rows):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(with_copies_marked(odd, filter_rows=filter_rows)) == expected(rows)
    kept = without_copies(odd, filter_rows=filter_rows)
    assert kept.columns == odd.columns and kept.count() == len({digest(t) for _, t in rows})


def test_empty_table(llm):
    empty = llm.createDataFrame([], "doc_id long, text string")
    assert found(with_copies_marked(empty)) == []


def test_hot_group_and_ties(llm):
    """One text on two thirds of the rows, ids that repeat, and many texts of their own."""
    rows = [(k % 900, "the same  text") for k in range(3000)] + [(k, f"text {k}") for k in range(1500)]
    docs = llm.createDataFrame([(i, t.replace("  ", "\t \n" if i % 2 else " ")) for i, t in rows], "doc_id long, text string")
    assert found(with_copies_marked(docs.repartition(7))) == expected(rows)


def test_white_space_only_of_ascii(llm):
    texts = ["a b", "a\x0b\x0c b", "a b", "a\x1fb", " a b", "ab", " ", "\n\n", "", None]
    rows = list(enumerate(texts))
    assert found(with_copies_marked(llm.createDataFrame(rows, "doc_id long, text string"))) == expected(rows)


def test_filter_misses_no_repeated_hash_and_few_others_pass(llm):
    hashes = llm.range(40_000).select(F.xxhash64(F.when(F.col("id") < 2_000, F.col("id") % 500).otherwise(F.col("id"))).alias("h"))
    cells = 40_000 * bloom_dedup.CELLS_A_ROW
    told = possibly_repeated(hashes, repeated_cells(hashes, cells), cells)
    counts = told.groupBy("h", "maybe").count().groupBy("maybe").agg(F.sum("count").alias("n"), F.max("count").alias("most"))
    by = {r.maybe: r for r in counts.collect()}
    assert by[False].most == 1 and 2_000 <= by[True].n < 4_000


def test_only_rows_in_question_are_shuffled(llm, tmp_path):
    """The part of the plan that returns unrepeated rows has no exchange but of broadcast filters."""
    docs = llm.range(1_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 990).alias("text"))
    plan = with_copies_marked(docs)._jdf.queryExecution().executedPlan().toString()
    alone = plan[plan.index("Union") : plan.index("Scan parquet") + 10]
    assert "Exchange" not in alone and "Python" not in plan and "Arrow" not in plan
