"""Spelling variants: vocabulary words one edit apart, grouped under their commonest form.

The vocabulary acceptor is composed with a one-edit transducer and with itself, one part of it at a
time. Of two words one edit apart, the shorter one of ``m`` code points, the edit leaves the first
``m // 2`` or the remaining code points of the shorter one alone. So both words meet in a part that is
named by ``m``, the side and that half: the state that the acceptor (on the other side, the acceptor
of the reversed words) is in after the half has been read. From that state on, the composition runs
over what is left of the words. A word lies in four parts at most, whatever its neighbours are.

A part with too many words is split by the same rule, applied to what is left, which leads to states
deeper in the acceptor; words are distinct, so what is left of one code point needs no more splits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.acceptor import one_edit_pairs
from riskflow.llm.common import stored

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
SPOILT = 31  # of so many runs one loses a code point
PART_WORDS = 20_000
PART = ["m", "state"]


def runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST_LENGTH) -> DataFrame:
    """``word``: each run of letters of ``least`` code points, some of them spoilt by a checksum.

    Only A-Z are lower-cased. Null texts have no runs, a null id is written as nothing.
    """
    lower = F.translate(F.col(text), UPPER, LOWER)
    run = F.explode(F.regexp_extract_all(lower, F.lit(f"{LETTERS}{{{least},}}"), F.lit(0))).alias("run")
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), run)
    rows = rows.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    cut = F.expr("int(h % char_length(run))")
    spoilt = F.concat(F.substring("run", F.lit(1), cut), F.substring("run", cut + 2, F.char_length("run")))
    return rows.select(F.when(F.col("h") % SPOILT == 0, spoilt).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word, n``: words of enough code points that occur often enough."""
    long = words.filter(F.char_length("word") >= least)
    return long.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _halves() -> Column:
    """Two parts for a word, where the shorter words have ``m`` code points left and it has some more."""
    h = F.floor(F.col("m") / 2).cast("int")
    kept = F.col("m") - h
    left = F.char_length("word") - F.col("front") - F.col("back")
    before = F.substring("word", F.col("front") + 1, h)
    behind = F.substring("word", F.col("front") + left - kept + 1, kept)

    def part(m, side, half, front, back):
        state = F.concat("state", F.lit(side), half).alias("state")
        return F.struct(m.alias("m"), state, front.alias("front"), back.alias("back"), "word", "n")

    return F.array(
        part(kept, "<", before, F.col("front") + h, F.col("back")),
        part(h, ">", behind, F.col("front"), F.col("back") + kept),
    )


def parts(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """``m, state, front, back, word, n``: the words of each part, at most ``part_words`` of them.

    All but ``front`` and ``back`` code points of a word are left in its part.
    """
    length = F.char_length("word")
    # A word meets those of its own length, or one longer, as the shorter one, and those one shorter as
    # the longer one. Words too short to have two halves meet by their length alone.
    role = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m")).filter("m >= 0")
    none = F.lit(0)
    role = role.select("m", F.concat(F.col("m").cast("string"), F.lit(":")).alias("state"), none.alias("front"), none.alias("back"), "word", "n")
    halves = role.filter("m >= 2").select(F.inline(_halves()))
    rows, done = stored(halves.unionByName(role.filter("m < 2")), "parts"), []
    while True:
        large = rows.groupBy(*PART).count().filter((F.col("count") > part_words) & (F.col("m") >= 2))
        large = stored(large.select(*PART), "large-parts")
        if large.isEmpty():
            break
        done.append(rows.join(large, PART, "left_anti"))
        rows = stored(rows.join(large, PART, "left_semi").select(F.inline(_halves())), "parts")
    for more in done:
        rows = rows.unionByName(more)
    return rows


def _pairs_of(m: int, back: int, words: list[str], rests: list[str], counts: list[int]) -> Iterator[tuple[str, int, str, int]]:
    """Near words of one part; ``rests`` are in order, the shorter word comes first."""
    for i, j in one_edit_pairs(rests):
        # Two of the longer words meet in another part, and so do words whose fronts agree as well.
        if len(rests[i]) == m and not (back and rests[j].startswith(rests[i])):
            yield words[i], counts[i], words[j], counts[j]


def near_pairs(words: DataFrame, part_words: int = PART_WORDS) -> DataFrame:
    """``a, a_n, b, b_n``: each two of the distinct ``word``s that are one edit apart, once.

    The edit is one inserted, deleted or replaced code point.
    """

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns)))
        out: list[tuple] = []
        for (m, _, back), group in groupby(rows, itemgetter(0, 1, 2)):
            _, _, _, rests, spelt, counts = zip(*group)
            if len(rests) > 1 and any(len(r) == m for r in rests):
                out += _pairs_of(m, back, spelt, rests, counts)
            if len(out) > 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    left = F.char_length("word") - F.col("front") - F.col("back")
    dealt = parts(words, part_words).repartition(*PART)
    dealt = dealt.select(*PART, "back", F.substring("word", F.col("front") + 1, left).alias("rest"), "word", "n")
    # Spark's order of strings, by bytes, is Python's, by code points.
    return dealt.sortWithinPartitions(*PART, "rest").mapInArrow(compose, "a string, a_n long, b string, b_n long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = pa.string(), pa.int64(), pa.string(), pa.int64()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["a", "a_n", "b", "b_n"])


def with_forms(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of a vocabulary.

    The form is the near word of largest ``n``, of equal ones the smallest, if that is ``times`` the
    word's own at least. Forms are followed by doubling the steps; as each step multiplies ``n``, the
    largest ``n`` bounds how many there are.
    """
    both = pairs.unionByName(pairs.selectExpr("b as a", "b_n as a_n", "a as b", "a_n as b_n"))
    best = F.min(F.struct((-F.col("b_n")).alias("n"), F.col("b").alias("word"))).alias("best")
    near = both.groupBy("a").agg(F.count("*").alias("n_near"), best)
    is_form = -F.col("best.n") >= times * F.col("n")
    joined = words.join(near, F.col("word") == F.col("a"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.n")).alias("form_n"),
    )
    joined = stored(joined, "forms")
    most = joined.agg(F.max("n")).first()[0] or 1
    steps = 1 + math.floor(math.log(most, times))
    roots = joined.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps))):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return joined.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of the words of whole texts.

    Other columns of ``docs`` are not read. Repeated rows count as often as they stand there; an empty
    table gives an empty result.
    """
    words = stored(vocabulary(runs(docs, text, doc_id)), "words")
    return with_forms(words, near_pairs(words, **options))
