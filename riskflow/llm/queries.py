"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm.common import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(build):
    @wraps(build)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return build(spark, sf_dir)

    QUERIES[build.__name__] = query
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op8_simhash_near_dedup(spark, sf_dir):
    from riskflow.llm.simhash_tiles import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


MIX_WEIGHTS = {"src0": 10, "src1": 8, "src2": 6, "src3": 6, "src4": 4, "src5": 4}
OTHER_WEIGHT = 3


@_query
def op3_pfair_mix(spark, sf_dir):
    from riskflow.llm.pfair import mixed

    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    placed = mixed(docs, MIX_WEIGHTS, default_weight=OTHER_WEIGHT)
    return placed.select("row.doc_id", "source", "block", "slot", "in_block")


@_query
def op4_string_kernel_toxicity(spark, sf_dir):
    from riskflow.llm.string_kernel import fit, held_out, with_score

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "toxic")
    scored = with_score(docs, fit(docs, labels.filter(~held_out())))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@_query
def op6_streaming_viterbi(spark, sf_dir):
    from riskflow.llm.viterbi import load, with_decoded, with_ids

    pieces = load()
    coded = with_ids(_table(spark, sf_dir, "documents").select("doc_id", "text"), pieces)
    decoded = with_decoded(coded, pieces)
    same = F.col("decoded") == F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", same.alias("round_trip"))


@_query
def op7_suffix_array_dedup(spark, sf_dir):
    from riskflow.llm.suffix_repeats import digest_of, remove_repeats

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest_of(remove_repeats(docs))


@_query
def op9_no_random_access_topk(spark, sf_dir):
    from riskflow.llm.nra_topk import top_k

    return top_k(_table(spark, sf_dir, "embeddings"))


@_query
def op5_learned_partitions(spark, sf_dir):
    from riskflow.llm.learned_partitions import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


@_query
def op10_html_layout(spark, sf_dir):
    from riskflow.llm.html_layout import with_visible_text

    return with_visible_text(_table(spark, sf_dir, "pages").select("page_id", "html"))


@_query
def op1_chat_prefix_tree(spark, sf_dir):
    from riskflow.llm.chat_tree import chat_tree, digests, ranks, read_back

    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    vocabulary = ranks()
    segments, members = chat_tree(rows, vocabulary)
    return digests(read_back(segments, members, vocabulary))


@_query
def op2_attention_lm(spark, sf_dir):
    from riskflow.llm.attention_lm import scored
    from riskflow.llm.chat_tree import ranks

    return scored(_table(spark, sf_dir, "documents").select("doc_id", "text"), ranks())


@_query
def op12_bloom_exact_dedup(spark, sf_dir):
    from riskflow.llm.bloom_dedup import with_copies_marked

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = with_copies_marked(docs, carry=["doc_id"])
    return marked.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


@_query
def op13_spelling_variants(spark, sf_dir):
    from riskflow.llm.spelling_variants import spelling_variants

    return spelling_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@_query
def op11_token_alignment(spark, sf_dir):
    from riskflow.llm.token_alignment import with_alignment

    return with_alignment(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("row.doc_id", "*").drop("row")


ORACLES["op1_chat_prefix_tree"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  sum(length('### ' || role || ': ' || text || '</turn>' || chr(10))
    + length(text) - length(translate(text, '\#<', ''))
    + length(role) - length(translate(role, '\#<:', '')))::BIGINT AS formatted_chars
FROM said GROUP BY conv_id"""

ORACLES["op9_no_random_access_topk"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5"""

ORACLES["op12_bloom_exact_dedup"] = r"""
WITH hashed AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (same ORDER BY doc_id) = 1 AS kept, text_sha256
FROM hashed WINDOW same AS (PARTITION BY text_sha256)"""

ORACLES["op13_spelling_variants"] = r"""
WITH RECURSIVE octets AS (
  SELECT list(list_reduce(list_prepend(k::UBIGINT, range(8)), lambda c, _:
    CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY k) AS t FROM range(256) r(k)),
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]{7,}')) AS run
  FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs GROUP BY ALL),
summed AS (
  SELECT run, n, xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
      string_split(id || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::UBIGINT]
        ELSE [(192 + (unicode(c) >> 6))::UBIGINT, (128 + unicode(c) % 64)::UBIGINT] END))),
    lambda crc, b: xor(crc >> 8, t[(xor(crc, b) % 256 + 1)::BIGINT]))) AS h
  FROM counted, octets),
spoilt AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
    ELSE run END AS word, n FROM summed),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM spoilt WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS other_n FROM near GROUP BY word),
formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * n THEN other END AS form,
    CASE WHEN other_n >= 10 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
followed AS (
  SELECT word, word AS root, form AS onward FROM formed
  UNION ALL SELECT f.word, g.word, g.form FROM followed f JOIN formed g ON f.onward = g.word)
SELECT word, n, n_near, form, form_n, root FROM formed JOIN (SELECT word, root FROM followed WHERE onward IS NULL) USING (word)"""
