"""Training-corpus pipeline over ``documents``: each stage's rows are written and reread by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.llm import pfair, simhash_tiles, string_kernel, suffix_repeats, viterbi
from riskflow.llm.common import scratch, ship
from riskflow.llm.queries import MIX_WEIGHTS, OTHER_WEIGHT

PASSAGE_BYTES, PASSAGE_PERIOD, PASSAGE_WORDS = 150, 73, 50


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the model learns from the labelled rows of ``docs``."""
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = string_kernel.fit(docs.select("doc_id", "text"), labels.filter(~string_kernel.held_out()))
    return string_kernel.with_score(docs, model, name="toxicity_score").filter("toxicity_score < 0.5").drop("toxicity_score")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link at three bits or fewer."""
    ship(spark)
    return simhash_tiles.without_near_copies(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of over 50 words that occur more than once; all documents stay.

    A passage of that many words has ``PASSAGE_BYTES`` in any language: words of two letters and a space.
    A character stays if any of its bytes does, so texts remain UTF-8; ``n_chars`` counts anew.
    """
    ship(spark)
    cut = suffix_repeats.remove_repeats(
        docs, length=PASSAGE_BYTES, period=PASSAGE_PERIOD, least_words=PASSAGE_WORDS, whole_characters=True
    )
    columns = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("text", "n_chars")]
    text = F.col("kept").cast("string").alias("text")
    return cut.select(*columns, text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the target weights interleave their sources."""
    placed = pfair.mixed(docs, MIX_WEIGHTS, default_weight=OTHER_WEIGHT)
    return placed.orderBy("slot", "in_block").select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``documents`` and the ids of each text."""
    ship(spark)
    coded = viterbi.with_ids(docs, viterbi.load())
    return coded.withColumn("n_ids", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("mix", mix),
    ("encode", encode),
]

# A trained classifier, similarity groups and a deadline schedule have no SQL form; tests/llm compares
# the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
