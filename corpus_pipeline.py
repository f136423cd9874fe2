"""Documents to tokens: the stages of the corpus pipeline, each applied to all that the one before it kept.

Stages work on rows whose doc_id may be null or repeated: decisions are taken
by doc_id (and text, for exact copies), nulls being a value like any other, so
rows that share one stay or go together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showlake.llm import decontaminate, exact_dedup, language_id, sentencepiece, simhash
from showlake.llm.common import stored
from showlake.llm.queries import piece_model, table

#: Least score of a document's language; below it most of its words are in scripts of none of the learned ones.
MIN_SCORE = 0.1
#: Most deviations by which its n-grams may be rarer than usual in that language; above it the language was not learned.
MAX_ODDNESS = 16.0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; texts without letters, in unknown scripts or in other languages go.

    Short texts deviate more than long ones, so of a few words only very odd
    ones go: one in doubt stays.
    """
    labelled = language_id.identify(docs, language_id.train(docs, spread=True), rows=True)
    wanted = labelled.filter((F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    wanted = wanted.filter(F.col("oddness") <= MAX_ODDNESS)
    return wanted.select("row.*")


def one_of_equals(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that of the largest doc_id."""
    kept = exact_dedup.exact_dedup(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    rows = docs.select(F.col("doc_id").alias("_doc"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("_hash"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"))
    found = rows.join(kept, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_sha")), "left_semi")
    return found.dropDuplicates(["_doc", "_hash"]).select("_row.*")


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of at most three fingerprint bits connect, that of the smallest doc_id."""
    kept = simhash.near_duplicates(docs).filter("kept").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_id"]), "left_semi")


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Items of every length count: one of a single word drops every document
    with that word.  ``decontaminate.leaks(..., min_words=n)`` spares them.
    """
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    leaked = found.select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(leaked, docs["doc_id"].eqNullSafe(leaked["_id"]), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, last_byte`` of what is left."""
    return sentencepiece.digests(docs, piece_model())


STAGES = [
    ("language id", known_language),
    ("exact dedup", one_of_equals),
    ("simhash near-dedup", one_of_similar),
    ("benchmark decontamination", no_benchmark),
    ("sentencepiece", tokens),
]

#: Language model and tokenizer have no SQL form; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
