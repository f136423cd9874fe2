"""The queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showlake.llm import (
    alignment,
    decontaminate,
    exact_dedup,
    language_id,
    licenses,
    pii,
    sentencepiece,
    simhash,
    token_counts,
    topk,
    toxicity,
    warc,
    whitening,
)
from showlake.llm.common import new_path, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find_personal_data(table(spark, sf_dir, "documents")))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.grade(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return licenses.Scanner(documents).scan(documents)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("kept")


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(warc.resolve(warc.captures_of(table(spark, sf_dir, "pages"))))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents inserted and that batch closed, then a tenth deleted (committed twice, as after a lost driver), another tenth revised to its text twice over."""
    import public_tokenizers

    how = ("byte_bpe_50k", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    documents = table(spark, sf_dir, "documents")
    counts = stored(token_counts.counted(documents, *how), "token-counts")
    gone, old = counts.filter("doc_id % 10 = 3"), counts.filter("doc_id % 10 = 7")
    twice = documents.filter("doc_id % 10 = 7").withColumn("text", F.concat_ws(" ", "text", "text"))
    rollup = token_counts.Rollup(spark, new_path(spark, "token-rollup"))
    rollup.commit(1, token_counts.inserted(counts))
    rollup.close(1)
    rollup.commit(2, token_counts.deleted(gone))
    rollup.commit(3, token_counts.revised(old, token_counts.counted(twice, *how)))
    rollup.commit(2, token_counts.deleted(gone))
    return rollup.totals()


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.digests(table(spark, sf_dir, "documents"), piece_model())


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    labelled = language_id.identify(documents, language_id.train(documents))
    return labelled.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.fitting(table(spark, sf_dir, "embeddings"), scale=1024, shift=100_000)
    return whitening.long_form(whitening.whiten(rows, k=8))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"), scale=256)
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, pattern = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    return alignment.report(table(spark, sf_dir, "documents"), a, pattern, piece_model())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_toxicity": op2_toxicity,
    "op3_licenses": op3_licenses,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_revisits": op6_revisits,
    "op7_token_counts": op7_token_counts,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_language_id": op9_language_id,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_whitening": op11_whitening,
    "op12_topk": op12_topk,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op12_topk": topk.ORACLE,
    "op6_revisits": warc.ORACLE,
    "op10_exact_dedup": """
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
        from (
            select *, max(doc_id) over (partition by body) as keep_id, count(*) over (partition by body) as group_size
            from (select doc_id, coalesce(text, '') as body from documents)
        )
    """,
}
