"""The pipeline against plain versions of its stages, and stages on odd rows."""

import hashlib

import duckdb
import pytest
import sentencepiece

import corpus_pipeline
from showlake.llm import decontaminate, language_id, queries
from tests.llm.test_simhash import plain_components, plain_fingerprint


STRANGE = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar",
    "asdkjh qwoeiu zxmnbv lkjhgf qpwoei rutyal skdjfh",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
]


def test_unlearned_languages_go(spark, sf):
    documents = queries.table(spark, sf, "documents").select("doc_id", "text", "lang")
    known = documents.filter("lang is not null and length(text) > 20").count()
    rows = [(-1 - i, " ".join([t] * 5), None) for i, t in enumerate(STRANGE)]
    mixed = documents.unionByName(spark.createDataFrame(rows, documents.schema))
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.known_language(spark, mixed, sf).collect()}
    assert min(kept) >= 0 and sum(len(t) > 20 for t in kept.values()) >= known


def test_run(spark, sf, truth):
    documents = queries.table(spark, sf, "documents")
    labelled = language_id.identify(documents, language_id.train(documents, spread=True)).collect()
    assert all(r["oddness"] <= corpus_pipeline.MAX_ODDNESS for r in labelled)
    scores = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in labelled}
    left = {i: t for i, t, *_ in truth if scores[i][0] != "und" and scores[i][1] >= corpus_pipeline.MIN_SCORE}
    last = {t: i for i, t in sorted(left.items())}
    left = {i: t for t, i in last.items()}
    parts = plain_components(sorted((i, plain_fingerprint(t)) for i, t in left.items()))
    left = {i: t for i, t in left.items() if parts[i] == i}
    items = duckdb.sql(f"select text from '{sf}/benchmark.parquet'").fetchall()
    flat = {i: f" {' '.join(decontaminate.words_of(t))} " for i, t in left.items()}
    leaked = {i for i, t in flat.items() for (x,) in items if f" {' '.join(decontaminate.words_of(x))} " in t}
    left = {i: t for i, t in left.items() if i not in leaked}
    library = sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, sf).collect()}
    assert set(got) == set(left) and leaked
    for i, text in left.items():
        ids = library.encode(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, sf, odd, none, name, stage):
    rows = stage(spark, odd, sf)
    assert stage(spark, none, sf).collect() == []
    if stage is not corpus_pipeline.tokens:
        assert rows.columns == odd.columns
    found = sorted((r["doc_id"] for r in rows.collect()), key=str)
    want = {
        "exact dedup": [2, 4, 5, 6, 7, None],
        "simhash near-dedup": [1, 3, 5, 7, None, None],  # rows of one id, null included, stay together
        "benchmark decontamination": [1, 2, 3, 4, 4, 5, 6, 7, None, None],
        "sentencepiece": [1, 2, 3, 4, 4, 5, 6, 7, None, None],
    }
    if name in want:
        assert found == sorted(want[name], key=str)
