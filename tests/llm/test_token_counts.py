"""Rolled-up token counts against a recount, and batches that are committed again."""

import base64
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken

from showlake.llm import queries
from showlake.llm import token_counts as tc
from showlake.llm.common import new_path

HOW = ("v1", public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def test_query(spark, sf, truth):
    with open(HOW[1], "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("plain", pat_str=HOW[2], mergeable_ranks=ranks, special_tokens={})
    docs, tokens = Counter(), Counter()
    for i, text, lang, source in truth:
        if i % 10 != 3:
            docs[source, lang] += 1
            tokens[source, lang] += len(plain.encode_ordinary(f"{text} {text}" if i % 10 == 7 else text))
    rows = queries.QUERIES["op7_token_counts"](spark, sf).collect()
    assert {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in rows} == {k: (docs[k], tokens[k]) for k in docs}
    assert {r["tokenizer"] for r in rows} == {"byte_bpe_50k"}


def test_batches(spark, odd, none):
    rollup = tc.Rollup(spark, new_path(spark, "test-rollup"))
    totals = lambda: {tuple(r) for r in rollup.totals().collect()}
    counts = tc.counted(odd, *HOW)
    rollup.commit(1, tc.inserted(counts))
    first = totals()
    assert sum(n for *_, n, _ in first) == 10 and (None, None, "v1", 2, 0) in first
    rollup.commit(2, tc.revised(counts.filter("doc_id = 4"), counts.filter("doc_id = 3")))  # one of two copies goes
    assert sum(n for *_, n, _ in totals()) == 9
    rollup.commit(2, tc.deleted(none.select("source", "lang").selectExpr("source", "lang", "'v1' tokenizer", "0L n_tokens")))
    assert totals() == first  # the second attempt, without changes, stands in place of the first
    rollup.commit(3, tc.deleted(counts))
    rollup.commit(3, tc.deleted(counts))
    assert totals() == set()
    rollup.commit(1, tc.inserted(counts))
    assert totals() == set()


def test_closed_batches(spark, odd):
    """Totals are the same whatever is closed; closed batches are not read, and not taken again."""
    rollup = tc.Rollup(spark, new_path(spark, "test-rollup"))
    assert rollup.totals().collect() == []
    counts = tc.counted(odd, *HOW)
    rollup.commit(1, tc.inserted(counts))
    rollup.commit(2, tc.deleted(counts.filter("doc_id = 4")))
    whole = {tuple(r) for r in rollup.totals().collect()}
    rollup.close(1)
    rollup.close(1)
    assert {tuple(r) for r in rollup.totals().collect()} == whole
    with pytest.raises(ValueError):
        rollup.commit(1, tc.inserted(counts))
    rollup.commit(2, tc.deleted(counts.filter("doc_id = 4")))
    rollup.close(2)
    rollup.commit(3, tc.inserted(counts.filter("doc_id = 5")))
    after = {tuple(r) for r in rollup.totals().collect()}
    assert sum(n for *_, n, _ in after) == sum(n for *_, n, _ in whole) + 1
    plan = rollup.totals()._jdf.queryExecution().executedPlan().toString()
    assert "(batch#" in plan and "> 2)" in plan


def test_many_keys(spark):
    """Sources of high number are summed and written by several tasks."""
    rollup = tc.Rollup(spark, new_path(spark, "test-rollup"))
    rows = spark.range(20_000).selectExpr("concat('s', id % 5000) source", "'en' lang", "'v' tokenizer", "id n_tokens")
    rollup.commit(1, tc.inserted(rows))
    got = {r["source"]: (r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect()}
    assert got == {f"s{i}": (4, 4 * i + 30_000) for i in range(5000)}


def test_long_texts(monkeypatch):
    """Cut word by word, texts have the tokens that the library gives them, and runs of blanks of any length have some."""
    r = random.Random(5)
    given = ["".join(r.choice("ab Z9 \n\t '\u3000\xa0é東🙂.s'll ") for _ in range(r.randrange(60))) for _ in range(500)]
    count = tc.counter(*HOW[1:])
    short = [count(t) for t in given]
    monkeypatch.setattr(tc, "LONG", 0)
    assert [count(t) for t in given] == short
    assert count(" " * 1_000_000 + "a") > 0
