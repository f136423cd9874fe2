"""Ordinal regression: held-out accuracy, gradients, order of thresholds, odd rows."""

import duckdb
import numpy as np

from showlake.llm import queries
from showlake.llm import toxicity as t


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in queries.QUERIES["op2_toxicity"](spark, sf).collect()}
    known = duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall()
    import zlib

    apart = [(rows[i], toxic) for i, toxic in known if zlib.crc32(str(i).encode()) % 5 == 0]
    flagged = [(r["toxic"], bool(toxic)) for r, toxic in apart]
    hits = sum(a and b for a, b in flagged)
    assert hits >= 0.95 * sum(a for a, _ in flagged) and hits >= 0.7 * sum(b for _, b in flagged)
    mean = {k: np.mean([r["severity"] for r, toxic in apart if toxic == k]) for k in (0, 1)}
    assert mean[1] > mean[0] + 1 and all(0 <= r["severity"] <= 3 for r in rows.values())


def test_fit_recovers_an_ordinal_model():
    r = np.random.default_rng(0)
    x = r.integers(0, 3, (4000, 3)).astype(float)
    score = x @ [2.0, -1.0, 0.0] + r.logistic(size=4000)
    grades = np.searchsorted([0.5, 2.0, 4.0], score)
    at, word = np.nonzero(x)
    weights, cuts = t.fit(at, word, x[at, word], grades, 3)
    assert np.abs(weights - [2.0, -1.0, 0.0]).max() < 0.25 and np.abs(cuts - [0.5, 2.0, 4.0]).max() < 0.3
    chances = t.Grader([], weights, cuts).chances(np.array([-5.0, 0.0, 5.0]))
    assert np.allclose(chances.sum(axis=1), 1) and (np.diff(chances @ np.arange(4)) > 0).all()


def test_odd_rows(spark, odd, none, got):
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 1), (4, 0), (None, 1), (3, 1)], "doc_id long, toxic int")
    assert len(got(t.grade(odd, t.train(odd, labels)))) == 10
    assert t.train(odd, labels.filter("toxic = 0")) is None and t.train(none, labels) is None
    assert {r["toxic"] for r in t.grade(odd, None).collect()} == {None}
    grader = t.Grader(["lazy"], np.array([3.0]), np.array([1.0, 2.0]))
    rows = {r["doc_id"]: r for r in t.grade(odd, grader).collect()}
    assert rows[5]["toxic"] and rows[5]["grade"] == 2 and not rows[1]["toxic"]
    assert t.grade(none, grader).collect() == []
