"""Exact search against brute force."""

import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from showlake.llm import queries, topk


def plain(rows, k, scale, every):
    """Every query against every row; components that one side lacks count as zero."""
    usable = [(i, [int(np.floor(np.float64(x) * scale)) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    asked = defaultdict(list)
    for i, v in usable:
        if i is not None and i % every == 0:
            asked[i].append(v)
    out = []
    for i, vectors in sorted(asked.items()):
        scored = [(-sum(a * b for a, b in zip(min(vectors), v)), j is None, j) for j, v in usable if j != i]
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(i, r + 1, j, -s) for r, (s, _, j) in enumerate(scored[:k])]
    return out


def run(spark, rows, k=5, every=50, parts=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(parts)
    vectors = topk.quantised(df, 256)
    got = topk.top_k(vectors, vectors.filter(f"vec_id % {every} = 0"), k)
    return sorted(tuple(r) for r in got.collect())


def test_query(spark, sf):
    got = sorted(tuple(r) for r in queries.QUERIES["op12_topk"](spark, sf).collect())
    embeddings = duckdb.sql(f"from '{sf}/embeddings.parquet'")  # noqa: F841
    assert got == sorted(duckdb.sql(topk.ORACLE).fetchall())
    assert got == plain(duckdb.sql(f"select vec_id, embedding from '{sf}/embeddings.parquet'").fetchall(), 5, 256, 50)


@pytest.mark.parametrize("shape", ["dense", "sparse", "positive", "ties"])
def test_shapes(spark, monkeypatch, shape):
    """Small slices and blocks, so that terms are left out, candidates are probed and passes repeated."""
    for name, size in (("FIRST", 8), ("SLICE", 32), ("QUERIES", 4), ("PROBE", 2), ("BLOCK", 6)):
        monkeypatch.setattr(topk, name, size)
    r = np.random.default_rng(3)
    x = r.normal(size=(400, 12)) * r.exponential(size=12)
    x = {"dense": x, "sparse": np.where(r.random(x.shape) < 0.8, 0, x), "positive": np.abs(x), "ties": np.round(x / 2)}[shape]
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    assert run(spark, rows, every=20) == plain(rows, 5, 256, 20)


def test_pairs_left_out():
    """Exactly the pairs that reach the k-th best come back, with their whole products."""
    r = np.random.default_rng(5)
    w, x = (np.floor(256 * r.normal(size=(n, 64)) * np.linspace(1, 0.05, 64)) for n in (40, 3000))
    full = w @ x.T
    least = np.sort(full, axis=1)[:, -5]
    place, doc, score = topk.max_score(w, np.ascontiguousarray(x.T), least)
    assert set(zip(place, doc)) == set(zip(*np.nonzero(full >= least[:, None]))) and (score == full[place, doc]).all()


def test_odd_rows(spark):
    r = random.Random(1)
    nan, inf = float("nan"), float("inf")
    rows = [(i, [r.uniform(-1, 1) for _ in range(4)]) for i in range(1, 60)]
    rows += [(0, None), (50, [0.5, None, 0.1, 0.2]), (100, [nan, 0.1, 0.1, 0.1]), (150, [inf, 0.0, 0.0, 0.0]), (200, []), (250, [0.5, 0.5]), (300, [0.5] * 6)]
    rows += [(None, [0.9] * 4), (None, None), (7, [0.9] * 4), (7, [0.9] * 4), (350, [0.25] * 4), (350, [0.5] * 4), (400, [-1.0] * 4), (401, [-1.0] * 4)]
    rows = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert run(spark, rows) == plain(rows, 5, 256, 50)
    few = [(0, [1.0]), (1, [2.0]), (2, [2.0])]
    assert run(spark, few) == [(0, 1, 1, 512 * 256), (0, 2, 2, 512 * 256)]
    assert run(spark, [(0, [1.0])]) == run(spark, []) == []


def test_large_numbers(spark):
    """Products beyond exact doubles."""
    rows = [(i, [float(2**22 + i), float(2**21 - i), 1.0]) for i in range(0, 40)]
    assert run(spark, rows, every=10) == plain(rows, 5, 256, 10)
