"""Components against a dense eigensolver, and whitened rows against their definitions."""

import duckdb
import numpy as np
import pytest

from showlake.llm import queries, whitening


def integers(vectors):
    return np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000


def dense(x, k):
    """Eigenvalues and vectors of the covariance, falling."""
    y = x - np.array([sum(map(int, c)) for c in x.T]) / len(x)
    values, vectors = np.linalg.eigh(y.T @ y / len(x))
    return values[::-1][:k], vectors[:, ::-1][:, :k], np.trace(y.T @ y / len(x))


def spectrum(values, seed=1):
    turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))
    return turn * values @ turn.T


@pytest.mark.parametrize(
    "values",
    [
        np.arange(1, 65.0), 1 + np.arange(64) * 1e-3, np.geomspace(1e-8, 1e8, 64), [3.0] * 30 + [1.0] * 10, [5.0] * 4 + [5 - 1e-9] * 4 + [1.0] * 8,
        [9.0, 4.0, 1.0] + [0.0] * 20, [2.0], [0.0] * 5, [1e-300, 2e-300, 4e-300], np.r_[np.full(7, 2.0), 1 + 1e-14, 1, 1, 0.5],
    ],
)
def test_components(spark, values):
    """Bulk spectra without gaps, wide ranges, equal and nearly equal eigenvalues, lower ranks."""
    v = spectrum(np.array(values, float))
    v = (v + v.T) / 2
    got, vectors = whitening.components(spark, v, 8)
    true, size = np.sort(values)[::-1][:8], max(values)
    assert len(got) == min(8, sum(np.array(values) > len(values) * 1e-15 * size))
    assert np.allclose(got, true[: len(got)], rtol=0, atol=1e-12 * size)
    assert np.allclose(vectors.T @ vectors, np.eye(len(got)), atol=1e-12)
    assert np.linalg.norm(v @ vectors - vectors * got, axis=0).max(initial=0) <= 1e-12 * size


def test_inertia():
    r = np.random.default_rng(2)
    for d in (1, 2, 5, 20):
        for _ in range(50):
            v = r.integers(-2, 3, size=(d, d)).astype(float)
            v = v + v.T
            values = np.linalg.eigvalsh(v)
            at = r.choice([0.1, -1.3, float(values[0]) - 1, float(values[-1]) + 1])
            assert whitening.above(v, at) == (values > at).sum()
    assert whitening.above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0) == 1 and whitening.above(np.zeros((3, 3)), 0) == 0


def check(rows, x, ids, k=8):
    values, vectors, trace = dense(x, k)
    n, sums = len(x), [sum(map(int, c)) for c in x.T]
    k = min(k, int((values > 64 * len(values) * 1e-16 * trace).sum()))
    assert len(rows) == n * k
    by = {(r["vec_id"], r["component"]): r for r in rows}
    plain = (x - np.array(sums) / n) @ vectors[:, :k] / np.sqrt(values[:k])
    whitened = np.array([[by[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    sign = np.sign((plain * whitened).sum(axis=0))
    assert np.allclose(whitened * sign, plain, atol=1e-6) and np.abs(whitened.T @ whitened / n - np.eye(k)).max() < 1e-9
    for i, row in zip(ids, x, strict=True):
        for c in range(k):
            r = by[i, c + 1]
            assert r["deviation"] == sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) and r["n"] == n
            assert abs(r["explained"] / (values[c] / trace) - 1) < 1e-9 and 0 <= r["identity_error"] < 1e-9


def test_query(spark, sf):
    rows = [r.asDict() for r in queries.QUERIES["op11_whitening"](spark, sf).collect()]
    given = duckdb.sql(f"select vec_id, embedding from '{sf}/embeddings.parquet' order by vec_id").fetchall()
    check(rows, integers([v for _, v in given]), [i for i, _ in given])


def long_rows(spark, rows, kind="array<float>"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding {kind}, x int, whitened string").repartition(3)
    fit = whitening.fitting(df, 1024, 100_000)
    return [r.asDict() for r in whitening.long_form(whitening.whiten(fit, 8)).collect()]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    r = np.random.default_rng(4)
    good = [(i, np.float32(v).tolist()) for i, v in enumerate(r.normal(size=(40, 5)))]
    bad = [(90, None), (91, [0.1, None, 0.1, 0.1, 0.1]), (92, [nan] * 5), (93, [0.0, -inf, 0.0, 0.0, 0.0]), (94, []), (95, [0.5, 0.5]), (None, None)]
    got = long_rows(spark, [(i, v, None, None) for i, v in good + bad])
    check(got, integers([v for _, v in good]), [i for i, _ in good])
    twice = long_rows(spark, [(i, v, 1, "a") for i, v in [*good, *good, (None, [0.0] * 5)]])
    assert len(twice) == 81 * 5 and {row["n"] for row in twice} == {81}
    assert long_rows(spark, [(1, [0.5, 0.25], None, None)] * 3) == long_rows(spark, [(1, None, None, None)]) == []
    line = long_rows(spark, [(i, [float(i), 2.0 * i, 0.0], None, None) for i in range(9)])
    assert len(line) == 9 and all(abs(row["explained"] - 1) < 1e-12 for row in line)


def test_large_deviations(spark):
    """Deviations beyond a long stay exact in the operator's decimal and are null in the long form."""
    rows = [(i, [float(i % 3) * 2**38, float(i % 7)], None, None) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x int, whitened string")
    fit = whitening.fitting(df, 1024, 100_000)
    whole = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(fit, 8).collect()}
    x = integers([v for _, v, *_ in rows])
    sums = [sum(map(int, c)) for c in x.T]
    assert whole == {i: sum((30 * int(v) - s) ** 2 for v, s in zip(row, sums)) for i, row in enumerate(x)}
    long = {r["vec_id"]: r["deviation"] for r in whitening.long_form(whitening.whiten(fit, 8)).collect()}
    assert long == {i: v if v < 2**63 else None for i, v in whole.items()} and None in long.values()
    with pytest.raises(ValueError):
        whitening.whiten(whitening.fitting(df.selectExpr("vec_id", "transform(embedding, x -> x * 1e9) as embedding"), 1024, 0), 8)
