"""Whitening of vectors by their leading principal components, found with FEAST contour integration.

Spark sums the covariance (dimensions squared numbers, whatever the rows) and
projects the rows.  In between, eigenvalue intervals are cut out by inertia
counts, the solves on the contours around them run as tasks of their own, and
Rayleigh-Ritz takes the components out of the subspace that they span.  An
interval counts as done when its residuals are at rounding level and it holds
as many components as the inertia of both ends says.

Rows whose vector is null, or holds a null or a number that is not finite,
take no part, nor do rows whose vector has another length than most (the
longer of equally frequent ones).  Repeated rows and null ids count and are
returned each; no rows give no rows, and so do vectors without variance.
Components without variance are left out, so there may be fewer than asked
for.  An entry whose integer form does not fit 2 ** 53 raises an error.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showlake.llm.common import in_arrow, stored

#: Points of a contour's upper half, and most eigenvalues that one interval is to hold.
NODES, PER_INTERVAL = 12, 4
#: Refinements of an interval's subspace before it is widened.
ROUNDS = 8
EPS = np.finfo(float).eps


def fitting(embeddings: DataFrame, scale: int, shift: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of all rows that take part: every entry as ``floor(scale * entry) + shift``."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = embeddings.filter(F.col(vector).isNotNull() & ~bad & (F.size(vector) > 0))
    lengths = usable.groupBy(F.size(vector).alias("d")).count()
    first = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    fits = usable.filter(F.size(vector) == (first["d"] if first else 0))
    whole = F.transform(vector, lambda v: F.floor(v.cast("double") * scale) + shift)
    return fits.select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("x"))


def _rows(column: pa.ListArray) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def moments(rows: DataFrame, column: str = "x") -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each entry."""
    value = F.col("v").cast("decimal(38,0)")
    sums = rows.select(F.posexplode(column).alias("i", "v")).groupBy("i").agg(F.sum(value).alias("s"), F.count("*").alias("n"), F.max(F.abs(value)).alias("most"))
    found = sorted((r["i"], int(r["s"]), r["n"], r["most"]) for r in sums.collect())
    if any(most >= 2**53 for *_, most in found):
        raise ValueError("an entry does not fit 2 ** 53")
    return (found[0][2] if found else 0), [s for _, s, *_ in found]


def covariance(rows: DataFrame, n: int, means: np.ndarray, column: str = "x") -> np.ndarray:
    """Covariance with divisor n of entries centred before they are multiplied; each task sums its rows into one matrix."""
    d = len(means)
    upper = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                y = _rows(batch.column(0)) - means
                total += y.T @ y
        places = (upper[0] * d + upper[1]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total[upper])], ["place", "v"])

    parts = in_arrow(rows.select(column), run, "place long, v double").groupBy("place").agg(F.sum("v").alias("v"))
    found = parts.toArrow()
    out = np.zeros(d * d)
    out[found.column("place").to_numpy()] = found.column("v").to_numpy() / n
    out = out.reshape(d, d)
    return out + np.triu(out, 1).T


def above(v: np.ndarray, at: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``at``: the positive part of the inertia of ``v - at``.

    Symmetric elimination with pivots of one or two rows; a pivot of two with
    a negative determinant has an eigenvalue on either side of zero.
    """
    a = v - at * np.eye(len(v))
    ratio, positive, scale = (1 + 17**0.5) / 8, 0, np.abs(a).max(initial=0)
    while len(a):
        diagonal = np.abs(np.diag(a))
        r = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        if not max(diagonal[r], off.max()) > EPS * scale * 1e-3:
            break  # what is left is zero: eigenvalues equal to ``at``
        if diagonal[r] >= ratio * off.max():
            pick = [r]
        else:
            pick = list(np.unravel_index(off.argmax(), off.shape))
        rest = [i for i in range(len(a)) if i not in pick]
        block, side = a[np.ix_(pick, pick)], a[np.ix_(rest, pick)]
        positive += int((np.linalg.eigvalsh(block) > 0).sum())
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
    return positive


@dataclass
class Interval:
    """Eigenvalues in (low, high], ``count`` many by inertia."""

    low: float
    high: float
    count: int


def intervals(v: np.ndarray, k: int, per: int = PER_INTERVAL) -> list[Interval]:
    """Intervals over the k largest eigenvalues (and those equal to the k-th at rounding level), cut between distinct ones."""
    size = float(np.abs(v).sum(axis=1).max())  # no eigenvalue of the matrix is larger
    least, apart, counted = 64 * len(v) * EPS * size, 8 * EPS * size, {}

    def count(at: float) -> int:
        if at not in counted:
            counted[at] = above(v, at)
        return counted[at]

    def between(wanted: int, low: float, high: float, close: float) -> tuple[float, float]:
        """Halves from a point with more than ``wanted`` eigenvalues above it, or as many, and one with fewer, or as many, until one is met."""
        while high - low > close and count(low) != wanted:
            mid = (low + high) / 2
            low, high = (mid, high) if count(mid) >= wanted else (low, mid)
        return low, high

    def cut(wanted: int, high: float) -> float:
        """A point below ``high`` with ``wanted`` eigenvalues above it, or a few more that equal the last at rounding level."""
        low, _ = between(wanted, -least, high, apart)
        if count(low) != wanted:
            low -= least
        inner = outer = low
        for up in (False, True):  # to the middle of the gap, since contours converge by the distance of what lies outside
            step = high - low
            while step > (outer - inner) / 16 + apart:
                at = outer + step if up else inner - step
                if -2 * least < at < high and count(at) == count(low):
                    inner, outer = (inner, at) if up else (at, outer)
                else:
                    step /= 2
        return (inner + outer) / 2

    low, high = -least, size + least
    while high - low > 1e-3 * high:  # close above the largest one
        mid = (low + high) / 2
        low, high = (low, mid) if count(mid) == 0 else (mid, high)
    out, done = [], 0
    while done < k:
        low = cut(min(k, done + per), high)
        out.append(Interval(low, high, count(low) - done))
        done, high = count(low), low
    return out


def contour(low: float, high: float, nodes: int = NODES) -> list[tuple[complex, complex]]:
    """Points on the upper half of the circle through both ends, with their weights for the projector."""
    angles = np.pi * (np.arange(nodes) + 0.5) / nodes
    turns = (high - low) / 2 * np.exp(1j * angles)
    return [((low + high) / 2 + t, t / nodes) for t in turns]


def _filtered(spark, v: np.ndarray, spans: list[Interval], blocks: list[np.ndarray]) -> list[np.ndarray]:
    """Each block of vectors after its interval's quadrature; every point is solved in a task of its own."""
    d = len(v)
    points = [(i, j, *map(float, (z.real, z.imag, w.real, w.imag))) for i, s in enumerate(spans) for j, (z, w) in enumerate(contour(s.low, s.high))]
    sent = spark.sparkContext.broadcast((v, blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, given = sent.value
        for batch in batches:
            for i, j, *z in zip(*(c.to_pylist() for c in batch.columns)):
                part = complex(*z[2:]) * np.linalg.solve(complex(*z[:2]) * np.eye(d) - matrix, given[i])
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([j]), pa.array([part.real.ravel().tolist()])], ["i", "j", "part"])

    frame = spark.createDataFrame(points, "i int, j int, zr double, zi double, wr double, wi double").repartition(min(len(points), spark.sparkContext.defaultParallelism))
    sums = [np.zeros_like(b) for b in blocks]
    for row in sorted(in_arrow(frame, run, "i long, j long, part array<double>").collect()):
        sums[row["i"]] += np.reshape(row["part"], sums[row["i"]].shape)
    sent.destroy()
    return sums


def components(spark, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix without negative ones, falling, and their unit vectors as columns.

    Fewer if the matrix has a lower rank.
    """
    d, size = len(v), np.abs(v).sum(axis=1).max(initial=0)
    rank = above(v, d * EPS * size) if size > 0 else 0
    k = min(k, rank)
    if not k:
        return np.zeros(0), np.zeros((d, 0))
    random, spans = np.random.default_rng(11), intervals(v, k)
    widths = [min(d, s.count * 3 // 2 + 4) for s in spans]
    found: dict[int, np.ndarray] = {}
    near = 16 * d * EPS * size
    blocks = [random.standard_normal((d, w)) for w in widths]
    rounds = 0
    while len(found) < len(spans):
        todo = [i for i in range(len(spans)) if i not in found]
        for i, filtered in zip(todo, _filtered(spark, v, [spans[i] for i in todo], [blocks[i] for i in todo]), strict=True):
            basis, _ = np.linalg.qr(filtered)
            values, turns = np.linalg.eigh(basis.T @ v @ basis)  # Rayleigh-Ritz
            vectors = basis @ turns
            off = np.linalg.norm(v @ vectors - vectors * values, axis=0)
            beside = np.maximum(spans[i].low - values, values - spans[i].high)
            inside = np.flatnonzero(beside <= near)
            if len(inside) >= spans[i].count and (off[inside] <= near).all():
                found[i] = vectors[:, inside[np.argsort(beside[inside], kind="stable")][: spans[i].count]]
            blocks[i] = vectors
        rounds += 1
        if rounds % ROUNDS == 0:  # too narrow a subspace for what lies close outside
            for i in range(len(spans)):
                if i not in found:
                    more = random.standard_normal((d, min(d, 2 * blocks[i].shape[1]) - blocks[i].shape[1]))
                    blocks[i] = np.hstack([blocks[i], more])
        if rounds > ROUNDS * (d.bit_length() + 2):
            raise ArithmeticError("the contours do not converge")
    basis, _ = np.linalg.qr(np.hstack([found[i] for i in range(len(spans))]))
    values, turns = np.linalg.eigh(basis.T @ v @ basis)  # once more over all, so that intervals are orthogonal to each other
    if len(values) != above(v, spans[-1].low):
        raise ArithmeticError("components are missing")
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], (basis @ turns)[:, order]


def whiten(rows: DataFrame, k: int) -> DataFrame:
    """``vec_id, n, deviation, whitened, shares, identity_error`` of ``vec_id, x``.

    ``whitened`` holds the row's place on each of at most k components in units
    of its spread, ``shares`` each component's part of the whole variance.
    ``deviation`` is the exact sum of ``(n * x - S) ** 2`` as a decimal, and
    ``identity_error`` how far the covariance of ``whitened``, summed anew over
    all rows, is from the identity at most.
    """
    spark = rows.sparkSession
    schema = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, shares array<double>"
    empty = spark.createDataFrame([], f"{schema}, identity_error double")
    n, sums = moments(rows)
    if not n:
        return empty
    whole, means = np.array(sums, object), np.array([s / n for s in sums])
    v = covariance(rows, n, means)
    values, vectors = components(spark, v, k)
    if not len(values):
        return empty
    turn, shares = vectors / np.sqrt(values), (values / np.trace(v)).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = _rows(batch.column(1))
            off = n * x.astype(object) - whole if n * (int(np.abs(x).max()) + 1) >= 2**62 else n * x - whole.astype(np.int64)
            most = int(np.abs(off).max())
            off = off.astype(object) if most * most * len(means) >= 2**63 else off.astype(np.int64)
            whitened = ((x - means) @ turn).ravel()
            stops = pa.array(np.arange(m + 1) * len(values), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(m, n), pa.int64()),
                    pa.array([str(s) for s in (off * off).sum(axis=1)], pa.string()).cast(pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(stops, pa.array(whitened)),
                    pa.ListArray.from_arrays(stops, pa.array(np.tile(shares, m))),
                ],
                ["vec_id", "n", "deviation", "whitened", "shares"],
            )

    out = stored(in_arrow(rows.select("vec_id", "x"), run, schema), "whitened")
    centre = out.select(F.posexplode("whitened").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("v")).collect()
    again = covariance(out, n, np.array([r["v"] for r in sorted(centre)]), "whitened")
    return out.withColumn("identity_error", F.lit(float(np.abs(again - np.eye(len(values))).max())))


def long_form(whitened: DataFrame) -> DataFrame:
    """A row for each vector and component, numbered from 1; a deviation that no long holds is null."""
    each = whitened.select("vec_id", "n", F.expr("try_cast(deviation as long)").alias("deviation"), "identity_error", F.posexplode(F.arrays_zip("whitened", "shares")).alias("c", "v"))
    return each.select(
        "vec_id", (F.col("c") + 1).alias("component"), "n", "deviation", F.col("v.whitened").alias("whitened"), F.col("v.shares").alias("explained"), "identity_error"
    )
