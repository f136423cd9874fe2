"""Exact search for the k largest inner products, by MaxScore over shards of the candidates.

A component is a term, and a term's postings are that component of all
candidates of a slice; the largest contribution that any of them can make to a
query is the term's bound.  A query's terms fall by bound into essential ones
and the rest, whose bounds together stay below the query's k-th best score so
far.  The essential postings are traversed (for a block of queries at once,
as a product of matrices); a candidate is competitive while its sum and the
bounds of what is left reach the k-th best, and only competitive ones are
probed for further terms.  Nothing is approximated: ties go to smaller ids.

Rows whose vector is null, or holds a null or a number that is not finite,
take no part.  Components that the shorter of two vectors lacks count as zero.
Rows that share an id are candidates each; as a query, the least of them
counts.  A row without an id is a candidate and ties behind all others.  No
rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from showlake.llm.common import in_arrow, new_path, stored

#: Queries that go to the executors at once; further blocks take further passes over the candidates.
BLOCK = 16384
#: Queries and candidates whose products are held at once, and candidates of the first slice, which sets the first k-th best scores.
QUERIES, SLICE, FIRST = 512, 4096, 128
#: Terms that competitive candidates are probed for at a time.
PROBE = 8
#: Above this share of competitive candidates all of a slice are probed, as that is faster than picking them.
DENSE = 1 / 16
NO_ID = np.iinfo(np.int64).max
SCHEMA = "query_id long, vec_id long, score long"


def quantised(embeddings: DataFrame, scale: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, q`` of all usable rows: every component as ``floor(scale * component)``."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = embeddings.filter(F.col(vector).isNotNull() & ~bad)
    return usable.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("q"))


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k best candidates of another id, all if there are fewer.

    Both inputs have ``vec_id`` and ``q``, an array of longs.  Blocks of at
    most about ``BLOCK`` queries are sent to every task that reads candidates;
    each task answers with k rows a query at most, which meet by query.
    """
    spark = candidates.sparkSession
    asked = queries.filter("vec_id is not null").groupBy("vec_id").agg(F.min("q").alias("q"))
    asked = stored(asked, "queries")
    blocks = -(-asked.count() // BLOCK)
    own, out = F.pmod(F.xxhash64("vec_id"), F.lit(max(blocks, 1))), new_path(spark, "top-k")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found.write.parquet(out)
    for b in range(blocks):
        block = asked.filter(own == b).toArrow()
        if not block.num_rows:
            continue
        ids, vectors = block.column("vec_id").to_numpy(), matrix(block.column("q").combine_chunks())
        sent = spark.sparkContext.broadcast((ids, vectors))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            shard = Shard(*sent.value, k)
            for batch in batches:
                shard.add(batch.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False), batch.column(1))
            yield from shard.best()

        shards = in_arrow(candidates.select("vec_id", "q"), run, SCHEMA)
        ranked = shards.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        ranked.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(out)
    return spark.read.schema(found.schema).parquet(out)


def matrix(lists: pa.ListArray, width: int | None = None) -> np.ndarray:
    """Rows of equal length, filled with zeros or cut to ``width`` (the longest row's by default)."""
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(sizes.max(initial=0)) if width is None else width
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    fits = place < width
    out[row[fits], place[fits]] = flat[fits]
    return out


class Shard:
    """The k best candidates of one task for a block of queries, as far as its rows have come."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.seen = 0
        #: Query place, score and id of the best so far, and each query's k-th best score.
        self.kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.least = np.full(len(ids), -np.inf)

    def add(self, ids: np.ndarray, lists: pa.ListArray) -> None:
        given, at = matrix(lists, self.vectors.shape[1]), 0
        while at < len(ids):
            end = min(len(ids), at + (SLICE if self.seen else FIRST))
            self._slice(ids[at:end], given[at:end])
            self.seen, at = self.seen + end - at, end

    def _slice(self, ids: np.ndarray, x: np.ndarray) -> None:
        largest = [int(np.abs(v.astype(object) if v.size and v.min() == np.iinfo(np.int64).min else v).max(initial=0)) for v in (x, self.vectors)]
        bound = largest[0] * largest[1] * max(1, x.shape[1])
        kind = np.float64 if bound < 2**53 else object  # sums of doubles are exact below 2 ** 53
        postings = np.ascontiguousarray(x.T).astype(kind)
        news = [[], [], []]
        for low in range(0, len(self.ids), QUERIES):
            w = self.vectors[low : low + QUERIES].astype(kind)
            place, doc, score = max_score(w, postings, self.least[low : low + QUERIES])
            other = ids[doc] != self.ids[low + place]
            for kept, new in zip(news, (low + place, score, ids[doc]), strict=True):
                kept.append(new[other].astype(np.int64))
        self._keep(*(np.concatenate(n) for n in news))

    def _keep(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(place):
            return
        place, score, ids = (np.concatenate(both) for both in zip(self.kept, (place, score, ids), strict=True))
        order = np.lexsort((ids, -score, place))
        place, score, ids = place[order], score[order], ids[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        self.kept = [v[rank < self.k] for v in (place, score, ids)]
        last = rank == self.k - 1
        self.least[place[last]] = score[last]

    def best(self) -> Iterator[pa.RecordBatch]:
        place, score, ids = self.kept
        found = pa.array(ids, pa.int64(), mask=ids == NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(self.ids[place], pa.int64()), found, pa.array(score, pa.int64())], ["query_id", "vec_id", "score"])


def max_score(w: np.ndarray, postings: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, inner product) of all pairs whose product reaches the query's ``least``.

    ``w`` has a row for each query, ``postings`` one for each term.
    """
    m, terms = w.shape
    n = postings.shape[1]
    if not terms or not n:
        place, doc = np.nonzero(np.broadcast_to((least <= 0)[:, None], (m, n)))
        return place, doc, np.zeros(len(place), np.int64)
    bounds = np.maximum(w * postings.max(axis=1), w * postings.min(axis=1))
    order = np.argsort(-bounds, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(terms)[None, :], axis=1)
    left = np.zeros((m, terms + 1), w.dtype)  # bounds of the terms from each rank on, together
    left[:, :terms] = np.cumsum(np.take_along_axis(bounds, order, axis=1)[:, ::-1], axis=1)[:, ::-1]
    # Rests of signed bounds need not fall by rank: essential are all terms up to the last rest that reaches the k-th best.
    reach = left[:, :terms] >= least[:, None]
    done = np.where(reach.any(axis=1), terms - np.argmax(reach[:, ::-1], axis=1), 0)
    sums = np.where(rank < done[:, None], w, 0) @ postings
    rows = np.arange(m)
    while True:
        competitive = sums + left[rows, done][:, None] >= least[:, None]
        if (done == terms).all() or np.count_nonzero(competitive) <= DENSE * m * n:
            break
        upto = np.minimum(done + PROBE, terms)
        sums += np.where((rank >= done[:, None]) & (rank < upto[:, None]), w, 0) @ postings
        done = upto
    place, doc = np.nonzero(competitive)
    score, at = sums[place, doc], done[place]
    while (at < terms).any():
        for _ in range(PROBE):
            term = order[place, np.minimum(at, terms - 1)]
            score = score + np.where(at < terms, w[place, term] * postings[term, doc], 0)
            at = np.minimum(at + 1, terms)
        near = score + left[place, at] >= least[place]
        place, doc, score, at = place[near], doc[near], score[near], at[near]
    return place, doc, score


ORACLE = """
    with v as (
        select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q
        from embeddings
        where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ), scored as (
        select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint as score
        from v as a join v as b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
    )
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
    from scored
    qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
"""
