"""Exact deduplication against its SQL, with odd rows, and with hashes that collide."""

import hashlib

import duckdb
from pyspark.sql import functions as F

from showlake.llm import exact_dedup, queries


def test_oracle(spark, sf):
    df = queries.QUERIES["op10_exact_dedup"](spark, sf)
    connection = duckdb.connect()
    connection.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = connection.execute(queries.ORACLES["op10_exact_dedup"])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want.fetchall())


def test_odd_rows(odd, got):
    rows = got(exact_dedup.exact_dedup(odd))
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert len(rows) == 9 and len(by[4]) == 1  # the repeated row of document 4 is one row
    assert (by[3][0]["keep_id"], by[3][0]["group_size"], by[3][0]["kept"]) == (4, 3, False)
    assert by[4][0]["kept"] and by[5][0]["group_size"] == 1
    empty = [r for r in rows if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in empty} == {(None, 2, False), (1, 2, False), (2, 2, True)}
    alone = next(r for r in by[None] if r["group_size"] == 1)
    assert alone["kept"] and alone["keep_id"] is None


def test_colliding_hashes_and_full_buckets(spark, truth, got):
    df = spark.createDataFrame([(i, t) for i, t, *_ in truth], "doc_id long, text string")
    few = got(exact_dedup.exact_dedup(df, bucket_rows=4, key_bits=3))
    assert few == got(exact_dedup.exact_dedup(df))
    entries = df.select(F.xxhash64("text").alias("h")).distinct()
    cells, depth = exact_dedup.directory(entries, 4)
    counts = {}
    placed = entries.withColumn("cell", exact_dedup.cell(depth)).join(cells, "cell").collect()
    for r in placed:
        counts[r["bucket"]] = counts.get(r["bucket"], 0) + 1
    assert len(placed) == entries.count() and max(counts.values()) <= 4
    assert len({r["local_depth"] for r in placed}) > 1


def test_the_index_decides(spark, truth, got, monkeypatch):
    """With a directory that loses a cell, or leads one to two buckets, results are wrong; owners hold whole ranges of buckets."""
    df = spark.createDataFrame([(i, t) for i, t, *_ in truth], "doc_id long, text string").repartition(3)
    right = exact_dedup.directory
    whole = got(exact_dedup.exact_dedup(df, bucket_rows=2, key_bits=20))
    assert whole == got(exact_dedup.exact_dedup(df))

    def lossy(hashes, bucket_rows):
        cells, depth = right(hashes, bucket_rows)
        return cells.filter(F.col("cell") != cells.agg(F.min("cell")).scalar()), depth

    monkeypatch.setattr(exact_dedup, "directory", lossy)
    assert len(got(exact_dedup.exact_dedup(df, bucket_rows=2, key_bits=20))) < len(whole)

    def torn(hashes, bucket_rows):
        cells, depth = right(hashes, bucket_rows)
        return cells.unionByName(cells.withColumn("bucket", F.col("bucket") + 1)), depth

    monkeypatch.setattr(exact_dedup, "directory", torn)
    assert len(got(exact_dedup.exact_dedup(df, bucket_rows=2, key_bits=20))) > len(whole)
    monkeypatch.setattr(exact_dedup, "directory", right)
    rows = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    index = exact_dedup.build_index(rows, 20).withColumn("file", F.input_file_name())
    spans = index.groupBy("file").agg(F.min("bucket").alias("a"), F.max("bucket").alias("b")).orderBy("a", "b").collect()
    assert all(x["b"] <= y["a"] for x, y in zip(spans, spans[1:]))
    assert {r["local_depth"] for r in right(rows.select("h").distinct(), 20)[0].collect()} != {0}


def test_empty(none):
    assert exact_dedup.exact_dedup(none).collect() == []
