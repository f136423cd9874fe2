"""Exact deduplication over an extendible-hash index in shared files.

A directory over the leading hash bits doubles until no bucket holds more than
``bucket_rows`` hashes, and cells that still fit one bucket share it.  Texts,
of which copies have met within tasks, are sent through the directory: hash to
cell, cell to bucket, and owner tasks take ranges of buckets.  An owner chains
the texts of a hash, compares their bytes, settles each group and writes it in
bucket and hash order; rows are answered from that index.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showlake.llm.common import join_groups, stored, texts

#: Hashes that a bucket may hold, and bits of the hash that the directory may use.
BUCKET_ROWS, MOST_BITS = 100_000, 40
#: Parts in which the copies of a text come to its owner at most, each summed before it is moved.
PARTS = 4


def cell(depth: int) -> Column:
    """The first ``depth`` bits of the hash."""
    return F.shiftrightunsigned("h", 64 - depth) if depth else F.lit(0).cast("long")


def directory(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """(cell, bucket, local_depth) of an extendible-hash directory over the hashes ``h`` of ``rows``, and its depth.

    The directory starts with one cell and doubles while a bucket overflows,
    up to cells 64 times finer than the mean needs: hashes that agree so far
    stay together, however many.  All doublings are tried in one pass over the
    counts of the finest cells.  A bucket is named after its first cell and is
    as shallow as its size permits.
    """
    finest = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, rows.count()) / bucket_rows))) + 6)
    counts = rows.select("h").distinct().groupBy(cell(finest).alias("fine")).agg(F.count("*").alias("n"))
    counts = stored(counts, "dedup-cells")
    tried = counts.select("n", "fine", F.explode(F.sequence(F.lit(0), F.lit(finest))).alias("depth"))
    sizes = tried.groupBy("depth", F.expr(f"shiftright(fine, {finest} - depth)").alias("cell")).agg(F.sum("n").alias("n"))
    fits = sizes.groupBy("depth").agg(F.max("n").alias("n")).filter(F.col("n") <= bucket_rows)
    depth = fits.agg(F.min("depth")).first()[0]
    depth = finest if depth is None else depth
    cells = counts.groupBy(F.shiftrightunsigned("fine", finest - depth).alias("cell")).agg(F.sum("n").alias("n"))
    if depth == 0:
        return cells.select("cell", F.lit(0).cast("long").alias("bucket"), F.lit(0).alias("local_depth")), 0
    paths = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("local_depth")).withColumn(
        "bucket", F.expr(f"shiftleft(shiftright(cell, {depth} - local_depth), {depth} - local_depth)")
    )
    fit = paths.groupBy("local_depth", "bucket").agg(F.sum("n").alias("n"))
    fit = fit.filter((F.col("n") <= bucket_rows) | (F.col("local_depth") == depth)).select("local_depth", "bucket")
    found = paths.drop("n").join(fit, ["local_depth", "bucket"]).groupBy("cell")
    first = found.agg(F.min(F.struct("local_depth", "bucket")).alias("s"))
    return first.select("cell", "s.bucket", "s.local_depth"), depth


def build_index(rows: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """The stored index of ``rows`` (doc_id, h, text): ``bucket, h, text_sha256, keep_id, group_size``, an entry for each distinct text.

    Copies are summed in every task, and in at most ``PARTS`` parts, before
    their text goes to the owner of its bucket; so a text that most rows hold
    arrives there in a few rows.  The owner's grouping by bucket, hash and text
    compares bytes wherever hashes are equal.
    """
    buckets, depth = directory(rows, bucket_rows)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).alias("part")
    entries = rows.groupBy("h", "text", part).agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    routed = entries.withColumn("cell", cell(depth)).join(buckets.select("cell", "bucket"), "cell")
    owned = routed.select("bucket", "h", "text", "keep_id", "group_size").repartitionByRange("bucket", "h")
    settled = owned.groupBy("bucket", "h", "text").agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    index = settled.select("bucket", "h", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    return stored(index.sortWithinPartitions("bucket", "h"), "dedup-index")


def exact_dedup(documents: DataFrame, bucket_rows: int = BUCKET_ROWS, key_bits: int = 64) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per document.

    A null text counts as empty.  Of equal texts the largest doc_id stays; a
    null doc_id is smaller than any other.  Rows that repeat a doc_id and its
    text give one row, though each counts in ``group_size``.  No documents, no
    rows.  Columns beyond doc_id and text are ignored.  ``key_bits`` shortens
    the hash, which only makes chains longer.
    """
    hashed = F.xxhash64("text")
    rows = texts(documents).withColumn("h", hashed if key_bits == 64 else F.shiftleft(hashed, 64 - key_bits))
    index = build_index(rows, bucket_rows)
    known = rows.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"))
    known = stored(known.distinct(), "dedup-rows")
    both = join_groups(known, index.drop("bucket"), ["h", "text_sha256"], "group_size")
    return both.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
