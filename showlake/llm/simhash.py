"""SimHash near-duplicates by ball hashing that meets in the middle.

Fingerprints at most three bits apart differ by at most two outside some
16-bit block in which they differ by at most one, or by nothing outside one
block.  So every distinct fingerprint emits, for each of its four blocks, the
remaining 48 bits and all their variants within one bit, half of the radius;
linked fingerprints meet in a common variant and are then verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showlake.llm.common import components, in_arrow, join_groups, stored, texts

RADIUS = 3
BLOCKS, BLOCK = 4, 16
REST = 64 - BLOCK
LOW = (1 << REST) - 1
#: Shingles hashed before their bits are counted, and members up to which a bucket compares pairs.
CHUNK, PAIRS = 65_536, 64


def fingerprint(text: str) -> int:
    """Bit set where more than half of the XXH64 hashes of three-word shingles have it; signed; 0 without words."""
    import xxhash

    words = text.encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends + 1 - sizes
    cut = list(zip(starts[: max(1, len(words) - 2)].tolist(), ends[min(2, len(words) - 1) :].tolist(), strict=True))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(cut), CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(line[a:b], 42) for a, b in cut[at : at + CHUNK]], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(cut), bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame) -> DataFrame:
    """``doc_id, fp`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return in_arrow(texts(documents), run, "doc_id long, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """(key, fp): each ``fp`` under the 4 x 49 variants that it emits; the key's upper bits name the block left out."""
    flips = [0, *(1 << i for i in range(REST))]
    emitted = F.array(
        *(
            F.struct(F.lit(REST - BLOCK * m).alias("turn"), F.lit(m << REST | flip).cast("long").alias("mark"))
            for m in range(BLOCKS)
            for flip in flips
        )
    )
    spread = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a few fingerprints become many rows
    rows = fps.repartition(spread, "fp").select("fp", F.explode(emitted).alias("v"))
    turned = f"(shiftleft(fp, v.turn) | shiftrightunsigned(fp, 64 - v.turn)) & {LOW}L"
    return rows.select(F.expr(f"({turned}) ^ v.mark").alias("key"), "fp")


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64))


def _bucket_edges(key: int, fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges that connect whatever a bucket's fingerprints link, at a cost that grows with their number.

    Outside the block left out, members differ by two bits at most, so equal
    blocks link them and so do blocks one bit apart.  Blocks two or three bits
    apart only matter for members that agree in all else; other such pairs
    meet in the bucket of another block.
    """
    if len(fps) <= PAIRS:
        near = _bits(fps[:, None] ^ fps[None, :]) <= RADIUS
        root = np.arange(len(fps))
        while (new := np.where(near, root, len(fps)).min(axis=1)).tolist() != root.tolist():
            root = new
        for i in np.flatnonzero(root != np.arange(len(fps))):
            yield int(fps[root[i]]), int(fps[i])
        return
    turn = REST - BLOCK * (key >> REST)
    turned = fps.view(np.uint64)
    turned = turned << np.uint64(turn) | (turned >> np.uint64(64 - turn) if turn else np.uint64(0))
    blocks = (turned >> np.uint64(REST)).astype(np.int64)
    centre = (turned & np.uint64(LOW)).astype(np.int64) == key & LOW

    def linked(chosen: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
        seen, first = np.unique(blocks[chosen], return_index=True)
        heads = fps[chosen][first]
        for distance in range(1, radius + 1):
            for bits in combinations(range(BLOCK), distance):
                other = seen ^ sum(1 << b for b in bits)
                at = np.searchsorted(seen, other)
                ok = (at < len(seen)) & (other > seen)
                ok[ok] = seen[at[ok]] == other[ok]
                yield from zip(heads[ok].tolist(), heads[at[ok]].tolist(), strict=True)

    everyone = np.ones(len(fps), bool)
    seen, first, where = np.unique(blocks, return_index=True, return_inverse=True)
    yield from zip(fps[first][where].tolist(), fps.tolist(), strict=True)
    yield from linked(everyone, 1)
    yield from linked(centre, RADIUS)


def links(fps: DataFrame) -> DataFrame:
    """Distinct edges (a, b) whose components are those of all links between the distinct ``fp``.

    A bucket holds at most 49 x 65,536 fingerprints, however many documents
    there are; buckets stream through sorted batches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            size = np.diff(np.append(start, len(keys)))
            two = start[size == 2]
            two = two[_bits(fps[two] ^ fps[two + 1]) <= RADIUS]
            found = {*zip(fps[two].tolist(), fps[two + 1].tolist(), strict=True)}
            for at, n in zip(start[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                found.update((a, b) for a, b in _bucket_edges(int(keys[at]), fps[at : at + n]) if a != b)
            pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        keys = held = np.zeros(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            held = np.concatenate([held, batch.column(1).to_numpy()])
            whole = np.searchsorted(keys, keys[-1]) if len(keys) else 0  # the last bucket may go on
            if whole:
                yield edges(keys[:whole], held[:whole])
                keys, held = keys[whole:], held[whole:]
        if len(keys):
            yield edges(keys, held)

    rows = variants(fps).repartition("key").sortWithinPartitions("key")
    return in_arrow(rows, run, "a long, b long").distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id, kept``, one row per document row.

    A text that is null or has no word has fingerprint zero, which links like
    any other.  ``component_id`` is the smallest doc_id that links reach; null
    doc_ids are passed over and get null where there is no other.  ``kept``
    marks that document.  Columns beyond doc_id and text are ignored; no
    documents, no rows.
    """
    rows = stored(fingerprints(documents), "simhash-rows")
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows"))
    distinct = stored(distinct, "simhash-distinct")
    edges = links(distinct.select("fp"))
    found = components(edges).withColumnRenamed("node", "fp")
    rooted = distinct.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("rows").alias("_in"))
    linked = join_groups(stored(rooted, "simhash-rooted"), stored(least, "simhash-least"), ["root"], "_in")
    classes = stored(linked.select("fp", "rows", "component_id"), "simhash-classes")
    return join_groups(rows, classes, ["fp"], "rows").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
