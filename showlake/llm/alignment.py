"""Alignment of two tokenizers' tokens over the same bytes, and how often ids are linked.

The tokens of both are measured in bytes; where a token of each ends at the
same byte, the text is cut, so every group of tokens covers the same bytes on
both sides.  Within a group, tokens whose bytes overlap are linked.

Each row is a document of its own: repeated rows and null ids are aligned and
counted each.  A text that is null, empty, or that one tokenizer does not keep
byte by byte has no tokens: its counts are zero and its digest is empty.  No
rows give no rows; columns beyond doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from functools import lru_cache
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showlake.llm.common import in_arrow, join_groups, stored, texts

#: Texts encoded at a time.
BATCH = 64
#: Longer texts go to the slower encoder of the two, which stands any run of blanks; both give the same ids.
LONG = 1 << 16
#: Pairs with more than this share of all links of documents are broadcast, at most 1 / HOT_PAIRS of them.
HOT_PAIRS = 1 / 65536


def byte_of_letter() -> dict[str, int]:
    """The bytes that a byte-level vocabulary writes as letters: visible ones of Latin-1 as themselves, the rest from U+0100 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE vocabulary; ``pattern`` is the expression that its words follow."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, added = byte_of_letter(), {t["content"]: t["id"] for t in spec["added_tokens"]}
        own = {bytes(map(letters.__getitem__, w)): i for w, i in spec["model"]["vocab"].items() if w not in added}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        ids = [spec["model"]["vocab"][m] for m in merges]
        if ids != sorted(ids):
            raise ValueError("the merges of the vocabulary are not in the order of its ids")
        self.pieces = {i: b for b, i in own.items()}
        self.short = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=own, special_tokens={})
        self.long = Tokenizer.from_file(path)
        self.long.encode_special_tokens = True

    def encode(self, given: list[str]) -> list[list[int]]:
        return [self.short.encode_ordinary(t) if len(t) <= LONG else self.long.encode(t, add_special_tokens=False).ids for t in given]


class Pieces:
    """A sentence-piece model that puts a space before each text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = {}
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.pieces[i] = bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, given: list[str]) -> list[list[int]]:
        return self.library.encode(given, num_threads=1)


@lru_cache(maxsize=2)
def _tokenizers(a: str, pattern: str, b: str) -> tuple[ByteLevel, Pieces, Side, Side]:
    one, other = ByteLevel(a, pattern), Pieces(b)
    return one, other, Side(one.pieces), Side(other.pieces)


class Side:
    """Of each token by id: its bytes, their number, and the letters of the id and a comma as the first seven and the last byte of a long."""

    def __init__(self, pieces: dict[int, bytes]):
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.sizes = np.array(list(map(len, self.pieces)))
        self.names = np.array([int.from_bytes(str(i).encode(), "little") | ord(",") << 56 for i in range(len(self.pieces))], "<i8")

    def joined(self, ids: Sequence[int]) -> bytes:
        """The bytes of all tokens."""
        return b"".join(itemgetter(*ids)(self.pieces)) if len(ids) > 1 else b"".join(self.pieces[i] for i in ids)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many tokens of either side end by each byte at which both have an end, and the places of the tokens of every link, in order.

    A slice of m and n tokens without a common end inside has m + n - 1 links:
    each byte at which a token of either side begins adds the two tokens over it.
    """
    if not len(ends_a):
        return (np.zeros(0, np.int64),) * 4
    begins = np.zeros((2, ends_a[-1]), np.int8)
    for side, ends in zip(begins, (ends_a, ends_b), strict=True):
        side[ends[:-1]] = 1
    at = np.flatnonzero(begins[0] | begins[1])
    moved = begins[:, at]
    over = np.zeros((2, len(at) + 1), np.int64)
    np.cumsum(moved, axis=1, dtype=np.int64, out=over[:, 1:])
    both = np.flatnonzero(moved[0] & moved[1]) + 1
    stops_a, stops_b = np.append(over[0, both], len(ends_a)), np.append(over[1, both], len(ends_b))
    return stops_a, stops_b, over[0], over[1]


def written(ids: np.ndarray, stops: np.ndarray, side: Side, end: str) -> np.ndarray:
    """The letters of each id and, in the last byte, the comma after it, or ``end`` after the last one of a group."""
    out = side.names[ids]
    out[stops - 1] ^= (ord(",") ^ ord(end)) << 56
    return out


class Aligned:
    """One text's ids on both sides, the stops of its groups and its links; all empty if the text has no tokens."""

    def __init__(self, text: str, a: Sequence[int], b: Sequence[int], side_a: Side, side_b: Side):
        raw = (" " + text).encode()
        if not text or side_a.joined(a) != raw or side_b.joined(b) != raw:
            a = b = []
        self.a, self.b, self.sides = np.fromiter(a, np.int64, len(a)), np.fromiter(b, np.int64, len(b)), (side_a, side_b)
        ends_a, ends_b = np.cumsum(side_a.sizes[self.a]), np.cumsum(side_b.sizes[self.b])
        self.stops_a, self.stops_b, left, right = overlaps(ends_a, ends_b)
        self.n_links = len(left)
        self.pairs, self.times = np.unique(self.a[left] << 32 | self.b[right], return_counts=True)

    def digest(self) -> str:
        """Hash of all groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        n_a, n_b = len(self.a), len(self.b)
        if not n_a:
            return ""
        one, other = written(self.a, self.stops_a, self.sides[0], "|"), written(self.b, self.stops_b, self.sides[1], ";")
        # The tokens of a group stand behind those of all groups before it, and the second side's behind the first's.
        before_a, before_b = np.append(0, self.stops_a), np.append(0, self.stops_b)
        out = np.empty(n_a + n_b, "<i8")
        out[np.arange(n_a) + np.repeat(before_b[:-1], np.diff(before_a))] = one
        out[np.arange(n_b) + np.repeat(self.stops_a, np.diff(before_b))] = other
        return hashlib.sha256(out.tobytes().translate(None, b"\0")[:-1]).hexdigest()


def _each(batches: Iterator[pa.RecordBatch], a: str, pattern: str, b: str) -> Iterator[tuple[pa.Array, list[Aligned]]]:
    one, other, *sides = _tokenizers(a, pattern, b)
    for whole in batches:
        for at in range(0, whole.num_rows, BATCH):
            part = whole.slice(at, BATCH)
            given = part.column(1).to_pylist()
            pairs = zip(given, one.encode([" " + t for t in given]), other.encode(given), strict=True)
            yield part.column(0), [Aligned(t, x, y, *sides) for t, x, y in pairs]


def _lists(values: list, kind: pa.DataType) -> pa.ListArray:
    stops = pa.array(np.cumsum([0, *map(len, values)]), pa.int32())
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(stops, pa.array(flat.astype(kind.to_pandas_dtype()), kind))


def align(documents: DataFrame, a: str, pattern: str, b: str) -> DataFrame:
    """``doc_id``, ids of both sides, and for each group the number of ids of either side up to its end.

    ``a`` is the path of a byte-level vocabulary whose words follow
    ``pattern``, ``b`` that of a sentence-piece model; every executor must be
    able to open them.
    """
    names = ["a_ids", "b_ids", "a_stops", "b_stops"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, got in _each(batches, a, pattern, b):
            values = [[x.a for x in got], [x.b for x in got], [x.stops_a for x in got], [x.stops_b for x in got]]
            yield pa.RecordBatch.from_arrays([ids, *(_lists(v, pa.int32()) for v in values)], ["doc_id", *names])

    return in_arrow(texts(documents), run, ", ".join(["doc_id long", *(f"{n} array<int>" for n in names)]))


def linked(documents: DataFrame, a: str, pattern: str, b: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256`` and ``pairs``: each different link of the text and how often it has it.

    A pair is the first side's id in the upper half of a long, the other's in the lower.
    """
    numbers = ["n_a", "n_b", "n_groups", "n_links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, got in _each(batches, a, pattern, b):
            counts = [[len(x.a), len(x.b), len(x.stops_a), x.n_links] for x in got]
            pairs, times = _lists([x.pairs for x in got], pa.int64()), _lists([x.times for x in got], pa.int64())
            each = pa.StructArray.from_arrays([pairs.values, times.values], ["pair", "times"])
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    *(pa.array(c, pa.int64()) for c in zip(*counts, strict=True)),
                    pa.array([x.digest() for x in got], pa.string()),
                    pa.ListArray.from_arrays(pairs.offsets, each),
                ],
                ["doc_id", *numbers, "groups_sha256", "pairs"],
            )

    schema = ", ".join(["doc_id long", *(f"{n} long" for n in numbers), "groups_sha256 string", "pairs array<struct<pair: long, times: long>>"])
    return in_arrow(texts(documents), run, schema)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``pair, docs, best`` of rows with a ``pair`` for each document that holds it: their number, and whether no other pair of its first id has more."""
    counts = stored(pairs.groupBy("pair").agg(F.count("*").alias("docs")), "pairs")
    first = F.shiftright("pair", 32).alias("a")
    most = counts.groupBy(first).agg(F.max("docs").alias("most"))
    return counts.select("pair", "docs", first).join(most, "a").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))


def report(documents: DataFrame, a: str, pattern: str, b: str) -> DataFrame:
    """Counts and digest of each document, ``n_best`` of its links that are most frequent for their first id, and ``count_sum`` over all its links.

    Texts are encoded once, into a stored table.  A pair's number of documents
    comes from one aggregation that combines in the map tasks; frequent pairs
    go back to the documents by broadcast and rare ones in a shuffle.
    """
    rows = stored(linked(documents, a, pattern, b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    each = rows.select("row", F.inline("pairs"))
    counts = stored(pair_counts(each), "pair-counts")
    both = join_groups(each, counts, ["pair"], "docs", HOT_PAIRS)
    sums = both.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("docs") * F.col("times")).alias("count_sum"),
    )
    zero = {"n_best": 0, "count_sum": 0}
    return rows.drop("pairs").join(sums, "row", "left").fillna(zero).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
