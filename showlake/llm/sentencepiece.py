"""SentencePiece encoding that keeps byte offsets, and decoding.

The text is normalised here: at each position the longest rule of the model's
compiled character map is applied, white space is escaped and the dummy prefix
added as the model asks, and every normalised byte remembers the byte of the
original from which it came.  The library then only cuts the normalised text
into pieces, and each piece is projected to its span of original bytes.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showlake.llm.common import in_arrow, texts

SPACE = "▁"
#: Documents per batch that a worker returns.
BATCH = 256


def fields(message: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and values of a serialised protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value, shift, at = value | (byte & 127) << shift, shift + 7, at + 1
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if tag & 7 == 2 else ((8, at) if tag & 7 == 1 else (4, at))
            value, at = message[at : at + size], at + size
        yield tag >> 3, value


class CharacterMap:
    """Longest-prefix lookup in a compiled character map: a double-array trie over UTF-8 and a pool of replacements."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.pool = compiled[4 + size :] if size else b""
        #: Bytes with which a rule can begin; others are copied in runs.
        self.starts = bytes(c for c in range(1, 256) if self.units and self._child(self._offset(self.units[0]), c) is not None)
        self.next_start = re.compile(b"[" + re.escape(self.starts) + b"]") if self.starts else None

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def _child(self, node: int, c: int) -> int | None:
        at = node ^ c
        return at if at < len(self.units) and self.units[at] & ((1 << 31) | 0xFF) == c else None

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest rule that matches at ``at``, and its replacement."""
        node, found = self._offset(self.units[0]), None
        for end in range(at, len(text)):
            child = self._child(node, text[end])
            if child is None:
                break
            unit = self.units[child]
            node = child ^ self._offset(unit)
            if unit >> 8 & 1:
                value = self.units[node] & ((1 << 31) - 1)
                found = end + 1 - at, self.pool[value : self.pool.index(b"\0", value)]
        return found


class Normaliser:
    """The normaliser of a model; ``normalise`` returns the text and, per byte, where it comes from."""

    def __init__(self, spec: bytes):
        given = dict(fields(spec))
        self.rules = CharacterMap(given.get(2, b""))
        self.dummy, self.squeeze, self.escape = (bool(given.get(n, 1)) for n in (3, 4, 5))

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its UTF-8 bytes and its end the offset of the original byte."""
        raw = text.encode("utf-8", "replace")
        if self.rules.next_start is None:
            out, origin = raw, np.arange(len(raw) + 1, dtype=np.int32)
        else:
            out, origin = self._mapped(raw)
        if self.squeeze:
            out, origin = self._squeezed(out, origin)
        if self.escape:
            counts = np.ones(len(origin), np.int8)
            counts[:-1][np.frombuffer(out, np.uint8) == 32] = 3
            origin = np.repeat(origin, counts)
            out = out.replace(b" ", SPACE.encode())
        if self.dummy and out:
            first = SPACE.encode() if self.escape else b" "
            out, origin = first + out, np.concatenate([np.full(len(first), origin[0], np.int32), origin])
        return out.decode("utf-8"), origin

    def _mapped(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        parts, origins, at = [], [], 0
        while at < len(raw):
            found = self.rules.next_start.search(raw, at)
            stop = found.start() if found else len(raw)
            if stop > at:
                parts.append(raw[at:stop])
                origins.append(np.arange(at, stop))
                at = stop
                continue
            size, new = self.rules.longest(raw, at) or (0, b"")
            if not size:  # no rule: one whole character is kept
                size = 1
                while at + size < len(raw) and raw[at + size] & 0xC0 == 0x80:
                    size += 1
                parts.append(raw[at : at + size])
                origins.append(np.full(size, at))
            else:
                parts.append(new)
                origins.append(np.full(len(new), at))
            at += size
        return b"".join(parts), np.concatenate([*origins, [len(raw)]]).astype(np.int32)

    def _squeezed(self, out: bytes, origin: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Without white space at either end, and with one space for each run of them."""
        flat = np.frombuffer(out, np.uint8)
        space = flat == 32
        keep = ~space | np.append(False, ~space[:-1])[: len(flat)]
        while_end = len(out.rstrip(b" "))
        keep[while_end:] = False
        end = origin[while_end]
        return flat[keep].tobytes(), np.append(origin[:-1][keep], end)


class Encoder:
    """A model with its own normaliser; the library cuts the normalised text into pieces."""

    def __init__(self, model: bytes):
        import sentencepiece

        spec, kinds = b"", {}
        for number, value in fields(model):
            if number == 3:
                spec += value
            elif number == 1:
                piece = dict(fields(value))
                kinds[len(kinds)] = (piece.get(1, b""), piece.get(3, 1))
        self.normaliser = Normaliser(spec)
        # A later copy of a field overrides the model's: no prefix, no squeezing, no escaping, and rules are ours.
        plain = b"\x12\x00\x18\x00\x20\x00\x28\x00"
        self.cutter = sentencepiece.SentencePieceProcessor(model_proto=model + b"\x1a" + bytes([len(plain)]) + plain)
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=model)
        if self.normaliser.rules.units:  # an empty map cannot override one, so such a model cuts its own normal form
            self.cutter = sentencepiece.SentencePieceProcessor(model_proto=without_rules(model))
        if any(kind == 4 for _, kind in kinds.values()):
            raise ValueError("models with user-defined pieces are not supported")
        #: Bytes of each piece; an unknown one (None) takes what the next known one leaves.
        self.sizes = np.array([1 if kind == 6 else len(p) for p, kind in kinds.values()])
        self.unknown = next((i for i, (_, kind) in kinds.items() if kind == 2), -1)
        self.fallback = any(kind == 6 for _, kind in kinds.values())

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the first and end byte of each piece in the original text."""
        normal, origin = self.normaliser.normalise(text)
        ids = np.array(self.cutter.encode(normal), np.int32)
        if not self.fallback and (ids == self.unknown).any():
            proto = self.cutter.encode(normal, out_type="immutable_proto")
            sizes = np.array([len(p.surface.encode()) for p in proto.pieces])
        else:
            sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return ids, origin[ends - sizes], origin[ends]


def without_rules(model: bytes) -> bytes:
    """The model with a normaliser that leaves its input as it is."""
    out = bytearray()
    for number, value in fields(model):
        if number == 3:
            value = b"\x0a\x08identity\x18\x00\x20\x00\x28\x00"
        if isinstance(value, bytes):
            size, head = len(value), bytearray([number << 3 | 2])
            while size > 127:
                head.append(size & 127 | 128)
                size >>= 7
            out += head + bytes([size]) + value
    return bytes(out)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    with open(path, "rb") as file:
        return Encoder(file.read())


def encode(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id, ids, begins, ends`` of every whole text; ``begins`` and ``ends`` are byte offsets in the UTF-8 text.

    A null text counts as empty and has no pieces.  ``model`` is a path that
    every executor can open, as the tokenizer package installs it.  Repeated
    rows are encoded each, columns beyond doc_id and text are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), *((n, pa.list_(pa.int32())) for n in ("ids", "begins", "ends"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):  # no rows: no batch
                part = whole.slice(at, BATCH)
                got = [encoder.encode(t.as_py()) for t in part.column(1)]
                stops = pa.array(np.cumsum([0, *(len(x[0]) for x in got)]), pa.int32())
                lists = [
                    pa.ListArray.from_arrays(stops, pa.array(np.concatenate([x[k] for x in got]).astype(np.int32)))
                    for k in range(3)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), *lists], schema=schema)

    return in_arrow(texts(documents), run, "doc_id long, ids array<int>, begins array<int>, ends array<int>")


def decode(encoded: DataFrame, model: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of its ``ids`` (no pieces or null: empty)."""
    fields_ = [f for f in encoded.schema.fields if f.name != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _encoder(model).whole
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                part = whole.slice(at, BATCH)
                lists = part.column(ids)
                flat, ends = lists.flatten().to_numpy(zero_copy_only=False).tolist(), np.cumsum([n or 0 for n in pc.list_value_length(lists).to_pylist()])
                back = library.decode([flat[a:b] for a, b in zip([0, *ends], ends)], num_threads=1)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(back, pa.string())], [*part.schema.names, "decoded"])

    kept = encoded.select(*(f.name for f in fields_))
    return in_arrow(kept, run, kept.withColumn("decoded", F.lit("")).schema)


def digests(documents: DataFrame, model: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, last_byte`` from the encoded and decoded texts."""
    both = decode(encode(documents, model).select("doc_id", "ids", F.array_max("ends").alias("last_byte")), model)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.coalesce("last_byte", F.lit(0)).cast("long").alias("last_byte"),
    )
