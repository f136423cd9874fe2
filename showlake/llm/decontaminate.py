"""Benchmark decontamination by pigeonhole edit matching on words.

An item of n words may be leaked with up to 20 % of them changed, inserted or
deleted.  Cut into one piece more than it may have errors, it leaves at least
one piece unharmed: exact hits of pieces propose places, which Myers'
bit-parallel edit distance verifies.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from showlake.llm.common import in_arrow, stored, texts

#: Share of an item's words that may differ.
ERRORS = 0.2
#: Words of benchmark text that one pass over the documents may carry.
BLOCK_WORDS = 500_000
#: Documents that are searched together.
BATCH = 256
#: Letters of scripts that are written without spaces (Unicode blocks): Thai, Lao, Myanmar, Khmer, kana, Han.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
WORD = re.compile(rf"[^\W{UNSPACED}]+|(?!\W)[{UNSPACED}]")
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters and digits, so that case, punctuation and layout do not matter.

    In scripts without spaces each letter is a word of its own.
    """
    return WORD.findall(text.lower())


def budget(n: int, errors: float = ERRORS) -> int:
    return math.floor(n * errors + 1e-9)


def best_end(masks: dict, pattern: int, text: list) -> tuple[int, int]:
    """Least edit distance of the pattern to any stretch of ``text``, and where the first such stretch ends (Myers 1999).

    ``masks`` has for each symbol the bits of its places in the pattern, which
    is ``pattern`` symbols long.
    """
    every, top = (1 << pattern) - 1, 1 << (pattern - 1)
    plus, minus, score, best, end = every, 0, pattern, pattern, 0
    for at, symbol in enumerate(text, 1):
        eq = masks.get(symbol, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus) & every
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = up << 1 & every, down << 1 & every  # a stretch may begin anywhere: row zero stays zero
        plus = down | ~(xv | up) & every
        minus = up & xv
        if score < best:
            best, end = score, at
    return best, end


@dataclass
class Items:
    """A block of benchmark items ready for search."""

    #: What the caller names each item by.
    ids: list
    vocabulary: dict[str, int]
    masks: list[dict[int, int]]
    sizes: list[int]
    #: By length of piece: sorted hashes, and the item and place in it of each.
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    errors: float

    @classmethod
    def build(cls, rows: list[tuple[object, str]], errors: float = ERRORS, min_words: int = 1) -> Items:
        vocabulary: dict[str, int] = {}
        ids, masks, sizes, found = [], [], [], {}
        for item, text in rows:
            words = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text or "")]
            if len(words) < min_words:
                continue
            bits: dict[int, int] = {}
            for at, w in enumerate(words):
                bits[w] = bits.get(w, 0) | 1 << at
            parts = budget(len(words), errors) + 1
            cuts = [len(words) * i // parts for i in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                key = int(rolling(np.array(words[a:b], np.uint64), b - a)[0])
                found.setdefault(b - a, []).append((key, len(ids), a))
            ids.append(item)
            masks.append(bits)
            sizes.append(len(words))
        pieces = {}
        for n, hits in found.items():
            hits.sort()
            keys, which, at = zip(*hits, strict=True)
            pieces[n] = np.array(keys, np.uint64), np.array(which, np.int64), np.array(at, np.int64)
        return cls(ids, vocabulary, masks, sizes, pieces, errors)

    def search(self, batch: list[str]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text's place in the batch, item, distance, first word, end word) of the best stretch per text and item."""
        words = [words_of(t) for t in batch]
        flat = [w for ws in words for w in ws]
        known = np.fromiter(map(self.vocabulary.get, flat, [0] * len(flat)), np.uint64, len(flat))
        ends = np.cumsum([len(ws) for ws in words])
        hits = []
        for n, (keys, which, at) in self.pieces.items():
            if len(flat) < n:
                continue
            hashes = rolling(known, n)
            may = np.flatnonzero(known[: len(hashes)])  # a piece begins with a word of some item
            low = np.searchsorted(keys, hashes[may])
            same = low < len(keys)
            same[same] = keys[low[same]] == hashes[may][same]
            places, low = may[same], low[same]
            count = np.searchsorted(keys, hashes[places], "right") - low  # equal pieces of several items
            each = np.repeat(low, count) + (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
            hits.append((np.repeat(places, count), which[each], at[each]))
        if not hits:
            return
        place, item, inside = (np.concatenate(x) for x in zip(*hits, strict=True))
        doc = np.searchsorted(ends, place, "right")
        diagonal = place - inside
        order = np.lexsort((diagonal, item, doc))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        windows: list[list[int]] = []
        for d, i, x in zip(doc[order].tolist(), item[order].tolist(), diagonal[order].tolist(), strict=True):
            k = budget(self.sizes[i], self.errors)
            start, stop = int(ends[d]) - len(words[d]), int(ends[d])
            a, b = max(start, x - k), min(stop, x + self.sizes[i] + k)
            if windows and windows[-1][:2] == [d, i] and a <= windows[-1][3]:
                windows[-1][3] = max(b, windows[-1][3])
            else:
                windows.append([d, i, a, b])
        for d, i, a, b in windows:
            if best.get((d, i), (1,))[0] == 0:
                continue  # the first whole hit stands
            k = budget(self.sizes[i], self.errors)
            seen = known[a:b].tolist()
            distance, end = best_end(self.masks[i], self.sizes[i], seen)
            if distance <= k and distance < best.get((d, i), (k + 1,))[0]:
                start = int(ends[d]) - len(words[d])
                back = {w: mirrored(bits, self.sizes[i]) for w, bits in self.masks[i].items()}
                _, size = best_end(back, self.sizes[i], seen[end - min(end, self.sizes[i] + k) : end][::-1])
                best[d, i] = distance, a + end - size - start, a + end - start
        for (d, i), found in best.items():
            yield d, i, *found


def mirrored(bits: int, n: int) -> int:
    return int(f"{bits:0{n}b}"[::-1], 2)


def rolling(symbols: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of every stretch of ``n`` symbols."""
    out = np.zeros(len(symbols) - n + 1, np.uint64)
    for i in range(n):
        out = (out ^ symbols[i : len(symbols) - n + 1 + i]) * MIX
        out ^= out >> np.uint64(29)
    return out


def leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    errors: float = ERRORS,
    min_words: int = 1,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``doc_id, item_id, n_items, n_words, distance, similarity, first_word, end_word``: each item that a document contains.

    One row per document row and item, at its best (first on ties) stretch of
    words; ``similarity`` is 1 - distance / n_words.  Null texts count as
    empty.  All items with a word are searched, unless ``min_words`` leaves out
    shorter ones; below 1 / ``errors`` words only exact hits count.  Items of
    the same text are searched once and give one row, under their smallest
    item_id and with their number in ``n_items``, so that what a block sends
    and a document finds does not grow with copies.  Only doc_id, item_id and
    the texts are read.  A benchmark of more than ``block_words``
    words is dealt by hash into blocks of about that size, one pass over the
    documents each, so that what is broadcast stays bounded.
    """
    spark = documents.sparkSession
    items = benchmark.groupBy(F.coalesce("text", F.lit("")).alias("text")).agg(
        F.min(F.col("item_id").cast("long")).alias("item_id"), F.count("*").alias("n_items")
    )
    items = stored(items, "benchmark-texts")
    # About six characters a word, but one in scripts without spaces.
    letters = F.length("text") + 5 * F.length(F.regexp_replace("text", f"[^{UNSPACED}]", ""))
    total = items.agg(F.sum(letters)).first()[0] or 0
    blocks = max(1, math.ceil(total / (6 * block_words)))
    schema = (
        "doc_id long, item_id long, n_items long, n_words long, distance long, similarity double, first_word long, end_word long"
    )
    names = ["doc_id", "item_id", "n_items", "n_words", "distance", "similarity", "first_word", "end_word"]
    types = [pa.int64()] * 5 + [pa.float64()] + [pa.int64()] * 2
    out = None
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("text", F.lit(7)), F.lit(blocks)) == block)
        rows = sorted((((i, n), t) for t, i, n in own.collect()), key=lambda r: r[1])
        shared = spark.sparkContext.broadcast(Items.build(rows, errors, min_words))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for whole in batches:
                for at in range(0, whole.num_rows, BATCH):
                    part = whole.slice(at, BATCH)
                    docs, found = part.column(0).to_pylist(), []
                    for d, i, distance, first, end in known.search(part.column(1).to_pylist()):
                        n = known.sizes[i]
                        found.append((docs[d], *known.ids[i], n, distance, round(1 - distance / n, 6), first, end))
                    columns = zip(*found, strict=True) if found else [[]] * len(names)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        part = in_arrow(texts(documents), run, schema)
        out = part if out is None else out.unionByName(part)
    return out
