"""Alignment of two tokenizers against plain definitions and the libraries themselves."""

import hashlib
import random
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from showlake.llm import alignment, queries

HOW = (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, queries.piece_model())


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(HOW[0])
    a.encode_special_tokens = True
    letters = alignment.byte_of_letter()
    of_a = lambda i: bytes(letters[c] for c in a.id_to_token(i))
    b = sentencepiece.SentencePieceProcessor(model_file=HOW[2])
    of_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, of_a, b, of_b


def spans(pieces):
    at, out = 0, []
    for p in pieces:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(text, libraries):
    """Groups by the ends that both have, links byte by byte."""
    a, of_a, b, of_b = libraries
    if not text:
        return [], [], [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a, bytes_b = [of_a(i) for i in ids_a], [of_b(i) for i in ids_b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return [], [], [], []
    at_a, at_b = spans(bytes_a), spans(bytes_b)
    both, groups, now = {e for _, e in at_a} & {e for _, e in at_b}, [], ([], [])
    owners = [[k for k, (s, e) in enumerate(at) for _ in range(s, e)] for at in (at_a, at_b)]
    found = [(ids_a[x], ids_b[y]) for x, y in sorted(set(zip(*owners, strict=True)))]
    i = j = 0
    for byte in range(1, at_a[-1][1] + 1):
        if i < len(at_a) and at_a[i][1] == byte:
            now[0].append(ids_a[i])
            i += 1
        if j < len(at_b) and at_b[j][1] == byte:
            now[1].append(ids_b[j])
            j += 1
        if byte in both:
            groups.append(now)
            now = ([], [])
    return ids_a, ids_b, groups, found


def expected(texts, libraries):
    each = [plain(t, libraries) for t in texts]
    docs = Counter(p for *_, found in each for p in set(found))
    best = defaultdict(int)
    for (x, _), n in docs.items():
        best[x] = max(best[x], n)
    out = []
    for ids_a, ids_b, groups, found in each:
        line = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append({
            "n_a": len(ids_a), "n_b": len(ids_b), "n_groups": len(groups), "n_links": len(found),
            "n_best": sum(docs[p] == best[p[0]] for p in found), "count_sum": sum(docs[p] for p in found),
            "groups_sha256": hashlib.sha256(line.encode()).hexdigest() if groups else "",
        })
    return out


def test_query(spark, sf, truth, got, libraries):
    """All short documents against the plain definitions; counts of documents need the long ones, too."""
    rows = got(queries.QUERIES["op13_alignment"](spark, sf))
    assert [r["doc_id"] for r in rows] == [i for i, *_ in truth]
    assert [{k: v for k, v in r.items() if k != "doc_id"} for r in rows] == expected([t for _, t, *_ in truth], libraries)


TEXTS = [
    "<|endoftext|> is plain here, </s> and <unk> too", "<0x41>", " ", "   two  spaces ", "a▁b", "\x00null", "naïve café 漢字かな 한글 😀👩‍👩‍👧",
    "ﬁ ligature", "\t\n\r\n", "́combining", "x" * 3000, "12345678901234567890", "don't they'll we've", "",
]


def test_odd_texts(spark, got, libraries):
    r = random.Random(5)
    more = ["".join(r.choice(" aAbé漢\n\t'sl1９▁<0x>|😀ñ") for _ in range(r.randint(1, 30))) for _ in range(150)]
    given = [*TEXTS, *more]
    df = spark.createDataFrame(list(enumerate(given)), "doc_id long, text string").repartition(3)
    rows = got(alignment.report(df, *HOW))
    assert [{k: v for k, v in x.items() if k != "doc_id"} for x in rows] == expected(given, libraries)
    full = got(alignment.align(df, *HOW))
    for row, text in zip(full, given, strict=True):
        ids_a, ids_b, groups, _ = plain(text, libraries)
        assert row["a_ids"] == ids_a and row["b_ids"] == ids_b and len(row["a_stops"]) == len(row["b_stops"]) == len(groups)
        cut = [(ids_a[i:p], ids_b[j:q]) for i, p, j, q in zip([0, *row["a_stops"]], row["a_stops"], [0, *row["b_stops"]], row["b_stops"])]
        assert cut == groups


def test_overlaps():
    """Common ends and links of random cuts against sets; no tokens have none."""
    r = random.Random(3)
    for size in [1, 2, 3, *range(4, 60), 500]:
        ends = [sorted({*r.sample(range(1, size + 1), r.randint(0, size)), size}) for _ in range(2)]
        owners = [np.searchsorted(e, np.arange(size), "right").tolist() for e in ends]
        common = sorted({*ends[0]} & {*ends[1]})
        got = [x.tolist() for x in alignment.overlaps(*map(np.array, ends))]
        assert got[:2] == [[e.index(x) + 1 for x in common] for e in ends]
        assert list(zip(*got[2:], strict=True)) == sorted(set(zip(*owners, strict=True)))
    assert [len(x) for x in alignment.overlaps(np.zeros(0, int), np.zeros(0, int))] == [0] * 4


def test_overlaps_take_less_time_than_places_by_end():
    """Marks on bytes against dictionaries of ends, for common ends alone."""
    r = np.random.default_rng(4)
    given = [[np.append(np.unique(r.integers(1, 12000, 3000)), 12000) for _ in range(2)] for _ in range(60)]

    def places(*ends):
        at = [dict(zip(e.tolist(), range(1, len(e) + 1))) for e in ends]
        return [[a[x] for x in sorted(at[0].keys() & at[1].keys())] for a in at]

    clock = [time.process_time()]
    for run in (alignment.overlaps, places):
        found = [run(*ends) for ends in given]
        clock.append(time.process_time())
    assert clock[1] - clock[0] < clock[2] - clock[1]
    assert [x.tolist() for x in alignment.overlaps(*given[-1])[:2]] == found[-1]


def test_encoders_agree(libraries):
    """Both encoders of the byte-level side, over letters of all planes and around the length at which they take turns."""
    a, *_ = libraries
    mine, r = alignment.ByteLevel(*HOW[:2]), random.Random(7)
    given = ["".join(chr(r.choice([r.randrange(32, 0x250), r.randrange(0x3000, 0xD800), r.randrange(0x10000, 0x1FA00)])) for _ in range(40)) for _ in range(300)]
    given += [" " * 65536, " " * 300000 + "x", "a " * 40000]
    for text, ids in zip(given, mine.encode(given), strict=True):
        assert ids == a.encode(text, add_special_tokens=False).ids


def test_rare_pairs_by_shuffle(spark, sf, got, monkeypatch):
    """Nothing broadcast, or everything: the same rows."""
    df = spark.read.parquet(f"{sf}/documents.parquet")
    monkeypatch.setattr(alignment, "HOT_PAIRS", 1.0)
    cold = got(alignment.report(df, *HOW))
    monkeypatch.setattr(alignment, "HOT_PAIRS", 0.0)
    assert cold == got(alignment.report(df, *HOW))


def test_odd_rows(odd, none, got):
    rows = got(alignment.report(odd, *HOW))
    assert len(rows) == odd.count() and alignment.report(none, *HOW).count() == 0
    by_id = defaultdict(list)
    for row in rows:
        by_id[row["doc_id"]].append(row)
    assert by_id[1][0]["n_a"] == by_id[2][0]["n_links"] == 0 and by_id[1][0]["groups_sha256"] == ""
    assert by_id[4][0] == by_id[4][1] == by_id[3][0] | {"doc_id": 4} and by_id[3][0]["count_sum"] >= 3 * by_id[3][0]["n_links"]
    assert {r["n_a"] > 0 for r in by_id[None]} == {True, False}
