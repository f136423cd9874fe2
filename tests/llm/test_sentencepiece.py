"""Pieces, offsets and decoded texts against the library."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from showlake.llm import queries
from showlake.llm import sentencepiece as own


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normaliser(rule, squeeze):
    """Compiled maps of the library's own rules; offsets lead from each character to one that it comes from."""
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    spec = b"".join(v for n, v in own.fields(theirs.serialized_model_proto()) if n == 3)
    mine, r = own.Normaliser(spec), random.Random(2)
    letters = "aA ééﬁ①Ⅷ　​\tñＡｂ가ᄀ\nß  .😀"
    for _ in range(400):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 14)))
        normal, origin = mine.normalise(text)
        assert normal == theirs.normalize(text)
        raw = text.encode()
        assert len(origin) == len(normal.encode()) + 1 and (origin[1:] >= origin[:-1]).all()
        for at in np.cumsum([0, *(len(c.encode()) for c in normal)]):
            raw[: origin[at]].decode()  # a character comes from the start of one


def test_query(spark, sf, truth, got, library):
    rows = got(queries.QUERIES["op8_sentencepiece"](spark, sf))
    assert len(rows) == len(truth)
    for row, (i, text, *_) in zip(rows, truth, strict=True):
        ids = library.encode(text)
        assert (row["doc_id"], row["n_tokens"], row["last_byte"]) == (i, len(ids), len(text.encode()))
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_spans_cover_the_text(spark, library):
    texts = ["Über ﬁne 😀 words\n\n  twice ", "▁x ▁▁", "a\0b", "<s>no control</s><unk>", "日本語 テキスト", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in own.encode(df, queries.piece_model()).collect():
        text = texts[row["doc_id"]]
        raw = text.encode()
        assert row["ids"] == library.encode(text)
        assert row["begins"] == [0, *row["ends"]][:-1] and row["ends"][-1] == len(raw)
        for n, a, b in zip(row["ids"], row["begins"], row["ends"], strict=True):
            piece = library.id_to_piece(n)
            if not library.is_byte(n) and "▁" not in text:
                assert raw[a:b].decode() in (piece.replace("▁", " "), piece.replace("▁", "", 1).replace("▁", " "))


def test_odd_rows(odd, none, got, library):
    rows = got(own.digests(odd, queries.piece_model()))
    assert len(rows) == 10
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {0}
    assert [r["n_tokens"] for r in rows if r["doc_id"] == 5] == [len(library.encode(_long()))]
    assert own.digests(none, queries.piece_model()).collect() == []
    encoded = own.encode(odd, queries.piece_model()).withColumnRenamed("begins", "decoded")
    assert own.decode(encoded, queries.piece_model()).columns == ["doc_id", "ids", "ends", "decoded"]


def _long():
    return "the quick brown fox jumps over a lazy dog near río año été " * 4000
