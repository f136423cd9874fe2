"""Edit matching against plain dynamic programming."""

import random

from showlake.llm import decontaminate as d
from showlake.llm import queries


def plain(pattern, text):
    """Least edits of the pattern to any stretch, and its first end."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row), row.index(min(row))


def test_bit_parallel_distance():
    r = random.Random(1)
    for _ in range(500):
        pattern = [r.randint(1, 4) for _ in range(r.randint(1, 70))]
        text = [r.randint(1, 5) for _ in range(r.randint(0, 30))]
        masks = {}
        for i, x in enumerate(pattern):
            masks[x] = masks.get(x, 0) | 1 << i
        assert d.best_end(masks, len(pattern), text) == plain(pattern, text)


def test_changed_items(spark):
    """Items with up to a fifth of their words changed are found wherever they stand; others are not."""
    r = random.Random(3)
    names = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(r.choice(names) for _ in range(r.randint(3, 40)))) for i in range(25)]
    docs = []
    for i in range(120):
        words = r.choice(items)[1].split()
        for _ in range(r.randint(0, max(1, len(words) // 3))):
            at, kind = r.randrange(len(words)), r.random()
            words[at : at + (kind < 0.7)] = [r.choice(names)] if kind > 0.3 else []
            words = words or ["w0"]
        before, after = ([r.choice(names) for _ in range(r.randint(0, 50))] for _ in range(2))
        docs.append((i, ", ".join([*before, *words, *after]).upper()))
    got = d.leaks(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
        block_words=60,
    ).collect()
    want = set()
    for i, text in docs:
        for j, item in items:
            pattern = d.words_of(item)
            distance, _ = plain(pattern, d.words_of(text))
            if distance <= d.budget(len(pattern)):
                want.add((i, j, distance))
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got} == want and len(want) > 40
    texts, pieces = dict(docs), dict(items)
    for row in got:  # the stretch named has the distance named
        part = d.words_of(texts[row["doc_id"]])[row["first_word"] : row["end_word"]]
        edits = list(range(len(part) + 1))
        for i, a in enumerate(d.words_of(pieces[row["item_id"]]), 1):
            new = [i]
            for j, b in enumerate(part, 1):
                new.append(min(edits[j] + 1, new[-1] + 1, edits[j - 1] + (a != b)))
            edits = new
        assert edits[-1] == row["distance"]


def test_short_and_unspaced_items(spark):
    """Short items are found word for word, and items without spaces with a fifth of their letters changed."""
    items = [(1, "Who is Hamlet?"), (2, "Paris"), (3, "東京は日本の首都であり最大の都市です"), (4, "กรุงเทพเป็นเมืองหลวง"), (5, "?!")]
    docs = [
        (1, "They asked: who is Hamlet, paris or Paris?"),
        (2, "Who was Hamlet in Parisian plays"),
        (3, "昔から東京は日木の首都であり最大の町です。"),
        (4, "東京は大きい町です"),
        (5, "ข้อความกรุงเทพเป็นเมืองหลวงของไทย"),
    ]
    got = d.leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), min_words=1
    ).collect()
    assert {(r["doc_id"], r["item_id"], r["distance"]) for r in got} == {(1, 1, 0), (1, 2, 0), (3, 3, 3), (5, 4, 0)}
    assert {(r["first_word"], r["end_word"]) for r in got if r["item_id"] == 2} == {(5, 6)}


def test_query_searches_short_items(spark, tmp_path):
    spark.createDataFrame([(1, "so: to be or not"), (2, "no")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "To be, or")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = queries.QUERIES["op4_decontaminate"](spark, str(tmp_path)).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(1, 7)]


def test_query(spark, sf, truth):
    import duckdb

    items = duckdb.sql(f"select item_id, text from '{sf}/benchmark.parquet'").fetchall()
    got = {(r["doc_id"], r["item_id"], r["distance"]) for r in queries.QUERIES["op4_decontaminate"](spark, sf).collect()}
    for i, text, *_ in truth:  # every whole item is found, and what is found is near
        flat = f" {' '.join(d.words_of(text))} "
        for j, item in items:
            if f" {' '.join(d.words_of(item))} " in flat:
                assert (i, j, 0) in got
    texts, pieces = {i: t for i, t, *_ in truth}, dict(items)
    for i, j, distance in got:
        assert plain(d.words_of(pieces[j]), d.words_of(texts[i]))[0] == distance


def test_copies_of_an_item(spark):
    """A third of the benchmark in one text: it is searched once, in one block, and found once."""
    items = [(i, "one two three four five six") for i in range(3000)] + [(3000 + i, f"a{i} b{i} c{i} d{i} e{i}") for i in range(60)]
    docs = spark.createDataFrame([(1, "zero one two three four five six"), (2, "a7 b7 c7 d7 e7")], "doc_id long, text string")
    got = d.leaks(docs, spark.createDataFrame(items, "item_id long, text string"), block_words=100).collect()
    assert {(r["doc_id"], r["item_id"], r["n_items"]) for r in got} == {(1, 0, 3000), (2, 3007, 1)} and len(got) == 2


def test_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [(9, "the same words again and again", 0), (None, "A row without an id", 0), (3, None, 0), (4, "", 0), (5, "dog", 0),
         (6, "the same words again and again", 0), (None, "the same words again and again", 0)],
        "item_id long, text string, doc_id int",
    )
    got = sorted(((r["doc_id"], r["item_id"]) for r in d.leaks(odd, items).collect()), key=str)
    # items of one text give one row under the smallest id
    assert got == sorted([(3, 6), (4, 6), (4, 6), (5, 5), (None, None)], key=str)
    assert {r["n_items"] for r in d.leaks(odd, items).collect() if r["item_id"] == 6} == {3}
    assert d.leaks(none, items).collect() == [] and d.leaks(odd, items.filter("false")).collect() == []
