"""Base patterns against Python's, and contexts that discover other identifiers."""

import hashlib
import random
import re

import duckdb
from pyspark.sql import functions as F

from showlake.llm import pii, queries

BASE = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def fits(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == 1:
        return all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))
    return [True, None, 14 <= len(digits) <= 19 and luhn(digits), 10 <= len(digits) <= 15][kind]


def plain(text):
    found = [(m.start(), k, m.end()) for k, p in enumerate(BASE) for m in re.finditer(p, text or "") if fits(k, m.group())]
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def check(rows, texts):
    for r in rows:
        want = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (texts[r["doc_id"]][:200], want, r["spans"])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [want.count(f"{k}:") for k in pii.KINDS]
        assert set(filter(None, want.split(","))) <= set(r["spans"].split(","))


def test_query(spark, sf, got):
    texts = dict(duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall())
    rows = got(queries.QUERIES["op1_pii"](spark, sf))
    assert len(rows) == len(texts)
    check(rows, texts)


def test_base_patterns_on_noise(spark, got):
    r = random.Random(11)
    parts = ["a@b.c", "a@b", "@", ".", "-", " ", "+1", "+", "(", ")", "1.2.3.4", "256.1.1.1", "0001.2.3.4.5", "4111111111111111", "4111-1111 1111-1111",
             "4000 0000", "12", "é", "😀", "_x", "%", "\n", "555", "x.y@z.w.v", "+49 (30) 123-4567 89", "--", "a@b.c_d@e.f", "1"]
    texts = {i: "".join(r.choice(parts) for _ in range(r.randint(0, 30))) for i in range(1500)}
    texts[1500] = "1" * 30_000 + " a" * 3 + "z" * 30_000 + "@"
    texts[1501] = " ".join(["me@x.org 10.0.0.1"] * 2000)  # more matches than one run of sums
    rows = got(pii.report(pii.find_personal_data(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))))
    check(rows, texts)


def test_contexts_discover_identifiers(spark, got):
    """Seeds teach "mail me at"; what follows it elsewhere is found, after the same words without seeds it is not."""
    seeds = [(i, f"Please mail me at user{i}@site.org today.") for i in range(12)]
    others = [(100, "Then mail me at (user100[at]site), or not."), (101, "We met at user7[at]site once."), (102, "nothing here 77")]
    df = spark.createDataFrame(seeds + others, "doc_id long, text string")
    found = {r["doc_id"]: r["added"] for r in pii.find_personal_data(df).collect()}
    (span,) = found[100]
    assert others[0][1][span["start"] : span["end"]] == "user100[at]site" and pii.KINDS[span["kind"]] == "email"
    assert not any(spans for i, spans in found.items() if i != 100)


def test_rounds_run_until_nothing_is_new(spark):
    """Each level is taught by the one before it, through two patterns; the last is found in the fifth round."""
    sizes, lines = [3300, 820, 205, 51, 13, 3], []
    name = lambda level, i: f"seed{i}@site.org" if level == 0 else f"user{level}x{i}[at]site"
    for level in range(len(sizes) - 1):
        for form in ("first", "second"):
            lines += [f"then {form} level{'abcdef'[level]} {name(k, i)} and" for k in (level, level + 1) for i in range(sizes[k])]
    df = spark.createDataFrame([(i, " ".join(lines[i * 200 : i * 200 + 200])) for i in range(len(lines) // 200 + 1)], "doc_id long, text string").repartition(4)
    count = lambda found: len({s["value"] for r in found.collect() for s in r["added"]})
    assert count(pii.find_personal_data(df)) == sum(sizes[1:])
    assert count(pii.find_personal_data(df, rounds=2)) == sum(sizes[1:3])


def test_words_of_context_are_whole(spark):
    """Words of a hundred letters that end alike are different contexts."""
    one, other = "a" + "x" * 100, "b" + "x" * 100
    texts = [f"{one} me at user{i}@site.org" for i in range(9)] + [f"me {one} id77" , f"me {other} id78"]
    texts += [f"me {one} user{i}@site.org" for i in range(9)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {s["value"] for r in pii.find_personal_data(df).collect() for s in r["added"]}
    assert found == {"id77"}


def test_native(spark, sf, capfd):
    queries.QUERIES["op1_pii"](spark, sf).explain()
    assert not re.search("Python|Pandas|Arrow", capfd.readouterr().out)


def test_odd_rows(odd, none, got):
    rows = got(pii.report(pii.find_personal_data(odd)))
    assert len(rows) == 10 and all(r["spans"] == "" for r in rows)
    again = odd.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(" a@b.org")))
    assert all(r["n_email"] == 1 for r in got(pii.report(pii.find_personal_data(again))))
    assert pii.find_personal_data(none).collect() == []
