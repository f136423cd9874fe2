"""Revisits against SQL, and against a plain search on few and crowded URLs."""

import hashlib
import random
from datetime import datetime, timedelta, timezone

import duckdb
import pytest
from pyspark.sql import functions as F

from showlake.llm import queries, warc


def test_oracle(spark, sf):
    df = queries.QUERIES["op6_revisits"](spark, sf)
    connection = duckdb.connect()
    connection.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    want = connection.execute(queries.ORACLES["op6_revisits"])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    got = sorted(map(repr, map(tuple, df.select(*columns).collect())))
    assert got == sorted(map(repr, want.fetchall())) and "'resolved'" in str(got) and "'changed'" in str(got)


@pytest.mark.parametrize("url, key", [
    ("HTTP://www.A.example:80/x/?b=2&utm_source=q&a=1#f", "a.example/x?a=1&b=2"),
    ("https://me@A.example", "a.example"),
    ("https://a.example/?ref=x", "a.example?ref=x"),
    ("https://a.example/?gclid=x", "a.example"),
    ("http://A.example:8080/a", "a.example:8080/a"),
    ("https://a.example:443/a", "a.example/a"),
    ("https://me@a.example:80/a", "a.example:80/a"),
    ("no url", "no url"),
    ("", ""),
    (None, None),
])
def test_canonical_url(spark, url, key):
    assert spark.createDataFrame([(url,)], "u string").select(warc.canonical_url(F.col("u"))).first()[0] == key


def test_as_of_with_a_hot_url(spark):
    r, start = random.Random(5), datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = []
    for i in range(600):
        url = "https://hot.example/" if i % 3 else f"https://x{r.randint(1, 9)}.example/"
        status = r.choice([200, 304, 304, 404])
        headers = {k: v for k, v in (("ETag", r.choice(["a", 'W/a', "b", None])), ("Last-Modified", r.choice(["1", "2", None]))) if v}
        headers |= {"Content-Type": f"t{i}", "X": f"x{i}"} if i % 2 else {}
        rows.append((i, url, start + timedelta(seconds=r.randint(0, 150)), status, headers, f"body {i}", 0))
    rows += [(1000, None, start, 304, {}, None, 0), (1001, "https://hot.example", None, 304, None, None, 0)]
    schema = "record_id long, url string, captured_at timestamp, status int, headers map<string,string>, payload string, key int"
    got = {r["record_id"]: r for r in warc.resolve(spark.createDataFrame(rows, schema).repartition(5), slices=7).collect()}
    assert set(got) == {r[0] for r in rows if r[3] == 304}
    for i, url, at, _, headers, *_ in (r for r in rows if r[3] == 304):
        before = [x for x in rows if x[3] == 200 and x[1] == url and at and x[2] < at]
        source = max(before, key=lambda x: (x[2], x[0]), default=None)
        assert got[i]["source_id"] == (source and source[0])
        mine = {k.lower(): v for k, v in (headers or {}).items()}
        if source is None:
            assert got[i]["state"] == "missing" and got[i]["headers"] == mine and got[i]["payload_md5"] is None
            continue
        old = {k.lower(): v for k, v in source[4].items()}
        strip = lambda v: v.removeprefix("W/")
        state = "unchecked"
        for name in ("last-modified", "etag"):
            if name in mine and name in old:
                state = "resolved" if strip(mine[name]) == strip(old[name]) else "changed"
        assert got[i]["state"] == state
        merged = old | {k: v for k, v in mine.items() if k not in warc.UNTOUCHED}
        assert got[i]["headers"] == (mine if state == "changed" else merged)
        assert got[i]["payload_md5"] == (None if state == "changed" else hashlib.md5(source[5].encode()).hexdigest())


def test_payloads_of_a_hot_response(spark):
    """Revisits get the very payload, also where one response has most of them, and from repeated responses that of the headers taken."""
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    rows = [(0, "https://hot.example/", start, 200, {"ETag": "a"}, "hot body"), (1, "https://x.example/", start, 200, {"ETag": "b"}, None)]
    rows += [(2, "https://y.example/", start, 200, {"ETag": t}, b) for t, b in (("c", "z"), ("d", "a"))]
    rows += [(i, "https://hot.example/", start + timedelta(seconds=i), 304, {"ETag": "a"}, None) for i in range(10, 3010)]
    rows += [(i, f"https://{h}.example/", start + timedelta(seconds=9), 304, {"ETag": t}, None) for i, h, t in ((3, "x", "b"), (4, "y", "d"), (5, "hot", "e"), (6, "n", "a"))]
    schema = "record_id long, url string, captured_at timestamp, status int, headers map<string,string>, payload string"
    got = {r["record_id"]: r for r in warc.resolve(spark.createDataFrame(rows, schema).repartition(5)).collect()}
    assert len(got) == 3004 and {got[i]["payload"] for i in range(10, 3010)} == {"hot body"}
    assert [(got[i]["state"], got[i]["payload"]) for i in (3, 4, 5, 6)] == [("resolved", None), ("resolved", "a"), ("changed", None), ("missing", None)]


def test_empty(spark, sf):
    captures = warc.captures_of(queries.table(spark, sf, "pages"))
    assert warc.resolve(captures.filter("false")).collect() == []
    assert {r["state"] for r in warc.resolve(captures.filter("status = 304")).collect()} == {"missing"}
