"""Licence notices: those in the documents, quotes of others, and prose that only sounds like one."""

import re
import time

import pytest
from pyspark.sql import functions as F

from showlake.llm import licenses, queries

LINES = {
    "Licensed under the Apache License, Version 2.0.": "apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc",
    "Released under the MIT License.": "mit",
}


@pytest.fixture(scope="module")
def scanner(spark, sf):
    return licenses.Scanner(queries.table(spark, sf, "documents"))


def test_query(spark, sf, truth):
    rows = queries.QUERIES["op3_licenses"](spark, sf).collect()
    want = {(i, n, LINES[line.strip()]) for i, text, *_ in truth for n, line in enumerate(text.split("\n")) if line.strip() in LINES}
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in rows if r["confirmed"]} == want
    # paragraphs of other kinds are not reported as known ones
    assert all(r["family"] == licenses.UNKNOWN for r in rows if not r["confirmed"])


def test_quotes_and_lookalikes(spark, scanner):
    quoted = [x for texts in licenses.NOTICES.values() for x in texts]
    df = spark.createDataFrame(
        [(i, f"Some words first.\n  {x.upper()}  ") for i, x in enumerate(quoted)]
        + [(100, "My driving licence has been lost, and the office gave no permission."), (101, "version 2.0 of the house")],
        "doc_id long, text string",
    )
    rows = {(r["doc_id"], r["paragraph"]): r for r in scanner.scan(df).collect()}
    families = [f for f, texts in licenses.NOTICES.items() for _ in texts]
    right = [rows[i, 1]["family"] == f for i, f in enumerate(families) if (i, 1) in rows]
    assert sum(right) >= 0.9 * len(families)
    assert not any(i in (100, 101) and r["confirmed"] for (i, _), r in rows.items())


def test_short_lines(spark, scanner):
    """Lines that only name a licence, none of them a notice, and lines as short that do not."""
    want = {"MIT License": "mit", "License: MIT": "mit", "Apache License": "apache-2.0", "BSD licence": "bsd", "License: GPLv3": "gpl-3.0", "CC0": "cc0"}
    others = ["mit", "MIT professor", "driving licence", "Apache helicopter", "license"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*want, *others])], "doc_id long, text string")
    rows = scanner.scan(df).collect()
    assert {(r["doc_id"], r["family"]) for r in rows if r["confirmed"]} == set(enumerate(want.values()))


def test_long_paragraph(spark):
    """A paragraph of 20,000 words costs in proportion to its words, in training and in the scan."""
    words = "so the license that we had was kept in a drawer of the house and the version was old".split()
    long = " ".join(words[i % len(words)] for i in range(20_000))
    df = spark.createDataFrame([(1, f"{long}\nReleased under the MIT License.\n{long} mit gpl"), (2, long)], "doc_id long, text string")
    began = time.monotonic()
    rows = licenses.Scanner(df).scan(df).collect()
    assert time.monotonic() - began < 60
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in rows if r["confirmed"]} == {(1, 1, "mit")}


def test_native(spark, scanner, odd, capfd):
    scanner.scan(odd).explain()
    assert not re.search("Python|Pandas|Arrow", capfd.readouterr().out)


def test_odd_rows(scanner, odd, none):
    assert scanner.scan(odd).collect() == [] and scanner.scan(none).collect() == []
    line = "Released under the MIT License."
    rows = scanner.scan(odd.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.lit(f"\n{line}")))).collect()
    assert len(rows) == 9 and {r["family"] for r in rows} == {"mit"}  # the repeated row reports once


def test_no_documents(none):
    assert licenses.Scanner(none).scan(none).collect() == []
