"""SimHash near-duplicates against a comparison of all pairs."""

import random
import re

import numpy as np
import pytest
import xxhash

from showlake.llm import queries, simhash


def plain_fingerprint(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes):
    """Of (node, fingerprint): the smallest node that links reach."""
    low = {n: n for n, _ in nodes}

    def root(n):
        while low[n] != n:
            n = low[n]
        return n

    for i, (a, x) in enumerate(nodes):
        for b, y in nodes[i + 1 :]:
            if (x ^ y).bit_count() <= 3:
                a_, b_ = root(a), root(b)
                low[max(a_, b_)] = min(a_, b_)
    return {n: root(n) for n in low}


def test_query(spark, sf, truth, got):
    want = {i: plain_fingerprint(t) for i, t, *_ in truth}
    parts = plain_components(sorted(want.items()))
    rows = got(queries.QUERIES["op5_simhash"](spark, sf))
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows} == {
        (i, f"{x:016x}", parts[i]) for i, x in want.items()
    }


def test_links_of_crowded_fingerprints(spark):
    """Chains, balls and blocks that differ in themselves alone, more than a bucket compares in pairs."""
    r = random.Random(7)
    centre = r.getrandbits(64)
    fps = {centre, 0, (1 << 64) - 1}
    for _ in range(400):
        x = centre
        for b in r.sample(range(64), r.randint(1, 6)):
            x ^= 1 << b
        fps.add(x)
    for block in range(4):
        fps |= {centre ^ (v << 16 * block) for v in r.sample(range(1 << 16), 150)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    edges = simhash.links(df)
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    want = plain_components([(x, x & ((1 << 64) - 1)) for x in signed])
    assert {x: found.get(x, x) for x in signed} == want
    assert len(set(want.values())) > 3


@pytest.mark.parametrize("key", [0, 1 << 48, 3 << 48])
def test_bucket_is_linear(key):
    """A crowded bucket yields few edges per member."""
    turn = 48 - 16 * (key >> 48)
    tops = np.arange(20_000, dtype=np.uint64) << np.uint64(48)
    fps = (tops >> np.uint64(turn) | tops << np.uint64(64 - turn) if turn else tops).view(np.int64)
    assert len(list(simhash._bucket_edges(key, fps))) < 500 * len(fps)


def test_odd_rows(odd, none, got):
    rows = got(simhash.near_duplicates(odd))
    assert len(rows) == 10
    zero = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} == {None, 1, 2, 6} and {r["component_id"] for r in zero} == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] in (3, 4)} == {3}
    assert simhash.near_duplicates(none).collect() == []
