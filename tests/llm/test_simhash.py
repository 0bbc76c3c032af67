import random
import re

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from churnlake.llm import simhash as S


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(ids, fps, k=3):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= k:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints(spark, cases):
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fp"] % (1 << 64)) for r in S.fingerprints(cases).collect())
    from .conftest import CASES
    assert got == sorted((i is None, i or 0, brute_fp(t)) for i, t in CASES)


def near(rng, n, centres, flips):
    base = [rng.getrandbits(64) for _ in range(centres)]
    out = set()
    while len(out) < n:
        x = rng.choice(base)
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("n,centres,flips", [(300, 300, 0), (400, 25, 6), (500, 1, 3), (400, 2, 5)])
def test_trie_join_matches_all_pairs(n, centres, flips):
    fps = near(random.Random(n + flips), n, centres, flips)
    got = S.trie_links(np.array(fps, np.uint64), np.array([0]), frontier=500)
    want = roots(list(range(len(fps))), fps)
    same = lambda r: [[j for j in range(len(fps)) if r[j] == r[i]][0] for i in range(len(fps))]
    assert same(got) == same(want)


@pytest.mark.parametrize("split", [4, 2048])
def test_links_and_components_match_all_pairs(spark, split):
    """A small ``split`` drives partitions through several levels of blocks."""
    fps = near(random.Random(9), 250, 12, 5) + [0, (1 << 64) - 1]
    d = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    comp = {r["node"] % (1 << 64): r["root"] for r in S.components(S.links(d, split)).collect()}
    want = roots(fps, {x: x for x in fps})
    for a in fps:
        for b in fps[:40]:
            assert (comp.get(a, a) == comp.get(b, b)) == (want[a] == want[b])


def test_chains_settle(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in S.components(edges).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[100 + i] == 100 for i in range(50))


def test_near_duplicates(spark, cases, none):
    got = {(r["doc_id"], r["fp"] % (1 << 64)): r["component_id"] for r in S.near_duplicates(cases).collect()}
    from .conftest import CASES
    rows = [(i, brute_fp(t)) for i, t in CASES]
    want = roots(list(range(len(rows))), [f for _, f in rows])
    for k, row in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if want[j] == want[k] and rows[j][0] is not None]
        assert got[row] == (min(members) if members else None)
    assert S.near_duplicates(none).count() == 0


def test_copies_are_one_fingerprint(spark):
    d = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("the same words again and again").alias("text"))
    assert {r["component_id"] for r in S.near_duplicates(d).collect()} == {0}
