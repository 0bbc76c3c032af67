import random
import re

import pytest

from churnlake.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items):
    low = lambda s: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")
    windows = {}
    for i, t in items:
        w = WORD.findall(low(t))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[k:k + 13]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = WORD.findall(low(t)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                ids = windows.get(tuple(w[k:k + n]))
                if ids:
                    hit.update(range(k, k + n))
                    found |= ids
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def made(seed):
    rng = random.Random(seed)
    vocab = ["a", "B", "c1", "é", "DD", "日本", "x"]
    text = lambda n: " ".join(rng.choice(vocab) + rng.choice(["", ",", "!?"]) for _ in range(n))
    items = [(k, text(rng.choice([1, 2, 3, 5, 13, 14, 30]))) for k in range(25)] + [(90, None), (91, "!!"), (None, "x x x"), (3, "a a a")]
    docs = [(k, text(rng.randint(0, 80)) + " " + (rng.choice(items)[1] or "")) for k in range(80)] + [(100, None), (101, ""), (5, "a b"), (5, "a b")]
    return docs, items


@pytest.mark.parametrize("seed,block", [(1, 10_000), (2, 10_000), (2, 20)])
def test_matches_brute_force(spark, seed, block):
    docs, items = made(seed)
    d = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, items string")
    b = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, pattern string")
    got = [tuple(r) for r in D.find_benchmark(d, b, pattern_block=block).collect()]
    assert sorted(((i, n, h, list(s), c) for i, n, h, s, c in got), key=repr) == brute(docs, items)
    kept = D.find_benchmark(d, b, keep=True, pattern_block=block)
    assert kept.columns == d.columns and kept.count() == sum(not r[4] for r in got)


def test_long_shifts_find_every_place():
    rng = random.Random(4)
    words = [str(i).encode() for i in range(5)]
    patterns = {tuple(rng.choice(words) for _ in range(n)): [n] for n in (1, 2, 2, 4, 13, 13, 13) for _ in range(6)}
    search = D.WuManber(patterns)
    for _ in range(200):
        w = [rng.choice(words) for _ in range(rng.randint(0, 60))]
        for p in rng.sample(sorted(patterns), 2):
            at = rng.randint(0, len(w))
            w[at:at] = p
        want = {(i, i + len(p)) for p in patterns for i in range(len(w) - len(p) + 1) if tuple(w[i:i + len(p)]) == p}
        assert {(a, b) for a, b, _ in search.find(w)} == want


def test_cases_and_empty(spark, cases, none):
    b = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog and runs away from it")], "item_id long, text string")
    got = D.find_benchmark(cases, b).collect()
    assert len(got) == cases.count() and [r["contaminated"] for r in got if r["doc_id"] == 7] == [True, True]
    assert D.find_benchmark(none, b).count() == 0
    assert not any(r["contaminated"] for r in D.find_benchmark(cases, b.limit(0)).collect())


def test_large_benchmark_with_a_window_of_many_items(spark):
    """More pairs than a block holds, one window in every item, repeated rows: each pattern is one entry, each row one row."""
    shared = "one two three four five six seven eight nine ten eleven twelve thirteen"
    items = [(k, f"{shared} tail{k} more{k}") for k in range(200)] + [(None, "lost words"), (7, shared)]
    docs = [(1, f"so {shared} it goes"), (1, f"so {shared} it goes"), (2, "three four five"), (3, None), (None, f"{shared} tail5 x lost words")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in D.find_benchmark(d, b, pattern_block=50).collect()]
    assert sorted(((i, n, h, list(s), c) for i, n, h, s, c in got), key=repr) == brute(docs, items)
    found = D._patterns(b, "item_id", "text")
    search, links = D._block_search(found, 50)
    tables = list(search.tables())
    assert len(tables) > 1 and links.count() == found.count() > found.select("pattern").distinct().count()


def test_buffers():
    import pyarrow as pa
    batches = [pa.RecordBatch.from_pydict({"k": [i, i], "text": ["x" * n, "y"]}) for i, n in enumerate([10, 10, 500, 10, 10, 10])]
    got = list(D.buffered(iter(batches), "text", 100))
    assert [r for b in got for r in b.to_pylist()] == [r for b in batches for r in b.to_pylist()] and 1 < len(got) < 6
    assert list(D.buffered(iter([]), "text", 100)) == []
