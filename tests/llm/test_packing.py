import math
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from churnlake.llm import packing as P

from .conftest import CASES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(rows, docs, capacity):
    whole = Tokenizer.from_file(PATH)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    total = 0
    for i in {i for i, _ in docs}:
        texts = [t for j, t in docs if j == i]
        total += sum(len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
        ids = whole.encode(texts[0] or "", add_special_tokens=False).ids + [0]
        parts = sorted(by[i], key=lambda r: r["piece"])[::len(texts)]      # repeated rows have equal texts
        at = 0
        for k, r in enumerate(parts):
            cut = np.array(ids[at:at + r["length"]], "<u4")
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(cut.tobytes())) and (k == 0 or r["length"] == capacity)
            at += r["length"]
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    assert sum(r["length"] for r in rows) == total
    return len(sequences), math.ceil(total / capacity)


def test_pieces_and_sequences(spark, cases, none):
    for capacity in (2048, 16):
        rows = P.pack(cases, PATH, capacity=capacity).collect()
        check(rows, CASES, capacity)
    assert P.pack(none, PATH).count() == 0


def test_near_the_lower_bound_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_ITEMS", 40)
    rng = random.Random(3)
    docs = [(i, " ".join("word" for _ in range(rng.randint(1, 60)))) for i in range(400)]
    rows = P.pack(spark.createDataFrame(docs, "doc_id long, text string"), PATH, capacity=64).collect()
    used, least = check(rows, docs, 64)
    assert used <= least * 1.05 + 1


def test_genetic_steps_keep_every_item_once():
    rng = random.Random(5)
    lengths = [rng.randint(1, 70) for _ in range(120)]
    a, b = P.best_fit(lengths, list(range(120)), [], 100), P.best_fit(lengths, rng.sample(range(120), 120), [], 100)
    for bins in (a, P.crossover(lengths, a, b, 100, rng), P.mutate(lengths, a, 100, rng), *P.evolve(lengths, [], 100, 1)):
        assert sorted(i for x in bins for i in x) == list(range(120)) and all(sum(lengths[i] for i in x) <= 100 for x in bins)


def test_evolution_beats_best_fit_where_it_can():
    rng = random.Random(8)
    wins = 0
    for seed in range(10):
        lengths = []      # triples that fill a bin exactly: greedy packing misses many of them
        for _ in range(20):
            x, y = rng.randint(26, 48), rng.randint(26, 48)
            lengths += [x, y, 100 - x - y]
        plain = len(P.best_fit(lengths, list(range(60)), [], 100))
        best = len(P.evolve(lengths, [], 100, seed, generations=150)[0])
        assert best <= plain
        wins += best < plain
    assert wins >= 3


def triples(n, capacity=2048):
    rng = random.Random(1)
    lengths = []
    for _ in range(n):
        x, y = rng.randint(capacity // 4, capacity * 15 // 32), rng.randint(capacity // 4, capacity * 15 // 32)
        while capacity - x - y < capacity // 5:
            x, y = rng.randint(capacity // 4, capacity * 15 // 32), rng.randint(capacity // 4, capacity * 15 // 32)
        lengths += [x, y, capacity - x - y]
    rng.shuffle(lengths)
    return lengths


def test_evolution_comes_within_one_percent_on_triples():
    """One block of 666 sequences that can be filled exactly, at production settings."""
    lengths = triples(666)
    best = P.evolve(lengths, [], 2048, 1)[0]
    assert len(P.best_fit(lengths, list(range(len(lengths))), [], 2048)) >= 700 and len(best) <= 672
    assert sorted(i for b in best for i in b) == list(range(len(lengths))) and all(sum(lengths[i] for i in b) <= 2048 for b in best)


def test_groupings_keep_their_sums():
    rng = random.Random(2)
    lengths = [rng.choice([1, 3, 7, 20, 33, 50, 100]) for _ in range(200)]
    g = P.best_fit(lengths, list(range(200)), [], 100)
    before = [tuple(b) for b in g]
    for _ in range(30):
        h = P.mutate(lengths, g, 100, rng)
        sums = [sum(lengths[i] for i in b) for b in h]
        assert h.rank() == (len(sums), -sum(x * x for x in sums)) and sorted(h.fill[k] for k in h.live()) == sorted(sums)
        assert all(i in h.bins[h.where[i]] for i in range(200)) and [tuple(b) for b in g] == before      # the parent stays
        g, before = h, [tuple(b) for b in h]


def test_islands_keep_what_they_found(spark):
    """Groupings go through Spark between epochs: the result is no worse than one island's start."""
    lengths = triples(60)
    items = spark.createDataFrame(list(enumerate(lengths)), "item long, length long")
    rows = P._pack_round(items, 2048, len(lengths), 0).collect()
    fills = {}
    for r in rows:
        fills.setdefault((r["block"], r["bin"]), []).append(r["length"])
    assert len(rows) == len(lengths) and all(sum(x) <= 2048 for x in fills.values())
    assert len(fills) < len(P.best_fit(lengths, list(range(len(lengths))), [], 2048))
