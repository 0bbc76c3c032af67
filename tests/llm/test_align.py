import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from churnlake.llm import align as G
from churnlake.llm.common import table
from churnlake.llm.encode import byte_alphabet

from .conftest import CASES, SMOKE

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ODD = ["<|endoftext|> a <|endoftext|>", "</s> <unk><s> <0x41>", "a▁b", "x  y   z \n\n w", "  lead", " trail  ", "\t\ttabs\t x", "\n word\n  two",
       "日本語 テキスト です🙂🙂", "é ﬁ ½ ＡＢ", "a\x00b \x1c c  d\xa0 e", "don't we'll I'm 12345 3.14159 --- ...", "x" * 500, " ", "\n", "naïve café", "a﻿b ​c"]


def brute(texts):
    ta = Tokenizer.from_file(A)
    ta.encode_special_tokens = True
    names = {i: t for t, i in ta.get_vocab().items()}
    byte = {c: b for b, c in byte_alphabet().items()}
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    docs = []
    for t in texts:
        groups = []
        if t:
            a, b = ta.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
            ba = [bytes(byte[c] for c in names[i]) for i in a]
            bb = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
            if b"".join(ba) == b"".join(bb) == (" " + t).encode():
                i = j = ends_a = ends_b = 0
                ga, gb = [], []
                while i < len(a) or j < len(b):
                    if ends_a <= ends_b and i < len(a):
                        ga.append(a[i])
                        ends_a += len(ba[i])
                        i += 1
                    else:
                        gb.append(b[j])
                        ends_b += len(bb[j])
                        j += 1
                    if ends_a == ends_b and ga and gb:
                        groups.append((ga, gb))
                        ga, gb = [], []
        docs.append(groups)
    links = [Counter((x, y) for ga, gb in g for x in ga for y in gb) for g in docs]
    n = Counter(p for c in links for p in c)
    top = defaultdict(int)
    for (x, _), k in n.items():
        top[x] = max(top[x], k)
    out = []
    for g, c in zip(docs, links):
        form = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()), sum(m for p, m in c.items() if n[p] == top[p[0]]),
                    sum(m * n[p] for p, m in c.items()), hashlib.sha256(form.encode()).hexdigest() if g else ""))
    return docs, out


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("hot", [0, 50, G.HOT_PAIRS])
def test_report_matches_brute_force(spark, hot):
    rng = random.Random(2)
    some = [x for t in ODD for x in (t, t + " " + rng.choice(ODD))] + [t for _, t in CASES if t is None or len(t) < 500] + ["same text"] * 3
    docs = spark.createDataFrame([(None if i == 4 else i // 2, t, 7, "x", 1) for i, t in enumerate(some)], "doc_id long, text string, id long, pairs string, row int")
    got = G.report(docs, A, B, hot_pairs=hot)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = [(None if i == 4 else i // 2, *r) for i, r in enumerate(brute(some)[1])]
    assert ordered(map(tuple, got.collect())) == ordered(want)


def test_given_documents(spark):
    docs = table(spark, SMOKE, "documents")
    rows = docs.select("doc_id", "text").collect()
    groups, want = brute([r["text"] for r in rows])
    got = G.report(docs, A, B)
    assert ordered(map(tuple, got.collect())) == ordered((r["doc_id"], *w) for r, w in zip(rows, want))
    made = {r["doc_id"]: [(g["a"], g["b"]) for g in r["groups"]] for r in G.groups(docs, A, B).collect()}
    assert all(made[r["doc_id"]] == g for r, g in zip(rows, groups))


def test_small_memory_and_empty_tables(spark, none, monkeypatch):
    import pyarrow as pa
    texts = [t for t in ODD if t] + ["one two three one two", "two three four"]
    small, large = G.Aligner(A, B, capacity=3), G.Aligner(A, B)
    for _ in range(2):
        a, b = (G._report(x, pa.array(range(len(texts))), pa.array(texts, pa.large_string())) for x in (small, large))
        assert a.equals(b)
    assert len(small.good) == 3
    monkeypatch.setattr(G, "JOINED", 4)        # digests of a text over several pieces
    monkeypatch.setattr(G, "NEW_CHUNKS", 5)
    assert G._report(G.Aligner(A, B), pa.array(range(len(texts))), pa.array(texts, pa.large_string())).equals(b)
    assert G.report(none, A, B).count() == 0 and G.groups(none, A, B).count() == 0


def test_texts_that_end_in_one_blank(spark):
    texts = ["a ", "one two ", "日本 ", "x\n ", "12 34 ", " lead and trail ", "one two", "a  "]
    got = G.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), A, B)
    want = brute(texts)[1]
    assert all(w[0] for w in want)
    assert ordered(map(tuple, got.collect())) == ordered((i, *w) for i, w in enumerate(want))


def test_slices():
    assert G.slices([1, 3, 6, 7], [2, 3, 7]) == ([2, 4], [2, 3])
    assert G.slices([], []) == ([], [])
