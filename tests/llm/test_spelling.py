import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from churnlake.llm import spelling as S


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:p] + b[p + 1:] == a for p in range(len(b)))


def corpus(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 97 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            n[low] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(n):
    blank = defaultdict(set)
    for w in n:
        for p in range(len(w)):
            blank[p, w[:p] + "\0" + w[p + 1:]].add(w)
            blank[None, w[:p] + w[p + 1:]].add(w)
    near = {w: set() for w in n}
    for w in n:
        for p in range(len(w)):
            near[w] |= blank[p, w[:p] + "\0" + w[p + 1:]] - {w}
        for longer in blank[None, w] if (None, w) in blank else ():
            near[w].add(longer)
            near[longer].add(w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def some_words(rng, n, alphabet, sizes):
    words = {"".join(rng.choice(alphabet) for _ in range(rng.choice(sizes))) for _ in range(n)}
    for w in list(words)[:n // 3]:
        p = rng.randrange(len(w))
        words |= {w[:p] + w[p + 1:], w[:p] + rng.choice(alphabet) + w[p + 1:], w[:p] + rng.choice(alphabet) + w[p:]}
    return sorted(w for w in words if len(w) >= 5)


@pytest.mark.parametrize("alphabet,sizes,leaf", [("abcdefghijk", (5, 6, 7), 100), ("ab", (6, 7, 8, 9), 30), ("aeéöst", (5, 6, 12), 10_000)])
def test_near_words_match_brute_force(spark, alphabet, sizes, leaf):
    rng = random.Random(leaf)
    words = some_words(rng, 900, alphabet, sizes)
    n = {w: rng.randrange(3, 60) for w in words}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = {r["word"]: tuple(r)[1:] for r in S.near_words(df, leaf_words=leaf, sample=60).collect()}
    want = {}
    for w in words:
        near = [x for x in words if one_edit(w, x)]
        if near:
            best = min(near, key=lambda x: (-n[x], x))
            want[w] = (len(near), n[best], best)
    assert got == want


def test_crowded_count_vectors(monkeypatch):
    """Hundreds of anagrams: words of a point are met by blanked forms, capped counts only lower distances."""
    rng = random.Random(1)
    words = sorted({"".join(rng.sample("aabbcde", 7)) for _ in range(700)} | {"".join(rng.sample("aabbcdf", 7)) for _ in range(700)})
    short = sorted({w[:p] + w[p + 1:] for w in words[::9] for p in range(7)})
    for dense, bits in ((10, 512), (10_000, 512), (10, 8)):
        monkeypatch.setattr(S, "DENSE", dense)
        monkeypatch.setattr(S.LeafTree, "MOST_BITS", bits)
        tree = S.LeafTree(words)
        for asked, longer in ((words, False), (short, True)):
            got = sorted((asked[i], words[j]) for a, b in tree.near(asked, longer) for i, j in zip(a.tolist(), b.tolist()))
            assert got == sorted((a, b) for a in asked for b in words if one_edit(a, b) and (len(a) < len(b)) == longer)


def test_top_tree_meets_every_near_leaf():
    rng = random.Random(3)
    words = some_words(rng, 3000, "abcdefgh", (7,))
    words = [w for w in words if len(w) == 7]
    tree = S.TopTree(words[::5], 4)
    assert tree.leaves > 8
    home = tree.home(words)
    met = set(zip(*(x.tolist() for x in tree.met(words, 1, 1))))
    assert len(met) < len(words) * tree.leaves
    for i in range(0, len(words), 20):
        for j, w in enumerate(words):
            if one_edit(words[i], w):
                assert (i, home[j]) in met


def test_whole_operator(spark, cases, none):
    rng = random.Random(8)
    base = some_words(rng, 60, "aeioutrsñ", (5, 6, 8))
    rows = [(i, " ".join(rng.choice(base).title() if rng.random() < .2 else rng.choice(base) for _ in range(300))) for i in range(60)]
    rows += [(None, None), (70, ""), (None, "wordy wordy Wordy worden"), (71, "x" * 9 + " ×÷×÷× " * 4 + "x" * 3000 + " " + "x" * 3001)]
    rows += rows[:5]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, word string")
    got = S.spelling_variants(df, leaf_words=40)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == brute(corpus(rows))
    assert S.spelling_variants(none).count() == 0
    from .conftest import CASES
    assert sorted(map(tuple, S.spelling_variants(cases).collect()), key=lambda r: r[0]) == brute(corpus(CASES))


def test_roots_follow_chains(spark):
    forms = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("x", "d"), ("p", "q")], "word string, form string")
    assert sorted(map(tuple, S.roots(forms).collect())) == [("a", "d"), ("b", "d"), ("c", "d"), ("p", "q"), ("x", "d")]
    assert S.roots(forms.filter("word > 'z'")).count() == 0


def test_edits():
    a, b = np.array([[1, 2, 3]]), np.array([[1, 9, 3], [1, 2, 3], [2, 1, 3]])
    assert S.one_replaced(np.repeat(a, 3, 0), b).tolist() == [True, False, False]
    c = np.array([[1, 2, 3, 3], [7, 1, 2, 3], [1, 2, 7, 3], [1, 3, 2, 3], [3, 2, 1, 3]])
    assert S.one_inserted(np.repeat(a, 5, 0), c).tolist() == [True, True, True, True, False]
