import collections
import random
import re

import pytest

from churnlake.llm import quality as Q

from .conftest import CASES


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(windows)
    cover = {i + k for i, x in enumerate(windows) if n[x] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


def test_counts_match_brute_force():
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab é日#|<\n\n \t\x0b\r") for _ in range(rng.randint(0, 120))) for _ in range(400)] + [t for _, t in CASES]
    for t in texts:
        assert Q.counts((t or "").encode())[:5] == brute(t), t


def test_binomial_tail_and_bound():
    assert Q.binomial_tail(0, 10, 0.5) == pytest.approx(0.5 ** 10)
    assert Q.binomial_tail(10, 10, 0.3) == pytest.approx(1.0)
    # 0 of 300: upper 95 % bound is 1 - 0.05^(1/300) = 0.00994
    assert Q.within_risk(0, 300, 0.0100, 0.05) and not Q.within_risk(0, 300, 0.0099, 0.05)
    assert not Q.within_risk(0, 0, 0.5, 0.05)


def test_cutoffs_hold_the_risk_and_need_labels():
    grid = 100
    cells = {("en", "r", c, True): 100 for c in range(0, 40)} | {("en", "r", c, False): 30 for c in range(0, 100, 10)}
    cells[("en", "r", 90, True)] = 2
    cut = Q.choose_cutoffs(cells, risk=0.02, delta=0.05, grid=grid)["r"]["en"]
    rejected = sum(n for (s, r, c, good), n in cells.items() if good and c > cut * grid)
    assert 0.3 <= cut <= 0.5 and rejected / 4002 < 0.02
    few = {k: 1 for k in cells}
    assert Q.choose_cutoffs(few, risk=0.02, grid=grid) == {}


def test_judge_and_stage(spark, cases, none):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    rng = random.Random(1)
    clean = lambda: " ".join(rng.choice(words) + str(rng.randint(0, 999)) for _ in range(80))
    rows = [(i, clean(), "en", "s", 1) for i in range(1500)] + [(2000 + i, clean().replace(" ", "$$$ "), "en", "s", 1) for i in range(300)]
    rows += [(3000, clean().replace(" ", "$$$ "), "xx", "s", 1), (3001, "short", "en", "s", 1), (3002, None, None, "s", 1), (3003, "a b c " * 30, "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words long")
    labels = spark.createDataFrame([(i, int(i < 2000), 0) for i, *_ in rows[:1800]] + [(5, 0, 0), (None, 0, 0), (9, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in Q.judge(docs, labels, risk=0.06).collect()}
    assert all(got[i]["kept"] for i in range(1500)) and not any(got[2000 + i]["kept"] for i in range(300))
    assert got[3000]["kept"] and all(got[k]["base_failed"] and not got[k]["kept"] for k in (3001, 3002, 3003))
    kept = Q.keep_good(docs, labels, risk=0.06)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}
    no_labels = labels.limit(0)
    assert Q.judge(cases, no_labels).count() == cases.count()
    assert Q.keep_good(cases, no_labels).count() == 0      # short, empty or repeating: all fail the base rules
    assert Q.judge(none, no_labels).count() == 0 and Q.keep_good(none, labels).count() == 0


def labelled(langs, n_good, n_bad):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    rng = random.Random(4)
    rows = []
    for lang in langs:
        for k in range(n_good + n_bad):
            text = " ".join(rng.choice(words) + str(rng.randint(0, 999)) for _ in range(80))
            if k >= n_good:
                text = text.replace(" ", "$$$ ") if k % 2 else text.upper()
            rows.append((len(rows), text, lang, int(k < n_good)))
    return rows


@pytest.mark.parametrize("langs,n_good", [(["de", "en", "es", "fr"], 160), (["de", "en", "es", "fr", None], 60)])
def test_few_labels_suffice_at_production_settings(spark, langs, n_good):
    """160 good labels a language, or a pool of 300 in thin languages and without language: the bad go, the good stay."""
    rows = labelled(langs, n_good, 20)
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, q) for i, _, _, q in rows], "doc_id long, quality int")
    kept = {r["doc_id"]: r["kept"] for r in Q.judge(docs, labels).collect()}
    assert not any(kept[i] for i, _, _, q in rows if not q)
    assert sum(not kept[i] for i, _, _, q in rows if q) <= Q.RISK * n_good * len(langs)


def test_labels_needed_and_levels():
    n = Q.labels_needed(5)
    assert Q.within_risk(0, n, Q.RISK, Q.DELTA / 5) and not Q.within_risk(0, n - 1, Q.RISK, Q.DELTA / 5)
    got = Q.badness_levels({"a": {0: 900, 5: 50, 10: 20}, "b": {3: 970}}, {"a": {10: 20}}, 10)
    assert got["a"] == [0] + [1] * 5 + [2] * 5 and not any(got["b"])      # no bad document, no level
