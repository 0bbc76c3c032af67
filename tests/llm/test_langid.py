import zlib

import numpy as np

from churnlake.llm import langid as L

from .conftest import CASES, SMOKE


def test_gram_counts_match_brute_force():
    import collections
    for t in ["", "a", "Ab cD  12é!x", "日本語", "z" * 3000] + [t or "" for _, t in CASES]:
        clean = b" " + b" ".join(bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in t.encode()).split()) + b" "
        want = collections.Counter(clean[i] << 16 | clean[i + 1] << 8 | clean[i + 2] for i in range(len(clean) - 2))
        codes, counts = L.gram_counts(t.encode())
        assert dict(zip(codes.tolist(), counts.tolist())) == want


def test_pieces_of_long_texts_agree(monkeypatch):
    text = " ".join(f"word{i % 7}x é" for i in range(2000)).encode()
    whole = [x.tolist() for x in L.gram_counts(text)]
    monkeypatch.setattr(L, "_STEP", 1000)
    assert [x.tolist() for x in L.gram_counts(text)] == whole


def test_cosine_equals_plain_arithmetic():
    rows = [("de", *L.gram_counts("und der die das ist nicht".encode())), ("en", *L.gram_counts(b"and the this is not that")), ("en", *L.gram_counts(b"the other one and more"))]
    m = L.fit_counts(rows, centroids=2).prepare()
    codes, n = L.gram_counts(b"this is the one")
    x = np.array([n[codes == g].sum() for g in m.grams]) * m.idf
    cos = m.centroids @ (x / np.linalg.norm(x))
    assert m.predict(b"this is the one")[:2] == (m.langs[m.owner[cos.argmax()]], np.float64(cos.max()).item()) or abs(m.predict(b"this is the one")[1] - cos.max()) < 1e-12


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang_pred"] == r["lang"] for r in held) / len(held) > 0.97 and all(0 <= r["score"] <= 1 for r in got)


def test_cases(spark, cases, none):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    model = L.train(docs)
    got = {r["doc_id"]: r for r in L.identify(cases, model=model).collect()}
    for i in (2, 3, 4, 12):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert got[5]["lang_pred"] in model.langs and got[9]["lang_pred"] in model.langs and not got[None]["held_out"]
    assert L.train(none) is None and L.identify(none).count() == 0
    assert {r["lang_pred"] for r in L.identify(cases.withColumn("lang", cases["lang"].substr(99, 1)).filter("false").unionByName(cases.filter("false"))).collect()} == set()


def test_sixty_languages_all_keep_trigrams():
    """Big languages with rich vocabularies crowd out none of the small ones."""
    import random
    rng = random.Random(3)
    scripts = {f"l{k:02d}": [chr(0x3400 + 40 * k + j) for j in range(30)] for k in range(60)}

    def text(lang, n=40):
        return " ".join("".join(rng.choice(scripts[lang]) for _ in range(rng.randint(2, 6))) for _ in range(n)).encode()

    rows = [(lang, *L.gram_counts(text(lang, 400 if k < 5 else 15))) for k, lang in enumerate(scripts) for _ in range(120 if k < 5 else 6)]
    model = L.fit_counts(rows, centroids=1, rounds=2)
    assert len(model.grams) >= L.VOCABULARY and model.langs == sorted(scripts)
    model.prepare()
    got = [(lang, *model.predict(text(lang))[:2]) for lang in scripts]
    assert all(lang == pred and score > 0 for lang, pred, score in got)
