"""Language identification by nearest centroid over TF-IDF letter n-grams.

A text becomes the counts of its byte trigrams (UTF-8, ASCII in lower case,
everything that is no letter of ASCII and no byte from 0x80 on turned into a
single blank), weighted by inverse document frequency and normalised.  Each
language has several centroids, found by spherical k-means over its training
texts; a text gets the language of the centroid with the largest cosine.  A
text whose cosine lies below its language's rejection radius (the ``REJECT``
quantile of the training texts' own cosines) is marked ``rejected``.

Training rows are those whose crc32(doc_id) mod 4 is not 2 and whose language
is known; a bounded sample of them (``SAMPLE`` rows in expectation, shared
equally among the languages, by hash) is fitted.  Tasks reduce the sampled
texts to trigram counts, so the driver holds counts, never texts.  The model
(``VOCABULARY`` trigrams times a few centroids per language) is a broadcast.

A text without a letter (or null) is ``und`` with score 0; so is every text if
nothing could be learned.  Predictions use the text alone; equal cosines go to
the language that sorts first.  Repeated rows are judged alike.  A null doc_id
is neither held out nor learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_tasks, steps, texts_of

SAMPLE = 2000
VOCABULARY = 6000
#: Trigrams that a language has at least, however many languages share the vocabulary.
OWN = 400
CENTROIDS = 3
REJECT = 0.01
ROUNDS = 8
HOLD_OUT, PARTS = 2, 4

_CLEAN = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_ASCII_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
#: Bytes of a text that are turned to codes at a time.
_STEP = 1 << 20


def has_letter(text: bytes) -> bool:
    if len(text.translate(None, _ASCII_LETTERS)) < len(text):
        return True
    return not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace"))


def _codes(text: bytes) -> Iterator[np.ndarray]:
    """The text's trigrams as 24-bit numbers, a bounded piece at a time."""
    clean = b" " + b" ".join(text.translate(_CLEAN).split()) + b" "
    for i in range(0, max(1, len(clean) - 2), _STEP):
        b = np.frombuffer(clean[i:i + _STEP + 2], np.uint8).astype(np.int32)
        if len(b) > 2:
            yield b[:-2] << 16 | b[1:-1] << 8 | b[2:]


def gram_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(codes, counts) of a whole text."""
    codes, counts = np.zeros(0, np.int32), np.zeros(0, np.int64)
    for part in _codes(text):
        c, n = np.unique(part, return_counts=True)
        if len(codes):
            merged, inverse = np.unique(np.concatenate((codes, c)), return_inverse=True)
            counts = np.bincount(inverse, weights=np.concatenate((counts, n)), minlength=len(merged)).astype(np.int64)
            codes = merged
        else:
            codes, counts = c, n
    return codes, counts


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=-1, keepdims=True)
    return x / np.where(n > 0, n, 1)


class Model:
    """Trigram numbers, idf, centroids (rows of unit length), their language, and rejection radii."""

    def __init__(self, grams: np.ndarray, idf: np.ndarray, centroids: np.ndarray, owner: np.ndarray, langs: list[str], radius: np.ndarray):
        self.grams, self.idf, self.centroids, self.owner, self.langs, self.radius = grams, idf, centroids, owner, langs, radius
        self.place = None

    def prepare(self) -> "Model":
        if self.place is None:
            self.place = np.full(1 << 24, len(self.grams), np.int16 if len(self.grams) < 1 << 15 else np.int32)
            self.place[self.grams] = np.arange(len(self.grams))
            self.weighted = np.ascontiguousarray((self.centroids * self.idf).T)
            self.square = self.idf ** 2
        return self

    def predict(self, text: bytes) -> tuple[str, float, bool]:
        size = len(self.grams)
        tf = np.zeros(size + 1)
        for part in _codes(text):
            tf += np.bincount(self.place[part], minlength=size + 1)
        tf = tf[:size]
        length = np.sqrt((tf * tf * self.square).sum())
        if length == 0:
            return self.langs[0], 0.0, True
        cos = tf @ self.weighted / length
        k = int(np.argmax(cos))
        lang, score = int(self.owner[k]), float(min(1.0, max(0.0, cos[k])))
        return self.langs[lang], score, bool(score < self.radius[lang])


def _spherical_kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = (x @ c.T).argmax(1)
        c = _unit(np.stack([x[near == j].sum(0) if (near == j).any() else x[rng.integers(len(x))] for j in range(k)]))
    return c


def fit_counts(rows: list[tuple[str, np.ndarray, np.ndarray]], vocabulary: int = VOCABULARY, centroids: int = CENTROIDS, rounds: int = ROUNDS,
               reject: float = REJECT, seed: int = 5) -> Model | None:
    """``rows``: (language, trigram codes, counts) of the training texts."""
    rows = [r for r in rows if len(r[1])]
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    grams, df = np.unique(np.concatenate([r[1] for r in rows]), return_counts=True)
    wanted = set()
    for lang in langs:
        g, n = np.unique(np.concatenate([r[1] for r in rows if r[0] == lang]), return_counts=True)
        wanted.update(g[np.argsort(-n, kind="stable")[:max(OWN, vocabulary // len(langs))]].tolist())
    # the rest of the vocabulary: the most frequent of all
    more = grams[np.argsort(-df, kind="stable")]
    wanted.update(more[~np.isin(more, np.fromiter(wanted, more.dtype))][:max(0, vocabulary - len(wanted))].tolist())
    top = np.flatnonzero(np.isin(grams, np.fromiter(wanted, grams.dtype)))
    grams, df = grams[top], df[top]
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    cents, owner, radius = [], [], []
    for j, lang in enumerate(langs):
        mine = [r for r in rows if r[0] == lang]
        x = np.zeros((len(mine), len(grams)), np.float32)
        for i, (_, codes, n) in enumerate(mine):
            at = np.searchsorted(grams, codes)
            ok = (at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == codes)
            x[i, at[ok]] = n[ok] * idf[at[ok]]
        x = _unit(x)
        c = _spherical_kmeans(x, centroids, rounds, seed + j)
        cents.append(c)
        owner += [j] * len(c)
        radius.append(float(np.quantile((x @ c.T).max(1), reject)))
    return Model(grams, idf, np.concatenate(cents).astype(np.float64), np.array(owner), langs, np.array(radius))


def held_out(id_col: str) -> Column:
    part = F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(PARTS))
    return F.coalesce(part == HOLD_OUT, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, **how) -> Model | None:
    rows = docs.filter(F.col(id_col).isNotNull() & ~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col).cast("string")).count().collect()}      # one row a language
    if not sizes:
        return None
    each = max(1, sample // len(sizes))
    limit = F.create_map(*[x for k, n in sorted(sizes.items()) for x in (F.lit(k), F.lit(int(min(1.0, each / n) * (1 << 30))))])
    lot = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter(
        F.pmod(F.xxhash64(F.col(id_col), F.lit(1)), F.lit(1 << 30)) <= F.element_at(limit, F.col("lang")))

    def count(batches) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            got = [gram_counts(x) for x in texts_of(b.column(1)).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([c.astype("<i4").tobytes() for c, _ in got], pa.binary()),
                                              pa.array([n.astype("<i8").tobytes() for _, n in got], pa.binary())], ["lang", "codes", "counts"])

    found = lot.transform(in_tasks(count, "lang string, codes binary, counts binary")).collect()      # about ``sample`` rows of counts
    found.sort(key=lambda r: (r[0], bytes(r[1]), bytes(r[2])))      # the same model whatever the order of tasks
    return fit_counts([(r[0], np.frombuffer(r[1], "<i4"), np.frombuffer(r[2], "<i8")) for r in found], **how)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model: Model | None = None,
             **how) -> DataFrame:
    """Per document row: id, held_out, lang_pred, score, rejected."""
    spark = docs.sparkSession
    model = model or train(docs, id_col, text_col, lang_col, **how)
    shared = spark.sparkContext.broadcast(model)

    def rows(batches) -> Iterator[pa.RecordBatch]:
        m = shared.value.prepare() if shared.value else None
        for b in steps(batches, "text"):
            got = [m.predict(x) if m and has_letter(x) else ("und", 0.0, True)
                   for x in texts_of(b.column(2)).cast(pa.large_binary()).to_pylist()]
            lang, score, far = zip(*got)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(far, pa.bool_())], ["id", "held_out", "lang_pred", "score", "rejected"])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return src.transform(in_tasks(rows, f"id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")).withColumnRenamed("id", id_col)
