"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

Words are maximal runs of Latin letters (A-Z lower-cased) of at least
``MIN_LENGTH`` code points, counted over all texts.  Two words are near if one
inserted, deleted or replaced code point turns one into the other.  One edit
changes a word's letter counts by an L1 distance of at most two: exactly two
for a replaced letter (one count up, one down; same length) and exactly one
for an inserted letter (length one more).  So a word asks the tree of its own
length with radius two and the tree of the next length with radius one;
deletions are the same pairs seen from the longer word.

* The words of a length form one k-d tree.  Its top is fitted on at most
  ``SAMPLE`` words of that length and cuts lengths with more than
  ``LEAF_WORDS`` words into leaves.  The cuts only deal out work: every word
  lies in one leaf and asks every leaf whose box its ball meets.
* Inside a leaf a task builds the rest of the tree over the distinct count
  vectors, with the tight box of every node, and moves all queries down it
  together, node level by node level; a (query, node) pair is dropped when
  the query's distance to the box exceeds the radius.
* Candidates at exactly the radius are verified letter by letter.  A count
  vector shared by more than ``DENSE`` words meets its queries through the
  word with the edited place blanked, so no group is paired in full.

A task returns per word its number of near words and the best of them; the
parts of a word meet in one aggregate.  A form has at least twice its word's
occurrences, so chains of forms end; roots are handed down from the words
without a form, one generation a round.

Defined results: null and empty texts have no words; a null doc_id counts as
empty in the hash; every row of a repeated document counts; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.session import materialize

from .common import in_tasks

MIN_LENGTH = 5
MIN_COUNT = 3
#: A run in about this many loses a letter (where the hash of document and run is divisible by it).
ONE_IN = 97
#: Words of one length that a task holds as tree, and words that the top of a tree is fitted on.
LEAF_WORDS = 24_000
SAMPLE = 2_000
#: Pairs of query and node, or of words, in one step of a task.
STEP_PAIRS = 400_000
#: Words in a node of the tree that are compared one by one.
BUCKET = 8
#: Words of one count vector beyond which they are met by their blanked form.
DENSE = 256


# ---- words ---------------------------------------------------------------------------------------------


def corpus_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                 min_count: int = MIN_COUNT, one_in: int = ONE_IN) -> DataFrame:
    """(word, n) over all texts; shorter runs can't become long enough words and are not even cut out."""
    upper = "".join(map(chr, range(65, 91)))
    low = F.translate(F.col(text_col), upper, upper.lower())
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
                       F.explode(F.regexp_extract_all(low, F.lit(f"([a-z\\u00C0-\\u00FF]{{{min_length},}})"), F.lit(1))).alias("_run"))
    h = F.crc32(F.concat("_id", F.lit(":"), "_run"))
    runs = runs.withColumn("_h", h)
    at = (F.col("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.length("_run")))
    word = F.when(F.col("_h") % one_in == 0, cut).otherwise(F.col("_run"))
    return (runs.select(word.alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


# ---- letter counts -------------------------------------------------------------------------------------


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the words in one array, and each word's borders."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat, np.concatenate(([0], np.cumsum([len(w) for w in words], dtype=np.int64)))


def letter_counts(words: list[str], letters: np.ndarray) -> np.ndarray:
    """Words x (letters and one more column for all other code points); ``letters`` ascends."""
    flat, borders = code_points(words)
    at = np.searchsorted(letters, flat)
    at[letters[np.minimum(at, len(letters) - 1)] != flat] = len(letters)
    width = len(letters) + 1
    cell = np.repeat(np.arange(len(words)), np.diff(borders)) * width + at
    return np.bincount(cell, minlength=len(words) * width).reshape(len(words), width)


# ---- the top of a tree ---------------------------------------------------------------------------------


class TopTree:
    """Cuts of the words of one length into leaves.  A node is (letter's
    column, most occurrences on the left, left, right), a leaf its number."""

    def __init__(self, words: list[str], depth: int):
        self.letters = np.unique(code_points(words)[0])
        self.leaves = 0
        self.root = self._cut(letter_counts(words, self.letters)[:, :-1], depth)

    def _cut(self, v: np.ndarray, depth: int):
        best = None
        for d in range(v.shape[1] if depth else 0):
            left = np.cumsum(np.bincount(v[:, d]))[:-1]
            for c in np.flatnonzero(left)[:8].tolist():
                gap = abs(2 * int(left[c]) - len(v))
                if best is None or gap < best[0]:
                    best = (gap, d, c)
        if best is None:
            self.leaves += 1
            return self.leaves - 1
        _, d, c = best
        side = v[:, d] <= c
        return d, c, self._cut(v[side], depth - 1), self._cut(v[~side], depth - 1)

    def home(self, words: list[str]) -> np.ndarray:
        """The leaf each word lies in."""
        return self._met(words, 0, 0)[1]

    def met(self, words: list[str], ups: int, downs: int) -> tuple[np.ndarray, np.ndarray]:
        """(word's index, leaf) of every leaf that may hold a word with at
        most ``ups`` letter counts one higher and ``downs`` one lower."""
        return self._met(words, ups, downs)

    def _met(self, words: list[str], ups: int, downs: int) -> tuple[np.ndarray, np.ndarray]:
        v = letter_counts(words, self.letters)
        who, leaf = [], []

        def walk(node, i: np.ndarray, up: np.ndarray, down: np.ndarray) -> None:
            """``up`` and ``down``: the columns whose edit is used up on the way (-1: none)."""
            if not len(i):
                return
            if isinstance(node, int):
                who.append(i)
                leaf.append(np.full(len(i), node))
                return
            d, most, left, right = node
            x = v[i, d] + (up == d) - (down == d)
            stay = x <= most
            rise = (x == most) & (up < 0) & (down != d) & bool(ups)
            fall = (x == most + 1) & (down < 0) & (up != d) & bool(downs)
            to_left, to_right = stay | fall, ~stay | rise
            walk(left, i[to_left], up[to_left], np.where(stay, down, d)[to_left])
            walk(right, i[to_right], np.where(stay, d, up)[to_right], down[to_right])

        every = np.arange(len(words))
        walk(self.root, every, np.full(len(words), -1), np.full(len(words), -1))
        if not who:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        a, b = np.concatenate(who), np.concatenate(leaf)
        order = np.argsort(a, kind="stable")
        return a[order], b[order]


# ---- the tree of a leaf --------------------------------------------------------------------------------


class LeafTree:
    """A k-d tree over the letter counts of words of one length.

    Counts are written in unary, a bit for "at least c of this letter", so a
    cut at a bit is a cut of one axis, the box of a node is the AND and the OR
    of its members, and distances are bit counts.  Beyond ``MOST_BITS`` bits
    high counts are capped, which only lowers distances."""

    MOST_BITS = 512

    def __init__(self, words: list[str]):
        self.words = words
        self.letters = np.unique(code_points(words)[0])
        counts = letter_counts(words, self.letters)[:, :-1]
        top = counts.max(0)
        cap = int(top.max())
        while cap > 1 and int(np.minimum(top, cap).sum()) > self.MOST_BITS:
            cap -= 1 + cap // 8
        self.exact = cap >= int(top.max())
        self.top, self.held = top, np.minimum(top, cap)
        bits = self._unary(counts)
        packed = np.ascontiguousarray(np.packbits(bits, axis=1)).view(np.uint64)
        self.points, first, group = np.unique(packed, axis=0, return_index=True, return_inverse=True)
        group = group.reshape(-1)
        order = np.argsort(group, kind="stable")
        self.members = order                                              # words, point by point
        self.ends = np.cumsum(np.bincount(group, minlength=len(self.points)))
        self._build(bits[first])
        self.rank = np.empty(len(words), np.int64)
        self.rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        self.codes = code_points(words)[0].reshape(len(words), -1)
        self._blank: dict[tuple[int, bool], dict[str, list[int]]] = {}

    def _unary(self, counts: np.ndarray) -> np.ndarray:
        """Rows of 0 / 1, padded to whole 64-bit words."""
        steps = np.concatenate([np.arange(1, h + 1) for h in self.held.tolist()])
        bits = np.repeat(counts[:, :len(self.held)], self.held, axis=1) >= steps
        return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 64))).astype(np.uint8)

    def _build(self, bits: np.ndarray) -> None:
        """Nodes as (first, end) of ``place`` and their children; points of a node are cut at its most even bit."""
        place = np.arange(len(bits))
        span, child, stack = [(0, len(bits))], [(-1, -1)], [0]
        while stack:
            node = stack.pop()
            a, b = span[node]
            if b - a <= BUCKET:
                continue
            part = place[a:b]
            ones = bits[part].sum(0, dtype=np.int64)
            d = int(np.abs(2 * ones - (b - a)).argmin())
            if not 0 < ones[d] < b - a:
                continue
            side = bits[part, d].astype(bool)
            place[a:b] = np.concatenate((part[~side], part[side]))
            cut = b - int(ones[d])
            child[node] = (len(span), len(span) + 1)
            stack += [len(span), len(span) + 1]
            span += [(a, cut), (cut, b)]
            child += [(-1, -1)] * 2
        self.place, self.span, self.child = place, np.array(span), np.array(child)
        ordered = self.points[place]
        low = [np.bitwise_and.reduce(ordered[a:b]) for a, b in span]
        high = [np.bitwise_or.reduce(ordered[a:b]) for a, b in span]
        self.low, self.high = np.stack(low), np.stack(high)

    # ---- queries ---------------------------------------------------------------------------------------

    def near(self, words: list[str], longer: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, word of the tree) index pairs that are one edit apart:
        the tree's word has a replaced letter, or is ``longer`` by one."""
        counts = letter_counts(words, self.letters)
        other = counts[:, -1] + np.maximum(counts[:, :-1] - self.top, 0).sum(1)      # letters beyond all words of the tree
        q = np.ascontiguousarray(np.packbits(self._unary(counts), axis=1)).view(np.uint64)
        downs = 0 if longer else 1
        codes = code_points(words)[0].reshape(len(words), -1)
        fits = np.flatnonzero(other <= downs)
        stack = [(fits, np.zeros(len(fits), np.int64))]
        while stack:
            i, node = stack.pop()
            if len(i) > STEP_PAIRS:
                stack.append((i[STEP_PAIRS:], node[STEP_PAIRS:]))
                i, node = i[:STEP_PAIRS], node[:STEP_PAIRS]
            x = q[i]
            up = np.bitwise_count(self.low[node] & ~x).sum(1)
            down = np.bitwise_count(x & ~self.high[node]).sum(1) + other[i]
            keep = (up <= 1) & (down <= downs)
            i, node = i[keep], node[keep]
            leaf = self.child[node, 0] < 0
            if leaf.any():
                yield from self._bucket(q, other, codes, words, i[leaf], node[leaf], downs)
            i, node = i[~leaf], node[~leaf]
            if len(i):
                stack.append((np.repeat(i, 2), self.child[node].reshape(-1)))

    def _bucket(self, q, other, codes, words, i, node, downs: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Points of a node one by one, then the words of the points that fit."""
        for i, point in _expanded(i, self.span[node, 0], self.span[node, 1], STEP_PAIRS):
            point = self.place[point]
            x, v = q[i], self.points[point]
            up = np.bitwise_count(v & ~x).sum(1)
            down = np.bitwise_count(x & ~v).sum(1) + other[i]
            fit = (up == 1) & (down == downs) if self.exact else (up <= 1) & (down <= downs)
            i, point = i[fit], point[fit]
            first = np.where(point > 0, self.ends[point - 1], 0)
            dense = self.ends[point] - first > DENSE
            for p in np.unique(point[dense]).tolist():
                yield self._by_blank(words, i[point == p], p, downs == 0)
            step = max(1, STEP_PAIRS * 8 // max(1, self.codes.shape[1]))
            for k, at in _expanded(i[~dense], first[~dense], self.ends[point[~dense]], step):
                w = self.members[at]
                ok = one_replaced(codes[k], self.codes[w]) if downs else one_inserted(codes[k], self.codes[w])
                yield k[ok], w[ok]

    def _by_blank(self, words, i: np.ndarray, point: int, longer: bool) -> tuple[np.ndarray, np.ndarray]:
        """Words of a point with many words, met through the edited place."""
        key = (point, longer)
        blank = "" if longer else "\0"
        if key not in self._blank:
            forms = self._blank[key] = {}
            for w in self.members[self.ends[point - 1] if point else 0:self.ends[point]].tolist():
                t = self.words[w]
                for f in {t[:p] + blank + t[p + 1:] for p in range(len(t))}:
                    forms.setdefault(f, []).append(w)
        forms, found = self._blank[key], []
        for k in i.tolist():
            t = words[k]
            for f in [t] if longer else [t[:p] + blank + t[p + 1:] for p in range(len(t))]:
                found += [(k, w) for w in forms.get(f, ()) if self.words[w] != t]
        a = np.array(found, np.int64).reshape(-1, 2)
        return a[:, 0], a[:, 1]


def _expanded(i: np.ndarray, first: np.ndarray, end: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every i with each of first..end-1, in steps of about ``step`` pairs."""
    n = np.cumsum(end - first)
    at = 0
    while at < len(i):
        base = n[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(n, base + step, side="right")))
        size = (end - first)[at:to]
        inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        yield np.repeat(i[at:to], size), np.repeat(first[at:to], size) + inside
        at = to


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows of ``b``, one letter longer, that are the row of ``a`` with one letter more."""
    head = np.logical_and.accumulate(a == b[:, :-1], axis=1).sum(1)
    tail = np.logical_and.accumulate((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= a.shape[1]


# ---- tasks ---------------------------------------------------------------------------------------------


_ROUTED = "part int, length int, leaf int, kind int, word string, n long"
_BEST = "word string, n_near long, near_n long, near string"


def _route(trees: dict[int, tuple[TopTree, int]], small: int):
    """Each word to its leaf (kind 0), as a query to its own length's leaves
    (kind 1) and to those of the next length (kind 2)."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = b.column(0).to_pylist()
            n = b.column(1).to_numpy()
            length = np.fromiter(map(len, words), np.int64, len(words))
            rows: list[list[np.ndarray]] = [[], [], [], [], []]      # part, length, leaf, kind, index
            for l in np.unique(length).tolist():
                at = np.flatnonzero(length == l)
                some = [words[i] for i in at.tolist()]
                for kind, to, ups, downs in ((0, l, 0, 0), (1, l, 1, 1), (2, l + 1, 1, 0)):
                    if to in trees:
                        tree, base = trees[to]
                        i, leaf = tree.met(some, ups, downs)
                        part = base + leaf
                    else:
                        i, leaf = np.arange(len(some)), np.zeros(len(some), np.int64)
                        part = leaf + to % small
                    for column, x in zip(rows, (part, np.full(len(i), to), leaf, np.full(len(i), kind), at[i])):
                        column.append(x)
            if not words:
                continue
            part, to, leaf, kind, i = (np.concatenate(c) for c in rows)
            yield pa.RecordBatch.from_arrays([*[pa.array(c.astype(np.int32)) for c in (part, to, leaf, kind)], b.column(0).take(pa.array(i)), pa.array(n[i])],
                                             ["part", "length", "leaf", "kind", "word", "n"])
    return run


class _Best:
    """Per word the number of near words and the best: most occurrences, then smallest."""

    def __init__(self, n: int):
        self.count = np.zeros(n, np.int64)
        self.n = np.full(n, -1, np.int64)
        self.rank = np.zeros(n, np.int64)
        self.word = np.full(n, -1, np.int64)

    def add(self, who: np.ndarray, n: np.ndarray, rank: np.ndarray, word: np.ndarray) -> None:
        np.add.at(self.count, who, 1)
        order = np.lexsort((rank, -n, who))
        first = order[np.flatnonzero(np.diff(who[order], prepend=-1))]
        w, n, rank, word = who[first], n[first], rank[first], word[first]
        new = (n > self.n[w]) | ((n == self.n[w]) & (rank < self.rank[w]))
        w = w[new]
        self.n[w], self.rank[w], self.word[w] = n[new], rank[new], word[new]

    def rows(self, words: list[str], others: list[str]) -> pa.RecordBatch:
        at = np.flatnonzero(self.count).tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array([words[i] for i in at], pa.string()), pa.array(self.count[at]), pa.array(self.n[at]),
             pa.array([others[j] for j in self.word[at].tolist()], pa.string())], ["word", "n_near", "near_n", "near"])


def _search(batches) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (length, leaf, kind): the words of a leaf become a tree, the queries after them pass through it."""
    key, tree, words, n = None, None, [], np.zeros(0, np.int64)
    parts: list[tuple[list[str], np.ndarray]] = []
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(c).to_numpy() for c in (1, 2, 3, 5)]
        text = b.column(4)
        cut = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])) + 1
        for a, e in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
            here, kind = (int(cols[0][a]), int(cols[1][a])), int(cols[2][a])
            if here != key:
                key, tree, parts = here, None, []
            rows = text.slice(a, e - a).to_pylist(), cols[3][a:e]
            if kind == 0:
                parts.append(rows)
                continue
            if parts:
                words, n = [w for p, _ in parts for w in p], np.concatenate([x for _, x in parts])
                tree, parts = LeafTree(words), []
            if tree is None:
                continue                                     # no words of that length here
            asked, asked_n = rows
            mine, theirs = _Best(len(asked)), _Best(len(words)) if kind == 2 else None
            rank = np.empty(len(asked), np.int64)
            rank[sorted(range(len(asked)), key=asked.__getitem__)] = np.arange(len(asked))
            for i, w in tree.near(asked, longer=kind == 2):
                mine.add(i, n[w], tree.rank[w], w)
                if theirs:
                    theirs.add(w, asked_n[i], rank[i], i)
            yield mine.rows(asked, words)
            if theirs:
                yield theirs.rows(words, asked)


def near_words(words: DataFrame, leaf_words: int = LEAF_WORDS, sample: int = SAMPLE) -> DataFrame:
    """(word, n_near, near_n, near) of the words (word, n) that have a near
    word: how many, and the one of most occurrences (ties: the smallest)."""
    sizes = {r["l"]: r["c"] for r in words.groupBy(F.length("word").alias("l")).agg(F.count(F.lit(1)).alias("c"))
             .filter(F.col("c") > leaf_words).collect()}      # a row for each leaf_words words at most
    small = max(1, int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    trees: dict[int, tuple[TopTree, int]] = {}
    n_parts = small
    if sizes:
        every = F.create_map(*[F.lit(x) for l, c in sizes.items() for x in (l, -(-c // sample))])[F.length("word")]
        drawn: dict[int, list[str]] = {l: [] for l in sizes}
        for r in words.filter(F.pmod(F.xxhash64("word"), every) == 0).select("word").collect():      # about ``sample`` a length
            drawn[len(r["word"])].append(r["word"])
        for l in sorted(sizes):
            if drawn[l]:
                tree = TopTree(drawn[l], (-(-sizes[l] // leaf_words) - 1).bit_length())
                trees[l] = (tree, n_parts)
                n_parts += tree.leaves
    routed = (words.select("word", "n").transform(in_tasks(_route(trees, small), _ROUTED))
              .repartitionById(n_parts, "part").sortWithinPartitions("length", "leaf", "kind"))
    return (routed.transform(in_tasks(_search, _BEST)).groupBy("word")
            .agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
            .select("word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): roots are handed down from the forms
    that have none, one generation a round.  A form has few words (its near
    ones), so no join key is hot."""
    links = forms.select("word", "form")
    heads = links.select(F.col("form").alias("word")).distinct().join(links.select("word"), "word", "left_anti")
    last = materialize(heads.select("word", F.col("word").alias("root")), "spelling_roots")
    out = None
    while True:
        last = materialize(links.join(last.select(F.col("word").alias("form"), "root"), "form").select("word", "root"), "spelling_roots")
        if last.isEmpty():
            return last if out is None else out
        out = last if out is None else out.unionByName(last)


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaf_words: int = LEAF_WORDS) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = materialize(corpus_words(docs, id_col, text_col), "corpus_words")
    near = near_words(words, leaf_words)
    is_form = F.col("near_n") >= 2 * F.col("n")
    known = materialize(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near")).alias("form"), F.when(is_form, F.col("near_n")).alias("form_n")), "near_words")
    found = roots(known.filter(F.col("form").isNotNull()))
    return known.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
