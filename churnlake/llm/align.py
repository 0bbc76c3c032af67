"""Alignment of two tokenizations of the same texts, and how often ids meet.

Vocabulary A (byte-level) encodes a blank and the text, vocabulary B
(sentencepiece, which adds that blank itself) the text.  Byte offsets at which
tokens of both end cut the tokens into groups: the ends of each side are the
keys of a dictionary end -> index, the intersection of the two key sets is
sorted, and each common end closes a slice of both id lists.  Within a slice
every A token is linked to every B token.

Neither vocabulary has a token that reaches over a blank which follows no
white space (``Aligner`` checks B's pieces for it), so both tokenizations, and
with them the groups, are those of the chunks between such blanks, one after
the other.  Each distinct chunk is encoded and sliced once per worker.

Link counts: every document gives its distinct linked id pairs with their
multiplicities; a grouped count over documents gives each pair's count and
each A id's highest.  Looking the counts up again would meet frequent pairs in
every document, so the ``HOT_PAIRS`` most frequent pairs (a fixed bound) go to
the tasks as one sorted table, and only the others, each of which few
documents hold, are joined by a shuffle.

Defined results: texts that are null or empty, or whose joined token bytes
differ from blank and text on either side, have no tokens: zeros, and an empty
digest.  Special tokens inside texts are plain text.  Every row counts as a
document, repeated ids and rows and a null id included.  An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from tokenizers import Tokenizer

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlake.session import materialize

from .common import in_tasks, list_offsets, steps, texts_of
from .encode import byte_alphabet

#: Distinct chunks a worker remembers; later ones are sliced for their batch alone.
CAPACITY = 200_000
#: New chunks that are sliced together.
NEW_CHUNKS = 50_000
#: Pairs whose counts every task holds (17 bytes each).
HOT_PAIRS = 500_000
#: Bytes of text in one step of a task.
STEP_BYTES = 3_000_000
#: Chunks joined at once for a digest.
JOINED = 200_000

#: A blank that opens a text or follows white space is no border between chunks.
_NO_BORDER = r"(?:^|[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]) "
_BORDER = re.compile(r"(?<=\S) ")


def slices(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """For each common end, ascending, the number of tokens up to it on either side."""
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    common = sorted(at_a.keys() & at_b.keys())
    return [at_a[end] for end in common], [at_b[end] for end in common]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    return (np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists))),
            np.fromiter(map(len, lists), np.int64, len(lists)))


def _total(x: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Sums of ``x`` between borders."""
    return np.diff(np.concatenate(([0], np.cumsum(x, dtype=np.int64)))[borders])


def _expanded(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each range, one after the other."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Aligner:
    """Groups of chunks.  A chunk's groups are kept as items in written order:
    each id with what follows it (another id of its side, the other side, the
    next group); an item's code is its place in a table of written forms."""

    def __init__(self, path_a: str, path_b: str, capacity: int = CAPACITY):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        vocab = self.a.get_vocab()
        byte = {c: b for b, c in byte_alphabet().items()}
        bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            if all(c in byte for c in token):
                bytes_a[i] = bytes(byte[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in pieces):
            raise ValueError("pieces that reach over a blank: chunks can't be encoded one by one")
        bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.bytes = [pa.array(x, pa.large_binary()) for x in (bytes_a, bytes_b)]
        self.length = [np.array([len(x) for x in side], np.int64) for side in (bytes_a, bytes_b)]
        self.size_a, self.size_b = len(bytes_a), len(bytes_b)
        self.last_blank = self.b.encode("a ")[len(self.b.encode("a")):]
        self.written = pa.array([f"{i}{end}" for n, ends in ((self.size_a, ",|"), (self.size_b, ",;")) for i in range(n) for end in ends], pa.large_binary())
        self.capacity = capacity
        self.known: dict[str, int] = {}
        self.good = bytearray()
        self.n = [array("i") for _ in range(4)]              # tokens of A and B, groups, links of every chunk
        self.items, self.item_ends = array("i"), array("q")
        self.pairs, self.pair_ends = array("q"), array("q")  # every link as a * size_b + b

    # ---- chunks ----------------------------------------------------------------------------------------

    def _same_bytes(self, side: int, ids: np.ndarray, n: np.ndarray, raw: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Chunks whose tokens' joined bytes are the chunk's own."""
        length = self.length[side][ids]
        same = _total(length, np.concatenate(([0], np.cumsum(n)))) == size
        of_token, of_byte = np.repeat(same, n), np.repeat(same, size)
        joined = np.frombuffer(self.bytes[side].take(pa.array(ids[of_token])).buffers()[2] or b"", np.uint8)[:int(length[of_token].sum())]
        wrong = np.flatnonzero(joined != raw[of_byte])
        if len(wrong):
            chunk = np.repeat(np.flatnonzero(same), size[same])
            same[chunk[wrong]] = False
        return same

    def _add(self, chunks: list[str]) -> None:
        """Encode and slice chunks (given without their leading blank)."""
        whole = [" " + c for c in chunks]
        a, n_a = _flat([e.ids for e in self.a.encode_batch_fast(whole, add_special_tokens=False)])
        # an empty chunk is the blank that ends a text; B adds none to an empty text
        b, n_b = _flat([x if c else self.last_blank for c, x in zip(chunks, self.b.encode(chunks, num_threads=1))])
        raw = [c.encode() for c in whole]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        raw_bytes = np.frombuffer(b"".join(raw), np.uint8)
        good = self._same_bytes(0, a, n_a, raw_bytes, size) & self._same_bytes(1, b, n_b, raw_bytes, size)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        n_a, n_b, size = n_a * good, n_b * good, size * good
        # the chunks lie one after the other, so one pair of dictionaries serves all
        to_a, to_b = (np.array(x, np.int64) for x in slices(np.cumsum(self.length[0][a]).tolist(), np.cumsum(self.length[1][b]).tolist()))
        in_a, in_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
        chunk_of_a = np.repeat(np.arange(len(chunks)), n_a)
        chunk_of_group = chunk_of_a[to_a - 1]
        n_groups = np.bincount(chunk_of_group, minlength=len(chunks))
        items = np.empty(len(a) + len(b), np.int64)
        last = np.zeros(len(a), np.int64)
        last[to_a - 1] = 1
        items[np.arange(len(a)) + np.repeat(to_b - in_b, in_a)] = 2 * a + last
        last = np.zeros(len(b), np.int64)
        last[to_b - 1] = 1
        items[np.arange(len(b)) + np.repeat(to_a, in_b)] = 2 * self.size_a + 2 * b + last
        # every A token of a group with every B token of it
        times = np.repeat(in_b, in_a)
        pairs = np.repeat(a, times) * self.size_b + b[_expanded(np.repeat(to_b - in_b, in_a), times)]
        n_links = np.bincount(chunk_of_group, in_a * in_b, len(chunks)).astype(np.int64)
        self.good.extend(good.astype(np.uint8).tobytes())
        for store, x in zip(self.n, (n_a, n_b, n_groups, n_links)):
            store.frombytes(x.astype(np.int32).tobytes())
        for store, ends, x, n in ((self.items, self.item_ends, items.astype(np.int32), n_a + n_b), (self.pairs, self.pair_ends, pairs, n_links)):
            ends.frombytes((len(store) + np.cumsum(n)).astype(np.int64).tobytes())
            store.frombytes(x.tobytes())

    def codes(self, distinct: list[str]) -> np.ndarray:
        """A number for each distinct chunk, valid until ``forget``."""
        known = self.known
        out = np.fromiter((known.get(c, -1) for c in distinct), np.int64, len(distinct))
        new = np.flatnonzero(out < 0)
        if len(new):
            at = len(self.good)
            chunks = [distinct[i] for i in new.tolist()]
            for i in range(0, len(chunks), NEW_CHUNKS):
                self._add(chunks[i:i + NEW_CHUNKS])
            out[new] = np.arange(at, at + len(new))
            for k, c in enumerate(chunks[:max(0, self.capacity - at)]):
                known[c] = at + k
        return out

    def forget(self) -> None:
        """Drop what is beyond the capacity."""
        n = len(self.known)
        if len(self.good) > n:
            for store, ends in ((self.items, self.item_ends), (self.pairs, self.pair_ends)):
                del store[ends[n - 1] if n else 0:], ends[n:]
            del self.good[n:]
            for store in self.n:
                del store[n:]


def _gathered(store: array, ends: array, kind, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the store has of each code, and how many."""
    ends = np.frombuffer(ends, np.int64)
    first = np.where(codes > 0, ends[codes - 1], 0)
    size = ends[codes] - first
    return np.frombuffer(store, kind)[_expanded(first, size)], size


_open: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner of two files (kept between the tasks of a worker)."""
    if (path_a, path_b) not in _open:
        _open[path_a, path_b] = Aligner(path_a, path_b)
    return _open[path_a, path_b]


# ---- batches -------------------------------------------------------------------------------------------


def chunked(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, list[str], np.ndarray]]:
    """Texts as (rows, borders, distinct chunks, chunk of every place): first
    those that Arrow can cut at every blank, then the others.  An empty text
    has no chunks."""
    odd = pc.match_substring_regex(texts, _NO_BORDER).to_numpy(zero_copy_only=False).astype(bool)
    empty = pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(bool)
    for which, cut in ((~odd, lambda t: pc.split_pattern(t, " ")),
                       (odd, lambda t: pa.array([_BORDER.split(x) for x in (" " + y for y in t.to_pylist())], pa.large_list(pa.large_string())))):
        rows = np.flatnonzero(which & ~empty)
        if not len(rows):
            continue
        lists = cut(texts.take(pa.array(rows)))
        values = lists.flatten().dictionary_encode()
        distinct = values.dictionary.to_pylist()
        index = values.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        borders = list_offsets(lists)
        if which is odd:                       # the first chunk of a text still has its blank, the cuts have taken the others'
            heads = index[borders[:-1]]
            at = {c: i for i, c in enumerate(distinct)}
            for r, h in zip(borders[:-1].tolist(), heads.tolist()):
                c = distinct[h][1:]
                if c not in at:
                    at[c] = len(distinct)
                    distinct.append(c)
                index[r] = at[c]
        yield rows, borders, distinct, index


def _report(al: Aligner, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """A row per text: sizes, digest, and the distinct linked pairs with their multiplicities."""
    n = len(texts)
    sums = np.zeros((4, n), np.int64)
    sha = [""] * n
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for rows, borders, distinct, index in chunked(texts):
        codes = al.codes(distinct)[index]
        whole = _total(np.frombuffer(al.good, np.uint8)[codes] == 0, borders) == 0
        for k, store in enumerate(al.n):
            sums[k, rows] = np.where(whole, _total(np.frombuffer(store, np.int32)[codes], borders), 0)
        for i, digest in _digests(al, codes, borders, whole):
            sha[rows[i]] = digest
        # distinct chunks of each text, then their pairs
        text = np.repeat(np.arange(len(rows)), np.diff(borders))
        keep = whole[text]
        chunk, times = np.unique(text[keep] * (len(al.good) + 1) + codes[keep], return_counts=True)
        text, chunk = np.divmod(chunk, len(al.good) + 1)
        pairs, size = _gathered(al.pairs, al.pair_ends, np.int64, chunk)
        found.append((rows[np.repeat(text, size)], pairs, np.repeat(times, size)))
        al.forget()
    row, pair, times = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (zip(*found) if found else ((), (), ())))
    width = al.size_a * al.size_b
    key = row * width + pair
    order = np.argsort(key)
    key = key[order]
    start = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.add.reduceat(times[order], start) if len(start) else np.zeros(0, np.int64)
    row, pair = np.divmod(key[start], width)
    at = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [ids, *[pa.array(s) for s in sums], pa.array(sha, pa.string()), pa.ListArray.from_arrays(at, pa.array(pair)),
         pa.ListArray.from_arrays(at, pa.array(times.astype(np.int32)))],
        ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def _digests(al: Aligner, codes: np.ndarray, borders: np.ndarray, whole: np.ndarray) -> Iterator[tuple[int, str]]:
    """Digest of the written groups of every whole text, some chunks at a
    time; the last mark of a text is not written."""
    open_, h = -1, None
    for at in range(0, len(codes), JOINED):
        part = codes[at:at + JOINED]
        items, size = _gathered(al.items, al.item_ends, np.int32, part)
        text = al.written.take(pa.array(items))
        ends = np.frombuffer(text.buffers()[1], np.int64)[:len(items) + 1][np.concatenate(([0], np.cumsum(size)))]
        raw = memoryview(text.buffers()[2] or b"")
        first, last = np.searchsorted(borders, (at, at + len(part) - 1), side="right") - 1
        for i in range(int(first), int(last) + 1):
            if not whole[i]:
                continue
            if i != open_:
                open_, h = i, hashlib.sha256()
            a, b = max(int(borders[i]), at) - at, min(int(borders[i + 1]), at + len(part)) - at
            done = borders[i + 1] <= at + len(part)
            h.update(raw[int(ends[a]):int(ends[b]) - int(done)])
            if done:
                yield i, h.hexdigest()


# ---- operators -----------------------------------------------------------------------------------------


def groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The alignment itself: per document the groups as (a, b) lists of ids, in order."""
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for b in steps(batches, "text", STEP_BYTES):
            texts = texts_of(b.column(1))
            out: list[list] = [[] for _ in range(len(texts))]
            for rows, borders, distinct, index in chunked(texts):
                codes = al.codes(distinct)[index]
                whole = _total(np.frombuffer(al.good, np.uint8)[codes] == 0, borders) == 0
                items, size = _gathered(al.items, al.item_ends, np.int32, codes)
                ends = np.concatenate(([0], np.cumsum(size)))[borders]
                for i in np.flatnonzero(whole).tolist():
                    written = "".join(x.decode() for x in al.written.take(pa.array(items[ends[i]:ends[i + 1]])).to_pylist())
                    sides = [g.split("|") for g in written[:-1].split(";")]
                    out[rows[i]] = [{"a": list(map(int, x.split(","))), "b": list(map(int, y.split(",")))} for x, y in sides]
                al.forget()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, kind)], ["id", "groups"])

    got = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(
        in_tasks(run, f"id {id_type}, groups array<struct<a: array<int>, b: array<int>>>"))
    return got.withColumnRenamed("id", id_col)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: sizes, digest of its groups, and its linked pairs (a * pieces of B + b) with multiplicities."""
    id_type = docs.select(id_col).schema[0].dataType.simpleString()

    def run(batches) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        for b in steps(batches, "text", STEP_BYTES):
            yield _report(al, b.column(0), texts_of(b.column(1)))

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(in_tasks(
        run, f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>"))


def link_counts(rows: DataFrame, size_b: int) -> DataFrame:
    """(pair, a, b, n, best): in how many documents a pair is linked, and
    whether that is its A id's highest.  ``rows`` is ``aligned``."""
    n = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    n = materialize(n.withColumns({"a": F.floor(F.col("pair") / size_b), "b": F.col("pair") % size_b}), "link_counts")
    top = n.groupBy("a").agg(F.max("n").alias("top"))
    return n.join(top, "a").select("pair", "a", "b", "n", (F.col("n") == F.col("top")).alias("best"))


def report(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Per document its sizes, digest, and sums over its links of their pairs' counts (see the module)."""
    spark = docs.sparkSession
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    rows = materialize(aligned(docs, path_a, path_b, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = materialize(link_counts(rows, size_b), "pair_counts")
    n_pairs = counts.count()
    head = counts.orderBy(F.desc("n"), "pair").limit(hot_pairs).select("pair", "n", "best").toArrow()
    order = np.argsort(head.column("pair").to_numpy())
    table = spark.sparkContext.broadcast(tuple(head.column(c).to_numpy()[order] for c in ("pair", "n", "best")))

    def look_up(batches) -> Iterator[pa.RecordBatch]:
        pairs, n, best = table.value
        for b in batches:
            lists, times = b.column(b.schema.get_field_index("pairs")), b.column(b.schema.get_field_index("times"))
            at = list_offsets(lists)
            pair, m = lists.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            where = np.minimum(np.searchsorted(pairs, pair), max(0, len(pairs) - 1))
            hit = pairs[where] == pair if len(pairs) else np.zeros(len(pair), bool)
            sums = (_total(np.where(hit & best[where], m, 0), at), _total(np.where(hit, n[where] * m, 0), at)) if len(pairs) else 2 * (np.zeros(b.num_rows, np.int64),)
            left = pa.array(np.concatenate(([0], np.cumsum(~hit)))[at].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in range(7)], *[pa.array(s) for s in sums], pa.ListArray.from_arrays(left, pa.array(pair[~hit])),
                 pa.ListArray.from_arrays(left, pa.array(m[~hit]))],
                [*b.schema.names[:7], "n_best", "count_sum", "rest", "rest_times"])

    plain = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "row"]
    kinds = ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in plain)
    got = rows.select(*plain, "pairs", "times").transform(in_tasks(
        look_up, f"{kinds}, n_best long, count_sum long, rest array<long>, rest_times array<long>"))
    if n_pairs > hot_pairs:      # the other pairs lie in few documents each
        got = materialize(got, "looked_up")
        rest = got.select("row", F.explode(F.arrays_zip(F.col("rest").alias("pair"), F.col("rest_times").alias("m"))).alias("x")).select("row", "x.*")
        more = rest.join(counts.select("pair", "n", "best"), "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("m")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("m")).alias("more_sum"))
        got = got.join(more, "row", "left").withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                                                         "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return got.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
