"""Exact top-k inner products over a bit-sliced index.

Vectors are quantised to integers.  The index holds blocks of rows, sorted by
id; for each attribute d and bit b of a block one bitmap tells which rows have
that bit set in ``x_d - low_d``.  A query's score of all rows of a block is
the weighted sum of slices, formed with bitmap arithmetic alone:

* weight w_d contributes each of its set bits k times each slice b as one
  bitmap of place value 2^(k+b); a negative weight takes the complement of
  the slice, which changes every row's sum by the same known amount;
* the bitmaps of a place value go through full adders (three in, a sum
  bitmap and a carry of the next place out) until one is left: the slice of
  the score.

The best k rows are selected from the score's most significant slice
downward.  Rows tied at the boundary are resolved exactly: the smallest ids
are taken, and every score is read back from the slices.

Rows are dealt evenly into blocks of about ``BLOCK_ROWS`` and meet queries in
groups of about ``GROUP_QUERIES``, one (block, group) pair at a time; each
pair gives at most k rows a query, and a window keeps the best k of all
blocks.  Every row is searched for every query; nothing is sampled or
approximated.

Defined results: vectors that are null, or hold a null or non-finite
component, take no part; neither do rows without id, nor vectors with a
component beyond 2^27 after quantisation, whose scores need not fit a long.
Vectors of unequal length count as padded with zeros (an empty vector is all
zeros).  A row is no candidate for queries of its own id; repeated rows are
candidates, and queries, each on its own.  An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlake.session import materialize

from .common import in_tasks, list_offsets

BLOCK_ROWS = 32_768
GROUP_QUERIES = 2_048
#: Pairs of block and query group at least, where there are enough queries, so that small tables use all cores too.
LEAST_PAIRS = 24
LIMIT = 1 << 27

#: A block (kind 1: ids, slices, lows, bits) or a group of queries (kind 0: ids, vectors, their length).
_PAYLOAD = "part long, kind int, ids binary, body binary, low binary, bits binary"


# ---- quantised rows ------------------------------------------------------------------------------------


def quantised(ids: pa.Array, vectors: pa.Array, scale: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids and integer vectors of the rows that take part; vectors come in
    matrices of equal length, in row order inside each."""
    lists = vectors.cast(pa.list_(pa.float64()))
    keep = pc.and_(ids.is_valid(), lists.is_valid())
    lists, ids = lists.filter(keep), ids.filter(keep)
    ids = ids.cast(pa.int64()).to_numpy(zero_copy_only=False)
    at = list_offsets(lists)
    flat = pc.fill_null(lists.flatten(), float("nan")).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore", over="ignore"):
        q = np.floor(flat * scale)
        bad = ~(np.abs(q) <= LIMIT)      # not a number, infinite or too large
    wrong = np.concatenate(([0], np.cumsum(bad)))
    good = np.flatnonzero(wrong[at[1:]] == wrong[at[:-1]])
    n = np.diff(at)[good]
    out_ids, out = [], []
    for width in np.unique(n).tolist():
        rows = good[n == width]
        out_ids.append(ids[rows])
        out.append(q[at[rows][:, None] + np.arange(width)].astype(np.int64) if width else np.zeros((len(rows), 0), np.int64))
    return np.concatenate(out_ids) if out_ids else np.zeros(0, np.int64), out


def padded(parts: list[np.ndarray]) -> np.ndarray:
    """One matrix of all rows, short vectors filled with zeros."""
    width = max((p.shape[1] for p in parts), default=0)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts]) if parts else np.zeros((0, 0), np.int64)


# ---- the index -----------------------------------------------------------------------------------------


class Block:
    """Bit slices of one block of rows, sorted by id."""

    def __init__(self, ids: np.ndarray, slices: np.ndarray, low: np.ndarray, bits: np.ndarray):
        self.ids, self.low, self.bits = ids, low, bits
        self.first = np.cumsum(bits) - bits            # where an attribute's slices start
        self.slices = slices                           # (sum of bits, words)
        self.both = np.concatenate((slices, ~slices))
        self.all = np.packbits(np.arange(slices.shape[1] * 64) < len(ids), bitorder="little").view(np.uint64)

    @classmethod
    def of_rows(cls, ids: np.ndarray, x: np.ndarray) -> "Block":
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        low = x.min(0) if len(x) else np.zeros(x.shape[1], np.int64)
        top = x.max(0) - low if len(x) else low
        bits = np.array([int(t).bit_length() for t in top.tolist()], np.int64)
        words = -(-len(ids) // 64)
        slices = np.zeros((int(bits.sum()), words * 8), np.uint8)
        at = 0
        for d, n in enumerate(bits.tolist()):
            rest = x[:, d] - low[d]
            for b in range(n):
                packed = np.packbits((rest >> b & 1).astype(bool), bitorder="little")
                slices[at, :len(packed)] = packed
                at += 1
        return cls(ids, slices.view(np.uint64), low, bits)

    # ---- one query -------------------------------------------------------------------------------------

    def score_slices(self, w: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of every row's score, least significant first, and the
        constant that was left out of them."""
        size = np.abs(w)
        spread = (1 << self.bits) - 1
        left_out = int((w * self.low).sum() - (size * spread)[w < 0].sum())
        # every (attribute, bit of the weight, slice) as a row of ``both`` and a place value
        d, k = np.nonzero(size[:, None] >> np.arange(int(size.max()).bit_length() if len(size) else 0) & 1)
        reps = self.bits[d]
        b = np.arange(int(reps.sum())) - np.repeat(np.cumsum(reps) - reps, reps)
        row = np.repeat(self.first[d] + np.where(w[d] < 0, len(self.slices), 0), reps) + b
        place = np.repeat(k, reps) + b
        order = np.argsort(place, kind="stable")
        row, place = row[order], place[order]
        out: list[np.ndarray] = []
        carry: list[np.ndarray] = []
        t = 0
        last = int(place[-1]) if len(place) else -1
        while t <= last or carry:
            lo, hi = np.searchsorted(place, (t, t + 1))
            level = np.concatenate([self.both[row[lo:hi]], *carry])
            carry = []
            while len(level) > 2:                      # full adders, a third of the bitmaps each
                m = len(level) // 3
                x, y, z = level[:m], level[m:2 * m], level[2 * m:3 * m]
                half = x ^ y
                carry.append((x & y) | (half & z))
                level = np.concatenate((half ^ z, level[3 * m:]))
            if len(level) == 2:
                carry.append((level[0] & level[1])[None])
                level = (level[0] ^ level[1])[None]
            out.append(level[0] if len(level) else np.zeros_like(self.all))
            t += 1
        return out, left_out

    def best(self, own: int, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows whose id is not ``own``."""
        width = max(len(w), len(self.bits))
        if width > len(self.bits):
            w = w[:len(self.bits)]                     # rows have zeros there
        elif width > len(w):
            w = np.pad(w, (0, width - len(w)))
        slices, left_out = self.score_slices(w)
        chosen, open_ = np.zeros_like(self.all), self.all.copy()
        lo, hi = np.searchsorted(self.ids, (own, own + 1))
        for r in range(lo, hi):
            open_[r >> 6] &= ~np.uint64(1 << (r & 63))
        for s in reversed(slices):
            ones = open_ & s
            n = int(np.bitwise_count(chosen | ones).sum())
            if n > k:
                open_ = ones
            else:
                chosen |= ones
                open_ &= ~s
                if n == k:
                    open_[:] = 0
                    break
        rows = _positions(chosen)
        tied = _positions(open_)[:k - len(rows)]       # rows lie in id order
        rows = np.concatenate((rows, tied))
        score = np.full(len(rows), left_out, np.int64)
        for t, s in enumerate(slices):
            score += (s[rows >> 6] >> (rows & 63).astype(np.uint64) & np.uint64(1)).astype(np.int64) << t
        return self.ids[rows], score


def _positions(bitmap: np.ndarray) -> np.ndarray:
    words = np.flatnonzero(bitmap)
    if not len(words):
        return np.zeros(0, np.int64)
    bits = np.unpackbits(bitmap[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    w, b = np.nonzero(bits)
    return words[w] * 64 + b


# ---- tasks ---------------------------------------------------------------------------------------------


def _gathered(batches, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """All rows of a partition that take part."""
    ids, parts = [], []
    for b in batches:
        i, x = quantised(b.column(0), b.column(1), scale)
        ids.append(i)
        parts += x
    return (np.concatenate(ids), padded(parts)) if sum(map(len, ids)) else None


def _payload(kind: int, ids: np.ndarray, *rest: np.ndarray) -> pa.RecordBatch:
    """One row; ``part`` is the number of the partition."""
    part = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([kind], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in (ids, *rest)]],
        ["part", "kind", "ids", "body", "low", "bits"])


def _build_block(scale: float):
    def build(batches) -> Iterator[pa.RecordBatch]:
        if (rows := _gathered(batches, scale)) is not None:
            b = Block.of_rows(*rows)
            yield _payload(1, b.ids, b.slices, b.low, b.bits)
    return build


def _build_group(scale: float):
    def build(batches) -> Iterator[pa.RecordBatch]:
        if (rows := _gathered(batches, scale)) is not None:
            ids, x = rows
            yield _payload(0, ids, np.ascontiguousarray(x), np.array([x.shape[1]], np.int64), np.zeros(0, np.int64))
    return build


def _meet(k: int, n_groups: int):
    """Search the block that follows a group of queries in a partition, pair by pair."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        part, ids, x = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                this, kind = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                raw = [np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in (2, 4, 5)]
                body = batch.column(3)[i].as_buffer()
                if kind == 0:
                    part, ids, x = this, raw[0], np.frombuffer(body, np.int64).reshape(len(raw[0]), int(raw[1][0]))
                    continue
                if this != part:
                    continue                           # a block whose group of queries is empty
                words = -(-len(raw[0]) // 64)
                block = Block(raw[0], np.frombuffer(body, np.uint64).reshape(int(raw[2].sum()), words), raw[1], raw[2])
                got = [block.best(q, w, k) for q, w in zip(ids.tolist(), x)]
                n = [len(a) for a, _ in got]
                key = (this % n_groups << 32) + np.arange(len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(key, n)), pa.array(np.repeat(ids, n)), pa.array(np.concatenate([a for a, _ in got])),
                                                  pa.array(np.concatenate([s for _, s in got]))], ["key", "query_id", "vec_id", "score"])
    return run


def index_blocks(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0,
                 n_blocks: int = 1) -> DataFrame:
    """The bit-sliced index: a row for each of ``n_blocks`` blocks (none for an empty one)."""
    return vectors.select(id_col, vector_col).repartition(n_blocks).transform(in_tasks(_build_block(scale), _PAYLOAD))


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: float = 256.0,
          block_rows: int = BLOCK_ROWS, group_queries: int = GROUP_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): every query row's k best rows by
    integer inner product, ties to the smaller id."""
    n_rows, n_queries = vectors.count(), queries.count()
    n_blocks = max(1, -(-n_rows // block_rows))
    n_groups = max(1, -(-n_queries // group_queries), min(-(-LEAST_PAIRS // n_blocks), -(-n_queries // 64)))
    blocks = materialize(index_blocks(vectors, id_col, vector_col, scale, n_blocks), "bit_slices")
    groups = materialize(queries.select(id_col, vector_col).repartition(n_groups).transform(in_tasks(_build_group(scale), _PAYLOAD)), "query_groups")

    def spread(df: DataFrame, parts) -> DataFrame:
        return df.select(F.explode(parts).alias("part"), *df.columns[1:])

    every_group = F.sequence(F.col("part") * n_groups, F.col("part") * n_groups + (n_groups - 1))
    every_block = F.sequence(F.col("part"), F.col("part") + (n_blocks - 1) * n_groups, F.lit(n_groups).cast("long"))
    pairs = spread(groups, every_block).unionByName(spread(blocks, every_group))
    pairs = pairs.repartitionById(n_blocks * n_groups, F.col("part").cast("int")).sortWithinPartitions("part", "kind")
    hits = pairs.transform(in_tasks(_meet(k, n_groups), "key long, query_id long, vec_id long, score long"))
    w = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
