"""SimHash near-duplicate detection by a binary-trie self-join.

Fingerprint: words are runs of anything but blank, tab, line feed, vertical
tab, form feed and carriage return, A-Z in lower case; shingles of three words
joined by blanks (repeats included; a shorter text is one shingle, a text
without words has fingerprint 0) are hashed with XXH64 (UTF-8, seed 42), and a
bit of the fingerprint is set if it is set in more than half of the hashes.

Links: two fingerprints that differ in at most ``k`` = 3 of 64 bits.  Rows are
first reduced to distinct fingerprints (partial aggregation), so a group of
copies is one row from then on.  A pair within 3 bits agrees in full on at
least one of four bit blocks, so the join is partitioned by (block number,
block value): in its partition the block is the trie's top part with an
exhausted error budget of zero, and the remaining bits form the trie that is
joined with itself.  A partition with more than ``SPLIT`` fingerprints is cut
again in the same way — four blocks of the bits that are left, one of which
must agree — so hot partitions spread over many tasks, level after level, until
few bits are left (at most 2^bits distinct fingerprints).

Inside a partition, pairs of trie nodes (prefixes) are walked together, one
bit a step: each step adds the differing bit to the pair's error count and
drops pairs beyond the budget, and leaves within it are linked.  Node pairs
that already belong to one component of the partition are dropped, too, so a
dense ball of near copies costs about its size, and the partition emits a
spanning forest instead of all pairs.

Components over the links: alternating large-star / small-star rounds on the
distinct fingerprints, each round written to the shared folder, until nothing
changes.  A component is named by its smallest doc_id.

Null text has no words.  Repeated doc_ids are rows of their own with the same
answer if their texts agree.  Null doc_ids keep a fingerprint and never name a
component unless all of it is null.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_path, materialize, scratch_path
from .common import in_tasks, steps, texts_of

SHINGLE = 3
MAX_BITS = 3
SPLIT = 2048
#: Bit blocks are cut while more than so many bits are free.
LEAST_FREE = 12
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set (bit 0 first)."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text (UTF-8 bytes)."""
    w = text.translate(_LOWER).split()
    if not w:
        return 0
    flat = b" ".join(w)
    n = max(1, len(w) - shingle + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(flat, 42)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(flat[a:b], 42) for a, b in zip(starts, ends[shingle - 1:].tolist())), np.uint64, n)
    return int(np.packbits(2 * _bit_counts(hashes) > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) for every row; ``fp`` is the fingerprint as a signed long."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            fps = [fingerprint(x, shingle) for x in texts_of(b.column(1)).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .transform(in_tasks(rows, f"id {kind}, fp long")).withColumnRenamed("id", id_col))


# ---- trie self-join inside a partition ----------------------------------------------------------------


def _find(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = int(parent[x])
    return x


def _roots(parent: np.ndarray) -> np.ndarray:
    """Every element's root, by pointer jumping."""
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent[:] = up


def trie_links(v: np.ndarray, starts: np.ndarray, k: int = MAX_BITS, frontier: int = 200_000) -> np.ndarray:
    """For every fingerprint the index of the smallest member of its component
    under links of at most ``k`` differing bits, partition by partition.

    ``v`` holds unsigned fingerprints, ascending inside each partition;
    ``starts`` are the partitions' first indices.  The tries are implicit: a
    node is a range of ``v`` whose members share the bits above ``depth``.
    Node pairs are expanded bit by bit in blocks of at most ``frontier``
    pairs, deepest first, so memory is bounded.
    """
    n = len(v)
    parent = np.arange(n)
    ends = np.append(starts[1:], n)

    def link(a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = _find(parent, x), _find(parent, y)
            if x != y:
                parent[max(x, y)] = min(x, y)

    first = np.stack((starts, ends, starts, ends), 1)
    first = first[ends - starts > 1]
    stack = [(64, first, np.full(len(first), k))] if len(first) else []
    while stack:
        depth, node, left = stack.pop()
        if len(node) > frontier:
            stack.append((depth, node[frontier:], left[frontier:]))
            node, left = node[:frontier], left[:frontier]
        a0, a1, b0, b1 = node.T
        # small pairs of nodes, leaves among them: the differing bits of every member pair
        small = (a1 - a0) * (b1 - b0) <= 16
        if small.any() or depth == 0:
            take = small if depth else np.ones(len(node), bool)
            na, nb = (a1 - a0)[take], (b1 - b0)[take]
            which = np.repeat(np.arange(len(na)), na * nb)
            inside = np.arange(len(which)) - np.repeat(np.cumsum(na * nb) - na * nb, na * nb)
            x, y = a0[take][which] + inside // nb[which], b0[take][which] + inside % nb[which]
            near = (x < y) & (np.bitwise_count(v[x] ^ v[y]) <= k)
            link(x[near], y[near])
            node, left = node[~take], left[~take]
            if not len(node):
                continue
            a0, a1, b0, b1 = node.T
        # node pairs whose members already hang together need no visit
        root = _roots(parent)
        change = np.concatenate(([0], np.cumsum(root[1:] != root[:-1])))
        done = (root[a0] == root[b0]) & (change[a1 - 1] == change[a0]) & (change[b1 - 1] == change[b0])
        if done.any():
            node, left = node[~done], left[~done]
            if not len(node):
                continue
            a0, a1, b0, b1 = node.T
        bit = np.uint64(1 << (depth - 1))
        unset = np.concatenate(([0], np.cumsum((v & bit) == 0)))
        am, bm = a0 + unset[a1] - unset[a0], b0 + unset[b1] - unset[b0]      # members with the bit unset come first
        node = np.concatenate([np.stack((a0, am, b0, bm), 1), np.stack((am, a1, bm, b1), 1),
                               np.stack((a0, am, bm, b1), 1), np.stack((am, a1, b0, bm), 1)])
        itself = (a0 == b0) & (a1 == b1)      # its two children meet once only
        left = np.concatenate([left, left, left - 1, np.where(itself, -1, left - 1)])
        full = (left >= 0) & (node[:, 1] > node[:, 0]) & (node[:, 3] > node[:, 2])
        if full.any():
            stack.append((depth - 1, node[full], left[full]))
    return _roots(parent)


# ---- partitions ---------------------------------------------------------------------------------------


def _blocks(free: int) -> list[int]:
    """Masks of four blocks of the set bits of ``free``."""
    bits = [i for i in range(64) if free >> i & 1]
    cut = [len(bits) * j // (MAX_BITS + 1) for j in range(MAX_BITS + 2)]
    return [sum(1 << i for i in bits[a:b]) for a, b in zip(cut, cut[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keyed(df: DataFrame) -> DataFrame:
    """A row for each of the four blocks of the bits outside ``fixed``: in the
    partition (fixed, key) the bits of ``fixed`` and of the block agree."""
    masks = [r["fixed"] for r in df.select("fixed").distinct().collect()]      # 4^level values at most
    step = None
    for m in masks:
        free = ~m & ((1 << 64) - 1)
        arr = F.array(*[F.lit(_signed(m & ((1 << 64) - 1) | b)) for b in _blocks(free)])
        step = F.when(F.col("fixed") == m, arr) if step is None else step.when(F.col("fixed") == m, arr)
    step = F.array().cast("array<long>") if step is None else step      # no rows at all
    return (df.withColumn("fixed", F.explode(step))
            .withColumn("key", F.col("fp").bitwiseAND(F.col("fixed"))))


def links(distinct: DataFrame, split: int = SPLIT, k: int = MAX_BITS) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints (column fp)."""
    if k > MAX_BITS:
        raise ValueError(f"blocks are cut for at most {MAX_BITS} differing bits")

    def join_sorted(batches) -> Iterator[pa.RecordBatch]:
        """Rows of a task, sorted by (fixed, key): whole partitions at a time."""
        rest = np.zeros((0, 3), np.int64)
        for b in batches:
            rest = np.concatenate((rest, np.stack([b.column(i).to_numpy() for i in range(3)], 1)))
            last = np.flatnonzero((rest[1:, 0] != rest[:-1, 0]) | (rest[1:, 1] != rest[:-1, 1])) + 1
            if len(last):
                yield from join(rest[:last[-1]])
                rest = rest[last[-1]:]
        if len(rest):
            yield from join(rest)

    def join(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = np.concatenate(([0], np.cumsum((rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1]))))
        v = np.ascontiguousarray(rows[:, 2]).view(np.uint64)
        v = v[np.lexsort((v, part))]
        starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        root = trie_links(v, starts, k)
        other = root != np.arange(len(v))
        if other.any():
            yield pa.RecordBatch.from_arrays([pa.array(v[root[other]].view(np.int64)), pa.array(v[other].view(np.int64))], ["a", "b"])

    out = None
    level = distinct.select("fp", F.lit(0).cast("long").alias("fixed"))
    free = 64
    while True:
        keyed = _keyed(level)
        free -= free // (MAX_BITS + 1)
        hot = None
        if free > LEAST_FREE:      # below, a partition has at most 2^free members
            hot = materialize(keyed.groupBy("fixed", "key").count().filter(F.col("count") > split).drop("count"), "simhash_hot_keys")
            hot = None if hot.isEmpty() else hot
        rows = keyed if hot is None else keyed.join(hot, ["fixed", "key"], "left_anti")
        part = (rows.select("fixed", "key", "fp").repartition("fixed", "key").sortWithinPartitions("fixed", "key")
                .transform(in_tasks(join_sorted, "a long, b long")))
        out = part if out is None else out.unionByName(part)
        if hot is None:
            return out
        level = materialize(keyed.join(hot, ["fixed", "key"], "left_semi").select("fp", "fixed").distinct(), "simhash_hot")


# ---- components ---------------------------------------------------------------------------------------


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node."""
    spark = edges.sparkSession

    def store(df: DataFrame) -> tuple[DataFrame, str]:
        path = scratch_path(spark, "components")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return (both.filter("v > u").join(low, "u").filter("v <> m")
                .select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        joined = down.join(low, "u")
        return (joined.select(F.col("m").alias("a"), F.col("u").alias("b"))
                .unionByName(joined.filter("v <> m").select(F.col("m").alias("a"), F.col("v").alias("b"))).distinct())

    e, path = store(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    mark = None
    for _ in range(max_rounds):
        e, new = store(small_star(large_star(e)))
        drop_path(spark, path)
        path = new
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            return e.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        mark = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, split: int = SPLIT) -> DataFrame:
    """Per document row: id, fp (signed long) and component_id."""
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min(id_col).alias("low")), "distinct_fingerprints")
    roots = components(links(distinct, split, max_bits))
    # the component's name is its smallest doc_id
    member = distinct.join(roots, distinct["fp"] == roots["node"]).select("fp", "root", "low")
    name = member.groupBy("root").agg(F.min("low").alias("name"))
    linked = member.join(name, "root").select("fp", "name")
    names = distinct.join(linked, "fp", "left").select("fp", F.coalesce("name", "low").alias("component_id"))
    return fps.join(names, "fp").select(id_col, "fp", "component_id")
