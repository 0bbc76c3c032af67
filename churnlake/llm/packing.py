"""Best-fit packing of documents into token sequences by a grouping genetic
algorithm on islands.

Pieces: a document's ids plus the end id; longer documents are cut into whole
sequences, the first piece taking the remainder.  Whole pieces are sequences
of their own; the rest are the items to group.

Items are dealt to blocks of about ``BLOCK_ITEMS`` by hash; each block is
solved by ``ISLANDS`` islands that start from different seeds.  An island's
population are groupings; crossover copies well-filled bins of one parent into
the other, removes the bins that hold duplicates of their items and best-fits
the displaced items (largest first, with Falkenauer's replacement step);
mutation dissolves bins that are not quite full.  A child costs its changed
bins only.  An island stops when it meets the lower bound
ceil(tokens / capacity), or after ``GENERATIONS`` children in a row without a
better grouping.  After each epoch the elite of every island migrates to the
next island of its block (the exchange is a Spark join on block and item), and
after the last one the best island's grouping is taken.

Then the items of bins filled below ``FULL`` are pooled from all blocks and
packed once more in new blocks, so that blocks do not each keep a half-empty
tail; the last round has few enough items for one block or the same schedule.

Only item counts reach the driver.  Blocks are hash-dealt, so equal lengths or
copies cannot make one block large.  Null text is a document of the end id
alone; repeated documents are packed as documents of their own; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import in_tasks, steps
from .encode import encoder, with_end

CAPACITY = 2048
BLOCK_ITEMS = 2000
ISLANDS = 2
EPOCHS = 2
POPULATION = 8
#: An island stops after so many children without a better grouping.
GENERATIONS = 40
FULL = 0.99
ROUNDS = 3

#: Numbers set aside for the bins of one block (a block has at most as many bins as items).
_BINS = 1 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, copy long"


def pieces(docs: DataFrame, vocab_path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, and ``copy``, a
    number of the document's row."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocab_path, drop_space=False)
        for b in steps(batches, "text"):
            ids, at = with_end(*enc.encode(b.column(1)), end_id)
            total = np.diff(at)
            first = (total - 1) % capacity + 1
            n = (total - first) // capacity + 1
            doc = np.repeat(np.arange(len(total)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = np.where(piece > 0, first[doc] + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first[doc])
            a = at[:-1][doc] + start
            crc = np.fromiter((zlib.crc32(ids[x:y].astype("<u4")) for x, y in zip(a.tolist(), (a + length).tolist())), np.int64, len(a))
            index = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(index), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc), b.column(2).take(index)], ["doc_id", "piece", "start", "length", "ids_crc32", "copy"])

    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"),
                      F.monotonically_increasing_id().alias("copy"))
    return src.transform(in_tasks(rows, PIECES))


# ---- one island ---------------------------------------------------------------------------------------


class Grouping:
    """Bins of items.  Bins are never altered, only replaced, and sums, the
    bin of every item and the measure are kept as bins change: a child shares
    its parent's bins and costs the changed ones only."""

    __slots__ = ("lengths", "capacity", "bins", "fill", "where", "holes", "square", "known")

    def __init__(self, lengths: list[int], capacity: int, bins=()):
        self.lengths, self.capacity = lengths, capacity
        self.bins, self.fill, self.holes, self.square = [], [], [], 0
        self.where = [-1] * len(lengths)
        self.known: dict[tuple[int, ...], list] = {}      # swaps of bins seen, shared with copies
        for b in bins:
            self.add(b)

    def __len__(self) -> int:
        return len(self.bins) - len(self.holes)

    def __iter__(self) -> Iterator[tuple[int, ...]]:
        return (b for b in self.bins if b is not None)

    def copy(self) -> Grouping:
        new = Grouping([], self.capacity)
        new.lengths, new.square, new.known = self.lengths, self.square, self.known
        new.bins, new.fill, new.where, new.holes = self.bins[:], self.fill[:], self.where[:], self.holes[:]
        return new

    def add(self, items) -> int:
        items = tuple(items)
        if self.holes:
            k = self.holes.pop()
        else:
            k = len(self.bins)
            self.bins.append(None)
            self.fill.append(0)
        self.put(k, items)
        return k

    def put(self, k: int, items: tuple[int, ...]) -> None:
        fill = sum(self.lengths[i] for i in items)
        self.square += fill * fill - self.fill[k] ** 2
        self.bins[k], self.fill[k] = items, fill
        for i in items:
            self.where[i] = k

    def remove(self, k: int) -> tuple[int, ...]:
        items = self.bins[k]
        self.square -= self.fill[k] ** 2
        self.bins[k], self.fill[k] = None, 0
        self.holes.append(k)
        return items

    def swaps(self, k: int) -> list[tuple[int, tuple[int, ...], int]]:
        """What the bin can give up (nothing, an item, two): tokens, items,
        and a mask of the sums that would fit instead."""
        items = self.bins[k]
        if items not in self.known:
            single = [(n, (i,)) for n, i in {self.lengths[i]: i for i in items}.items()]      # items of one length are alike
            outs = [(0, ()), *single, *((x + y, a + b) for (x, a), (y, b) in combinations(single, 2))]
            room = self.capacity - self.fill[k]
            self.known[items] = [(out, gone, (2 << (out + room)) - 1) for out, gone in outs]
        return self.known[items]

    def live(self) -> list[int]:
        return [k for k, b in enumerate(self.bins) if b is not None]

    def rank(self) -> tuple[int, int]:
        """Fewer bins first, then the grouping measure that rewards full bins (sum of squared fill)."""
        return len(self), -self.square


def _place(g: Grouping, items) -> Grouping:
    """Best fit, largest first: into the fullest bin that has room, a new one where none has."""
    if not items:
        return g
    lengths, capacity = g.lengths, g.capacity
    room = sorted((capacity - f, k) for k, f in enumerate(g.fill) if 0 < f < capacity)
    more: dict[int, list[int]] = {}
    size, fresh = len(g.bins), []
    for i in sorted(items, key=lengths.__getitem__, reverse=True):
        need = lengths[i]
        at = bisect_left(room, (need, -1))
        if at < len(room):
            free, k = room.pop(at)
            free -= need
        else:
            free, k = capacity - need, size + len(fresh)      # numbers of new bins go on where the bins end
            fresh.append(k)
        more.setdefault(k, []).append(i)
        if free:
            insort(room, (free, k))
    for k, got in more.items():
        if k < size:
            g.put(k, g.bins[k] + tuple(got))
    for k in fresh:
        g.add(more[k])
    return g


def best_fit(lengths: list[int], items: Sequence[int], bins, capacity: int) -> Grouping:
    """Place items by best fit beside the bins given."""
    return _place(Grouping(lengths, capacity, bins), items)


class _Loose:
    """Displaced items by length.  Bit t of ``one`` (``pairs()``) says that
    one item (two items) of t tokens in all can be taken."""

    def __init__(self, lengths: list[int], items):
        self.lengths, self.by, self.one, self._two = lengths, {}, 0, None
        self.give(items)

    def give(self, items) -> None:
        for i in items:
            self.by.setdefault(self.lengths[i], []).append(i)
            self.one |= 1 << self.lengths[i]
        self._two = None

    def pairs(self) -> int:
        if self._two is None:
            self._two = 0
            for n, held in self.by.items():
                self._two |= (self.one if len(held) > 1 else self.one ^ (1 << n)) << n
        return self._two

    def pop(self, n: int) -> int:
        held = self.by[n]
        i = held.pop()
        if not held:
            del self.by[n]
            self.one ^= 1 << n
        self._two = None
        return i

    def take(self, total: int, count: int) -> tuple[int, ...]:
        if count == 1:
            return (self.pop(total),)
        n = next(n for n, held in self.by.items() if total - n in self.by and (total != 2 * n or len(held) > 1))
        return self.pop(n), self.pop(total - n)

    def items(self) -> list[int]:
        return [i for held in self.by.values() for i in held]


def _few(most: int, rng: random.Random) -> int:
    """A number from 1 to ``most``, each order of magnitude as likely."""
    return int(math.exp(rng.uniform(0, math.log(max(2, most) + 0.99))))


def refit(g: Grouping, displaced, rng: random.Random) -> Grouping:
    """Best-fit displaced items, then empty some of the emptiest bins: every
    bin with room gives up to two items for one or two of theirs where that
    fills it best (smaller items are left, which fit more easily), and the
    rest is best-fitted again."""
    _place(g, displaced)
    emptiest = sorted((k for k, f in enumerate(g.fill) if 0 < f < FULL * g.capacity), key=g.fill.__getitem__)
    displaced = [i for k in emptiest[:_few(len(emptiest), rng)] for i in g.remove(k)]
    lengths, capacity = g.lengths, g.capacity
    loose = _Loose(lengths, displaced)
    open_bins = [k for k, f in enumerate(g.fill) if 0 < f < capacity]
    rng.shuffle(open_bins)
    for k in open_bins:
        if not loose.by:
            break
        room, one, two = capacity - g.fill[k], loose.one, loose.pairs()
        gain, move = 0, None
        for out, gone, low in g.swaps(k):
            total, pair = (one & low).bit_length() - 1, (two & low).bit_length() - 1      # the most that fits
            if total - out > gain:
                gain, move = total - out, (gone, total, 1)
            if pair - out > gain:
                gain, move = pair - out, (gone, pair, 2)
            if gain == room:
                break
        if move:
            gone, total, count = move
            taken = loose.take(total, count)
            g.put(k, tuple(i for i in g.bins[k] if i not in gone) + taken)
            loose.give(gone)
    return _place(g, loose.items())


def crossover(lengths: list[int], giver: Grouping, taker: Grouping, capacity: int, rng: random.Random) -> Grouping:
    """Inject well-filled bins of the giver whole, drop the taker's bins that
    share items with them, best-fit the displaced items."""
    ranked = sorted(giver.live(), key=giver.fill.__getitem__, reverse=True)
    new = [b for k in ranked[:max(1, len(ranked) // 2)] if (b := giver.bins[k]) != taker.bins[taker.where[b[0]]]]
    good = rng.sample(new, min(len(new), _few(len(ranked) // 20, rng)))
    child, displaced = taker.copy(), set()
    for k in {taker.where[i] for b in good for i in b}:
        displaced.update(child.remove(k))
    for b in good:
        displaced.difference_update(b)
        child.add(b)
    return refit(child, sorted(displaced), rng)


def mutate(lengths: list[int], bins: Grouping, capacity: int, rng: random.Random) -> Grouping:
    """Dissolve some bins that are not quite full."""
    child = bins.copy()
    some = [k for k, f in enumerate(child.fill) if 0 < f < capacity]
    gone = rng.sample(some, min(len(some), _few(len(child) // 20, rng) - 1))
    return refit(child, [i for k in gone for i in child.remove(k)], rng)


def _bins(assigned: np.ndarray) -> list[list[int]]:
    order = np.argsort(assigned, kind="stable")
    cut = np.flatnonzero(np.diff(assigned[order])) + 1
    return [x.tolist() for x in np.split(order, cut)]


def evolve(lengths: list[int], start: list[list[list[int]]], capacity: int, seed: int, generations: int = GENERATIONS,
           population: int = POPULATION) -> list[Grouping]:
    """The population, best first, once ``generations`` children in a row
    brought no better grouping or the lower bound is met."""
    rng = random.Random(seed)
    least = math.ceil(sum(lengths) / capacity)
    pop = [Grouping(lengths, capacity, b) for b in start] or [best_fit(lengths, range(len(lengths)), [], capacity)]
    best = min(pop, key=Grouping.rank)
    if len(best) == least:
        return [best]
    while len(pop) < population:
        pop.append(mutate(lengths, best, capacity, rng))
    idle = 0
    while idle < generations:
        giver, *some = rng.sample(range(len(pop)), min(4, len(pop)))
        at = min(some, key=lambda k: pop[k].rank())      # a tournament for the taker
        child, way = pop[at], rng.random()
        if way < 0.6:
            child = crossover(lengths, pop[giver], child, capacity, rng)
        if way > 0.3:
            child = mutate(lengths, child, capacity, rng)
        if child.rank() <= pop[at].rank():      # the taker's place: equals drift, a child is much like its taker
            pop[at] = child
        idle += 1
        if child.rank() < best.rank():
            best, idle = child, 0
            if len(best) == least:
                break
    return sorted(pop, key=Grouping.rank)


def _evolve_group(capacity: int, epoch: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", kind="stable")
        lengths = pdf["length"].tolist()
        held = np.stack(pdf["bins"].tolist(), 1) if len(pdf["bins"].iloc[0]) else []
        pop = evolve(lengths, [_bins(x) for x in held], capacity, seed=hash((int(key[0]), int(key[1]), epoch)))
        out = np.empty((len(pdf), len(pop)), np.int32)
        for j, bins in enumerate(pop):
            for k, b in enumerate(bins):
                out[list(b), j] = k
        return pdf[["block", "island", "item", "length"]].assign(bins=list(out), n=np.int32(len(pop[0])),
                                                                  fit=pop[0].square / max(1, len(pop[0])) / capacity ** 2)
    return run


_STATE = "block long, island int, item long, length long, bins array<int>, n int, fit double"


def _pack_round(items: DataFrame, capacity: int, n_items: int, salt: int) -> DataFrame:
    """(item, length, block, bin, fill) of the best island's grouping."""
    blocks = max(1, -(-n_items // BLOCK_ITEMS))
    state = (items.select(F.pmod(F.xxhash64("item", F.lit(salt)), F.lit(blocks)).alias("block"), "item", "length",
                          F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"), F.array().cast("array<int>").alias("bins")))
    for epoch in range(EPOCHS):
        if epoch:
            elite = state.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), "item", F.element_at("bins", 1).alias("_elite"))
            state = (state.join(elite, ["block", "island", "item"])
                     .withColumn("bins", F.concat(F.slice("bins", 1, POPULATION - 1), F.array("_elite"))).drop("_elite", "n", "fit"))
        state = materialize(state.groupBy("block", "island").applyInPandas(_evolve_group(capacity, epoch), _STATE), "pack_islands")
    best = (state.groupBy("block", "island").agg(F.first("n").alias("n"), F.first("fit").alias("fit"))
            .groupBy("block").agg(F.min_by("island", F.struct("n", -F.col("fit"), "island")).alias("island")))
    won = state.join(best, ["block", "island"]).select("item", "length", "block", F.element_at("bins", 1).alias("bin"))
    fill = won.groupBy("block", "bin").agg(F.sum("length").alias("fill"))
    return won.join(fill, ["block", "bin"])


def pack(docs: DataFrame, vocab_path: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    made = materialize(pieces(docs, vocab_path, end_id, capacity, id_col, text_col), "pieces")
    whole = made.filter(F.col("length") == capacity)
    # a document has at most one piece below a whole sequence: its row number names the item
    rest = made.filter(F.col("length") < capacity)
    items = rest.select(F.col("copy").alias("item"), "length")
    n, placed = rest.count(), None
    for r in range(rounds):
        if n == 0:
            break
        got = materialize(_pack_round(items, capacity, n, r), "packed")
        low = got.filter(F.col("fill") < FULL * capacity)
        left = low.count()
        last = r == rounds - 1 or n <= BLOCK_ITEMS or left == n
        done = (got if last else got.filter(F.col("fill") >= FULL * capacity)).select(
            "item", "length", ((F.col("block") * _BINS + F.col("bin")) * 2 * rounds + 2 * r + 1).alias("seq"))
        placed = done if placed is None else placed.unionByName(done)
        if last:
            break
        items, n = low.select("item", "length"), left
    out = [whole.select("doc_id", "piece", "start", "length", "ids_crc32", (F.monotonically_increasing_id() * 2).alias("sequence_id"),
                        F.lit(0).cast("long").alias("offset"))]
    if placed is not None:
        running = Window.partitionBy("seq").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
        at = placed.withColumn("offset", F.coalesce(F.sum("length").over(running), F.lit(0)).cast("long")).select("item", "seq", "offset")
        out.append(rest.join(at, rest["copy"] == at["item"]).select(
            "doc_id", "piece", "start", "length", "ids_crc32", F.col("seq").alias("sequence_id"), "offset"))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])
