"""Second-order histogram boosting (T3, T4, T5): many models in one pass.

Every feature is cut into at most ``max_bins`` ranges once.  A pass over the
rows adds up, per model, open tree node and bin, the gradients, Hessians and
row counts of the logistic loss; partitions add up their own rows, and a
model's partial sums (nodes x bins x 3 numbers) meet in one task, which finds the best
cuts.  The driver gets a cut a node and asks for the next nodes.  All models of a job (learners, and their
refits without one fold each) share the passes.

* Regularised gain ``GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)`` and leaf weight
  ``-G/(H+l)``; missing values go to the side that gains more.
* Level-wise growth cuts every node of a level that gains.  Leaf-wise growth
  (``max_leaves``) always cuts the open leaf of the largest gain.  A pass
  prepares the children of every node that may still be among the cuts, so a
  tree takes as many passes as it has levels, not one a leaf; children that
  best-first order does not reach are thrown away.
* Where one task has all rows, every node's rows are kept; of two children only
  the one with fewer rows is added up, the other is its parent less its sibling.
  Features of few values are added up together, by the combinations that occur.
* Rows are drawn per tree by a hash of their key, features per tree by the
  seed.  Gradients are rounded to multiples of 2^-24, so sums are exact and a
  model does not depend on partitions, retries or their order.

Up to ``MODEL_ROWS`` rows every model gets a task of its own with all blocks (some 100 bytes a row).
Beyond, the rows stay in a persisted RDD of NumPy blocks (bins, label, fold, key and the
models' margins): the loop runs hundreds of short passes with per-partition
array work, for which planning a query each time would cost more than the
pass.  Margins are brought up to date every ``FOLD`` trees; lineage is cut by
``checkpoint()`` into the shared folder.
"""

from __future__ import annotations

import heapq
import json
import pickle
import threading
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .features import FEATURE_COLUMNS, LABEL

#: Rows of a block, and the most rows that one task takes per model.  A pass by rows costs a Spark job a tree level.
BLOCK_ROWS, MODEL_ROWS = 65_536, 1_000_000
#: Combinations of values up to which features are added up together.
COMBINED = 1024
#: Trees until margins are brought up to date, and such updates until lineage is cut.
FOLD = 6
CUT_LINEAGE = 10
#: Rows, times models, that are worth a partition of their own while there are idle cores, and the most rows of one.
LEAST_ROWS, MOST_ROWS = 65_536, 200_000
GRID = float(1 << 24)


@dataclass(frozen=True)
class BoostSpec:
    """Settings of a learner.  ``criterion`` "newton" cuts by regularised
    gain, "friedman" by the squared distance of the sides' mean residuals."""

    rounds: int
    max_depth: int
    learning_rate: float = 0.1
    subsample: float = 1.0
    colsample: float = 1.0
    max_leaves: int | None = None
    reg_lambda: float = 0.0
    min_child_weight: float = 0.0
    min_child_rows: int = 1
    criterion: str = "newton"
    importance: str = "gain"
    seed: int = 42


# ---- bins ----------------------------------------------------------------------------------------------


class Bins:
    """Cuts of every feature.  Bin numbers run through all features; the
    first bin of a feature holds its missing values, bin b > 0 the values in
    (cut[b-2], cut[b-1]]."""

    def __init__(self, features: list[str], cuts: list[np.ndarray]):
        self.features, self.cuts = features, cuts
        size = np.array([len(c) + 2 for c in cuts])
        self.start = np.cumsum(size) - size
        self.total = int(size.sum())
        self.feature = np.repeat(np.arange(len(cuts)), size)

    def of(self, values: list[np.ndarray]) -> np.ndarray:
        out = np.empty((len(values[0]) if values else 0, len(values)), np.int32)
        for j, x in enumerate(values):
            out[:, j] = self.start[j] + np.where(np.isnan(x), 0, np.searchsorted(self.cuts[j], x, side="left") + 1)
        return out


def find_bins(df: DataFrame, features, max_bins: int = 256) -> Bins:
    """Cuts at the quantiles: one aggregate over all features."""
    probs = ", ".join(f"{k / max_bins!r}D" for k in range(1, max_bins))
    value = "CASE WHEN NOT isnan(CAST(`{0}` AS DOUBLE)) THEN CAST(`{0}` AS DOUBLE) END".format
    row = df.agg(*[F.expr(f"percentile_approx({value(c)}, array({probs}), {50 * max_bins}) AS c{i}") for i, c in enumerate(features)],
                 *[F.expr(f"max({value(c)}) AS m{i}") for i, c in enumerate(features)]).first()
    cuts = []
    for i in range(len(features)):
        q = np.unique(np.array(row[f"c{i}"] or [], float))
        cuts.append(q[q < row[f"m{i}"]] if row[f"m{i}"] is not None else q[:0])
    return Bins(list(features), cuts)


# ---- trees ---------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes as arrays; a leaf has left = -1."""

    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def walk(self, bins: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The node each row of bin numbers ends in."""
        node = np.zeros(len(bins), np.int64)
        moving = np.flatnonzero(self.left[node] >= 0)
        while len(moving):
            n = node[moving]
            f = self.feature[n]
            b = bins[moving, f]
            go_left = np.where(b == start[f], self.missing_left[n], b <= self.bin[n])
            node[moving] = np.where(go_left, self.left[n], self.right[n])
            moving = moving[self.left[node[moving]] >= 0]
        return node


def best_cuts(s: BoostSpec, b: Bins, allowed: np.ndarray, h: np.ndarray) -> list[tuple]:
    """(gain, feature, bin, missing goes left, left sums) of each node's best cut."""
    cum = [np.cumsum(h[..., c], axis=1) for c in range(3)]
    first = b.start[b.feature]
    before = [np.where(first > 0, c[:, np.maximum(first - 1, 0)], 0.0) for c in cum]
    total = [(c[:, -1] - (c[:, b.start[-1] - 1] if b.start[-1] else 0.0))[:, None] for c in cum]
    gains = []
    missing = [[c[:, first] for c in cum], before]             # missing right, missing left
    for less in missing if h[:, b.start, 2].any() else missing[:1]:      # without missing values both are the same
        left = [c - x for c, x in zip(cum, less)]
        right = [t - x for t, x in zip(total, left)]
        ok = (allowed & (np.arange(b.total) > first) & (left[2] >= s.min_child_rows) & (right[2] >= s.min_child_rows)
              & (left[1] >= s.min_child_weight) & (right[1] >= s.min_child_weight))
        with np.errstate(divide="ignore", invalid="ignore"):
            if s.criterion == "friedman":
                gain = (left[2] * right[2] / total[2]) * (left[0] / left[2] - right[0] / right[2]) ** 2
            else:
                gain = left[0] ** 2 / (left[1] + s.reg_lambda) + right[0] ** 2 / (right[1] + s.reg_lambda) - total[0] ** 2 / (total[1] + s.reg_lambda)
        gains.append(np.where(ok & np.isfinite(gain), gain, 0.0))
    both = np.stack(gains, 1)
    at = both.reshape(len(h), -1).argmax(1)
    side, t = np.divmod(at, b.total)
    out = []
    for i in range(len(h)):
        j = int(t[i])
        left = np.array([c[i, j] - x[i, j] for c, x in zip(cum, missing[side[i]])])
        gain = float(both[i, side[i], j])
        out.append((gain if gain > 1e-10 else 0.0, int(b.feature[j]), j, bool(side[i]), left))
    return out


def node_cuts(spec: BoostSpec, bins: Bins, allowed: np.ndarray, nodes: list[int], sums: np.ndarray) -> tuple[dict[int, tuple], np.ndarray | None]:
    """From the nodes' sums (nodes x bins x 3) their best cuts, and the root's own sums where it is among them."""
    root = sums[0, slice(bins.start[0], bins.start[1] if len(bins.start) > 1 else None)].sum(0) if nodes[0] == 0 else None
    return dict(zip(nodes, best_cuts(spec, bins, allowed, sums))), root


class Grower:
    """One model while it is fitted: its finished trees and the tree that grows."""

    def __init__(self, spec: BoostSpec, bins: Bins, base: float, fold: int | None):
        self.spec, self.bins, self.base, self.fold = spec, bins, base, fold
        self.trees: list[Tree] = []
        self.pending: list[Tree] = []      # not yet in the margins
        self.grown_as: list[int] = []      # of the last tree's nodes, their numbers while it grew
        self._start()

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.spec.rounds

    # ---- the growing tree ------------------------------------------------------------------------------

    def _start(self) -> None:
        s = self.spec
        n = len(self.bins.features)
        take = max(1, int(n * s.colsample))
        chosen = np.arange(n) if take == n else np.random.default_rng((s.seed, len(self.trees))).permutation(n)[:take]
        self.allowed = np.isin(self.bins.feature, chosen)
        self.nodes: list[dict] = []
        self._node(0)
        self.asked: list[tuple[int, int | None, int | None]] = [(0, None, None)]      # (node, sibling that needs a cut, their parent)

    def _node(self, depth: int, stats=None) -> int:
        self.nodes.append({"depth": depth, "stats": stats, "best": None, "kids": None})
        return len(self.nodes) - 1

    def tree_now(self) -> Tree:
        """The tree with every prepared cut, for placing rows."""
        return self._flat({i for i, n in enumerate(self.nodes) if n["kids"]})

    def _flat(self, cut: set[int]) -> Tree:
        n = len(self.nodes)
        t = Tree(np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool), np.full(n, -1, np.int64), np.full(n, -1, np.int64), np.zeros(n), np.zeros(n))
        for i in cut:
            t.gain[i], t.feature[i], t.bin[i], t.missing_left[i] = self.nodes[i]["best"][:4]
            t.left[i], t.right[i] = self.nodes[i]["kids"]
        return t

    def receive(self, cuts: dict[int, tuple], root: np.ndarray | None) -> None:
        """Best cuts of the asked nodes and their siblings, and the root's
        sums; afterwards ``asked`` holds the next nodes, or a tree has been
        finished."""
        if root is not None:
            self.nodes[0]["stats"] = root
        for i, best in cuts.items():
            self.nodes[i]["best"] = best
        self.asked = []
        cut = self._leafwise() if self.spec.max_leaves else self._levelwise()
        if not self.asked:
            self._finish(cut)

    def _cuttable(self, i: int) -> bool:
        n = self.nodes[i]
        return n["best"] is not None and n["best"][0] > 0 and n["depth"] < self.spec.max_depth

    def _prepare(self, i: int) -> None:
        """Make the children of a node and ask for what their own cuts need."""
        n = self.nodes[i]
        left, right = n["best"][4], n["stats"] - n["best"][4]
        n["kids"] = self._node(n["depth"] + 1, left), self._node(n["depth"] + 1, right)
        wanted = [k for k in n["kids"] if n["depth"] + 1 < self.spec.max_depth and self.nodes[k]["stats"][2] >= 2 * self.spec.min_child_rows]
        if wanted:
            small = min(n["kids"], key=lambda k: self.nodes[k]["stats"][2])
            self.asked.append((small, next((k for k in wanted if k != small), None), i))

    def _levelwise(self) -> set[int]:
        for i in range(len(self.nodes)):
            if not self.nodes[i]["kids"] and self._cuttable(i):
                self._prepare(i)
        return {i for i, n in enumerate(self.nodes) if n["kids"]}

    def _leafwise(self) -> set[int]:
        """Best-first order cuts the nodes with the largest least gain on
        their way from the root.  Those among the known ones get their
        children prepared; once all have, the order is played through."""
        most = self.spec.max_leaves - 1
        least: dict[int, float] = {}
        todo = [(0, np.inf)]
        while todo:
            i, above = todo.pop()
            if self._cuttable(i):
                least[i] = min(above, self.nodes[i]["best"][0])
                todo += [(k, least[i]) for k in self.nodes[i]["kids"] or ()]
        for i in sorted(least, key=lambda i: (-least[i], i))[:most]:
            if self.nodes[i]["kids"] is None:
                self._prepare(i)
        cut: set[int] = set()
        heap = [(-self.nodes[0]["best"][0], 0)] if self._cuttable(0) else []
        while heap and len(cut) < most and not self.asked:
            _, i = heapq.heappop(heap)
            if self.nodes[i]["kids"] is None:      # reached through equal gains only
                self._prepare(i)
            cut.add(i)
            for k in self.nodes[i]["kids"]:
                if self._cuttable(k):
                    heapq.heappush(heap, (-self.nodes[k]["best"][0], k))
        return cut

    def _finish(self, cut: set[int]) -> None:
        """Keep the cuts made, renumbered, and give the leaves their weights."""
        order, todo = [], [0]
        while todo:
            i = todo.pop()
            order.append(i)
            if i in cut:
                todo += reversed(self.nodes[i]["kids"])
        new = {i: k for k, i in enumerate(order)}
        whole = self._flat(cut)
        take = np.array(order)
        renumber = lambda x: np.array([new[int(k)] if k >= 0 else -1 for k in x[take]], np.int64)
        value = np.zeros(len(order))
        for i in order:
            if i not in cut:
                g, h, _ = self.nodes[i]["stats"]
                value[new[i]] = -self.spec.learning_rate * g / (h + self.spec.reg_lambda) if h + self.spec.reg_lambda > 0 else 0.0
        tree = Tree(whole.feature[take], whole.bin[take], whole.missing_left[take], renumber(whole.left), renumber(whole.right), value, whole.gain[take])
        self.grown_as = order
        self.trees.append(tree)
        self.pending.append(tree)
        if not self.done:
            self._start()


# ---- passes --------------------------------------------------------------------------------------------


def _drawn(key: np.ndarray, seed: int, tree: int, share: float) -> np.ndarray:
    """Rows of a tree's sample: a mixed 64-bit hash of key, seed and tree."""
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(seed * 1_000_003 + tree + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(float) / float(1 << 53) < share


def _gradients(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.round((p - y) * GRID) / GRID, np.round(p * (1.0 - p) * GRID) / GRID


def node_sums(bins: np.ndarray, slot: np.ndarray, n_slots: int, g: np.ndarray, h: np.ndarray, total: int) -> np.ndarray:
    """Sums of gradients, Hessians and rows per (slot, bin)."""
    at = (slot[:, None] * total + bins).ravel()
    wide = bins.shape[1]
    return np.stack([np.bincount(at, w, n_slots * total) for w in (np.repeat(g, wide), np.repeat(h, wide), None)], -1).reshape(n_slots, total, 3)


class ModelRows:
    """All rows that a model is fitted on, for a task that grows it alone: the
    sums are those of ``_sums_of``, over rows kept by node."""

    def __init__(self, blocks: list[tuple], grower: Grower):
        self.grower, b = grower, grower.bins
        keep = [np.flatnonzero(fold != grower.fold) if grower.fold is not None else slice(None) for _, _, fold, _, _ in blocks]
        bins = np.concatenate([x[0][k] for x, k in zip(blocks, keep)])
        self.y = np.concatenate([x[1][k] for x, k in zip(blocks, keep)])
        self.key = np.concatenate([x[3][k] for x, k in zip(blocks, keep)])
        self.margin = np.full(len(self.y), grower.base)
        sets = _combined(bins, b)
        self.sets = [which for _, *which in sets]
        # Small numbers that lie together: the combinations of a row, the bins of a feature.
        kind = np.min_scalar_type(max([n for n, *_ in self.sets] + [len(c) + 2 for c in b.cuts]))
        self.codes = np.stack([code.astype(kind) for code, *_ in sets], 1)
        self.columns = [(bins[:, j] - first).astype(kind) for j, first in enumerate(b.start)]
        self.rows: dict[int, np.ndarray] = {}
        self.kept: dict[int, np.ndarray] = {}

    def start(self) -> None:
        """The rows of the next tree, and their gradients."""
        spec = self.grower.spec
        drawn = _drawn(self.key, spec.seed, len(self.grower.trees), spec.subsample) if spec.subsample < 1.0 else np.ones(len(self.y), bool)
        self.g, self.h = _gradients(self.margin, self.y)
        self.rows, self.kept, self.others = {0: np.flatnonzero(drawn)}, {}, np.flatnonzero(~drawn)

    def sides(self, rows: np.ndarray, f: int, t: int, missing_left: bool) -> tuple[np.ndarray, np.ndarray]:
        """The rows on both sides of a cut."""
        b, t = self.columns[f][rows], t - self.grower.bins.start[f]
        left = (b <= t) if missing_left else (b <= t) & (b != 0)
        return rows[left], rows[~left]

    def sums(self) -> tuple[list[int], np.ndarray]:
        """The asked nodes with their siblings, and their sums."""
        g, total = self.grower, self.grower.bins.total
        if g.asked[0][0] == 0:
            self.start()
        for parent in {p for _, _, p in g.asked if p is not None}:
            self.rows |= zip(g.nodes[parent]["kids"], self.sides(self.rows[parent], *g.nodes[parent]["best"][1:4]))
        held = [self.rows[i] for i, _, _ in g.asked]
        slot, rows = np.repeat(np.arange(len(held)), [len(r) for r in held]), np.concatenate(held)
        grad, hess = self.g[rows], self.h[rows]
        wide = self.codes.shape[1]
        codes = self.codes.view(f"V{self.codes.itemsize * wide}").ravel()[rows].view(self.codes.dtype).reshape(len(rows), wide)
        out = np.empty((len(held), 3, total))
        for j, (n, spread, at) in enumerate(self.sets):
            cell = slot * n + codes[:, j]
            hist = np.stack([np.bincount(cell, w, len(held) * n).reshape(len(held), n) for w in (grad, hess, None)], 1)
            out[:, :, at] = hist if spread is None else (hist.reshape(-1, n) @ spread.T).reshape(len(held), 3, len(at))
        self.kept |= {i: x for (i, _, _), x in zip(g.asked, out)}
        self.kept |= {k: self.kept[p] - self.kept[i] for i, k, p in g.asked if k is not None}
        nodes = _with_siblings(g.asked)
        return nodes, np.moveaxis(np.stack([self.kept[i] for i in nodes]), 1, 2)

    def grown(self) -> None:
        """Add the finished tree to the margins: its nodes' rows are known as
        far as they were summed up, the rows that were not drawn are placed."""
        (t,), grown_as, self.grower.pending = self.grower.pending, self.grower.grown_as, []
        todo = [(0, self.rows[0], True), (0, self.others, False)]
        while todo:
            i, rows, known = todo.pop()
            if t.left[i] < 0:
                self.margin[rows] += t.value[i]
                continue
            kids = int(t.left[i]), int(t.right[i])
            if known and grown_as[kids[0]] in self.rows:
                todo += [(k, self.rows[grown_as[k]], True) for k in kids]
            elif len(rows):
                todo += [(k, r, False) for k, r in zip(kids, self.sides(rows, int(t.feature[i]), int(t.bin[i]), bool(t.missing_left[i])))]


def _combined(x: np.ndarray, b: Bins) -> list[tuple]:
    """Features dealt to sets of at most ``COMBINED`` combinations of bins: the
    combination of every row, how many there are, a 0/1 matrix from them to
    the bins (None for a feature alone), and those bins."""
    size = np.diff(np.append(b.start, b.total))
    out: list[tuple] = []
    code, held, combos = None, [], None

    def close() -> None:
        at = np.concatenate([np.arange(b.start[j], b.start[j] + size[j]) for j in held])
        spread = np.concatenate([combos[:, i] == np.arange(size[j])[:, None] for i, j in enumerate(held)]).astype(float)
        out.append((code, len(combos), spread, at))

    for j in np.argsort(size, kind="stable").tolist():
        own = x[:, j] - b.start[j]
        if size[j] > COMBINED // 4:
            out.append((own.astype(np.int64), int(size[j]), None, np.arange(b.start[j], b.start[j] + size[j])))
            continue
        if held:
            values, new = np.unique(code * size[j] + own, return_inverse=True)
            if len(values) <= COMBINED:
                code, combos = new.astype(np.int64), np.column_stack([combos[values // size[j]], values % size[j]])
                held.append(j)
                continue
            close()
        values, new = np.unique(own, return_inverse=True)
        code, held, combos = new.astype(np.int64), [j], values[:, None]
    if held:
        close()
    return out


def _with_siblings(asked: list[tuple]) -> list[int]:
    """The asked nodes, then their siblings that need a cut."""
    return [i for i, _, _ in asked] + [k for _, k, _ in asked if k is not None]


def _work(growers: list[Grower]) -> list[tuple]:
    """What tasks need of every model that still grows."""
    return [(m, g.pending, g.tree_now(), np.array(_with_siblings(g.asked)), g.fold, g.spec.seed, len(g.trees), g.spec.subsample)
            for m, g in enumerate(growers) if not g.done]


def _sums_of(block: tuple, work: list[tuple], start: np.ndarray, total: int) -> dict[int, np.ndarray]:
    bins, y, fold, key, margins = block
    out = {}
    for m, pending, tree, asked, left_out, seed, number, share in work:
        margin = margins[m] + sum(t.value[t.walk(bins, start)] for t in pending) if pending else margins[m]
        slot_of = np.full(len(tree.left), -1, np.int64)
        slot_of[asked] = np.arange(len(asked))
        use = np.ones(len(y), bool) if left_out is None else fold != left_out
        if share < 1.0:
            use &= _drawn(key, seed, number, share)
        rows = np.flatnonzero(use)
        slot = slot_of[tree.walk(bins[rows], start)] if len(tree.left) > 1 else np.zeros(len(rows), np.int64)
        rows, slot = rows[slot >= 0], slot[slot >= 0]
        g, h = _gradients(margin[rows], y[rows])
        out[m] = node_sums(bins[rows], slot, len(asked), g, h, total)
    return out


def _partial_sums(blocks: Iterator[tuple], work: list[tuple], start: np.ndarray, total: int) -> Iterator[tuple[int, np.ndarray]]:
    """The sums of every model over a partition."""
    out: dict[int, np.ndarray] = {}
    for block in blocks:
        for m, sums in _sums_of(block, work, start, total).items():
            out[m] = out[m] + sums if m in out else sums
    yield from out.items()


def _updated(block: tuple, new: dict[int, list[Tree]], start: np.ndarray) -> tuple:
    bins, y, fold, key, margins = block
    margins = margins.copy()
    for m, trees in new.items():
        for t in trees:
            margins[m] += t.value[t.walk(bins, start)]
    return bins, y, fold, key, margins


# ---- models --------------------------------------------------------------------------------------------


@dataclass
class Ensemble:
    """A fitted model: base margin and trees over the features' cuts."""

    features: list[str]
    cuts: list[np.ndarray]
    base: float
    trees: list[Tree] = field(repr=False)
    importance: str = "gain"

    def margin(self, values: list[np.ndarray]) -> np.ndarray:
        bins = Bins(self.features, self.cuts)
        b = bins.of(values)
        out = np.full(len(b), self.base)
        for t in self.trees:
            out += t.value[t.walk(b, bins.start)]
        return out

    def importances(self) -> list[float]:
        """Per feature: mean gain of its cuts ("gain"), their number ("split"),
        or total gain averaged over trees ("impurity"); the first and last sum to one."""
        n = len(self.features)
        if self.importance == "impurity":
            per = np.zeros(n)
            for t in self.trees:
                one = np.bincount(t.feature[t.left >= 0], t.gain[t.left >= 0], n)
                per += one / one.sum() if one.sum() else 0.0
        else:
            cut = np.concatenate([t.feature[t.left >= 0] for t in self.trees]) if self.trees else np.zeros(0, np.int64)
            count = np.bincount(cut, minlength=n).astype(float)
            if self.importance == "split":
                return count.tolist()
            total = np.bincount(cut, np.concatenate([t.gain[t.left >= 0] for t in self.trees]) if self.trees else None, n)
            per = np.divide(total, count, out=np.zeros(n), where=count > 0)
        return (per / per.sum() if per.sum() else per).tolist()

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON record through Spark's file layer."""
        trees = [{k: getattr(t, k).tolist() for k in Tree.__dataclass_fields__} for t in self.trees]
        record = {"features": self.features, "cuts": [c.tolist() for c in self.cuts], "base": self.base, "importance": self.importance, "trees": trees}
        spark.createDataFrame([(json.dumps(record),)], "model string").coalesce(1).write.mode("errorifexists").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Ensemble":
        r = json.loads(spark.read.text(path, wholetext=True).first()["value"])
        kinds = {"missing_left": bool, "value": float, "gain": float}
        trees = [Tree(**{k: np.array(v, kinds.get(k, np.int64)) for k, v in t.items()}) for t in r["trees"]]
        return cls(r["features"], [np.array(c, float) for c in r["cuts"]], r["base"], trees, r["importance"])


def scores(models: dict[str, Ensemble], df: DataFrame, keep=()) -> DataFrame:
    """``keep`` columns and, per row and model, (model, score): the probability of label 1."""
    features = next(iter(models.values())).features
    keep = list(keep)
    kept = df.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + (", " if keep else "") + "model string, score double"

    def run(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in b.columns[len(keep):]]
            for name, model in models.items():
                p = 1.0 / (1.0 + np.exp(-model.margin(values)))
                yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array([name] * b.num_rows, pa.string()), pa.array(p)],
                                                 [*b.schema.names[:len(keep)], "model", "score"])

    wide = df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(features)])
    _ship(df.sparkSession)
    return wide.mapInArrow(run, schema)


_shipped: set[str] = set()
_shipping = threading.Lock()      # fits side by side ship once


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, wherever the driver found it."""
    import tempfile
    import zipfile
    from pathlib import Path
    with _shipping:
        if spark.sparkContext.applicationId in _shipped:
            return
        root = Path(__file__).resolve().parents[1]
        path = Path(tempfile.mkdtemp(prefix="churnlake-code-")) / f"{root.name}-operators.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(path))
        _shipped.add(spark.sparkContext.applicationId)


# ---- training ------------------------------------------------------------------------------------------


def _blocks(df: DataFrame, bins: Bins, label: str, fold: str | None, key: str, block_rows: int) -> DataFrame:
    """The rows as blocks of NumPy bytes, a row each."""
    n_features = len(bins.features)

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(c).tobytes()], pa.binary()) for c in zip(*held)], ["x", "y", "fold", "key"])

        for b in batches:
            values = [b.column(i).to_numpy(zero_copy_only=False) for i in range(n_features)]
            cols = [bins.of(values), *[b.column(n_features + i).to_numpy(zero_copy_only=False).astype(t) for i, t in enumerate((float, np.int64, np.int64))]]
            if rows and rows + b.num_rows > block_rows:
                yield block()
                held, rows = [], 0
            held.append(cols)
            rows += b.num_rows
        if rows:
            yield block()

    cols = [F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(bins.features)]
    fold_col = F.coalesce(F.col(fold).cast("long"), F.lit(-1)) if fold else F.lit(-1).cast("long")
    wide = df.select(*cols, F.col(label).cast("double").alias("_y"), fold_col.alias("_fold"), F.col(key).cast("long").alias("_key"))
    return wide.mapInArrow(run, "x binary, y binary, fold binary, key binary")


def _parsed(x, y, fold, key, bases: list[float]) -> tuple:
    y = np.frombuffer(y, float)
    x = np.frombuffer(x, np.int32)
    return (x.reshape(len(y), len(x) // len(y)), y, np.frombuffer(fold, np.int64), np.frombuffer(key, np.int64), np.repeat(np.array(bases)[:, None], len(y), axis=1))


def fit_many(train: DataFrame, fits: list[tuple[BoostSpec, int | None]], features=FEATURE_COLUMNS, label: str = LABEL, fold: str | None = None,
             key: str = "k", max_bins: int = 256, bins: Bins | None = None, block_rows: int | None = None) -> list[Ensemble]:
    """Fit every (settings, fold left out or None) on the rows of ``train``,
    all in the same passes.  Deterministic for a seed and the rows given.  Up
    to ``MODEL_ROWS`` rows (``block_rows`` where given) are handed to one task a
    model instead, which makes the same passes over them; the models are the same."""
    spark = train.sparkSession
    _ship(spark)
    checkpoint_dir(spark)
    bins = bins or find_bins(train, features, max_bins)
    y = F.col(label).cast("double")
    rates = train.agg(F.count(F.lit(1)).alias("n"), F.struct(F.avg(y)).alias("all"),
                      *[F.struct(F.avg(F.when(F.coalesce(F.col(fold), F.lit(-1)) != k, y))).alias(f"f{k}") for k in sorted({k for _, k in fits if k is not None})]).first()
    growers = []
    for spec, k in fits:
        p = rates["all" if k is None else f"f{k}"][0]
        if p is None:
            raise ValueError("no rows to fit on")
        p = min(max(p, 1e-6), 1 - 1e-6)
        growers.append(Grower(spec, bins, float(np.log(p / (1 - p))), k))
    blocks = lambda df, rows: _blocks(df, bins, label, fold, key, rows)
    if rates["n"] <= (block_rows or MODEL_ROWS):
        trees = _fit_by_model(blocks(train, block_rows or BLOCK_ROWS), growers)
    else:
        trees = _fit_by_rows(blocks(_spread(train, rates["n"], len(fits)), block_rows or BLOCK_ROWS), growers)
    return [Ensemble(bins.features, bins.cuts, g.base, t, g.spec.importance) for g, t in zip(growers, trees)]


def _spread(df: DataFrame, n: int, models: int) -> DataFrame:
    """Rows over as many partitions as keep the cores busy, none of them too large."""
    parts = max(-(-n // MOST_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, -(-n * models // LEAST_ROWS)))
    return df.repartition(parts)


def _fit_by_rows(blocks: DataFrame, growers: list[Grower]) -> list[list[Tree]]:
    """Blocks over many tasks; a Spark job per pass serves every model."""
    bins, bases = growers[0].bins, [g.base for g in growers]
    start, total = bins.start, bins.total
    state = blocks.rdd.map(lambda r: _parsed(*r, bases)).persist(StorageLevel.MEMORY_AND_DISK)
    folds, old = 0, None
    while work := _work(growers):
        plan = {w[0]: (growers[w[0]].spec, bins, growers[w[0]].allowed, w[3].tolist()) for w in work}
        sums = state.mapPartitions(lambda part, work=work: _partial_sums(part, work, start, total)).reduceByKey(np.add, len(work))
        for m, (cuts, root) in sums.map(lambda row, plan=plan: (row[0], node_cuts(*plan[row[0]], row[1]))).collect():
            growers[m].receive(cuts, root)
        if old is not None:
            old.unpersist()
            old = None
        if max(len(g.pending) for g in growers) >= FOLD:
            new = {m: g.pending for m, g in enumerate(growers) if g.pending}
            old, state = state, state.map(lambda block, new=new: _updated(block, new, start)).persist(StorageLevel.MEMORY_AND_DISK)
            folds += 1
            if folds % CUT_LINEAGE == 0:
                state.checkpoint()
            for g in growers:
                g.pending = []
    state.unpersist()
    return [g.trees for g in growers]


def _fit_by_model(blocks: DataFrame, growers: list[Grower]) -> list[list[Tree]]:
    """All blocks to a task per model."""
    def fitted(m: int, held: list[tuple]) -> pa.RecordBatch:
        g = growers[m]
        rows = ModelRows(held, g)
        while not g.done:
            nodes, sums = rows.sums()
            g.receive(*node_cuts(g.spec, g.bins, g.allowed, nodes, sums))
            if g.pending:
                rows.grown()
        return pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([pickle.dumps(g.trees)], pa.binary())], ["m", "trees"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for b in batches:
            for i in range(b.num_rows):
                held.setdefault(b.column(0)[i].as_py(), []).append(_parsed(*[b.column(c)[i].as_buffer() for c in range(1, 5)], [0.0]))
        for m in sorted(held):
            yield fitted(m, held.pop(m))

    n = len(growers)
    dealt = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("m"), "*").repartitionById(n, "m")
    got = {r["m"]: pickle.loads(r["trees"]) for r in dealt.mapInArrow(run, "m int, trees binary").collect()}
    return [got[m] for m in range(n)]
