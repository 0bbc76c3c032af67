"""Random forests whose trees are grown and kept by tasks.

``pyspark.ml`` holds every node of every tree on the driver while it fits, saves
and scores.  Here a task gets all rows as bytes (a byte a feature) and grows
some of the trees; they are written to the shared folder by the task, 10 bytes
a node.  The driver knows where they lie, their number and importances.

The method is that of ``pyspark.ml``'s forest: at most 32 bins a feature, a
Poisson(1) sample of the rows a tree, the square root of the number of features
drawn a node, Gini gain, ``minInstancesPerNode`` drawn rows in a child, leaves
of one parent that decide alike merged, a tree's vote its leaf's share of label
1.  Missing values are an error while fitting; while scoring they count as the
largest.

A tree's rows are kept in order of its open nodes, so a level is a sum a drawn
feature over neighbouring cells.  Draws depend on seed, tree and the rows'
contents alone, not on partitions or order.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import boosting as BO

#: Bins of a feature.
MAX_BINS = 32
#: Trees that a task grows, the rows of a block, and the most rows that a task takes (some 150 bytes a row while it grows a tree).
TASK_TREES, BLOCK_ROWS, TASK_ROWS = 10, 65_536, 4_000_000
#: A row's weight and that of its label are added up in one number.
POSITIVE = float(1 << 26)
#: Gini gain, times rows, that no cut reaches by rounding.
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class ForestSpec:
    trees: int
    max_depth: int
    min_rows: int = 1
    seed: int = 42


def find_cuts(df: DataFrame, bins: BO.Bins) -> list[np.ndarray]:
    """The quantiles that boosting cuts at, 31 of them where there are more,
    and the least value, which may be too rare for a quantile."""
    value = "CASE WHEN NOT isnan(CAST(`{0}` AS DOUBLE)) THEN CAST(`{0}` AS DOUBLE) END".format
    ends = df.agg(*[F.expr(f"{f}({value(c)}) AS {f}{i}") for i, c in enumerate(bins.features) for f in ("min", "max")]).first()
    out = []
    for i, c in enumerate(bins.cuts):
        low, high = ends[f"min{i}"], ends[f"max{i}"]
        c = np.union1d(c, [low]) if low is not None and low < high else c
        out.append(c if len(c) < MAX_BINS else c[np.arange(1, MAX_BINS) * len(c) // MAX_BINS])
    return out


def binned(values: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """Bin b holds the values in (cut[b-1], cut[b]], the last one the missing values too."""
    out = np.empty((len(values[0]) if values else 0, len(values)), np.uint8)
    for j, x in enumerate(values):
        out[:, j] = np.searchsorted(cuts[j], x, side="left")
    return out


# ---- trees ---------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes as arrays; a leaf has left = -1, a right child stands behind the left one."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray

    KINDS = (("feature", np.uint8), ("bin", np.uint8), ("left", np.int32), ("value", np.float32))

    def packed(self) -> bytes:
        return b"".join(getattr(self, k).astype(t).tobytes() for k, t in self.KINDS)

    @classmethod
    def unpacked(cls, data: bytes) -> "Tree":
        n, at, out = len(data) // sum(np.dtype(t).itemsize for _, t in cls.KINDS), 0, []
        for _, t in cls.KINDS:
            out.append(np.frombuffer(data, t, n, at))
            at += out[-1].nbytes
        return cls(*out)

    def votes(self, x: np.ndarray) -> np.ndarray:
        """The share of label 1 in the leaf of each row of bins."""
        flat, wide = x.ravel(), x.shape[1]
        node = np.zeros(len(x), np.int32)
        moving = np.arange(len(x) if self.left[0] >= 0 else 0)
        while len(moving):
            n = node[moving]
            to = self.left[n] + (flat[moving * wide + self.feature[n]] > self.bin[n])
            node[moving] = to
            moving = moving[self.left[to] >= 0]
        return self.value[node]


def _split_sums(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows, and rows of label 1, of sums of both."""
    positive = np.floor(sums / POSITIVE)
    return sums - positive * POSITIVE, positive


def _impure(n: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Half the Gini impurity, times rows."""
    return positive * (n - positive) / n


def _best_cuts(s: ForestSpec, x: np.ndarray, at: np.ndarray, weight: np.ndarray, count: np.ndarray, whole: np.ndarray,
               sizes: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(impurity left, feature, bin) of the best cut of every open node among its chosen features."""
    nodes = len(count)
    least, feature, cut = np.full(nodes, np.inf), np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
    for f in chosen.T:
        size = sizes[f]
        end = np.cumsum(size)
        first = end - size
        sums = np.cumsum(np.bincount(np.repeat(first, count) + x.take(at + np.repeat(f, count)), weight, end[-1]))
        left = sums - np.repeat(np.where(first > 0, sums[first - 1], 0.0), size)
        n, positive = _split_sums(left)
        n_right, positive_right = _split_sums(np.repeat(whole, size) - left)
        with np.errstate(divide="ignore", invalid="ignore"):
            impure = np.where((n >= s.min_rows) & (n_right >= s.min_rows) & (n > 0) & (n_right > 0),
                              _impure(n, positive) + _impure(n_right, positive_right), np.inf)
        best = np.minimum.reduceat(impure, first)
        hit = np.flatnonzero(impure == np.repeat(best, size))[::-1]
        where = np.empty(nodes, np.int64)
        where[np.repeat(np.arange(nodes), size)[hit]] = hit       # the first of equal ones is written last
        better = best < least
        least = np.where(better, best, least)
        feature, cut = np.where(better, f, feature), np.where(better, where - first, cut)
    return least, feature, cut


def grow(s: ForestSpec, bins: np.ndarray, y: np.ndarray, drawn: np.ndarray, sizes: np.ndarray, draw: np.random.Generator,
         take: int) -> tuple[Tree, np.ndarray]:
    """A tree over rows that are drawn so many times each, and the gain of its features."""
    wide = bins.shape[1]
    rows = np.flatnonzero(drawn)
    held = np.ascontiguousarray(bins).view(f"V{wide}").ravel()[rows]
    x, at = held.view(np.uint8), np.arange(len(rows)) * wide
    weight = drawn[rows] + drawn[rows] * y[rows] * POSITIVE
    count, whole = np.array([len(rows)]), np.array([weight.sum()])
    n_nodes = 1
    stats, levels = [whole], []       # sums of every level's nodes; what was cut on it
    least_rows = max(2 * s.min_rows, 2)

    def openable(sums: np.ndarray) -> np.ndarray:
        n, positive = _split_sums(sums)
        return (n >= least_rows) & (positive > 0) & (positive < n)

    ids = np.arange(1)[openable(whole)]
    while len(ids) and len(levels) < s.max_depth:
        chosen = draw.random((len(ids), wide)).argpartition(take - 1, axis=1)[:, :take] if take < wide else np.tile(np.arange(wide), (len(ids), 1))
        impure, feature, cut = _best_cuts(s, x, at, weight, count, whole, sizes, chosen)
        gain = _impure(*_split_sums(whole)) - impure
        made = gain > LEAST_GAIN
        k = int(made.sum())
        if not k:
            break
        rows, count = np.flatnonzero(np.repeat(made, count)), count[made]
        feature, cut = feature[made], cut[made]
        levels.append((ids[made], feature, cut, n_nodes + 2 * np.arange(k), gain[made]))
        child = np.repeat(2 * np.arange(k), count) + (x.take(at[rows] + np.repeat(feature, count)) > np.repeat(cut, count))
        sums = np.bincount(child, weight[rows], 2 * k)
        stats.append(sums)
        more = openable(sums)
        kept = more[child]
        child, rows = (np.cumsum(more) - 1)[child[kept]], rows[kept]
        rows = rows[np.argsort(child.astype(np.uint16) if more.sum() < 1 << 16 else child, kind="stable")]
        held, weight, whole = held[rows], weight[rows], sums[more]      # rows lie by node, so a level reads them in order
        x, at = held.view(np.uint8), at[:len(rows)]
        count = np.bincount(child, minlength=int(more.sum()))
        ids = n_nodes + np.flatnonzero(more)
        n_nodes += 2 * k
    return _merged(np.concatenate(stats), levels, wide)


def _merged(sums: np.ndarray, levels: list[tuple], wide: int) -> tuple[Tree, np.ndarray]:
    """The tree without cuts whose sides are leaves that decide alike."""
    n, positive = _split_sums(sums)
    decides, left = positive > n - positive, np.full(len(n), -1, np.int64)
    feature, cut, gain = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), np.zeros(len(n))
    for ids, f, c, kids, g in reversed(levels):
        keep = (left[kids] >= 0) | (left[kids + 1] >= 0) | (decides[kids] != decides[kids + 1])
        ids = ids[keep]
        left[ids], feature[ids], cut[ids], gain[ids] = kids[keep], f[keep], c[keep], g[keep]
    reached = np.zeros(len(n), bool)
    reached[0] = True
    for ids, *_ in levels:
        ids = ids[reached[ids] & (left[ids] >= 0)]
        reached[left[ids]] = reached[left[ids] + 1] = True
    number = np.cumsum(reached) - 1
    at = np.flatnonzero(reached)
    cuts = at[left[at] >= 0]
    value = np.divide(positive, n, out=np.zeros(len(n)), where=n > 0)
    tree = Tree(feature[at], cut[at], np.where(left[at] >= 0, number[left[at]], -1), value[at])
    return tree, np.bincount(feature[cuts], gain[cuts], wide)


def ordered(bins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows in an order of their contents: rows that are alike may change places."""
    h = np.full(len(y), 0xBF58476D1CE4E5B9, np.uint64)
    with np.errstate(over="ignore"):
        for c in (y, *bins.T):
            h = (h ^ c.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    return bins[order], y[order]


# ---- fitting -------------------------------------------------------------------------------------------


def _blocks(df: DataFrame, features, cuts: list[np.ndarray], label: str, fold: str | None) -> DataFrame:
    wide = len(features)

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([np.concatenate(c).tobytes()], pa.binary()) for c in zip(*held)], ["x", "y", "fold"])

        for b in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if not np.isin(cols[wide], (0, 1)).all():
                raise ValueError("labels must be 0 or 1")
            if not all(np.isfinite(c).all() for c in cols[:wide]):
                raise ValueError("features must not be missing or infinite")
            held.append((binned(cols[:wide], cuts), cols[wide].astype(np.uint8), cols[wide + 1].astype(np.int32)))
            if sum(len(y) for _, y, _ in held) >= BLOCK_ROWS:
                yield block()
                held = []
        if held:
            yield block()

    fold_col = F.coalesce(F.col(fold).cast("int"), F.lit(-1)) if fold else F.lit(-1)
    cols = [F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(features)]
    return df.select(*cols, F.col(label).cast("int").alias("_y"), fold_col.alias("_fold")).mapInArrow(run, "x binary, y binary, fold binary")


TREES = "model int, tree int, importances array<double>, nodes binary"


def fit_many(train: DataFrame, fits: list[tuple[ForestSpec, int | None]], bins: BO.Bins, label: str, fold: str | None = None) -> list["Trees"]:
    """Fit every (settings, fold left out or None) on ``train``: one job, a task for some trees of a model."""
    spark, features = train.sparkSession, bins.features
    BO._ship(spark)
    cuts = find_cuts(train, bins)
    sizes = np.array([len(c) + 1 for c in cuts])
    wide = len(sizes)
    tasks = [(m, range(t, min(t + TASK_TREES, s.trees))) for m, (s, _) in enumerate(fits) for t in range(0, s.trees, TASK_TREES)]

    def grown(task: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        m, numbers = tasks[task]
        s, left_out = fits[m]
        bins, y, folds = (np.concatenate(c) for c in zip(*held))
        held.clear()
        if left_out is not None:
            bins, y = bins[folds != left_out], y[folds != left_out]
        bins, y = ordered(bins, y)
        take = int(np.ceil(np.sqrt(wide))) if s.trees > 1 else wide
        for t in numbers:
            draw = np.random.default_rng((s.seed, t))
            drawn = draw.poisson(1.0, len(y)) if s.trees > 1 else np.ones(len(y), np.int64)
            tree, gain = grow(s, bins, y, drawn, sizes, draw, take)
            yield pa.RecordBatch.from_arrays([pa.array([m], pa.int32()), pa.array([t], pa.int32()),
                                              pa.array([(gain / gain.sum() if gain.sum() else gain).tolist()], pa.list_(pa.float64())),
                                              pa.array([tree.packed()], pa.binary())], ["model", "tree", "importances", "nodes"])

    def run(batches) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for b in batches:
            for i in range(b.num_rows):
                x, y, folds = (np.frombuffer(b.column(c)[i].as_buffer(), t) for c, t in ((1, np.uint8), (2, np.uint8), (3, np.int32)))
                held.setdefault(b.column(0)[i].as_py(), []).append((x.reshape(len(y), wide), y, folds))
        for task in sorted(held):
            yield from grown(task, held.pop(task))

    n = len(tasks)
    dealt = _blocks(train, features, cuts, label, fold).select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("task"), "*").repartitionById(n, "task")
    stored = materialize(dealt.mapInArrow(run, TREES), "forests")
    found: list[list[tuple]] = [[] for _ in fits]
    for r in stored.select("model", "tree", "importances").collect():
        found[r["model"]].append((r["tree"], r["importances"]))
    gains = [np.sum([x for _, x in sorted(per)], axis=0).tolist() for per in found]
    if any(len(per) != s.trees for per, (s, _) in zip(found, fits)):
        raise ValueError("no rows to fit on")
    return [Trees(stored.filter(F.col("model") == m).drop("model"), features, cuts, s.trees, gains[m]) for m, (s, _) in enumerate(fits)]


@dataclass
class Trees:
    """Trees of a forest, as a table that tasks have written: all of its trees, or those numbered from ``first`` on."""

    table: DataFrame = field(repr=False)
    features: list[str]
    cuts: list[np.ndarray]
    getNumTrees: int
    gains: list[float] = field(default_factory=list)
    first: int = 0

    @property
    def stages(self) -> list["Trees"]:
        return [self]

    def part(self, first: int, trees: int) -> "Trees":
        return Trees(self.table, self.features, self.cuts, trees, first=first)

    def _rows(self) -> DataFrame:
        return self.table.filter(F.col("tree").between(self.first, self.first + self.getNumTrees - 1))

    def importances(self) -> list[float]:
        total = sum(self.gains)
        return [g / total if total else 0.0 for g in self.gains]

    def votes(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` and the sum of the trees' votes for label 1."""
        spark, cuts = df.sparkSession, self.cuts
        BO._ship(spark)
        packed = spark.sparkContext.broadcast([r["nodes"] for r in sorted(self._rows().select("tree", "nodes").toLocalIterator(), key=lambda r: r["tree"])])
        wide, kept = len(self.features), len(df.columns)
        out = df.withColumn(name, F.lit(0.0)).schema

        def run(batches) -> Iterator[pa.RecordBatch]:
            trees = [Tree.unpacked(t) for t in packed.value]
            for b in batches:
                x = binned([c.to_numpy(zero_copy_only=False) for c in b.columns[kept:kept + wide]], cuts)
                votes = np.zeros(len(x))
                for t in trees:
                    votes += t.votes(x)
                yield pa.RecordBatch.from_arrays([*b.columns[:kept], pa.array(votes)], [*b.schema.names[:kept], name])

        cols = [F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(self.features)]
        return df.select("*", *cols).mapInArrow(run, out)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``rawPrediction``, the sums of the trees' votes for both labels."""
        votes = self.votes(df, "_votes")
        return votes.withColumn("rawPrediction", array_to_vector(F.array(F.lit(float(self.getNumTrees)) - F.col("_votes"), F.col("_votes")))).drop("_votes")

    def save(self, spark: SparkSession, path: str) -> None:
        self._rows().write.parquet(f"{path}/trees")
        record = {"features": self.features, "cuts": [c.tolist() for c in self.cuts], "trees": self.getNumTrees, "gains": self.gains}
        spark.createDataFrame([(json.dumps(record),)], "forest string").coalesce(1).write.text(f"{path}/forest")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Trees":
        r = json.loads(spark.read.text(f"{path}/forest", wholetext=True).first()["value"])
        return cls(spark.read.parquet(f"{path}/trees"), r["features"], [np.array(c, float) for c in r["cuts"]], r["trees"], r["gains"])
