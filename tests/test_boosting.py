"""Boosted trees: cuts, leaves and order of growth against exhaustive ones."""

import heapq
import pickle

import numpy as np
import pytest

from churnlake.operators import boosting as B


def table(n, seed=1, missing=True):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 9, n).astype(float), rng.normal(size=n).round(2), rng.integers(0, 2, n).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.5 * a - 2 + b * c)))).astype(int)
    if missing:
        b[rng.random(n) < 0.15] = np.nan
    return a, b, c, y


def frame(spark, n, seed=1, parts=3):
    a, b, c, y = table(n, seed)
    rows = [(float(i), None if np.isnan(j) else float(j), float(k), int(l), q, q % 4) for q, (i, j, k, l) in enumerate(zip(a, b, c, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, y int, k long, fold int").repartition(parts)


def gain(g, h, n, left, s):
    if not left.any() or left.all() or min(left.sum(), (~left).sum()) < s.min_child_rows or min(h[left].sum(), h[~left].sum()) < s.min_child_weight:
        return 0.0
    gl, gr, hl, hr = g[left].sum(), g[~left].sum(), h[left].sum(), h[~left].sum()
    if s.criterion == "friedman":
        nl, nr = left.sum(), (~left).sum()
        return nl * nr / (nl + nr) * (gl / nl - gr / nr) ** 2
    return gl ** 2 / (hl + s.reg_lambda) + gr ** 2 / (hr + s.reg_lambda) - (gl + gr) ** 2 / (hl + hr + s.reg_lambda)


def best_cut(x, g, h, rows, s):
    """Every cut of every feature, missing values on either side."""
    best = (0.0, None)
    for f in range(x.shape[1]):
        v = x[rows, f]
        for t in np.unique(v[~np.isnan(v)]):
            for missing_left in (False, True):
                left = np.where(np.isnan(v), missing_left, v <= t)
                k = gain(g[rows], h[rows], len(rows), left, s)
                if k > best[0] + 1e-9:
                    best = (k, left)
    return best


def grow(x, g, h, s):
    """Leaves (rows, weight) and number of passes over nodes, by exhaustive search."""
    leaves, heap, made = [], [], 0

    def push(rows, depth):
        nonlocal made
        k, left = best_cut(x, g, h, rows, s) if depth < s.max_depth and len(rows) >= 2 * s.min_child_rows else (0.0, None)
        heapq.heappush(heap, (-k, made, rows, depth, left))
        made += 1

    push(np.arange(len(g)), 0)
    while heap:
        k, _, rows, depth, left = heapq.heappop(heap)
        if k < -1e-9 and (not s.max_leaves or len(leaves) + len(heap) + 1 < s.max_leaves):
            push(rows[left], depth + 1)
            push(rows[~left], depth + 1)
        else:
            leaves.append((rows, -s.learning_rate * g[rows].sum() / (h[rows].sum() + s.reg_lambda)))
    return leaves


SPECS = [B.BoostSpec(3, 4, reg_lambda=1.0, min_child_weight=1.0), B.BoostSpec(3, 6, max_leaves=7, min_child_rows=5, min_child_weight=1e-3),
         B.BoostSpec(3, 3, criterion="friedman"), B.BoostSpec(2, 8, max_leaves=31, min_child_rows=3)]


@pytest.mark.parametrize("s", SPECS)
@pytest.mark.parametrize("block_rows", [10_000, 64])
def test_trees_match_exhaustive_search(spark, s, block_rows):
    """Every distinct value is a bin here, so all cuts are the same; both ways of running."""
    a, b, c, y = table(300)
    x = np.stack((a, b, c), 1)
    got = B.fit_many(frame(spark, 300), [(s, None)], ["a", "b", "c"], "y", key="k", max_bins=400, block_rows=block_rows)[0]
    margin = np.full(300, got.base)
    assert got.base == pytest.approx(np.log(y.mean() / (1 - y.mean())))
    for t in got.trees:
        g, h = B._gradients(margin, y)
        step = np.zeros(300)
        for rows, w in grow(x, g, h, s):
            step[rows] = w
        bins = B.Bins(got.features, got.cuts)
        mine = t.value[t.walk(bins.of([a, b, c]), bins.start)]
        assert np.allclose(mine, step, atol=1e-9)
        margin += mine
    assert np.allclose(got.margin([a, b, c]), margin)


def test_models_do_not_depend_on_partitions_blocks_or_company(spark):
    specs = [B.BoostSpec(9, 4, subsample=0.7, colsample=0.7, reg_lambda=1.0), B.BoostSpec(8, 6, max_leaves=5, min_child_rows=4)]
    fits = [(s, k) for s in specs for k in (None, 2)]
    cols = ["a", "b", "c"]
    whole = B.fit_many(frame(spark, 900), fits, cols, "y", "fold", "k")
    small = B.fit_many(frame(spark, 900, parts=20), fits, cols, "y", "fold", "k", block_rows=50)
    alone = [B.fit_many(frame(spark, 900, parts=1), [f], cols, "y", "fold", "k")[0] for f in fits]
    values = list(table(900)[:3])
    for m, n, o in zip(whole, small, alone):
        assert (m.margin(values) == n.margin(values)).all() and (m.margin(values) == o.margin(values)).all()
    assert (whole[0].margin(values) != whole[1].margin(values)).any()
    assert max((t.left < 0).sum() for t in whole[2].trees) == 5 and sum((t.left < 0).sum() <= 5 for t in whole[2].trees) == 8


def test_a_fold_left_out_is_not_seen(spark):
    s = B.BoostSpec(4, 3)
    df = frame(spark, 400)
    left_out = B.fit_many(df, [(s, 1)], ["a", "b", "c"], "y", "fold", "k", bins=(bins := B.find_bins(df, ["a", "b", "c"])))[0]
    without = B.fit_many(df.filter("fold <> 1"), [(s, None)], ["a", "b", "c"], "y", "fold", "k", bins=bins)[0]
    values = list(table(400)[:3])
    assert (left_out.margin(values) == without.margin(values)).all()


def test_save_scores_and_importances(spark, tmp_path):
    df = frame(spark, 300)
    kinds = ("gain", "split", "impurity")
    models = B.fit_many(df, [(B.BoostSpec(5, 3, importance=k), None) for k in kinds], ["a", "b", "c"], "y", key="k")
    models[0].save(spark, f"{tmp_path}/m")
    back = B.Ensemble.load(spark, f"{tmp_path}/m")
    values = list(table(300)[:3])
    assert (back.margin(values) == models[0].margin(values)).all()
    p = {r["k"]: r["score"] for r in B.scores({"m": back}, df, ["k"]).collect()}
    assert np.allclose([p[i] for i in range(300)], 1 / (1 + np.exp(-back.margin(values))))
    assert sum(models[0].importances()) == pytest.approx(1) and sum(models[2].importances()) == pytest.approx(1)
    assert sum(models[1].importances()) == sum((t.left >= 0).sum() for t in models[1].trees)


def test_one_class_and_no_rows(spark):
    df = frame(spark, 60).selectExpr("a", "b", "c", "0 AS y", "k", "fold")
    m = B.fit_many(df, [(B.BoostSpec(2, 3), None)], ["a", "b", "c"], "y", key="k")[0]
    assert (m.margin(list(table(60)[:3])) < -5).all()
    with pytest.raises(ValueError):
        B.fit_many(df.filter("k < 0"), [(B.BoostSpec(2, 3), None)], ["a", "b", "c"], "y", key="k")


def test_the_driver_gets_cuts_and_no_sums(spark, monkeypatch):
    sizes, receive = [], B.Grower.receive

    def counted(self, *got):
        sizes.append(len(pickle.dumps(got)))
        receive(self, *got)

    monkeypatch.setattr(B.Grower, "receive", counted)
    df = frame(spark, 900, parts=5)
    bins = B.find_bins(df, ["a", "b", "c"], 400)
    B.fit_many(df, [(B.BoostSpec(4, 4), None), (B.BoostSpec(4, 6, max_leaves=6), None)], ["a", "b", "c"], "y", key="k", bins=bins, block_rows=50)
    assert sizes and max(sizes) < 8 * bins.total      # one node's sums take 24 bytes a bin


def test_rows_are_spread_over_the_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    df = spark.range(10).coalesce(1)
    assert B._spread(df, B.LEAST_ROWS // 2 + 1, 2).rdd.getNumPartitions() == min(cores, 2)
    assert B._spread(df, 3 * B.LEAST_ROWS, 50).rdd.getNumPartitions() == min(cores, 150)
    assert B._spread(df, 50 * B.MOST_ROWS, 1).rdd.getNumPartitions() == 50


def test_rows_of_several_blocks_meet_in_a_task_a_model(spark, monkeypatch):
    """A pass over the rows is then no Spark job."""
    df = spark.range(70_000).selectExpr("id * 37 % 9 + 0e0 AS a", "id * 31 % 1009 + 0e0 AS b", "id % 2 + 0e0 AS c", "CAST(id * 13 % 11 < 4 + id % 2 AS INT) AS y",
                                        "id AS k", "CAST(id % 4 AS INT) AS fold")
    fits = [(B.BoostSpec(2, 4, subsample=0.7, colsample=0.7, reg_lambda=1.0), None), (B.BoostSpec(2, 6, max_leaves=5), 1)]
    by_rows = B.fit_many(df, fits, ["a", "b", "c"], "y", "fold", "k", block_rows=60_000)
    monkeypatch.setattr(B, "_fit_by_rows", None)
    for m, n in zip(by_rows, B.fit_many(df, fits, ["a", "b", "c"], "y", "fold", "k")):
        assert all((t.value == u.value).all() and (t.bin == u.bin).all() for t, u in zip(m.trees, n.trees, strict=True))


def test_features_added_up_together_give_the_sums_of_each(monkeypatch):
    monkeypatch.setattr(B, "COMBINED", 40)
    rng = np.random.default_rng(3)
    values = [rng.integers(0, n, 500).astype(float) for n in (2, 2, 3, 2, 60, 9, 4, 1)]
    values[2][rng.random(500) < 0.2] = np.nan
    bins = B.Bins(list("abcdefgh"), [np.unique(v[~np.isnan(v)])[:-1] for v in values])
    x, y = bins.of(values), rng.integers(0, 2, 500).astype(float)
    sets = B._combined(x, bins)
    assert 1 < len(sets) < 8 and sorted(np.concatenate([at for *_, at in sets])) == list(range(bins.total))
    g = B.Grower(B.BoostSpec(1, 3), bins, 0.3, None)
    nodes, sums = B.ModelRows([(x[:200], y[:200], np.zeros(200), np.arange(200), None), (x[200:], y[200:], np.zeros(300), np.arange(300), None)], g).sums()
    assert nodes == [0] and (sums == B.node_sums(x, np.zeros(500, np.int64), 1, *B._gradients(np.full(500, 0.3), y), bins.total)).all()
