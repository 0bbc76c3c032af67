"""Rows of a model that one task grows: kept by node, placed once."""

import time
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import numpy as np
import pytest

from churnlake.operators import boosting as B


@pytest.mark.parametrize("s", [B.BoostSpec(6, 5, subsample=0.7, colsample=0.7, reg_lambda=1.0), B.BoostSpec(6, 8, max_leaves=9, min_child_rows=4),
                               B.BoostSpec(6, 4, criterion="friedman")])
def test_a_tree_is_added_to_the_margins_without_a_walk(monkeypatch, s):
    """walking every tree again took as long as a third of a fit."""
    rng = np.random.default_rng(5)
    values = [rng.integers(0, n, 700).astype(float) for n in (9, 300, 2, 40)]
    values[1][rng.random(700) < 0.2] = np.nan
    y = (rng.random(700) < 0.2 + 0.06 * values[0]).astype(float)
    bins = B.Bins(list("abcd"), [np.unique(v[~np.isnan(v)])[:-1] for v in values])
    x, g = bins.of(values), B.Grower(s, bins, -0.4, None)
    rows = B.ModelRows([(x, y, np.zeros(700), np.arange(700), None)], g)
    walk = B.Tree.walk
    monkeypatch.setattr(B.Tree, "walk", None)
    while not g.done:
        nodes, sums = rows.sums()
        g.receive(*B.node_cuts(g.spec, g.bins, g.allowed, nodes, sums))
        if g.pending:
            rows.grown()
    margin = np.full(700, -0.4)
    for t in g.trees:
        margin += t.value[walk(t, x, bins.start)]
    assert len(g.trees) == 6 and (rows.margin == margin).all() and len(np.unique(margin)) > 20


def test_fits_side_by_side_ship_the_code_once(monkeypatch):
    shipped = []
    monkeypatch.setattr(B, "_shipped", set())
    spark = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="a", addPyFile=lambda p: (time.sleep(0.2), shipped.append(p))))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(B._ship, [spark] * 4))
    assert len(shipped) == 1
