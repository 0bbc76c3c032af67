"""Forests grown by tasks: cuts and votes against exhaustive search, and that none is fitted on the driver."""

import json

import numpy as np
import pytest

from pyspark.sql import functions as F

from churnlake.operators import boosting as B
from churnlake.operators import evaluation as EV
from churnlake.operators import forest as FO
from churnlake.operators import training as TR
from churnlake.plans import q_training as QT
from churnlake.session import scratch_path
from churnlake.sources import fixtures as FX
from conftest import SMALL

COLS = ["a", "b", "c"]


def table(n, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 9, n).astype(float), rng.normal(size=n).round(1), rng.integers(0, 2, n).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.5 * a - 2 + b * c)))).astype(int)
    b[rng.random(n) < 0.1] = np.nan
    return a, b, c, y


def frame(spark, n, seed=1, parts=3):
    rows = [(float(i), 0.0 if np.isnan(j) else float(j), float(k), int(l), q, q % 4) for q, (i, j, k, l) in enumerate(zip(*table(n, seed)))]
    return spark.createDataFrame(rows, "a double, b double, c double, y int, k long, fold int").repartition(parts)


def impure(y):
    return y.sum() * (len(y) - y.sum()) / len(y)


def grown(x, y, rows, depth, s):
    """Leaves (rows, decision) of one tree by exhaustive search, leaves of one parent that decide alike as one."""
    best = (FO.LEAST_GAIN, None)
    if depth < s.max_depth:
        for f in range(x.shape[1]):
            for t in np.unique(x[rows, f])[:-1]:
                left = x[rows, f] <= t
                if min(left.sum(), (~left).sum()) >= s.min_rows:
                    k = impure(y[rows]) - impure(y[rows][left]) - impure(y[rows][~left])
                    if k > best[0] + 1e-9:
                        best = (k, left)
    if best[1] is not None:
        sides = [grown(x, y, rows[side], depth + 1, s) for side in (best[1], ~best[1])]
        if any(len(side) > 1 for side in sides) or sides[0][0][1] != sides[1][0][1]:
            return sides[0] + sides[1]
    return [(rows, 2 * y[rows].sum() > len(rows))]


@pytest.mark.parametrize("s", [FO.ForestSpec(1, 4, 2), FO.ForestSpec(1, 15, 1), FO.ForestSpec(1, 3, 20)])
def test_a_tree_matches_exhaustive_search(s):
    a, b, c, y = table(300)
    cuts = [np.unique(v[~np.isnan(v)])[:-1] for v in (a, b, c)]
    x = FO.binned([a, b, c], cuts)
    assert x[np.isnan(b), 1].min() == len(cuts[1])        # a missing value counts as the largest
    tree, gain = FO.grow(s, x, y.astype(np.uint8), np.ones(300, np.int64), np.array([len(k) + 1 for k in cuts]), np.random.default_rng(0), 3)
    votes = tree.votes(x)
    for rows, _ in grown(x.astype(int), y, np.arange(300), 0, s):
        assert np.allclose(votes[rows], y[rows].mean(), atol=1e-6)
    back = FO.Tree.unpacked(tree.packed())
    assert (back.votes(x) == votes.astype(np.float32)).all() and gain.sum() > 0


def test_forests_do_not_depend_on_partitions_order_or_company(spark):
    s, other = FO.ForestSpec(12, 5, 2), FO.ForestSpec(3, 2)
    df = frame(spark, 600)
    bins = B.find_bins(df, COLS)
    whole = FO.fit_many(df, [(s, None), (other, None), (s, 1)], bins, "y", "fold")
    alone = FO.fit_many(frame(spark, 600, parts=11), [(s, None)], bins, "y")[0]
    without = FO.fit_many(df.filter("fold <> 1"), [(s, None)], bins, "y")[0]
    votes = [{r["k"]: r["v"] for r in m.votes(df, "v").collect()} for m in (whole[0], alone, whole[2], without)]
    assert votes[0] == votes[1] != votes[2] == votes[3] and len(votes[0]) == 600
    assert whole[0].importances() == pytest.approx(alone.importances()) and sum(alone.importances()) == pytest.approx(1)
    assert whole[1].table.count() == 3 and whole[0].table.select("nodes").distinct().count() == 12      # every tree has a sample of its own


def test_a_rare_least_value_gets_a_bin(spark):
    df = spark.range(2000).selectExpr("CAST(id > 2 AS DOUBLE) AS a", "CAST(id AS DOUBLE) AS b")
    cuts = FO.find_cuts(df, B.find_bins(df, ["a", "b"]))
    assert cuts[0].tolist() == [0.0] and len(cuts[1]) == FO.MAX_BINS - 1


def test_other_labels_and_missing_features_are_an_error(spark):
    """As in ``pyspark.ml``'s forest; rows that are scored may have missing values."""
    df = frame(spark, 60)
    bins = B.find_bins(df, COLS)
    for c, bad, said in (("y", "CAST(NULL AS INT)", "labels"), ("y", "2", "labels"), ("b", "CAST(NULL AS DOUBLE)", "features"), ("a", "CAST('inf' AS DOUBLE)", "features")):
        with pytest.raises(Exception, match=f"{said} must"):
            FO.fit_many(df.withColumn(c, F.expr(bad)), [(FO.ForestSpec(2, 3), None)], bins, "y")
    model = FO.fit_many(df, [(FO.ForestSpec(4, 3), None)], bins, "y")[0]
    votes = [[r["v"] for r in model.votes(df.withColumn("b", F.expr(f"CAST({x} AS DOUBLE)")).orderBy("k"), "v").collect()] for x in ("NULL", "1e9")]
    assert votes[0] == votes[1] and len(votes[0]) == 60


def test_a_large_frames_forest_never_lies_on_the_driver(spark, monkeypatch, tmp_path):
    """``pyspark.ml`` would hold every node there."""
    monkeypatch.setattr(TR, "pipeline", None)
    df = spark.range(TR.FOREST_ROWS + 1).selectExpr("id * 37 % 9 + 0e0 AS a", "id * 31 % 1009 + 0e0 AS b", "id % 2 + 0e0 AS c",
                                                    "CAST(xxhash64(id) % 11 < 4 + id % 2 AS INT) AS y", "id AS k")
    spec = TR.ModelSpec("Forest", "rf", {"numTrees": 9, "maxDepth": 8, "minInstancesPerNode": 2})
    model = TR.fit(df, spec, COLS, "y")
    assert sum(p.getNumTrees for p in model.parts) == model.whole.getNumTrees == 9
    TR.save(model, spark, f"{tmp_path}/m")
    back = TR.load(spark, f"{tmp_path}/m", "rf")
    assert json.dumps(back.importances()) == json.dumps(model.importances())
    got = [sorted(tuple(r) for r in TR.predict(m, df, "y").select("k", "score", "prediction").collect()) for m in (model, back)]
    assert got[0] == got[1] and len(got[0]) == TR.FOREST_ROWS + 1 and len({s for _, s, _ in got[0]}) > 50


def test_runs_with_folds_are_fitted_as_one_group(spark, monkeypatch):
    """rows are binned, dealt and scored once for the fits and the refits."""
    monkeypatch.setattr(FX, "_ARTIFACTS", {k: v for k, v in FX._ARTIFACTS.items() if k[0] not in ("fitted_all", "cv", "cv_runs", "model_runs")})
    monkeypatch.setattr(TR, "FOREST_ROWS", 0)
    monkeypatch.setattr(TR, "pipeline", None)
    specs = [TR.ModelSpec("Forest", "rf", {"numTrees": 4, "maxDepth": 4}), TR.ModelSpec("Boosted", "boost", {"maxIter": 3, "maxDepth": 3})]
    monkeypatch.setattr(QT, "SPECS", {s.name: s for s in specs})
    sizes, fit_group = [], TR.fit_group
    monkeypatch.setattr(TR, "fit_group", lambda data, fits, *a, **b: sizes.append(len(fits)) or fit_group(data, fits, *a, **b))
    got = {r["model_type"]: r.asDict() for r in QT.cv_runs(spark, SMALL).collect()}
    assert sizes == [12] and set(got) == {"Forest", "Boosted"}
    train = QT._split(spark, SMALL, "train")
    alone = {r["model"]: r.asDict() for r in TR.cross_validate(train, specs).collect()}
    metrics = {r["model"]: r.asDict() for r in QT._fit(spark, SMALL, ["Forest", "Boosted"])[1].collect()}
    for n, run in got.items():
        assert [run[c] for c in ("cv_f1_mean", "cv_f1_std")] == pytest.approx([alone[n][c] for c in ("cv_f1_mean", "cv_f1_std")])
        assert [run[c] for c in ("accuracy", "f1_score", "roc_auc")] == [metrics[n][c] for c in ("accuracy", "f1_score", "roc_auc")]
    assert set(QT.fitted_all(spark, SMALL)[0]) == set(got) and sizes == [12, 10, 2]


def _large(spark):
    return spark.range(TR.FOREST_ROWS + 1).selectExpr("id * 37 % 9 + 0e0 AS a", "id * 31 % 1009 + 0e0 AS b", "id % 2 + 0e0 AS c",
                                                      "CAST(xxhash64(id) % 11 < 4 + id % 2 AS INT) AS y", "id AS k", "CAST(id % 5 AS INT) AS fold")


SPEC = TR.ModelSpec("Forest", "rf", {"numTrees": 12, "maxDepth": 8, "minInstancesPerNode": 2})


def test_refits_of_a_large_frame_never_lie_on_the_driver(spark, monkeypatch):
    """five forests of ``pyspark.ml`` at once did."""
    monkeypatch.setattr(TR, "pipeline", None)
    fitted = TR.fit_group(_large(spark), [(SPEC, k) for k in range(5)], COLS, "y")
    tables = {m.whole.table.inputFiles()[0].rsplit("/", 1)[0] for m in fitted}
    assert len(tables) == 1 and all(m.whole.table.count() == 12 for m in fitted)
    groups = [({"Forest": m}, _large(spark).filter(F.col("fold") == k)) for k, m in enumerate(fitted)]
    scored = TR.score_tables(groups, ["fold"], "y")
    assert scored.count() == TR.FOREST_ROWS + 1 and scored.filter("score > 0 and score < 1").count() > TR.FOREST_ROWS // 2


def test_registering_a_forest_reads_no_tree_on_the_driver(spark, monkeypatch):
    """the version and its trees are written by tasks; loading one reads its settings alone."""
    model = TR.fit(_large(spark), SPEC, COLS, "y")
    root = scratch_path(spark, "reg")
    rows = type(model.whole.table).toLocalIterator
    monkeypatch.setattr(type(model.whole.table), "toLocalIterator", None)
    assert TR.register_version(spark, model, root, "forest", "r1").first()["version"] == 1
    back = TR.load_production(spark, root, "forest")
    top = TR.feature_importance(back, COLS).collect()
    assert [r["importance"] for r in top] == sorted(model.importances(), reverse=True)
    monkeypatch.setattr(type(model.whole.table), "toLocalIterator", rows)
    cols = ("k", "score", "prediction")
    got = [sorted(tuple(r) for r in TR.predict(m, _large(spark).limit(100), "y").select(*cols).collect()) for m in (model, back)]
    assert got[0] == got[1]


def test_scores_of_several_models_with_a_forest_grown_by_tasks(spark, monkeypatch):
    """what is compared are the metrics of every learner over all rows."""
    monkeypatch.setattr(TR, "pipeline", None)
    specs = [SPEC, TR.ModelSpec("Boosted", "boost", {"maxIter": 2, "maxDepth": 3})]
    models = dict(zip(("Forest", "Boosted"), TR.fit_group(_large(spark), [(s, None) for s in specs], COLS, "y")))
    metrics = EV.classification_metrics(TR.score_tables([(models, _large(spark))], label="y"), group_cols=["model"]).collect()
    assert {r["model"] for r in metrics} == set(models) and all(r["roc_auc"] > 0.52 for r in metrics)
