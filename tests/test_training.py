import pytest

from pyspark.sql import functions as F

from churnlake.operators import training as TR
from churnlake.plans import q_training as QT
from churnlake.session import scratch_path
from conftest import SMALL


def test_gbt_beats_chance_and_registry_versions(spark):
    data = QT.training_frame(spark, SMALL)
    train, test = data.filter(F.col("split") == "train"), data.filter(F.col("split") == "test")
    spec = TR.ModelSpec("GradientBoosting", "gbt", {"maxIter": 5, "maxDepth": 3})
    model = TR.fit(train, spec)
    m = TR.evaluate(model, test).first()
    assert m["roc_auc"] > 0.6
    root = scratch_path(spark, "reg")
    v1 = TR.register_version(spark, model, root, "gbt", "r1").first()["version"]
    v2 = TR.register_version(spark, model, root, "gbt", "r2").first()["version"]
    assert (v1, v2) == (1, 2)
    assert TR.load_production(spark, root, "gbt") is not None
    assert TR.load_production(spark, root, "other") is None and TR.load_production(spark, f"{root}/none", "gbt") is None
    imp = TR.feature_importance(model).collect()
    assert len(imp) == 10 and imp[0]["importance"] >= imp[-1]["importance"]


def test_settings_are_the_references():
    by = {s.name: s.params for s in TR.SPECS}
    assert (by["RandomForest"]["numTrees"], by["RandomForest"]["maxDepth"]) == (200, 15)
    assert [(by[n]["maxIter"], by[n]["maxDepth"]) for n in ("XGBoost", "LightGBM", "GradientBoosting")] == [(200, 6), (200, 8), (150, 5)]


def test_folds_lie_in_the_train_split_and_are_stratified(spark):
    cells = {(r["split"], r["fold"]): (r["n"], r["p"]) for r in QT.training_frame(spark, SMALL).groupBy("split", "fold")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("churned").alias("p")).collect()}
    folds = [cells[("train", k)] for k in range(5)]
    assert ("test", None) in cells and len(cells) == 6
    assert max(p for _, p in folds) - min(p for _, p in folds) <= 1 and max(n for n, _ in folds) - min(n for n, _ in folds) <= 2


def test_cross_validation_refits_per_fold(spark):
    train = QT.training_frame(spark, SMALL).filter("split = 'train'")
    specs = [TR.ModelSpec("Boosted", "boost", {"maxIter": 3, "maxDepth": 3}), TR.ModelSpec("Forest", "rf", {"numTrees": 3, "maxDepth": 3})]
    got = {r["model"]: r for r in TR.cross_validate(train, specs).collect()}
    assert set(got) == {"Boosted", "Forest"}
    assert all(0 <= r["cv_f1_mean"] < 0.9 and r["cv_f1_std"] >= 0 for r in got.values())


def test_a_scoring_job_carries_one_forest(spark, monkeypatch):
    """A task unpacks every tree of its job: with all folds in one, every fold's forest."""
    carried, predict_long = [], TR.predict_long
    monkeypatch.setattr(TR, "predict_long", lambda models, *a: carried.append([isinstance(m, TR.Forest) for m in models.values()]) or predict_long(models, *a))
    train = QT.training_frame(spark, SMALL).filter("split = 'train'")
    specs = [TR.ModelSpec("Forest", "rf", {"numTrees": 2, "maxDepth": 3}), TR.ModelSpec("A", "boost", {"maxIter": 2, "maxDepth": 2}),
             TR.ModelSpec("B", "boost", {"maxIter": 1, "maxDepth": 2})]
    assert {r["model"] for r in TR.cross_validate(train, specs).collect()} == {"Forest", "A", "B"}
    assert sorted(carried) == 5 * [[False, False]] + 5 * [[True]]
    models = dict(zip(("Forest", "A", "B"), TR.fit_group(train, [(x, None) for x in specs])))
    rows = [sorted(tuple(r) for r in x.select("k", "model", "score", "prediction").collect())
            for x in (TR.score_tables([(models, train)], ["k"]), predict_long(models, train, ["k"]))]
    assert rows[0] == rows[1] and len(rows[0]) == 3 * train.count()


def test_a_forest_is_fitted_as_parts_and_every_tree_has_a_vote(spark, monkeypatch):
    monkeypatch.setattr(TR, "FOREST_PARTS", 3)
    monkeypatch.setattr(TR, "FOREST_ROWS", 0)
    data = QT.training_frame(spark, SMALL)
    model = TR.fit(data.filter("split = 'train'"), TR.ModelSpec("Forest", "rf", {"numTrees": 7, "maxDepth": 4}))
    assert [p.stages[-1].getNumTrees for p in model.parts] == [3, 2, 2]
    test = data.filter("split = 'test'").limit(50)
    got = {r["k"]: r for r in TR.predict(model, test).collect()}
    votes = dict.fromkeys(got, 0.0)
    for p in model.parts:
        for r in p.transform(test).select("k", "rawPrediction").collect():
            votes[r["k"]] += r["rawPrediction"][1]      # a forest's raw prediction is the sum of its trees' votes
    assert all(got[k]["score"] == pytest.approx(v / 7) and got[k]["prediction"] == int(got[k]["score"] > 0.5) for k, v in votes.items())
    root = scratch_path(spark, "forest")
    TR.register_version(spark, model, root, "forest", "r1")
    back = TR.load_production(spark, root, "forest")
    assert back.importances() == pytest.approx(model.importances()) and sum(back.importances()) == pytest.approx(1)
    assert {r["k"]: r["score"] for r in TR.predict(back, test).collect()} == pytest.approx({k: r["score"] for k, r in got.items()})


def test_an_unreadable_versions_table_is_an_error(spark):
    """Taken for an empty table it would start the version numbers again and overwrite models."""
    root = scratch_path(spark, "broken_registry")
    spark.createDataFrame([("not a table",)], "t string").write.text(f"{root}/versions")
    train = QT.training_frame(spark, SMALL).filter("split = 'train'")
    model = TR.fit(train, TR.ModelSpec("Boosted", "boost", {"maxIter": 2, "maxDepth": 2}))
    with pytest.raises(Exception):
        TR.register_version(spark, model, root, "boosted", "r1")
    with pytest.raises(Exception):
        TR.load_production(spark, root, "boosted")


def test_run_ids_name_settings_and_source():
    a, b = TR.SPECS[:2]
    assert TR.run_id(a, "x") == TR.run_id(a, "x") != TR.run_id(a, "y") and TR.run_id(a, "x") != TR.run_id(b, "x")
