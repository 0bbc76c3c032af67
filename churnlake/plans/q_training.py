"""The training job at the
reference's settings.  Tree learners cannot be rebuilt in SQL, so metrics are
rows-only (thresholds in the tests); the plan of the job — learners,
settings, sizes and positives per split and fold — and what the run log holds
besides metrics have an oracle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import evaluation as EV
from ..operators import features as FE
from ..operators import training as TR
from ..session import materialize, scratch_path
from ..sources import fixtures as FX
from ..sources import sinks
from .registry import query

AS_OF = "2024-01-31T00:00:00"
STARTED = dt.datetime(2025, 10, 9, 23, 49, 44)
SPECS = {s.name: s for s in TR.SPECS}


def training_frame(spark, sf_dir):
    """Scaled feature table with key, exact stratified split, and stratified
    folds of the train split (null on test rows), stored once; every fit and
    evaluation reads it."""
    from .q_drift import feature_model

    def build():
        ft = FX.with_key(FE.select_features(feature_model(spark, sf_dir).transform(FX.customers_raw(spark, sf_dir))))
        ft = materialize(EV.stratified_split(ft.withColumn("label", F.col(FE.LABEL))))
        train = EV.stratified_folds(ft.filter("split = 'train'")).select(*ft.columns, "fold")
        return materialize(train.unionByName(ft.filter("split = 'test'").withColumn("fold", F.lit(None).cast("int"))).drop("label"))

    return FX.session_artifact(spark, "training_frame", sf_dir, build)


def _split(spark, sf_dir, name):
    return training_frame(spark, sf_dir).filter(F.col("split") == name)


def _stored(spark, models):
    paths = {n: scratch_path(spark, f"model_{n}") for n in models}
    TR.save_all(models, spark, paths)
    return paths


def _test_metrics(scored):
    return materialize(EV.classification_metrics(scored, group_cols=["model"]), "test_metrics")


def _fit(spark, sf_dir, names):
    """Learners fitted on the train split (their paths), and their test metrics."""
    models = dict(zip(names, TR.fit_group(_split(spark, sf_dir, "train"), [(SPECS[n], None) for n in names])))
    paths = _stored(spark, models)
    return paths, _test_metrics(TR.score_tables([(models, _split(spark, sf_dir, "test"))]))


def fitted(spark, sf_dir, name):
    return FX.session_artifact(spark, f"fitted_{name}", sf_dir, lambda: _fit(spark, sf_dir, [name]))


def fitted_all(spark, sf_dir):
    return FX.session_artifact(spark, "fitted_all", sf_dir, lambda: _fit(spark, sf_dir, list(SPECS)))


def model(spark, sf_dir, name):
    return TR.load(spark, fitted_all(spark, sf_dir)[0][name], SPECS[name].kind)


def cv_rows(spark, sf_dir):
    """Five refits of every learner on the train split only.  Where the fits on
    all of it are not there yet, they are part of the same group: rows are
    binned, dealt and scored once."""
    def build():
        whole = not FX.has_artifact(spark, "fitted_all", sf_dir)
        folds, models = TR.fit_folds(_split(spark, sf_dir, "train"), list(SPECS.values()), whole=whole)
        if whole:
            paths = _stored(spark, models)
            folds.append((models, _split(spark, sf_dir, "test")))
        scored = TR.score_tables(folds, ["fold"])
        if whole:
            FX.session_artifact(spark, "fitted_all", sf_dir, lambda: (paths, _test_metrics(scored.filter(F.col("fold").isNull()).drop("fold"))))
        return materialize(EV.cv_f1(scored.filter(F.col("fold").isNotNull()), group_cols=["model"]), "cv_metrics")

    return FX.session_artifact(spark, "cv", sf_dir, build)


def _runs(spark, sf_dir, cv):
    def build():
        sizes = training_frame(spark, sf_dir).agg(F.count_if(F.col("split") == "train").alias("a"), F.count_if(F.col("split") == "test").alias("b")).first()
        state = str(FX._source_state(spark, sf_dir)[1:])
        fold_metrics = cv_rows(spark, sf_dir) if cv else None
        rows = TR.run_rows(spark, list(SPECS.values()), fitted_all(spark, sf_dir)[1], fold_metrics, sizes["a"], sizes["b"], STARTED, state)
        return materialize(rows.coalesce(1), "model_runs")

    return FX.session_artifact(spark, "cv_runs" if cv else "model_runs", sf_dir, build)


def runs(spark, sf_dir):
    """The run log with test metrics: needs the four fits alone."""
    return _runs(spark, sf_dir, False)


def cv_runs(spark, sf_dir):
    """The run log with fold metrics too."""
    return _runs(spark, sf_dir, True)


def training_job(spark, sf_dir):
    """The best run by F1 registered as production with its metadata.
    Returns the folder of the version and metadata tables."""
    def build():
        root = scratch_path(spark, "model_store")
        best = EV.best_model(runs(spark, sf_dir)).first()
        TR.register_version(spark, model(spark, sf_dir, best["model_type"]), f"{root}/registry", "churn_model", best["run_id"])
        metrics = fitted_all(spark, sf_dir)[1].filter(F.col("model") == best["model_type"])
        meta = TR.model_metadata(spark, SPECS[best["model_type"]], metrics, STARTED.isoformat())
        sinks.write_json(meta, f"{root}/model_metadata")
        return root, meta.schema

    return FX.session_artifact(spark, "training_job", sf_dir, build)


def _one_learner(spark, sf_dir, name):
    sizes = training_frame(spark, sf_dir).agg(F.count_if(F.col("split") == "train").alias("train_size"),
                                              F.count_if(F.col("split") == "test").alias("test_size"))
    return EV.with_one_row(fitted(spark, sf_dir, name)[1], sizes)


@query("train_random_forest")
def train_random_forest(spark, sf_dir):
    return _one_learner(spark, sf_dir, "RandomForest")


@query("train_gbt_depth6")
def train_gbt_depth6(spark, sf_dir):
    return _one_learner(spark, sf_dir, "XGBoost")


@query("train_gbt_depth8")
def train_gbt_depth8(spark, sf_dir):
    return _one_learner(spark, sf_dir, "LightGBM")


@query("train_gbt_depth5")
def train_gbt_depth5(spark, sf_dir):
    return _one_learner(spark, sf_dir, "GradientBoosting")


@query("training_plan", oracle="""
WITH s AS (SELECT sr.k, sr.label, sr.split, ((k + 1) * 961748927) % 2147483647 AS h FROM split_rank sr),
f AS (SELECT k, label, split, CASE WHEN split = 'train' THEN
        CAST((row_number() OVER (PARTITION BY label, split ORDER BY h, k) - 1) % 5 AS INTEGER) END AS fold FROM s),
l AS (SELECT * FROM (VALUES ('RandomForest', 200, 15), ('XGBoost', 200, 6), ('LightGBM', 200, 8), ('GradientBoosting', 150, 5)) t(model, trees, depth))
SELECT l.model, l.trees, l.depth, f.split, f.fold, COUNT(*) AS n, CAST(SUM(f.label) AS BIGINT) AS positives
FROM l, f GROUP BY ALL""")
def training_plan(spark, sf_dir):
    """What the job fits: per learner its settings, and rows and positives per split and fold."""
    cells = (training_frame(spark, sf_dir).groupBy("split", "fold")
             .agg(F.count(F.lit(1)).alias("n"), F.sum(FE.LABEL).cast("bigint").alias("positives")))
    learners = F.array(*[F.struct(F.lit(s.name).alias("model"), F.lit(s.params.get("numTrees", s.params.get("maxIter"))).alias("trees"),
                                  F.lit(s.params["maxDepth"]).alias("depth")) for s in TR.SPECS])
    return cells.select(F.explode(learners).alias("l"), "*").select("l.*", "split", "fold", "n", "positives")


@query("cross_validation")
def cross_validation(spark, sf_dir):
    return cv_runs(spark, sf_dir).select("model_type", "cv_f1_mean", "cv_f1_std")


@query("trained_runs")
def trained_runs(spark, sf_dir):
    """One run per learner."""
    return cv_runs(spark, sf_dir).drop("params")


@query("trained_run_settings", oracle="""
SELECT l.model || '_run' AS run_name, l.model AS model_type, CAST(l.i AS INTEGER) AS ordinal,
       TIMESTAMP '2025-10-09 23:49:44' + l.i * INTERVAL '1 minute' AS start_time,
       COUNT(*) FILTER (WHERE sr.split = 'train') AS train_size, COUNT(*) FILTER (WHERE sr.split = 'test') AS test_size,
       l.trees AS trees, l.depth AS depth, TRUE AS has_metrics
FROM (VALUES ('RandomForest', 0, '200', '15'), ('XGBoost', 1, '200', '6'), ('LightGBM', 2, '200', '8'), ('GradientBoosting', 3, '150', '5')) l(model, i, trees, depth),
     split_rank sr GROUP BY l.model, l.i, l.trees, l.depth""")
def trained_run_settings(spark, sf_dir):
    """What the log of the trained runs holds besides metrics."""
    return runs(spark, sf_dir).select(
        "run_name", "model_type", "ordinal", F.col("start_time").cast("timestamp_ntz").alias("start_time"), "train_size", "test_size",
        F.coalesce(F.col("params")["numTrees"], F.col("params")["maxIter"]).alias("trees"), F.col("params")["maxDepth"].alias("depth"),
        (F.col("f1_score").between(0, 1) & F.col("roc_auc").between(0, 1)).alias("has_metrics"))


@query("trained_best_model")
def trained_best_model(spark, sf_dir):
    """The best run, its registered version, and the metadata read back."""
    root, schema = training_job(spark, sf_dir)
    best = EV.best_model(runs(spark, sf_dir)).select("run_id", "model_type", "f1_score")
    versions = TR.registered_versions(spark, f"{root}/registry").select("run_id", "name", "version", "stage")
    meta = sinks.read_json(spark, f"{root}/model_metadata", schema).select(
        F.col("model_name").alias("model_type"), "best_score", F.size("features").alias("n_features"))
    return best.join(versions, "run_id").join(meta, "model_type").drop("run_id")


@query("trained_model_comparison")
def trained_model_comparison(spark, sf_dir):
    """T12 over the trained runs."""
    return EV.model_comparison(runs(spark, sf_dir))


@query("trained_promotion_gate")
def trained_promotion_gate(spark, sf_dir):
    """The best trained run against the rules in production."""
    from .q_evaluation import run_log
    both = runs(spark, sf_dir).select("run_name", "f1_score", "ordinal").unionByName(
        run_log(spark, sf_dir).filter(F.col("run_name").startswith("PRODUCTION_")).select("run_name", "f1_score", "ordinal"))
    return EV.promotion_gate(both)


@query("latest_model_run")
def latest_model_run(spark, sf_dir):
    """The most recent run."""
    path = scratch_path(spark, "run_log")
    TR.append_run(cv_runs(spark, sf_dir), path)
    return TR.latest_run(spark, path).drop("params")


@query("feature_importance")
def feature_importance(spark, sf_dir):
    """Top ten importances of every learner."""
    out = None
    for name in SPECS:
        top = TR.feature_importance(model(spark, sf_dir, name)).select(F.lit(name).alias("model"), "*")
        out = top if out is None else out.unionByName(top)
    return out


@query("importance_bars")
def importance_bars(spark, sf_dir):
    """All feature importances of the best learner, ascending (the bar-chart order)."""
    best = EV.best_model(runs(spark, sf_dir)).first()["model_type"]
    return TR.feature_importance(model(spark, sf_dir, best), top=None).orderBy("importance", "feature")


@query("score_with_model")
def score_with_model(spark, sf_dir):
    """P8 with a real model: load the production version and score every
    customer; rows without a model probability fall back to rules."""
    from .q_drift import feature_model
    best = TR.load_production(spark, f"{training_job(spark, sf_dir)[0]}/registry", "churn_model")
    return TR.score_with_model(best, FX.customers_raw(spark, sf_dir), feature_model(spark, sf_dir), AS_OF)
