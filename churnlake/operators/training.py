"""Training jobs.

The random forest of a small frame is ``pyspark.ml``'s, that of a larger one is
grown by tasks (``forest``), as the former's nodes all lie on the driver; the
boosted learners are those of
``boosting`` (second-order trees, leaf-wise trees, residual trees), all fitted
in the same passes.  Metrics reuse ``evaluation`` (exact count ratios and rank
AUC on the positive-class probability).  Run and version bookkeeping are small
versioned tables in the shared folder.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources import versioned as V
from . import boosting as BO
from . import evaluation as EV
from . import forest as FO
from .features import FEATURE_COLUMNS, LABEL

SEED = 42
#: Training rows of a partition; small frames then take few tasks a pass.
ROWS_PER_PARTITION = 200_000


@dataclass
class ModelSpec:
    name: str
    kind: str                        # "rf" | "gbt" | "boost"
    params: dict = field(default_factory=dict)


# The reference's four learner settings, and what its learners take where nothing is set.
SPECS = [
    ModelSpec("RandomForest", "rf", {"numTrees": 200, "maxDepth": 15, "minInstancesPerNode": 2}),
    ModelSpec("XGBoost", "boost", {"maxIter": 200, "maxDepth": 6, "stepSize": 0.1, "subsamplingRate": 0.8, "featuresPerTree": 0.8,
                                   "regLambda": 1.0, "minChildWeight": 1.0}),
    ModelSpec("LightGBM", "boost", {"maxIter": 200, "maxDepth": 8, "stepSize": 0.1, "maxLeaves": 31, "minChildRows": 20,
                                    "minChildWeight": 0.001, "importance": "split"}),
    ModelSpec("GradientBoosting", "boost", {"maxIter": 150, "maxDepth": 5, "stepSize": 0.1, "criterion": "friedman", "importance": "impurity"}),
]

_BOOST = {"maxIter": "rounds", "maxDepth": "max_depth", "stepSize": "learning_rate", "subsamplingRate": "subsample", "featuresPerTree": "colsample",
          "maxLeaves": "max_leaves", "regLambda": "reg_lambda", "minChildWeight": "min_child_weight", "minChildRows": "min_child_rows"}

#: Memory for the statistics of a pass and node ids kept per row: a tree level then takes one pass.
_FOREST = {"maxMemoryInMB": 2048, "cacheNodeIds": True}
#: Rows beyond which tasks grow and keep a forest's trees: ``pyspark.ml``'s forest has some hundred bytes a node on the
#: driver, and nodes grow with the rows.  The parts that such a forest is dealt to; beyond ``FO.TASK_ROWS``, where a task
#: can't hold all rows, they are ``pyspark.ml`` forests fitted side by side.
FOREST_PARTS, FOREST_ROWS = 8, 16_384
#: Fits that are submitted at once.
PARALLEL_FITS = 12


def boost_spec(spec: ModelSpec) -> BO.BoostSpec:
    return BO.BoostSpec(**{_BOOST.get(k, k): v for k, v in spec.params.items()}, seed=SEED)


def pipeline(spec: ModelSpec, features=FEATURE_COLUMNS, label: str = LABEL) -> Pipeline:
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    cls = RandomForestClassifier if spec.kind == "rf" else GBTClassifier
    est = cls(featuresCol="features", labelCol=label, **({"seed": SEED} | _FOREST | spec.params))
    return Pipeline(stages=[asm, est])


def forest_parts(spec: ModelSpec, rows: int) -> list[ModelSpec]:
    """A forest's trees dealt to ``FOREST_PARTS`` forests with seeds of their own and a share of the memory each."""
    n = spec.params["numTrees"]
    parts = min(FOREST_PARTS, n) if rows > FOREST_ROWS else 1
    return [replace(spec, params=spec.params | {"numTrees": n // parts + (j < n % parts), "seed": SEED + j, "maxMemoryInMB": _FOREST["maxMemoryInMB"] // parts})
            for j in range(parts)]


@dataclass
class Forest:
    """A forest as its parts, each a fitted ``pyspark.ml`` pipeline or some
    trees of ``whole``.  Every tree has one vote, so the parts count by their
    trees."""

    parts: list
    whole: FO.Trees | None = None

    def _shares(self) -> list[float]:
        n = [p.stages[-1].getNumTrees for p in self.parts]
        return [x / sum(n) for x in n]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the positive class's probability and the decision."""
        if self.whole:
            out, probability = self.whole.votes(df, "_votes"), F.col("_votes") / self.whole.getNumTrees
        else:
            out, probability = self.parts[0].stages[0].transform(df), F.lit(0.0)
        for j, (p, share) in enumerate(zip([] if self.whole else self.parts, self._shares())):
            model = p.stages[-1].copy().setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"_part{j}")
            out = model.transform(out)
            probability = probability + vector_to_array(f"_part{j}")[1] * share
        return out.withColumns({"score": probability, "prediction": (probability > 0.5).cast("int")}).select(
            *[F.col(f"`{c}`") for c in df.columns if c not in ("prediction", "score")], "prediction", "score")

    def importances(self) -> list[float]:
        if self.whole:
            return self.whole.importances()
        per = [p.stages[-1].featureImportances.toArray() for p in self.parts]
        return sum(x * share for x, share in zip(per, self._shares())).tolist()

    def save(self, spark: SparkSession, path: str) -> None:
        if self.whole:
            return self.whole.save(spark, path)
        _side_by_side(spark, [lambda j=j, p=p: p.write().save(f"{path}/part{j:03d}") for j, p in enumerate(self.parts)])

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Forest":
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        found = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
        names = sorted(f.getPath().getName() for f in found if f.getPath().getName().startswith("part"))
        if not names:
            whole = FO.Trees.load(spark, path)
            return cls([whole], whole)
        return cls(_side_by_side(spark, [lambda n=n: PipelineModel.load(f"{path}/{n}") for n in names]))


def forest_spec(spec: ModelSpec) -> FO.ForestSpec:
    return FO.ForestSpec(spec.params["numTrees"], spec.params["maxDepth"], spec.params.get("minInstancesPerNode", 1), SEED)


def forest_of(whole: FO.Trees, spec: ModelSpec, rows: int) -> Forest:
    """A forest grown by tasks, and its trees dealt to parts."""
    parts, first = [], 0
    for part in forest_parts(spec, rows):
        parts.append(whole.part(first, part.params["numTrees"]))
        first += part.params["numTrees"]
    return Forest(parts, whole)


def _side_by_side(spark: SparkSession, jobs: list, parallelism: int = PARALLEL_FITS) -> list:
    with ThreadPoolExecutor(parallelism) as pool:
        return [done.result() for done in [pool.submit(inheritable_thread_target(spark)(j)) for j in jobs]]


def packed(df: DataFrame, n: int) -> DataFrame:
    """As few partitions as the ``n`` rows need."""
    return df.coalesce(max(1, -(-n // ROWS_PER_PARTITION)))


def fit_group(train: DataFrame, fits: list[tuple[ModelSpec, int | None]], features=FEATURE_COLUMNS, label: str = LABEL,
              key: str = "k", parallelism: int = PARALLEL_FITS) -> list:
    """Models of (settings, fold left out or None): the boosted ones share
    their passes, forests beyond ``FOREST_ROWS`` their job, the others are
    submitted side by side, as each alone leaves most of a cluster idle between
    its tree levels."""
    n_rows = train.count()
    few = packed(train, n_rows)
    by_tasks = FOREST_ROWS < n_rows <= FO.TASK_ROWS
    boosted = [i for i, (s, _) in enumerate(fits) if s.kind == "boost"]
    grown = [i for i, (s, _) in enumerate(fits) if s.kind == "rf" and by_tasks]
    out: list = [None] * len(fits)
    fold = "fold" if any(k is not None for _, k in fits) else None
    bins = BO.find_bins(train, features) if boosted or grown else None

    def one(spec: ModelSpec, k: int | None) -> PipelineModel:
        rows = few if k is None else few.filter(F.col("fold") != k)
        return pipeline(spec, features, label).fit(rows.withColumn(label, F.col(label).cast("double")))

    def together() -> list:
        return BO.fit_many(train, [(boost_spec(fits[i][0]), fits[i][1]) for i in boosted], features, label, fold, key, bins=bins)

    def forests() -> list:
        return FO.fit_many(train, [(forest_spec(fits[i][0]), fits[i][1]) for i in grown], bins, label, fold)

    groups = [(x, job) for x, job in ((boosted, together), (grown, forests)) if x]
    others = [(i, part) for i, (s, _) in enumerate(fits) if i not in boosted + grown for part in (forest_parts(s, n_rows) if s.kind == "rf" else [s])]
    got = _side_by_side(train.sparkSession, [job for _, job in groups] + [lambda i=i, part=part: one(part, fits[i][1]) for i, part in others], parallelism)
    for x, _ in groups:
        for i, m in zip(x, got.pop(0)):
            out[i] = m
    for i in grown:
        out[i] = forest_of(out[i], fits[i][0], n_rows)
    for (i, _), m in zip(others, got):
        if fits[i][0].kind != "rf":
            out[i] = m
        elif out[i] is None:
            out[i] = Forest([m])
        else:
            out[i].parts.append(m)
    return out


def fit(train: DataFrame, spec: ModelSpec, features=FEATURE_COLUMNS, label: str = LABEL):
    return fit_group(train, [(spec, None)], features, label)[0]


def predict(model, df: DataFrame, label: str = LABEL) -> DataFrame:
    """Positive-class probability and 0/1 decision, as plain columns."""
    if isinstance(model, BO.Ensemble):
        return BO.scores({"": model}, df, df.columns).drop("model").withColumn("prediction", (F.col("score") > 0.5).cast("int"))
    df = df.withColumn(label, F.col(label).cast("double")) if label in df.columns else df
    if isinstance(model, Forest):
        return model.transform(df)
    out = model.transform(df)
    return out.withColumns({
        "score": vector_to_array("probability")[1],
        "prediction": F.col("prediction").cast("int"),
    }).drop("features", "rawPrediction", "probability")


def predict_long(models: dict[str, object], df: DataFrame, keep=(), label: str = LABEL) -> DataFrame:
    """(label, keep…, model, score, prediction) of several models."""
    df = df.withColumn("label", F.col(label).cast("int"))
    cols = ["label", *keep]
    boosted = {n: m for n, m in models.items() if isinstance(m, BO.Ensemble)}
    out = [BO.scores(boosted, df, cols).withColumn("prediction", (F.col("score") > 0.5).cast("int"))] if boosted else []
    out += [predict(m, df, label).select(*cols, F.lit(n).alias("model"), "score", "prediction") for n, m in models.items() if n not in boosted]
    whole = out[0]
    for more in out[1:]:
        whole = whole.unionByName(more)
    return whole


def score_tables(groups: list[tuple[dict[str, object], DataFrame]], keep=(), label: str = LABEL) -> DataFrame:
    """``predict_long`` of several (models, rows), written.  A task gets, and
    unpacks, every tree of its job, so each forest has a job of its own, side
    by side with the others, and so have the boosted models of a group."""
    jobs = []
    for models, df in groups:
        boosted = {n: m for n, m in models.items() if isinstance(m, BO.Ensemble)}
        for some in ([boosted] if boosted else []) + [{n: m} for n, m in models.items() if n not in boosted]:
            jobs.append(lambda some=some, df=df: materialize(predict_long(some, df, keep, label), "scores"))
    whole, *more = _side_by_side(groups[0][1].sparkSession, jobs)
    for part in more:
        whole = whole.unionByName(part)
    return whole


def save(model, spark: SparkSession, path: str) -> None:
    if isinstance(model, BO.Ensemble | Forest):
        model.save(spark, path)
    else:
        model.write().save(path)


def save_all(models: dict[str, object], spark: SparkSession, paths: dict[str, str]) -> None:
    _side_by_side(spark, [lambda n=n, m=m: save(m, spark, paths[n]) for n, m in models.items()])


def load(spark: SparkSession, path: str, kind: str):
    return BO.Ensemble.load(spark, path) if kind == "boost" else Forest.load(spark, path) if kind == "rf" else PipelineModel.load(path)


def _kind(model) -> str:
    return "boost" if isinstance(model, BO.Ensemble) else "rf" if isinstance(model, Forest) else "ml"


def evaluate(model, test: DataFrame, label: str = LABEL) -> DataFrame:
    """T6 on a model: accuracy, precision, recall, F1, ROC-AUC."""
    p = predict(model, test, label).withColumn("label", F.col(label).cast("int"))
    return EV.classification_metrics(p)


def fit_folds(data: DataFrame, specs: list[ModelSpec], n_folds: int = EV.N_FOLDS, label: str = LABEL,
              whole: bool = False) -> tuple[list[tuple[dict[str, object], DataFrame]], dict[str, object]]:
    """Refits without one fold each, with that fold's rows, and, if asked for,
    the fits on all rows, all as one group."""
    fits = [(s, k) for k in range(n_folds) for s in specs] + [(s, None) for s in specs if whole]
    models = fit_group(data, fits, label=label)
    of = lambda k: {s.name: m for (s, f), m in zip(fits, models) if f == k}
    return [(of(k), data.filter(F.col("fold") == k)) for k in range(n_folds)], of(None)


def cross_validate(data: DataFrame, specs: list[ModelSpec], n_folds: int = EV.N_FOLDS, label: str = LABEL) -> DataFrame:
    """K-fold F1 over the rows given (the train split, with a stratified
    ``fold`` column), refitted per fold; (model, cv_f1_mean, cv_f1_std) with
    the population std.  All refits are fitted as one group."""
    return EV.cv_f1(score_tables(fit_folds(data, specs, n_folds, label)[0], ["fold"], label), group_cols=["model"])


def feature_importance(model, features=FEATURE_COLUMNS, top: int | None = 10) -> DataFrame:
    """Importances from the fitted trees (model metadata, one value
    per feature) ranked descending; ``top`` keeps the report's top-k."""
    spark = SparkSession.getActiveSession()
    imp = model.importances() if isinstance(model, BO.Ensemble | Forest) else model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame([(f, float(v), i) for i, (f, v) in enumerate(zip(features, imp))],
                               "feature string, importance double, ordinal int")
    df = df.orderBy(F.desc("importance"), F.asc("ordinal"))
    return (df.limit(top) if top else df).drop("ordinal")


# ---------------------------------------------------------------- bookkeeping

def run_id(spec: ModelSpec, source: str) -> str:
    """The same for the same settings and the same source state."""
    return hashlib.md5(json.dumps([spec.name, spec.kind, spec.params, SEED, source], sort_keys=True).encode()).hexdigest()


def run_rows(spark: SparkSession, specs: list[ModelSpec], metrics: DataFrame, cv: DataFrame | None, train_size: int, test_size: int,
             started: dt.datetime, source: str = "") -> DataFrame:
    """One run-log row per learner (settings, sizes, metrics; fold
    metrics where ``cv`` is given), a minute apart."""
    rows = [(s.name, i, run_id(s, source), f"{s.name}_run", started + dt.timedelta(minutes=i), {k: str(v) for k, v in s.params.items()})
            for i, s in enumerate(specs)]
    plan = spark.createDataFrame(rows, "model string, ordinal int, run_id string, run_name string, start_time timestamp, params map<string,string>")
    out = plan.join(metrics, "model")
    out = out.join(cv, "model", "left") if cv is not None else out.withColumns({c: F.lit(None).cast("double") for c in ("cv_f1_mean", "cv_f1_std")})
    return out.select("run_id", "run_name", F.col("model").alias("model_type"), "start_time", F.lit(train_size).cast("bigint").alias("train_size"),
                      F.lit(test_size).cast("bigint").alias("test_size"), "accuracy", "precision", "recall", "f1_score", "roc_auc",
                      "cv_f1_mean", "cv_f1_std", "params", "ordinal")


def append_run(run: DataFrame, runs_path: str) -> None:
    V.append(run, runs_path)


def latest_run(spark: SparkSession, runs_path: str) -> DataFrame:
    """The most recent run (``search_runs`` ordered by start time,
    one result)."""
    runs = V.read(spark, runs_path)
    return runs.agg(F.max_by(F.struct(*runs.columns), F.struct("start_time", "run_id")).alias("r")).select("r.*")


def _latest(spark: SparkSession, registry_path: str, name: str):
    """The state of the versions table and the row of a model's highest
    version in it, or None where none is registered.  A versions table that is
    there but can't be read is an error: taking it for an empty one would
    start the numbers again."""
    snap = V.snapshot(spark, f"{registry_path}/versions")
    if not snap.version:
        return snap, None
    rows = V.open_snapshot(spark, f"{registry_path}/versions", snap).filter(F.col("name") == name)
    return snap, rows.agg(F.max_by(F.struct(*rows.columns), "version").alias("r")).first()["r"]


def register_version(spark: SparkSession, model, registry_path: str, name: str, run_id: str, stage: str = "Production") -> DataFrame:
    """Next version = max(version) + 1 for the name.  The model is saved
    in a folder of its own first; its row is committed on top of the versions
    table it was numbered from, so two writers never get the same number."""
    path = f"{registry_path}/models/{name}/{uuid.uuid4().hex}"
    save(model, spark, path)
    while True:
        snap, last = _latest(spark, registry_path, name)
        row = spark.createDataFrame([(name, (last["version"] if last else 0) + 1, run_id, stage, path, _kind(model))],
                                    "name string, version int, run_id string, stage string, path string, kind string")
        try:
            V.append(row, f"{registry_path}/versions", base=snap.version)
            return row
        except V.Conflict:
            continue


def registered_versions(spark: SparkSession, registry_path: str) -> DataFrame:
    return V.read(spark, f"{registry_path}/versions")


def load_production(spark: SparkSession, registry_path: str, name: str):
    """Latest registered version of a model, or None where none was
    registered (→ rule fallback); failing reads are errors."""
    last = _latest(spark, registry_path, name)[1]
    return load(spark, last["path"], last["kind"]) if last else None


def model_metadata(spark: SparkSession, spec: ModelSpec, metrics: DataFrame, trained_at: str,
                   features=FEATURE_COLUMNS) -> DataFrame:
    """Model name, best score, training time, feature list, metrics."""
    return metrics.select(F.lit(spec.name).alias("model_name"), F.col("f1_score").alias("best_score"),
                          F.lit(trained_at).alias("trained_at"),
                          F.array(*[F.lit(f) for f in features]).alias("features"),
                          F.struct("f1_score", "accuracy").alias("metrics"))


def score_with_model(model, raw: DataFrame, feature_model, as_of: str) -> DataFrame:
    """The model's probability where a model is available and produced
    one, the rule score otherwise.  The rule score is computed on the raw
    columns first and carried through the feature transform, so the whole
    scoring is one narrow pipeline — no join back to the requests."""
    from . import scoring as SC
    x = raw.withColumn("rule_probability", SC.rule_score())
    if model is None:
        scored = x.withColumns({"churn_probability_raw": F.col("rule_probability"),
                                "model_mode": F.lit(SC.RULES_MODE)})
    else:
        p = predict(model, feature_model.transform(x).drop(LABEL))
        scored = p.withColumns({
            "churn_probability_raw": F.coalesce(F.col("score"), F.col("rule_probability")),
            "model_mode": F.when(F.col("score").isNotNull(), F.lit(SC.MODEL_MODE)).otherwise(F.lit(SC.RULES_MODE))})
    return SC.response_rows(scored, as_of, F.col("model_mode"))
