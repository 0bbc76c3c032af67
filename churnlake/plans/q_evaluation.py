"""T1, T6, T7 folds, T9–T13, T15: evaluation over the scored customer set."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import evaluation as EV
from ..operators import features as FE
from ..operators import scoring as SC
from ..sources import fixtures as FX
from .ctes import define
from .q_scoring import _RULE
from .registry import query

START_TIME = "2025-10-09 23:49:44"
RUN_PARAMS = {
    "PRODUCTION_rules": {"mode": "rules", "threshold": "0.5"},
    "risk_score": {"mode": "feature", "feature": "risk_score"},
    "high_risk_contract": {"mode": "feature", "feature": "high_risk_contract"},
}


def scored_set(spark, sf_dir):
    """FIXTURES §5: customers with the rule score, its decision and the label."""
    cr = FX.with_key(FX.customers_raw(spark, sf_dir))
    p = SC.rule_score()
    return cr.select("k", "customer_id", F.col("churned").alias("label"), p.alias("score"),
                     (p >= 0.5).cast("int").alias("prediction"))


def scorer_long(spark, sf_dir):
    """Three scorers over the same customers, with split and fold."""
    from .q_drift import feature_model
    biz = FX.with_key(FE.business_features(FX.customers_raw(spark, sf_dir), feature_model(spark, sf_dir).p75))
    scorers = {
        "PRODUCTION_rules": SC.rule_score(),
        "risk_score": F.col("risk_score"),
        "high_risk_contract": F.col("high_risk_contract").cast("double"),
    }
    base = biz.select("k", "customer_id", F.col("churned").alias("label"), *[e.alias(f"_s{i}") for i, e in
                                                                            enumerate(scorers.values())])
    long = EV.stack_scorers(base, {n: F.col(f"_s{i}") for i, n in enumerate(scorers)}).drop(
        *[f"_s{i}" for i in range(len(scorers))])
    long = EV.fold_assignment(long)
    # the split depends on the key and label only: compute it once per customer
    split = EV.stratified_split(base.select("k", "label")).select("k", "split")
    return long.join(split.hint("merge"), "k")      # a row per customer: never through the driver


def run_log(spark, sf_dir):
    """The run log, a stored table (the reference's tracking store).

    The training step writes it once per session to the shared table
    folder; best-model selection, the comparison table and the promotion
    gate read that table, as the reference's later steps read logged runs.
    While building it, the long scored frame feeds four aggregates
    (metrics, AUC, sizes, CV) and is written once so they read it
    instead of re-deriving it."""
    def build():
        from ..session import materialize, scratch_path
        from ..sources.sinks import write_table
        long = materialize(scorer_long(spark, sf_dir))
        return write_table(EV.run_log_rows(long, START_TIME, RUN_PARAMS), scratch_path(spark, "run_log"))

    return spark.read.parquet(FX.session_artifact(spark, "run_log", sf_dir, build))


# ---------------------------------------------------------------- oracle CTEs
define("scored", ["rule_scored"], "SELECT k, customer_id, churned AS label, p AS score, "
       "CAST(p >= 5e-1 AS INTEGER) AS prediction FROM rule_scored")
define("split_rank", ["customers_k"], """
  SELECT k, churned AS label,
         CASE WHEN row_number() OVER (PARTITION BY churned ORDER BY ((k + 1) * 961748927) % 2147483647, k)
                   <= ROUND(2e-1 * COUNT(*) OVER (PARTITION BY churned)) THEN 'test' ELSE 'train' END AS split
  FROM customers_k""")
define("scorer_long", ["rule_scored", "biz", "split_rank"], f"""
  SELECT u.*, CAST(score >= 5e-1 AS INTEGER) AS prediction, CAST((((k + 1) * 961748927) % 2147483647) % 5 AS INTEGER) AS fold,
         sr.split
  FROM (SELECT r.k, r.customer_id, r.churned AS label, 'PRODUCTION_rules' AS scorer, 0 AS ordinal, r.p AS score FROM rule_scored r
        UNION ALL SELECT b.k, b.customer_id, b.churned, 'risk_score', 1, b.risk_score FROM (SELECT biz.*, customers_k.k FROM biz JOIN customers_k USING (customer_id)) b
        UNION ALL SELECT r.k, r.customer_id, r.churned, 'high_risk_contract', 2, CASE WHEN contract_type = 'Month-to-month' THEN 1e0 ELSE 0e0 END
               FROM rule_scored r) u
  JOIN split_rank sr USING (k)""")


def _counts_sql(src, group):
    gsel = f"{group}, " if group else ""
    gby = f"GROUP BY {group}" if group else ""
    return f"""SELECT {gsel}COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
       COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
       COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
       COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn FROM {src} {gby}"""


def _r(a, b):
    return f"coalesce(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0e0), 0e0)"


_METRICS = (f"{_r('tp + tn', 'tp + fp + tn + fn')} AS accuracy, {_r('tp', 'tp + fp')} AS precision, "
            f"{_r('tp', 'tp + fn')} AS recall, {_r('2 * tp', '2 * tp + fp + fn')} AS f1_score")


def _auc_sql(src, group):
    gsel = f"{group}, " if group else ""
    part = f"PARTITION BY {group}" if group else ""
    gby = f"GROUP BY {group}" if group else ""
    return f"""SELECT {gsel}CAST(SUM(2 * npos * below + npos * nneg) AS DOUBLE)
                  / CAST(2 * SUM(npos) * SUM(nneg) AS DOUBLE) AS roc_auc
FROM (SELECT *, coalesce(SUM(nneg) OVER ({part} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT {gsel}CAST(score AS DOUBLE) AS s, COUNT(*) FILTER (WHERE label = 1) AS npos,
                   COUNT(*) FILTER (WHERE label = 0) AS nneg
            FROM {src} WHERE score IS NOT NULL GROUP BY {gsel}CAST(score AS DOUBLE))) {gby}"""


define("run_metrics", ["scorer_long"], f"""
  SELECT c.scorer, c.ordinal, {_METRICS}, a.roc_auc
  FROM ({_counts_sql("(SELECT * FROM scorer_long WHERE split = 'test')", "scorer, ordinal")}) c
  JOIN ({_auc_sql("(SELECT * FROM scorer_long WHERE split = 'test')", "scorer, ordinal")}) a USING (scorer, ordinal)""")
define("run_cv", ["scorer_long"], f"""
  SELECT scorer, ordinal, AVG(f1_score) AS cv_f1_mean, stddev_pop(f1_score) AS cv_f1_std
  FROM (SELECT scorer, ordinal, fold, {_r('2 * tp', '2 * tp + fp + fn')} AS f1_score
        FROM ({_counts_sql("scorer_long", "scorer, ordinal, fold")})) GROUP BY scorer, ordinal""")
define("run_log", ["run_metrics", "run_cv", "scorer_long"], """
  SELECT concat('run-', CAST(m.ordinal AS VARCHAR)) AS run_id, m.scorer AS run_name, m.scorer AS model_type,
         m.ordinal, s.train_size, s.test_size, m.accuracy, m.precision, m.recall, m.f1_score, m.roc_auc,
         c.cv_f1_mean, c.cv_f1_std
  FROM run_metrics m JOIN run_cv c USING (scorer, ordinal)
  JOIN (SELECT scorer, COUNT(*) FILTER (WHERE split = 'train') AS train_size,
               COUNT(*) FILTER (WHERE split = 'test') AS test_size FROM scorer_long GROUP BY scorer) s
    ON s.scorer = m.scorer""")


@query("stratified_split", oracle="SELECT k AS customer_key, label, split FROM split_rank")
def stratified_split(spark, sf_dir):
    s = scored_set(spark, sf_dir)
    return EV.stratified_split(s).select(F.col("k").alias("customer_key"), "label", "split")


@query("split_summary", oracle="SELECT label, split, COUNT(*) AS n FROM split_rank GROUP BY label, split")
def split_summary(spark, sf_dir):
    return (EV.stratified_split(scored_set(spark, sf_dir))
            .groupBy("label", "split").agg(F.count(F.lit(1)).alias("n")))


@query("fold_assignment", oracle="""
SELECT CAST((((k + 1) * 961748927) % 2147483647) % 5 AS INTEGER) AS fold, COUNT(*) AS n,
       CAST(SUM(churned) AS BIGINT) AS positives FROM customers_k GROUP BY 1""")
def fold_assignment(spark, sf_dir):
    return (EV.fold_assignment(scored_set(spark, sf_dir)).groupBy("fold")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("label").cast("bigint").alias("positives")))


@query("classification_metrics", oracle=f"SELECT {_METRICS} FROM ({_counts_sql('scored', '')})")
def classification_metrics(spark, sf_dir):
    return EV.classification_metrics(scored_set(spark, sf_dir), score=None)


@query("roc_auc", oracle=_auc_sql("scored", ""))
def roc_auc(spark, sf_dir):
    return EV.roc_auc(scored_set(spark, sf_dir))


@query("confusion_matrix", oracle=f"""
SELECT * FROM (SELECT 0 AS label, 0 AS prediction, tn AS count FROM c UNION ALL SELECT 0, 1, fp FROM c
               UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c)""".replace(
    "FROM c", f"FROM ({_counts_sql('scored', '')})"))
def confusion_matrix(spark, sf_dir):
    return EV.confusion_matrix(scored_set(spark, sf_dir))


_REPORT = f"""
SELECT '0' AS class, {_r('tn', 'tn + fn')} AS precision, {_r('tn', 'tn + fp')} AS recall,
       {_r('2 * tn', '2 * tn + fn + fp')} AS f1_score, CAST(tn + fp AS BIGINT) AS support FROM c
UNION ALL SELECT '1', {_r('tp', 'tp + fp')}, {_r('tp', 'tp + fn')}, {_r('2 * tp', '2 * tp + fp + fn')}, CAST(tp + fn AS BIGINT) FROM c
UNION ALL SELECT 'accuracy', {_r('tp + tn', 'tp + tn + fp + fn')}, {_r('tp + tn', 'tp + tn + fp + fn')},
       {_r('tp + tn', 'tp + tn + fp + fn')}, CAST(tp + tn + fp + fn AS BIGINT) FROM c
UNION ALL SELECT 'macro avg', ({_r('tn', 'tn + fn')} + {_r('tp', 'tp + fp')}) / 2,
       ({_r('tn', 'tn + fp')} + {_r('tp', 'tp + fn')}) / 2,
       ({_r('2 * tn', '2 * tn + fn + fp')} + {_r('2 * tp', '2 * tp + fp + fn')}) / 2, CAST(tp + tn + fp + fn AS BIGINT) FROM c
UNION ALL SELECT 'weighted avg',
       {_r(f"{_r('tn', 'tn + fn')} * (tn + fp) + {_r('tp', 'tp + fp')} * (tp + fn)", 'tp + tn + fp + fn')},
       {_r(f"{_r('tn', 'tn + fp')} * (tn + fp) + {_r('tp', 'tp + fn')} * (tp + fn)", 'tp + tn + fp + fn')},
       {_r(f"{_r('2 * tn', '2 * tn + fn + fp')} * (tn + fp) + {_r('2 * tp', '2 * tp + fp + fn')} * (tp + fn)", 'tp + tn + fp + fn')},
       CAST(tp + tn + fp + fn AS BIGINT) FROM c"""


@query("classification_report", oracle=f"SELECT * FROM (WITH c AS ({_counts_sql('scored', '')}) {_REPORT})")
def classification_report(spark, sf_dir):
    return EV.classification_report(scored_set(spark, sf_dir))


@query("cross_validation_rules", oracle="""
SELECT ROUND(cv_f1_mean, 10) AS cv_f1_mean, ROUND(cv_f1_std, 10) AS cv_f1_std FROM run_cv
WHERE scorer = 'PRODUCTION_rules'""")
def cross_validation_rules(spark, sf_dir):
    s = EV.fold_assignment(scored_set(spark, sf_dir))
    return EV.cv_f1(s).select(F.round("cv_f1_mean", 10).alias("cv_f1_mean"),
                              F.round("cv_f1_std", 10).alias("cv_f1_std"))


_RUN_COLS = ("run_id, run_name, model_type, ordinal, train_size, test_size, accuracy, precision, recall, f1_score, "
             "roc_auc, ROUND(cv_f1_mean, 10) AS cv_f1_mean, ROUND(cv_f1_std, 10) AS cv_f1_std")


def _run_cols(df):
    return df.select("run_id", "run_name", "model_type", "ordinal", "train_size", "test_size", "accuracy",
                     "precision", "recall", "f1_score", "roc_auc", F.round("cv_f1_mean", 10).alias("cv_f1_mean"),
                     F.round("cv_f1_std", 10).alias("cv_f1_std"))


@query("run_log", oracle=f"SELECT {_RUN_COLS} FROM run_log")
def run_log_q(spark, sf_dir):
    return _run_cols(run_log(spark, sf_dir))


@query("best_model", oracle="""
SELECT run_name, f1_score FROM run_log WHERE f1_score IS NOT NULL ORDER BY f1_score DESC, ordinal LIMIT 1""")
def best_model(spark, sf_dir):
    return EV.best_model(run_log(spark, sf_dir)).select("run_name", "f1_score")


@query("model_comparison", oracle="""
SELECT run_name AS "Model", accuracy AS "Accuracy", precision AS "Precision", recall AS "Recall",
       f1_score AS "F1-Score", roc_auc AS "ROC-AUC" FROM run_log
WHERE accuracy IS NOT NULL AND precision IS NOT NULL AND recall IS NOT NULL AND f1_score IS NOT NULL
  AND roc_auc IS NOT NULL""")
def model_comparison(spark, sf_dir):
    return EV.model_comparison(run_log(spark, sf_dir))


@query("promotion_gate", oracle="""
SELECT c.run_name AS candidate, c.f1_score AS candidate_f1, p.run_name AS production, p.f1_score AS production_f1,
       c.f1_score > p.f1_score * 1.02e0 AS promote
FROM (SELECT * FROM run_log WHERE NOT starts_with(run_name, 'PRODUCTION_') ORDER BY f1_score DESC, ordinal LIMIT 1) c,
     (SELECT * FROM run_log WHERE starts_with(run_name, 'PRODUCTION_') ORDER BY f1_score DESC, ordinal LIMIT 1) p""")
def promotion_gate(spark, sf_dir):
    return EV.promotion_gate(run_log(spark, sf_dir))
