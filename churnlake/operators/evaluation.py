"""Model evaluation as aggregates (T1, T6, T7 folds, T9–T13, T15).

All metrics come from integer counts computed in one aggregate pass, so
they are exact ratios of integers and agree bit-for-bit with any SQL engine.
ROC-AUC is the Mann–Whitney statistic with average ranks for ties, computed
over distinct scores with a distributed prefix sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import hkey
from .stats import prefix_sum, with_one_row

SPLIT_KEY = 961748927
TEST_FRACTION = 0.2
N_FOLDS = 5


def _ratio(a: Column, b: Column) -> Column:
    """a / b with 0 when b = 0 (scikit-learn ``zero_division`` default)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction", group_cols=()) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.groupBy(*group_cols).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 1) & (p == 0)).alias("fn"))


def metrics_from_counts(c: DataFrame, group_cols=()) -> DataFrame:
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return c.select(*group_cols,
                     _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                     _ratio(tp, tp + fp).alias("precision"),
                     _ratio(tp, tp + fn).alias("recall"),
                     _ratio(F.lit(2) * tp, F.lit(2) * tp + fp + fn).alias("f1_score"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", group_cols=()) -> DataFrame:
    """Average-rank AUC per group: Σ_pos (negatives below + ½ ties) / (P·N).

    Rows are first collapsed to distinct (group, score) with positive and
    negative counts (partial aggregation); the negatives-below count is a
    prefix sum over those distinct scores.
    """
    g = list(group_cols)
    y = F.col(label)
    d = (df.filter(F.col(score).isNotNull())
         .groupBy(*g, F.col(score).cast("double").alias("s"))
         .agg(F.count_if(y == 1).alias("npos"), F.count_if(y == 0).alias("nneg")))
    cum = prefix_sum(d, g, ["s"], ["nneg", "npos"])
    below = F.col("nneg_cum") - F.col("nneg")
    num = cum.groupBy(*g).agg(
        F.sum(F.lit(2) * F.col("npos") * below + F.col("npos") * F.col("nneg")).alias("_num2"),
        F.first("npos_tot").alias("_p"), F.first("nneg_tot").alias("_n"))
    return num.select(*g, F.try_divide(F.col("_num2").cast("double"),
                                       (F.lit(2) * F.col("_p") * F.col("_n")).cast("double")).alias("roc_auc"))


def classification_metrics(df: DataFrame, label: str = "label", pred: str = "prediction",
                           score: str | None = "score", group_cols=()) -> DataFrame:
    """Accuracy, precision, recall, F1 (positive class 1) and ROC-AUC."""
    m = metrics_from_counts(confusion_counts(df, label, pred, group_cols), group_cols)
    if score is None:
        return m
    a = roc_auc(df, label, score, group_cols)
    return m.join(a, list(group_cols)) if group_cols else with_one_row(m, a)


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """The full 2×2 grid (absent cells as 0) from one aggregate."""
    c = confusion_counts(df, label, pred)
    return c.select(F.inline(F.array(
        F.struct(F.lit(0).alias("label"), F.lit(0).alias("prediction"), F.col("tn").alias("count")),
        F.struct(F.lit(0).alias("label"), F.lit(1).alias("prediction"), F.col("fp").alias("count")),
        F.struct(F.lit(1).alias("label"), F.lit(0).alias("prediction"), F.col("fn").alias("count")),
        F.struct(F.lit(1).alias("label"), F.lit(1).alias("prediction"), F.col("tp").alias("count")))))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class precision / recall / F1 / support, macro and
    support-weighted averages, and accuracy — from the four counts."""
    c = confusion_counts(df, label, pred)
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    # class 1 is positive; class 0 swaps the roles
    p1, r1, f1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn), _ratio(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp), _ratio(2 * tn, 2 * tn + fn + fp)
    s1, s0 = (tp + fn), (tn + fp)
    n = s0 + s1
    acc = _ratio(tp + tn, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.cast("bigint").alias("support"))

    wavg = lambda a, b: _ratio(a * s0 + b * s1, n)
    return c.select(F.inline(F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", acc, acc, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", wavg(p0, p1), wavg(r0, r1), wavg(f0, f1), n))))


def stratified_split(df: DataFrame, label: str = "label", key: str = "k", test_fraction: float = TEST_FRACTION,
                     hash_a: int = SPLIT_KEY) -> DataFrame:
    """Exact stratified split.  Within each class rows are ranked by
    (H(key), key); the first ROUND(f·n_class) are test.  The rank is a
    distributed prefix count over (key, class) alone, so a class with a third
    (or all) of the rows is spread over many tasks; the rows meet their split
    in one join on the (unique) key (merged: stored keys are so small that
    Spark would send millions of them through the driver)."""
    x = df.select(key, label).withColumns({"_h": hkey(key, hash_a), "_one": F.lit(1)})
    r = prefix_sum(x, [label], ["_h", key], ["_one"])
    test = F.col("_one_cum") <= F.round(F.lit(test_fraction) * F.col("_one_tot"))
    split = r.select(key, F.when(test, F.lit("test")).otherwise(F.lit("train")).alias("split"))
    return df.join(split.hint("merge"), key)


def stratified_folds(df: DataFrame, label: str = "label", key: str = "k", n_folds: int = N_FOLDS,
                     hash_a: int = SPLIT_KEY) -> DataFrame:
    """Folds of equal class shares — within each class rows are dealt to
    the folds in (H(key), key) order."""
    x = df.select(key, label).withColumns({"_h": hkey(key, hash_a), "_one": F.lit(1)})
    r = prefix_sum(x, [label], ["_h", key], ["_one"])
    folds = r.select(key, ((F.col("_one_cum") - 1) % n_folds).cast("int").alias("fold"))
    return df.join(folds.hint("merge"), key)


def fold_assignment(df: DataFrame, key: str = "k", n_folds: int = N_FOLDS, hash_a: int = SPLIT_KEY) -> DataFrame:
    """fold = H(key) mod n_folds."""
    return df.withColumn("fold", (hkey(key, hash_a) % n_folds).cast("int"))


def cv_f1(df: DataFrame, label: str = "label", pred: str = "prediction", group_cols=()) -> DataFrame:
    """Per-fold F1, then mean and population std over folds."""
    per = metrics_from_counts(confusion_counts(df, label, pred, [*group_cols, "fold"]), [*group_cols, "fold"])
    return per.groupBy(*group_cols).agg(F.avg("f1_score").alias("cv_f1_mean"),
                                        F.stddev_pop("f1_score").alias("cv_f1_std"))


# --------------------------------------------------------------------------
# run log, selection, comparison, promotion


def best_model(runs: DataFrame, metric: str = "f1_score", order_col: str = "ordinal") -> DataFrame:
    """Highest metric wins; ties go to the earliest run (strict >).
    No run with the metric gives no row."""
    best = runs.filter(F.col(metric).isNotNull()).agg(
        F.max_by(F.struct(*runs.columns), F.struct(F.col(metric), -F.col(order_col))).alias("b"))
    return best.filter(F.col("b").isNotNull()).select("b.*")


def model_comparison(runs: DataFrame) -> DataFrame:
    """Display names for metrics; runs with any missing metric dropped."""
    metrics = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
    return (runs.dropna(subset=metrics)
            .select(F.col("run_name").alias("Model"), F.col("accuracy").alias("Accuracy"),
                    F.col("precision").alias("Precision"), F.col("recall").alias("Recall"),
                    F.col("f1_score").alias("F1-Score"), F.col("roc_auc").alias("ROC-AUC")))


def promotion_gate(runs: DataFrame, production_prefix: str = "PRODUCTION_", min_gain: float = 0.02) -> DataFrame:
    """The best candidate is promoted iff its F1 beats the production
    run's F1 by more than ``min_gain`` (relative)."""
    is_prod = F.col("run_name").startswith(production_prefix)
    cand = best_model(runs.filter(~is_prod)).select(
        F.col("run_name").alias("candidate"), F.col("f1_score").alias("candidate_f1"))
    prod = best_model(runs.filter(is_prod)).select(
        F.col("run_name").alias("production"), F.col("f1_score").alias("production_f1"))
    return with_one_row(cand, prod).withColumn(
        "promote", F.col("candidate_f1") > F.col("production_f1") * F.lit(1.0 + min_gain))


def run_log_rows(scored: DataFrame, start_time: str, params: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """One run-log row per scorer from a long frame
    (scorer, ordinal, k, label, score, prediction, split, fold): test-split
    metrics, sizes and 5-fold F1 — all grouped aggregates, no loop."""
    g = ["scorer", "ordinal"]
    test = scored.filter(F.col("split") == "test")
    m = classification_metrics(test, group_cols=g)
    sizes = scored.groupBy(*g).agg(F.count_if(F.col("split") == "train").alias("train_size"),
                                   F.count_if(F.col("split") == "test").alias("test_size"))
    cv = cv_f1(scored, group_cols=g)
    out = m.join(sizes, g).join(cv, g)
    pmap = F.create_map()
    if params:
        pm = [F.when(F.col("scorer") == s, F.create_map(*[F.lit(x) for kv in p.items() for x in kv]))
              for s, p in params.items()]
        pmap = F.coalesce(*pm, F.create_map().cast("map<string,string>"))
    return out.select(
        F.concat(F.lit("run-"), F.col("ordinal").cast("string")).alias("run_id"),
        F.col("scorer").alias("run_name"), F.col("scorer").alias("model_type"), "ordinal",
        F.lit(start_time).cast("timestamp").alias("start_time"),
        "train_size", "test_size", "accuracy", "precision", "recall", "f1_score", "roc_auc",
        "cv_f1_mean", "cv_f1_std", pmap.cast("map<string,string>").alias("params"))


def stack_scorers(df: DataFrame, scorers: dict[str, Column], threshold: float = 0.5) -> DataFrame:
    """Long frame (scorer, ordinal, …, score, prediction) for several scoring
    columns over the same rows — one ``explode`` instead of a union per
    scorer; a null score falls back to no prediction."""
    arr = F.array(*[F.struct(F.lit(name).alias("scorer"), F.lit(i).alias("ordinal"),
                             expr.cast("double").alias("score")) for i, (name, expr) in enumerate(scorers.items())])
    x = df.select("*", F.inline(arr))
    return x.withColumn("prediction", (F.col("score") >= threshold).cast("int"))


