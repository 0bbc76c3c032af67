"""Drift detection.

The reference runs one KS test per feature in a Python loop.  Here all
features go through one plan: wide → long (feature, side, value), distinct
values counted per side (partial aggregation), a distributed prefix sum per
feature gives both empirical CDFs at every distinct value, and the KS
statistic is a max per feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import hkey, ks_pvalue
from .stats import equal_width_histogram, prefix_sum, to_long, with_one_row

# Fixed values (drift rules of the reference).
KS_THRESHOLD = 0.1
P_VALUE_THRESHOLD = 0.05
PREDICTION_DRIFT_THRESHOLD = 0.05
ALERT_PCT, WARNING_PCT = 20.0, 10.0
TOP_K = 5
HIST_BINS = 30
EXCLUDED = ("customer_id", "churned")
REF_LIMIT, PROD_LIMIT = 5000, 2000
SAMPLE_ORDER_KEY = 633910099


def numeric_features(df: DataFrame, exclude=EXCLUDED) -> list[str]:
    """Numeric columns minus identifiers and the label."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def bounded_sample(df: DataFrame, n: int, key: str = "k") -> DataFrame:
    """A deterministic bounded sample — the first ``n`` rows by key hash
    (TakeOrderedAndProject: a per-partition top-n, no global sort)."""
    return df.orderBy(hkey(key, SAMPLE_ORDER_KEY), F.col(key)).limit(n)


def value_counts(sides: DataFrame, features, side_col: str = "side") -> DataFrame:
    """Rows per (feature, distinct value) on each side; missing values dropped."""
    long = to_long(sides, features, [side_col], "double").filter(F.col("value").isNotNull())
    return (long.groupBy(F.col("column").alias("feature"), "value")
            .agg(F.count_if(F.col(side_col) == "ref").alias("c_ref"), F.count_if(F.col(side_col) == "prod").alias("c_prod")))


def ks_from_counts(counts: DataFrame) -> DataFrame:
    """D1 from value counts (several rows of one value are added up)."""
    one = counts.groupBy("feature", "value").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_prod").alias("c_prod"))
    cum = prefix_sum(one, ["feature"], ["value"], ["c_ref", "c_prod"])
    gap = F.abs(F.try_divide("c_ref_cum", "c_ref_tot") - F.try_divide("c_prod_cum", "c_prod_tot"))
    return cum.groupBy("feature").agg(F.max(gap).alias("ks_statistic"),
                                      F.first("c_ref_tot").alias("n_ref"),
                                      F.first("c_prod_tot").alias("n_prod"))


def ks_statistics(sides: DataFrame, features, side_col: str = "side") -> DataFrame:
    """Two-sample KS statistic per feature (missing values dropped,
    ties grouped).  Output: feature, ks_statistic, n_ref, n_prod."""
    return ks_from_counts(value_counts(sides, features, side_col))


def side_means(sides: DataFrame, features, side_col: str = "side") -> DataFrame:
    """D4 inputs: per-feature mean on each side — conditional averages of the
    columns as they are, one row, then one row per feature."""
    def mean(c: str, side: str):
        v = F.col(f"`{c}`").cast("double")
        return F.avg(F.when((F.col(side_col) == side) & ~F.isnan(v), v)).alias(f"{side}:{c}")

    wide = sides.agg(*[mean(c, side) for c in features for side in ("ref", "prod")])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`ref:{c}`").alias("ref_mean"), F.col(f"`prod:{c}`").alias("prod_mean"))
                     for c in features])
    return wide.select(F.inline(rows))


def drift_from_counts(counts: DataFrame, means: DataFrame, features=None) -> DataFrame:
    """D1–D4 from value counts and means (of both sides, or of either side
    each): feature, ordinal, ks_statistic, p_value, drift_detected, ref_mean,
    prod_mean, change_pct."""
    m = means.groupBy("feature").agg(F.max("ref_mean").alias("ref_mean"), F.max("prod_mean").alias("prod_mean"))
    ordinal = (F.array_position(F.array(*[F.lit(f) for f in features or []]).cast("array<string>"), F.col("feature")) - 1).cast("int")
    tested = ks_from_counts(counts).join(m, "feature").repartition(max(1, len(features or [])), "feature")      # a p-value each, in tasks of their own
    p = ks_pvalue(F.col("ks_statistic"), F.col("n_ref"), F.col("n_prod"))
    return tested.withColumn("p_value", p).select(
        "feature", ordinal.alias("ordinal"), "ks_statistic", "p_value",
        ((F.col("ks_statistic") > KS_THRESHOLD) | (F.col("p_value") < P_VALUE_THRESHOLD)).alias("drift_detected"),
        "ref_mean", "prod_mean",
        (F.try_divide(F.col("prod_mean") - F.col("ref_mean"), F.col("ref_mean")) * F.lit(100.0)).alias("change_pct"))


def feature_drift(sides: DataFrame, features=None, side_col: str = "side") -> DataFrame:
    """D1–D4 over ``features`` (default: every numeric column that is no
    identifier or label), with the feature's ordinal (input order)."""
    feats = features or numeric_features(sides.drop(side_col))
    return drift_from_counts(value_counts(sides, feats, side_col), side_means(sides, feats, side_col), feats)


def prediction_drift(sides: DataFrame, label: str = "churned", side_col: str = "side") -> DataFrame:
    """Churn-rate shift between the sides."""
    r = sides.agg(F.avg(F.when(F.col(side_col) == "ref", F.col(label))).alias("ref_churn_rate"),
                  F.avg(F.when(F.col(side_col) == "prod", F.col(label))).alias("prod_churn_rate"))
    diff = F.col("prod_churn_rate") - F.col("ref_churn_rate")
    return r.select("ref_churn_rate", "prod_churn_rate", F.abs(diff).alias("absolute_change"),
                    (F.try_divide(diff, F.col("ref_churn_rate")) * F.lit(100.0)).alias("change_pct"),
                    (F.abs(diff) > PREDICTION_DRIFT_THRESHOLD).alias("drift_detected"))


def drift_summary(drift: DataFrame) -> DataFrame:
    """D6 + D11: counts, share drifted, status, retrain flag."""
    s = drift.agg(F.count(F.lit(1)).alias("total_features_analyzed"),
                  F.count_if("drift_detected").alias("features_with_drift"))
    pct = F.coalesce(F.try_divide(F.col("features_with_drift").cast("double"),
                                  F.col("total_features_analyzed").cast("double")) * F.lit(100.0), F.lit(0.0))
    s = s.withColumn("drift_percentage", pct)
    status = (F.when(F.col("drift_percentage") > ALERT_PCT, "ALERT")
              .when(F.col("drift_percentage") > WARNING_PCT, "WARNING").otherwise("OK"))
    return s.withColumn("overall_drift_status", status) \
        .withColumn("retrain_recommended", F.col("overall_drift_status") == "ALERT")


def top_drifted(drift: DataFrame, k: int = TOP_K) -> DataFrame:
    """Top-k by KS statistic; ties keep input order (first wins)."""
    return (drift.orderBy(F.desc("ks_statistic"), F.asc("ordinal")).limit(k)
            .select("feature", "ks_statistic", "change_pct"))


def drift_report(drift: DataFrame, pred: DataFrame, as_of: str, k: int = TOP_K) -> DataFrame:
    """D8 (S11): one nested record; arrays are bounded by the feature count."""
    summary = drift_summary(drift)
    by_ord = lambda a, b: F.when(a["ordinal"] < b["ordinal"], -1).when(a["ordinal"] > b["ordinal"], 1).otherwise(0)
    allf = drift.agg(F.array_sort(F.collect_list(F.struct(*drift.columns)), by_ord).alias("all_features"))
    ranked = (drift.orderBy(F.desc("ks_statistic"), F.asc("ordinal")).limit(k)
              .select(F.struct("ks_statistic", "ordinal", "feature", "change_pct").alias("t")))
    by_ks = lambda a, b: (F.when(a["ks_statistic"] > b["ks_statistic"], -1)
                          .when(a["ks_statistic"] < b["ks_statistic"], 1)
                          .when(a["ordinal"] < b["ordinal"], -1).when(a["ordinal"] > b["ordinal"], 1).otherwise(0))
    top = ranked.agg(F.array_sort(F.collect_list("t"), by_ks).alias("_t")).select(
        F.transform("_t", lambda x: F.struct(x["feature"].alias("feature"), x["ks_statistic"].alias("ks_statistic"),
                                             x["change_pct"].alias("change_pct"))).alias("top_drifted_features"))
    rep = with_one_row(with_one_row(with_one_row(summary, allf), top), pred.select(F.struct(*pred.columns).alias("prediction_drift")))
    return rep.select(F.lit(as_of).alias("timestamp"),
                      F.struct("total_features_analyzed", "features_with_drift", "drift_percentage",
                               "overall_drift_status").alias("summary"),
                      "prediction_drift", "top_drifted_features", "all_features")


def drift_histograms(sides: DataFrame, features, side_col: str = "side", bins: int = HIST_BINS) -> DataFrame:
    """Density histograms (``bins`` equal-width bins over each side's own
    range) for the given features — the data behind the overlaid plot."""
    long = to_long(sides, features, [side_col], "double").withColumnRenamed("column", "feature")
    return equal_width_histogram(long, "value", bins, group_cols=["feature", side_col], density=True)
