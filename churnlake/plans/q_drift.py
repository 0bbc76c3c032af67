"""Drift between reference and production feature sides."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as DR
from ..operators import features as FE
from ..session import scratch_path
from ..sources import fixtures as FX
from ..sources import sinks
from .ctes import define
from .registry import query

AS_OF = "2024-01-31T00:00:00"
FEATS = FE.FEATURE_COLUMNS


def feature_model(spark, sf_dir):
    """The feature job's fitted model (p75, codes, moments), fitted once per
    session on the loaded table."""
    return FX.session_artifact(spark, "feature_model", sf_dir,
                               lambda: FE.FeatureModel.fit(FX.customers_raw(spark, sf_dir)))


def unscaled_features(spark, sf_dir):
    """The unscaled feature table, written once by the feature job; drift
    reads it (the reference's drift job reads the stored feature table)."""
    from ..sources.sinks import write_table

    def build():
        raw = FX.customers_raw(spark, sf_dir)
        ft = FE.select_features(feature_model(spark, sf_dir).transform(raw, scale=False))
        return (write_table(ft, scratch_path(spark, "customer_features_unscaled")), ft.schema)

    path, schema = FX.session_artifact(spark, "features_unscaled", sf_dir, build)
    return spark.read.schema(schema).parquet(path)


def sides(spark, sf_dir):
    """Reference/production feature rows.  Every drift pass (KS, means,
    label drift, histograms) reads this table, so it is materialised once."""
    from ..session import materialize
    return materialize(FX.drift_sides(spark, sf_dir, unscaled_features(spark, sf_dir)).drop("k"))


def _drift(spark, sf_dir):
    """The features are the numeric columns that are no id or label."""
    return DR.feature_drift(sides(spark, sf_dir).select("side", *FEATS, "customer_id", "churned"))


# ---------------------------------------------------------------- oracle CTEs
_U_M = "((((k + 1) * 373587883) % 2147483647) / 2147483647e0)"
_U_T = "((((k + 1) * 472882027) % 2147483647) / 2147483647e0)"
define("sides", ["encoded", "customers_k"], f"""
  SELECT CASE WHEN k % 3 = 0 THEN 'prod' ELSE 'ref' END AS side,
         CASE WHEN k % 3 = 0 THEN CAST(e.tenure_months AS DOUBLE) * (8e-1 + 2e-1 * {_U_T})
              ELSE CAST(e.tenure_months AS DOUBLE) END AS tenure_months,
         CASE WHEN k % 3 = 0 THEN e.monthly_charges * (1e0 + 2e-1 * {_U_M}) ELSE e.monthly_charges END AS monthly_charges,
         {', '.join('e.' + c for c in FEATS if c not in ('tenure_months', 'monthly_charges'))}, e.churned, e.customer_id
  FROM encoded e JOIN customers_k USING (customer_id)""")
define("drift_long", ["sides"], " UNION ALL ".join(
    f"SELECT side, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM sides" for c in FEATS))
define("ks", ["drift_long"], """
  SELECT feature, MAX(abs(CAST(cr AS DOUBLE) / CAST(nr AS DOUBLE) - CAST(cp AS DOUBLE) / CAST(np AS DOUBLE))) AS ks_statistic,
         ANY_VALUE(nr) AS n_ref, ANY_VALUE(np) AS n_prod
  FROM (SELECT feature, value,
               SUM(c_ref) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cr,
               SUM(c_prod) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cp,
               SUM(c_ref) OVER (PARTITION BY feature) AS nr, SUM(c_prod) OVER (PARTITION BY feature) AS np
        FROM (SELECT feature, value, COUNT(*) FILTER (WHERE side = 'ref') AS c_ref,
                     COUNT(*) FILTER (WHERE side = 'prod') AS c_prod
              FROM drift_long WHERE value IS NOT NULL GROUP BY feature, value))
  GROUP BY feature""")
_ORD = " UNION ALL ".join(f"SELECT '{c}' AS feature, {i} AS ordinal" for i, c in enumerate(FEATS))
define("feature_drift", ["ks", "drift_long"], f"""
  SELECT ks.feature, o.ordinal, ks.ks_statistic, pv.p_value,
         ks.ks_statistic > 1e-1 OR pv.p_value < 5e-2 AS drift_detected, m.ref_mean, m.prod_mean,
         (m.prod_mean - m.ref_mean) / NULLIF(m.ref_mean, 0e0) * 1e2 AS change_pct
  FROM ks
  JOIN (SELECT feature, AVG(value) FILTER (WHERE side = 'ref') AS ref_mean,
               AVG(value) FILTER (WHERE side = 'prod') AS prod_mean FROM drift_long GROUP BY feature) m USING (feature)
  JOIN ({_ORD}) o USING (feature)
  JOIN ks_p pv USING (feature)""")
# Exact p-value up to 10 000 values a side: share of lattice paths that stay strictly between the borders, point by point along
# the antidiagonals (a point outside them has no row); asymptotic series beyond.
define("ks_p", ["ks"], """
  WITH RECURSIVE k AS (
    SELECT feature, n_ref AS n, n_prod AS m, CAST(round(ks_statistic * n_ref * n_prod) AS BIGINT) AS h, ks_statistic AS d FROM ks),
  path(feature, s, i, share) AS (
    SELECT feature, CAST(0 AS BIGINT), CAST(0 AS BIGINT), 1e0 FROM k WHERE h > 0 AND greatest(n, m) <= 10000
    UNION ALL
    SELECT t.feature, t.s, t.i, SUM(t.part) FROM (
      SELECT feature, s + 1 AS s, i + 1 AS i, share * CAST(i + 1 AS DOUBLE) / CAST(s + 1 AS DOUBLE) AS part FROM path
      UNION ALL
      SELECT feature, s + 1, i, share * CAST(s + 1 - i AS DOUBLE) / CAST(s + 1 AS DOUBLE) FROM path) t JOIN k USING (feature)
    WHERE t.i <= k.n AND t.s - t.i <= k.m AND abs(t.i * (k.n + k.m) - t.s * k.n) < k.h GROUP BY t.feature, t.s, t.i)
  SELECT k.feature, CASE WHEN k.h = 0 THEN 1e0 WHEN greatest(k.n, k.m) <= 10000 THEN 1e0 - coalesce(x.share, 0e0) ELSE a.p END AS p_value
  FROM k
  LEFT JOIN path x ON x.feature = k.feature AND x.s = k.n + k.m AND x.i = k.n
  JOIN (SELECT feature, LEAST(1e0, GREATEST(0e0, CASE WHEN lam < 1e-1 THEN 1e0 ELSE 2e0 * s END)) AS p
        FROM (SELECT feature, ANY_VALUE(lam) AS lam,
                     SUM(pow(-1e0, CAST(t.j - 1 AS DOUBLE)) * exp(-2e0 * t.j * t.j * lam * lam)) AS s
              FROM (SELECT feature, d * sqrt(CAST(n * m AS DOUBLE) / CAST(n + m AS DOUBLE)) AS lam FROM k) y,
                   range(1, 101) t(j) GROUP BY feature)) a ON a.feature = k.feature""")


def _r(c, d=9):
    return F.round(c, d).alias(c)


@query("ks_statistic", oracle="SELECT feature, ks_statistic, n_ref, n_prod FROM ks")
def ks_statistic(spark, sf_dir):
    return DR.ks_statistics(sides(spark, sf_dir), FEATS)


@query("ks_p_value", oracle="SELECT feature, ROUND(p_value, 10) AS p_value FROM feature_drift")
def ks_p_value(spark, sf_dir):
    return _drift(spark, sf_dir).select("feature", F.round("p_value", 10).alias("p_value"))


@query("feature_drift", oracle="""
SELECT feature, ks_statistic, ROUND(p_value, 10) AS p_value, drift_detected, ROUND(ref_mean, 9) AS ref_mean,
       ROUND(prod_mean, 9) AS prod_mean, ROUND(change_pct, 6) AS change_pct FROM feature_drift""")
def feature_drift(spark, sf_dir):
    d = _drift(spark, sf_dir)
    return d.select("feature", "ks_statistic", F.round("p_value", 10).alias("p_value"), "drift_detected",
                    _r("ref_mean"), _r("prod_mean"), _r("change_pct", 6))


_PREDICTION_SQL = """
SELECT AVG(churned) FILTER (WHERE side = 'ref') AS ref_churn_rate, AVG(churned) FILTER (WHERE side = 'prod') AS prod_churn_rate,
       abs(AVG(churned) FILTER (WHERE side = 'prod') - AVG(churned) FILTER (WHERE side = 'ref')) AS absolute_change,
       (AVG(churned) FILTER (WHERE side = 'prod') - AVG(churned) FILTER (WHERE side = 'ref'))
         / AVG(churned) FILTER (WHERE side = 'ref') * 1e2 AS change_pct,
       abs(AVG(churned) FILTER (WHERE side = 'prod') - AVG(churned) FILTER (WHERE side = 'ref')) > 5e-2 AS drift_detected
FROM sides"""


@query("prediction_drift", oracle=_PREDICTION_SQL)
def prediction_drift(spark, sf_dir):
    return DR.prediction_drift(sides(spark, sf_dir))


_SUMMARY_SQL = """
SELECT COUNT(*) AS total_features_analyzed, COUNT(*) FILTER (WHERE drift_detected) AS features_with_drift,
       coalesce(CAST(COUNT(*) FILTER (WHERE drift_detected) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0e0) * 1e2, 0e0)
         AS drift_percentage,
       CASE WHEN CAST(COUNT(*) FILTER (WHERE drift_detected) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 1e2 > 20 THEN 'ALERT'
            WHEN CAST(COUNT(*) FILTER (WHERE drift_detected) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 1e2 > 10 THEN 'WARNING'
            ELSE 'OK' END AS overall_drift_status,
       CAST(COUNT(*) FILTER (WHERE drift_detected) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) * 1e2 > 20 AS retrain_recommended
FROM feature_drift"""


@query("drift_summary", oracle=_SUMMARY_SQL)
def drift_summary(spark, sf_dir):
    return DR.drift_summary(_drift(spark, sf_dir))


@query("top_drifted_features", oracle="""
SELECT feature, ks_statistic, ROUND(change_pct, 6) AS change_pct FROM feature_drift
ORDER BY ks_statistic DESC, ordinal LIMIT 5""")
def top_drifted_features(spark, sf_dir):
    t = DR.top_drifted(_drift(spark, sf_dir))
    return t.select("feature", "ks_statistic", _r("change_pct", 6))


@query("drift_report", oracle=f"""
SELECT '{AS_OF}' AS timestamp, s.features_with_drift, s.overall_drift_status, p.drift_detected AS label_drift, d.feature, d.ks_statistic,
       d.drift_detected, row_number() OVER (ORDER BY d.ks_statistic DESC, d.ordinal) <= 5 AS top
FROM feature_drift d, ({_SUMMARY_SQL}) s, ({_PREDICTION_SQL}) p""")
def drift_report(spark, sf_dir):
    """The nested report is written as JSON, read back and laid out one row per feature."""
    s = sides(spark, sf_dir)
    report = DR.drift_report(DR.feature_drift(s, FEATS), DR.prediction_drift(s), AS_OF)
    back = sinks.read_json(spark, sinks.write_json(report, scratch_path(spark, "drift_report")), report.schema)
    one = back.select("timestamp", "summary.features_with_drift", "summary.overall_drift_status",
                      F.col("prediction_drift.drift_detected").alias("label_drift"),
                      F.transform("top_drifted_features", lambda x: x["feature"]).alias("_top"), F.explode("all_features").alias("f"))
    return one.select("timestamp", "features_with_drift", "overall_drift_status", "label_drift", "f.feature", "f.ks_statistic",
                      "f.drift_detected", F.array_contains("_top", F.col("f.feature")).alias("top"))


@query("drift_histograms", oracle="""
WITH top AS (SELECT feature FROM feature_drift ORDER BY ks_statistic DESC, ordinal LIMIT 5),
     v AS (SELECT l.feature, l.side, l.value FROM drift_long l JOIN top USING (feature) WHERE l.value IS NOT NULL),
     r AS (SELECT feature, side, MIN(value) AS lo, MAX(value) AS hi, COUNT(*) AS n FROM v GROUP BY feature, side),
     c AS (SELECT v.feature, v.side,
                  CASE WHEN r.hi = r.lo THEN 0 ELSE LEAST(GREATEST(CAST(floor((v.value - r.lo) / ((r.hi - r.lo) / 3e1)) AS INTEGER), 0), 29) END AS bin,
                  COUNT(*) AS cnt
           FROM v JOIN r USING (feature, side) GROUP BY 1, 2, 3)
SELECT r.feature, r.side, b.bin, r.lo + b.bin * ((r.hi - r.lo) / 3e1) AS bin_start,
       r.lo + (b.bin + 1) * ((r.hi - r.lo) / 3e1) AS bin_end, coalesce(c.cnt, 0) AS count,
       CAST(coalesce(c.cnt, 0) AS DOUBLE) / NULLIF(r.n * ((r.lo + (b.bin + 1) * ((r.hi - r.lo) / 3e1)) - (r.lo + b.bin * ((r.hi - r.lo) / 3e1))), 0e0) AS density
FROM r CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(0, 30)) b
LEFT JOIN c ON c.feature = r.feature AND c.side = r.side AND c.bin = b.bin""")
def drift_histograms(spark, sf_dir):
    s = sides(spark, sf_dir)
    d = DR.feature_drift(s, FEATS)
    top = [r["feature"] for r in DR.top_drifted(d).select("feature").collect()]  # ≤ 5 names
    return DR.drift_histograms(s, top).withColumnRenamed("side", "side")


@query("drift_reference_sample", oracle="""
SELECT customer_id FROM customers_k WHERE k % 3 <> 0 ORDER BY ((k + 1) * 633910099) % 2147483647, k LIMIT 5000""")
def drift_reference_sample(spark, sf_dir):
    cr = FX.with_key(FX.customers_raw(spark, sf_dir))
    return DR.bounded_sample(cr.filter(F.col("k") % 3 != 0), DR.REF_LIMIT).select("customer_id")


@query("drift_production_sample", oracle="""
SELECT customer_id FROM customers_k WHERE k % 3 = 0 ORDER BY ((k + 1) * 633910099) % 2147483647, k LIMIT 2000""")
def drift_production_sample(spark, sf_dir):
    cr = FX.with_key(FX.customers_raw(spark, sf_dir))
    return DR.bounded_sample(cr.filter(F.col("k") % 3 == 0), DR.PROD_LIMIT).select("customer_id")
