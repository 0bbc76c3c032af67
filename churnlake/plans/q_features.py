"""Business features, encoders, scaler, feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..session import scratch_path
from ..sources import fixtures as FX
from ..sources import sinks
from .ctes import define
from .registry import query

_SERV = FE.SERVICE_COLUMNS
_flags = ",\n         ".join(f"CAST(coalesce({c} = 'Yes', FALSE) AS INTEGER) AS {c}_yes" for c in _SERV)

define("p75", [], "SELECT quantile_cont(monthly_charges, 0.75) AS thr FROM customers_raw")
define("biz0", ["customers_raw", "p75"], f"""
  SELECT cr.*,
         total_charges / (tenure_months + 1) AS avg_monthly_spend,
         monthly_charges / (tenure_months + 1) AS charges_to_tenure_ratio,
         CAST(coalesce(monthly_charges > p75.thr, FALSE) AS INTEGER) AS high_spender,
         CAST(coalesce(tenure_months <= 6, FALSE) AS INTEGER) AS is_new_customer,
         CAST(coalesce(tenure_months >= 36, FALSE) AS INTEGER) AS is_loyal_customer,
         CASE WHEN tenure_months > 0 AND tenure_months <= 12 THEN '0-1yr'
              WHEN tenure_months > 12 AND tenure_months <= 24 THEN '1-2yr'
              WHEN tenure_months > 24 AND tenure_months <= 48 THEN '2-4yr'
              WHEN tenure_months > 48 AND tenure_months <= 100 THEN '4yr+' END AS tenure_group,
         {_flags},
         CAST(coalesce(contract_type = 'Month-to-month', FALSE) AS INTEGER) AS high_risk_contract,
         CAST(coalesce(payment_method = 'Electronic check', FALSE) AS INTEGER) AS risky_payment,
         CAST(coalesce(online_security = 'No' AND tech_support = 'No', FALSE) AS INTEGER) AS no_protection,
         CAST(coalesce(phone_service = 'Yes' AND internet_service <> 'No', FALSE) AS INTEGER) AS has_phone_internet,
         CAST(coalesce(paperless_billing = 'Yes', FALSE) AS INTEGER) AS paperless_engaged
  FROM customers_raw cr, p75""")
define("biz1", ["biz0"], f"""
  SELECT *, {' + '.join(f'{c}_yes' for c in _SERV)} AS total_services FROM biz0""")
define("biz", ["biz1"], """
  SELECT *, CAST(coalesce(total_services >= 4, FALSE) AS INTEGER) AS has_premium_services,
         CASE WHEN is_new_customer = 1 THEN 3e-1 ELSE 0e0 END
         + CASE WHEN high_risk_contract = 1 THEN 2.5e-1 ELSE 0e0 END
         + CASE WHEN risky_payment = 1 THEN 1.5e-1 ELSE 0e0 END
         + CASE WHEN no_protection = 1 THEN 1.5e-1 ELSE 0e0 END
         + CASE WHEN total_services = 0 THEN 1.5e-1 ELSE 0e0 END AS risk_score
  FROM biz1""")


def _lab(c):
    return f"coalesce(CAST({c} AS VARCHAR), '{'nan' if c == 'tenure_group' else 'None'}')"


define("enc", ["biz"], "SELECT \"column\", value, CAST(dense_rank() OVER (PARTITION BY \"column\" ORDER BY value) - 1 "
       "AS INTEGER) AS code FROM (" + " UNION ".join(
           f"SELECT DISTINCT '{c}' AS \"column\", {_lab(c)} AS value FROM biz" for c in FE.CATEGORICAL_COLUMNS) + ")")

_enc_cols = ",\n         ".join(
    f"(SELECT code FROM enc WHERE enc.\"column\" = '{c}' AND enc.value = {_lab('b.' + c)}) AS {c}_encoded"
    for c in FE.CATEGORICAL_COLUMNS)
define("encoded", ["biz", "enc"], f"SELECT b.*, {_enc_cols} FROM biz b")

_mom = ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1e0 ELSE stddev_pop({c}) END AS s_{c}"
                 for c in FE.NUMERICAL_COLUMNS)
define("moments", ["encoded"], f"SELECT {_mom} FROM encoded")
_scaled = ", ".join(f"(CAST(e.{c} AS DOUBLE) - mo.m_{c}) / mo.s_{c} AS {c}" for c in FE.NUMERICAL_COLUMNS)
define("scaled", ["encoded", "moments"],
       f"SELECT e.* EXCLUDE ({', '.join(FE.NUMERICAL_COLUMNS)}), {_scaled} FROM encoded e, moments mo")
define("customer_features", ["scaled"],
       f"SELECT customer_id, {', '.join(FE.FEATURE_COLUMNS)}, churned FROM scaled")

_BIZ_OUT = ["customer_id", "avg_monthly_spend", "charges_to_tenure_ratio", "high_spender", "is_new_customer",
            "is_loyal_customer", "tenure_group", *[f"{c}_yes" for c in _SERV], "total_services",
            "has_premium_services", "high_risk_contract", "risky_payment", "no_protection", "has_phone_internet",
            "paperless_engaged", "risk_score"]


def _biz(spark, sf_dir):
    return FE.business_features(FX.customers_raw(spark, sf_dir))


@query("business_features", oracle=f"SELECT {', '.join(_BIZ_OUT)} FROM biz")
def business_features(spark, sf_dir):
    return _biz(spark, sf_dir).select(*_BIZ_OUT)


@query("high_spender", oracle="""
SELECT high_spender, COUNT(*) AS customers, MIN(monthly_charges) AS min_monthly, MAX(monthly_charges) AS max_monthly
FROM biz GROUP BY high_spender""")
def high_spender(spark, sf_dir):
    return (_biz(spark, sf_dir).groupBy("high_spender")
            .agg(F.count(F.lit(1)).alias("customers"), F.min("monthly_charges").alias("min_monthly"),
                 F.max("monthly_charges").alias("max_monthly")))


@query("tenure_groups", oracle="""
SELECT tenure_group, COUNT(*) AS customers, MIN(tenure_months) AS min_tenure, MAX(tenure_months) AS max_tenure
FROM biz GROUP BY tenure_group""")
def tenure_groups(spark, sf_dir):
    return (_biz(spark, sf_dir).groupBy("tenure_group")
            .agg(F.count(F.lit(1)).alias("customers"), F.min("tenure_months").alias("min_tenure"),
                 F.max("tenure_months").alias("max_tenure")))


@query("service_counts", oracle="""
SELECT total_services, has_premium_services, COUNT(*) AS customers FROM biz GROUP BY total_services, has_premium_services""")
def service_counts(spark, sf_dir):
    return (_biz(spark, sf_dir).groupBy("total_services", "has_premium_services")
            .agg(F.count(F.lit(1)).alias("customers")))


@query("risk_scores", oracle="""
SELECT risk_score, COUNT(*) AS customers, CAST(SUM(churned) AS BIGINT) AS churned FROM biz GROUP BY risk_score""")
def risk_scores(spark, sf_dir):
    return (_biz(spark, sf_dir).groupBy("risk_score")
            .agg(F.count(F.lit(1)).alias("customers"), F.sum("churned").cast("bigint").alias("churned")))


@query("label_encoding_map", oracle='SELECT "column", value, code FROM enc')
def label_encoding_map(spark, sf_dir):
    return FE.fit_label_encoders(_biz(spark, sf_dir))


_ENC_OUT = ["customer_id", *[f"{c}_encoded" for c in FE.CATEGORICAL_COLUMNS]]


@query("encode_unseen", oracle="""
WITH seen AS (SELECT payment_method AS v, dense_rank() OVER (ORDER BY payment_method) - 1 AS code
              FROM (SELECT DISTINCT payment_method FROM customers_raw WHERE contract_type = 'Two year' AND payment_method <> 'Mailed check'))
SELECT customer_id, CAST(coalesce(code, -1) AS INTEGER) AS payment_method_encoded FROM customers_raw LEFT JOIN seen ON v = payment_method""")
def encode_unseen(spark, sf_dir):
    """codes fitted on some customers, applied to all; a value that was not there gets -1."""
    raw = FX.customers_raw(spark, sf_dir)
    fit = raw.filter((F.col("contract_type") == "Two year") & (F.col("payment_method") != "Mailed check"))
    enc = FE.fit_label_encoders(fit, ["payment_method"])
    return FE.apply_label_encoders(raw, enc, ["payment_method"]).select("customer_id", "payment_method_encoded")


@query("encode_categorical", oracle=f"SELECT {', '.join(_ENC_OUT)} FROM encoded")
def encode_categorical(spark, sf_dir):
    biz = _biz(spark, sf_dir)
    return FE.apply_label_encoders(biz, FE.fit_label_encoders(biz)).select(*_ENC_OUT)


@query("scaler_params", oracle=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", ROUND(m_{c}, 9) AS mean, ROUND(s_{c}, 9) AS std FROM moments"
    for c in FE.NUMERICAL_COLUMNS))
def scaler_params(spark, sf_dir):
    p = FE.fit_scaler(_biz(spark, sf_dir))
    return p.select("column", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


@query("scale_numerical", oracle="SELECT customer_id, " + ", ".join(
    f"ROUND({c}, 9) AS {c}" for c in FE.NUMERICAL_COLUMNS) + " FROM scaled")
def scale_numerical(spark, sf_dir):
    biz = _biz(spark, sf_dir)
    s = FE.apply_scaler(biz, FE.fit_scaler(biz))
    return s.select("customer_id", *[F.round(c, 9).alias(c) for c in FE.NUMERICAL_COLUMNS])


_FT_ROUND = ", ".join(f"ROUND({c}, 9) AS {c}" if c in FE.NUMERICAL_COLUMNS else c for c in FE.FEATURE_COLUMNS)


def _rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if c in FE.NUMERICAL_COLUMNS else F.col(c) for c in df.columns])


@query("feature_table", oracle=f"SELECT customer_id, {_FT_ROUND}, churned FROM customer_features")
def feature_table(spark, sf_dir):
    return _rounded(FE.feature_table(FX.customers_raw(spark, sf_dir)))


@query("saved_feature_model", oracle=f"SELECT customer_id, {_FT_ROUND}, churned FROM customer_features")
def saved_feature_model(spark, sf_dir):
    """The fitted state is written as parameter tables, loaded and applied."""
    raw = FX.customers_raw(spark, sf_dir)
    path = scratch_path(spark, "feature_model")
    FE.FeatureModel.fit(raw).save(path)
    return _rounded(FE.feature_table(raw, FE.FeatureModel.load(spark, path)))


@query("scan_features", oracle=f"SELECT {_FT_ROUND} FROM customer_features")
def scan_features(spark, sf_dir):
    """S2 + S4: write the feature table, scan it back, split off X."""
    ft = FE.feature_table(FX.customers_raw(spark, sf_dir))
    back = sinks.overwrite_roundtrip(spark, ft, "customer_features")
    x, _ = FE.split_xy(back)
    return _rounded(x)


@query("feature_summary", oracle="""
SELECT 27 AS feature_count, COUNT(*) AS rows, AVG(churned) AS churn_rate FROM customer_features""")
def feature_summary(spark, sf_dir):
    return FE.feature_summary(FE.feature_table(FX.customers_raw(spark, sf_dir)))
