"""Serving features, rule scores, fallback, responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import scoring as SC
from ..sources import fixtures as FX
from .ctes import define
from .registry import query

AS_OF = "2024-01-31T00:00:00"


def _flag(cond):
    return f"CAST(coalesce({cond}, FALSE) AS INTEGER)"


def _map(col, codes, default):
    arms = " ".join(f"WHEN {col} = '{k}' THEN {v}" for k, v in codes.items())
    return f"CASE {arms} ELSE {default} END"


_PH = _flag("phone_service = 'Yes'")
_SEC = _flag("online_security = 'Yes'")
_TECH = _flag("tech_support = 'Yes'")
_NSERV = f"{_PH} + {_SEC} + {_TECH}"

_SERV_SQL = [
    ("tenure_months", "tenure_months"), ("monthly_charges", "monthly_charges"), ("total_charges", "total_charges"),
    ("senior_citizen", "senior_citizen"),
    ("avg_monthly_spend", "total_charges / GREATEST(tenure_months, 1)"),
    ("charges_to_tenure_ratio", "monthly_charges / GREATEST(tenure_months, 1)"),
    ("total_services", _NSERV),
    ("risk_score", "CASE WHEN contract_type = 'Month-to-month' THEN 3e-1 ELSE 0e0 END + CASE WHEN tenure_months < 12 THEN 2.5e-1 ELSE 0e0 END"
                   " + CASE WHEN payment_method = 'Electronic check' THEN 1.5e-1 ELSE 0e0 END"
                   " + CASE WHEN online_security = 'No' AND tech_support = 'No' THEN 1.5e-1 ELSE 0e0 END"),
    ("is_new_customer", _flag("tenure_months < 6")), ("is_loyal_customer", _flag("tenure_months > 24")),
    ("high_spender", _flag("monthly_charges > 70")), ("high_value_customer", _flag("monthly_charges > 70")),
    ("has_premium_services", _flag(f"{_NSERV} >= 2")),
    ("high_risk_contract", _flag("contract_type = 'Month-to-month'")),
    ("risky_payment", _flag("payment_method = 'Electronic check'")),
    ("no_protection", _flag("online_security = 'No' AND tech_support = 'No'")),
    ("has_phone_internet", _flag("phone_service = 'Yes' AND internet_service <> 'No'")),
    ("paperless_engaged", "0"),
    ("online_security_yes", _flag("online_security = 'Yes'")), ("online_backup_yes", "0"),
    ("device_protection_yes", "0"), ("tech_support_yes", _flag("tech_support = 'Yes'")),
    ("streaming_tv_yes", "0"), ("streaming_movies_yes", "0"),
    ("contract_type_encoded", _map("contract_type", SC.CONTRACT_CODES, SC.CONTRACT_DEFAULT)),
    ("contract_Month-to-month", _flag("contract_type = 'Month-to-month'")),
    ("contract_One year", _flag("contract_type = 'One year'")),
    ("contract_Two year", _flag("contract_type = 'Two year'")),
    ("payment_method_encoded", _map("payment_method", SC.PAYMENT_CODES, SC.PAYMENT_DEFAULT)),
    ("payment_Electronic check", _flag("payment_method = 'Electronic check'")),
    ("payment_Mailed check", _flag("payment_method = 'Mailed check'")),
    ("payment_Credit card", _flag("payment_method = 'Credit card'")),
    ("payment_Bank transfer", _flag("payment_method = 'Bank transfer'")),
    ("internet_service_encoded", _map("internet_service", SC.INTERNET_CODES, SC.INTERNET_DEFAULT)),
    ("internet_DSL", _flag("internet_service = 'DSL'")), ("internet_Fiber optic", _flag("internet_service = 'Fiber optic'")),
    ("internet_No", _flag("internet_service = 'No'")),
    ("phone_service_encoded", _flag("phone_service = 'Yes'")), ("phone_service", _flag("phone_service = 'Yes'")),
    ("online_security", _flag("online_security = 'Yes'")), ("tech_support", _flag("tech_support = 'Yes'")),
    ("online_backup", "0"), ("device_protection", "0"), ("streaming_tv", "0"), ("streaming_movies", "0"),
]

_RULE = """GREATEST(0e0, LEAST(1e0, 3e-1 + CASE WHEN contract_type = 'Month-to-month' THEN 2.5e-1 ELSE 0e0 END
  + CASE WHEN tenure_months < 6 THEN 2e-1 WHEN tenure_months < 12 THEN 1e-1 ELSE 0e0 END
  + CASE WHEN monthly_charges > 80 THEN 1.5e-1 ELSE 0e0 END
  + CASE WHEN payment_method = 'Electronic check' THEN 1e-1 ELSE 0e0 END
  + CASE WHEN internet_service = 'Fiber optic' AND tech_support = 'No' THEN 1.2e-1 ELSE 0e0 END
  + CASE WHEN online_security = 'No' THEN 8e-2 ELSE 0e0 END
  + CASE WHEN senior_citizen = 1 THEN 5e-2 ELSE 0e0 END
  - CASE WHEN tenure_months > 24 THEN 2e-1 ELSE 0e0 END
  - CASE WHEN contract_type = 'Two year' THEN 2e-1 ELSE 0e0 END
  - CASE WHEN online_security = 'Yes' AND tech_support = 'Yes' THEN 1.5e-1 ELSE 0e0 END
  - CASE WHEN payment_method IN ('Bank transfer', 'Credit card') THEN 8e-2 ELSE 0e0 END))"""

define("rule_scored", ["customers_k"], f"SELECT *, {_RULE} AS p FROM customers_k")
define("fallback_scored", ["rule_scored", "biz"], """
  SELECT *, coalesce(mp, p) AS pf, CASE WHEN mp IS NOT NULL THEN '""" + SC.MODEL_MODE + """' ELSE 'rules' END AS mode
  FROM (SELECT r.*, CASE WHEN r.total_charges > 0 THEN b.risk_score END AS mp
        FROM rule_scored r JOIN (SELECT customer_id, risk_score FROM biz) b USING (customer_id))""")


def _resp(p, mode_sql="'rules'", src="rule_scored"):
    return f"""SELECT customer_id, ROUND({p}, 4) AS churn_probability, {p} >= 5e-1 AS churn_prediction,
       CASE WHEN {p} >= 7e-1 THEN 'HIGH' WHEN {p} >= 4e-1 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
       ROUND(abs({p} - 5e-1) * 2e0, 4) AS confidence, '{AS_OF}' AS "timestamp",
       concat({mode_sql}, '-1.0') AS model_version FROM {src}"""


define("responses", ["rule_scored"], _resp("p"))


def _requests(spark, sf_dir):
    return FX.customers_raw(spark, sf_dir)


@query("serving_features", oracle="SELECT customer_id, " + ", ".join(
    f"{e} AS \"{n}\"" for n, e in _SERV_SQL) + " FROM customers_dirty")
def serving_features(spark, sf_dir):
    return SC.serving_features(FX.customers_dirty(spark, sf_dir))


@query("serving_aligned", oracle="SELECT customer_id, " + ", ".join(
    (f"{dict(_SERV_SQL)[n]} AS {n}" if n in dict(_SERV_SQL) else f"0 AS {n}") for n in FE.FEATURE_COLUMNS)
    + " FROM customers_raw")
def serving_aligned(spark, sf_dir):
    """Serving features aligned to the model's 27-feature list."""
    return SC.align_to_model(SC.serving_features(_requests(spark, sf_dir)), FE.FEATURE_COLUMNS)


@query("serving_encodings", oracle=f"""
SELECT customer_id, {_map('contract_type', SC.CONTRACT_CODES, 0)} AS contract_type_encoded,
       {_map('payment_method', SC.PAYMENT_CODES, 0)} AS payment_method_encoded,
       {_map('internet_service', SC.INTERNET_CODES, 2)} AS internet_service_encoded FROM customers_dirty""")
def serving_encodings(spark, sf_dir):
    return SC.serving_features(FX.customers_dirty(spark, sf_dir)).select(
        "customer_id", "contract_type_encoded", "payment_method_encoded", "internet_service_encoded")


@query("rule_scores", oracle="SELECT customer_id, p AS churn_probability FROM rule_scored")
def rule_scores(spark, sf_dir):
    return _requests(spark, sf_dir).select("customer_id", SC.rule_score().alias("churn_probability"))


@query("risk_levels", oracle="""
SELECT risk_level, COUNT(*) AS customers FROM responses GROUP BY risk_level""")
def risk_levels(spark, sf_dir):
    r = SC.score_customers(_requests(spark, sf_dir), AS_OF)
    return r.groupBy("risk_level").agg(F.count(F.lit(1)).alias("customers"))


@query("score_customers", oracle="SELECT * FROM responses")
def score_customers(spark, sf_dir):
    return SC.score_customers(_requests(spark, sf_dir), AS_OF)


@query("score_with_fallback", oracle=_resp("pf", "mode", "fallback_scored"))
def score_with_fallback(spark, sf_dir):
    """The primary score here is the feature job's risk score (F20), absent for
    customers without charges; ``score_with_model`` does it with a fitted model."""
    requests = _requests(spark, sf_dir)
    df = FE.business_features(requests, FE.p75_value(requests))
    df = df.withColumn("model_probability", F.when(F.col("total_charges") > 0, F.col("risk_score")))
    scored = SC.with_fallback(df)
    return SC.response_rows(scored, AS_OF, F.col("model_mode"))


@query("batch_score_summary", oracle="""
SELECT COUNT(*) AS total_processed, COUNT(*) FILTER (WHERE risk_level = 'HIGH') AS high_risk,
       COUNT(*) FILTER (WHERE risk_level = 'MEDIUM') AS medium_risk,
       COUNT(*) FILTER (WHERE risk_level = 'LOW') AS low_risk,
       COUNT(*) FILTER (WHERE churn_prediction) AS predicted_churn FROM responses""")
def batch_score_summary(spark, sf_dir):
    return SC.batch_score_summary(SC.score_customers(_requests(spark, sf_dir), AS_OF))


_ACTIONS = " UNION ALL ".join(f"SELECT {i} AS action_rank, '{a}' AS action" for i, a in enumerate(SC.RECOMMENDED_ACTIONS))


@query("recommendations", oracle=f"""
WITH b AS (SELECT customer_id, churn_probability, risk_level,
                  CASE WHEN risk_level = 'HIGH' OR churn_probability > 7e-1 THEN 'HIGH'
                       WHEN risk_level = 'MEDIUM' OR churn_probability > 4e-1 THEN 'MEDIUM' ELSE 'LOW' END
                    AS recommendation_band FROM responses)
SELECT b.*, a.action_rank, a.action FROM b, ({_ACTIONS}) a WHERE b.churn_probability > 5e-1
UNION ALL
SELECT b.*, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR) FROM b WHERE NOT (b.churn_probability > 5e-1)""")
def recommendations(spark, sf_dir):
    return SC.recommendations(SC.score_customers(_requests(spark, sf_dir), AS_OF))
