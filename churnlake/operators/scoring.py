"""Scoring as batch/stream jobs.

The reference scores one HTTP request at a time; here every rule is a
column expression, so scoring a table is a single narrow projection
(no shuffle) that runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import flag, hunif, risk_band_api, weighted_sum

# Fixed values (serving encodings and rule weights of the reference).
CONTRACT_CODES = {"Month-to-month": 0, "One year": 1, "Two year": 2}
PAYMENT_CODES = {"Electronic check": 0, "Mailed check": 1, "Credit card": 2, "Bank transfer": 3}
INTERNET_CODES = {"DSL": 0, "Fiber optic": 1, "No": 2}
CONTRACT_DEFAULT, PAYMENT_DEFAULT, INTERNET_DEFAULT = 0, 0, 2
RECOMMENDED_ACTIONS = [
    "Schedule personalized retention call",
    "Offer loyalty discount or upgrade incentive",
    "Send targeted retention email campaign",
    "Assign dedicated account manager",
    "Review service usage and satisfaction",
]
JITTER_KEY = 633910099
MODEL_VERSION = "1.0"
# The two serving modes as they appear in ``model_version``.
MODEL_MODE, RULES_MODE = "mlflow", "rules"


def _code(c: str, codes: dict, default: int) -> Column:
    """Fixed-map lookup with a default (``dict.get(x, d)``)."""
    m = F.create_map(*[x for kv in codes.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return F.coalesce(F.element_at(m, F.col(c)), F.lit(default))


def serving_feature_columns() -> list[tuple[str, Column]]:
    """The 45 serving features of one request, in their fixed order."""
    ten, mon, tot = F.col("tenure_months"), F.col("monthly_charges"), F.col("total_charges")
    ct, pm, isv = F.col("contract_type"), F.col("payment_method"), F.col("internet_service")
    ph, sec, tech = F.col("phone_service"), F.col("online_security"), F.col("tech_support")
    services = flag(ph == "Yes") + flag(sec == "Yes") + flag(tech == "Yes")
    zero = F.lit(0)
    return [
        ("tenure_months", ten), ("monthly_charges", mon), ("total_charges", tot),
        ("senior_citizen", F.col("senior_citizen")),
        ("avg_monthly_spend", tot / F.greatest(ten, F.lit(1))),
        ("charges_to_tenure_ratio", mon / F.greatest(ten, F.lit(1))),
        ("total_services", services),
        ("risk_score", weighted_sum([(0.3, ct == "Month-to-month"), (0.25, ten < 12),
                                     (0.15, pm == "Electronic check"), (0.15, (sec == "No") & (tech == "No"))])),
        ("is_new_customer", flag(ten < 6)), ("is_loyal_customer", flag(ten > 24)),
        ("high_spender", flag(mon > 70)), ("high_value_customer", flag(mon > 70)),
        ("has_premium_services", flag(services >= 2)),
        ("high_risk_contract", flag(ct == "Month-to-month")),
        ("risky_payment", flag(pm == "Electronic check")),
        ("no_protection", flag((sec == "No") & (tech == "No"))),
        ("has_phone_internet", flag((ph == "Yes") & (isv != "No"))),
        ("paperless_engaged", zero),
        ("online_security_yes", flag(sec == "Yes")), ("online_backup_yes", zero),
        ("device_protection_yes", zero), ("tech_support_yes", flag(tech == "Yes")),
        ("streaming_tv_yes", zero), ("streaming_movies_yes", zero),
        ("contract_type_encoded", _code("contract_type", CONTRACT_CODES, CONTRACT_DEFAULT)),
        ("contract_Month-to-month", flag(ct == "Month-to-month")),
        ("contract_One year", flag(ct == "One year")),
        ("contract_Two year", flag(ct == "Two year")),
        ("payment_method_encoded", _code("payment_method", PAYMENT_CODES, PAYMENT_DEFAULT)),
        ("payment_Electronic check", flag(pm == "Electronic check")),
        ("payment_Mailed check", flag(pm == "Mailed check")),
        ("payment_Credit card", flag(pm == "Credit card")),
        ("payment_Bank transfer", flag(pm == "Bank transfer")),
        ("internet_service_encoded", _code("internet_service", INTERNET_CODES, INTERNET_DEFAULT)),
        ("internet_DSL", flag(isv == "DSL")), ("internet_Fiber optic", flag(isv == "Fiber optic")),
        ("internet_No", flag(isv == "No")),
        ("phone_service_encoded", flag(ph == "Yes")), ("phone_service", flag(ph == "Yes")),
        ("online_security", flag(sec == "Yes")), ("tech_support", flag(tech == "Yes")),
        ("online_backup", zero), ("device_protection", zero), ("streaming_tv", zero), ("streaming_movies", zero),
    ]


def serving_features(requests: DataFrame, keep=("customer_id",)) -> DataFrame:
    """P1 over a table of requests."""
    return requests.select(*keep, *[c.alias(n) for n, c in serving_feature_columns()])


def align_to_model(df: DataFrame, feature_names, keep=("customer_id",)) -> DataFrame:
    """P2 (J8 + J9): keep the model's features in its order; a feature the
    frame lacks is added as constant 0."""
    have = set(df.columns)
    return df.select(*[c for c in keep if c in have],
                     *[F.col(f"`{n}`") if n in have else F.lit(0).alias(n) for n in feature_names])


def rule_score() -> Column:
    """Rule-based probability, clamped to [0, 1].  Terms are
    added in the reference's order so every engine rounds identically."""
    ten, mon = F.col("tenure_months"), F.col("monthly_charges")
    ct, pm = F.col("contract_type"), F.col("payment_method")
    sec, tech = F.col("online_security"), F.col("tech_support")

    def add(cond, w):
        return F.when(cond, F.lit(w)).otherwise(F.lit(0.0))

    s = (F.lit(0.3) + add(ct == "Month-to-month", 0.25)
         + F.when(ten < 6, F.lit(0.20)).when(ten < 12, F.lit(0.10)).otherwise(F.lit(0.0))
         + add(mon > 80, 0.15) + add(pm == "Electronic check", 0.10)
         + add((F.col("internet_service") == "Fiber optic") & (tech == "No"), 0.12)
         + add(sec == "No", 0.08) + add(F.col("senior_citizen") == 1, 0.05)
         - add(ten > 24, 0.20) - add(ct == "Two year", 0.20)
         - add((sec == "Yes") & (tech == "Yes"), 0.15)
         - add(pm.isin("Bank transfer", "Credit card"), 0.08))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), s))


def score_rules(requests: DataFrame) -> DataFrame:
    return requests.withColumn("churn_probability_raw", rule_score())


def with_fallback(df: DataFrame, model_col: str = "model_probability") -> DataFrame:
    """Per row, the model's probability when it produced one, else the
    rule score; records which path answered."""
    used_model = F.col(model_col).isNotNull()
    return df.withColumns({
        "churn_probability_raw": F.coalesce(F.col(model_col), rule_score()),
        "model_mode": F.when(used_model, F.lit(MODEL_MODE)).otherwise(F.lit(RULES_MODE)),
    })


def response_rows(scored: DataFrame, as_of: str, mode: str | Column = "rules") -> DataFrame:
    """P6, P7, P9 (S17): the 7-field response per request."""
    p = F.col("churn_probability_raw")
    m = F.lit(mode) if isinstance(mode, str) else mode
    return scored.select(
        "customer_id",
        F.round(p, 4).alias("churn_probability"),
        (p >= 0.5).alias("churn_prediction"),
        risk_band_api(p).alias("risk_level"),
        F.round(F.abs(p - F.lit(0.5)) * F.lit(2.0), 4).alias("confidence"),
        F.lit(as_of).alias("timestamp"),
        F.concat(m, F.lit(f"-{MODEL_VERSION}")).alias("model_version"),
    )


def score_customers(requests: DataFrame, as_of: str) -> DataFrame:
    return response_rows(score_rules(requests), as_of)


def batch_score_summary(responses: DataFrame) -> DataFrame:
    """P10: the batch response's ``total_processed`` plus per-band counts."""
    return responses.agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if(F.col("risk_level") == "HIGH").alias("high_risk"),
        F.count_if(F.col("risk_level") == "MEDIUM").alias("medium_risk"),
        F.count_if(F.col("risk_level") == "LOW").alias("low_risk"),
        F.count_if(F.col("churn_prediction")).alias("predicted_churn"),
    )


def recommendations(responses: DataFrame) -> DataFrame:
    """Recommendation band per response, and one row per recommended
    action when the probability is above 0.5 (none otherwise)."""
    p, r = F.col("churn_probability"), F.col("risk_level")
    band = (F.when((r == "HIGH") | (p > 0.7), "HIGH")
            .when((r == "MEDIUM") | (p > 0.4), "MEDIUM").otherwise("LOW"))
    actions = F.when(p > 0.5, F.array(*[F.lit(a) for a in RECOMMENDED_ACTIONS])) \
        .otherwise(F.array().cast("array<string>"))
    return (responses.select("customer_id", "churn_probability", "risk_level", band.alias("recommendation_band"),
                             F.posexplode_outer(actions).alias("action_rank", "action")))
