"""Explicit schemas: nothing is inferred on read."""

from pyspark.sql import types as T

BASE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
}

CUSTOMERS_RAW = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("tenure_months", T.LongType()),
    T.StructField("monthly_charges", T.DoubleType()),
    T.StructField("total_charges", T.DoubleType()),
    T.StructField("contract_type", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("internet_service", T.StringType()),
    T.StructField("phone_service", T.StringType()),
    T.StructField("multiple_lines", T.StringType()),
    T.StructField("online_security", T.StringType()),
    T.StructField("online_backup", T.StringType()),
    T.StructField("device_protection", T.StringType()),
    T.StructField("tech_support", T.StringType()),
    T.StructField("streaming_tv", T.StringType()),
    T.StructField("streaming_movies", T.StringType()),
    T.StructField("paperless_billing", T.StringType()),
    T.StructField("senior_citizen", T.IntegerType()),
    T.StructField("partner", T.StringType()),
    T.StructField("dependents", T.StringType()),
    T.StructField("churned", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

# Scoring request (11 fields) — the constraint set lives in operators.quality.
SCORING_REQUEST = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("tenure_months", T.LongType()),
    T.StructField("monthly_charges", T.DoubleType()),
    T.StructField("total_charges", T.DoubleType()),
    T.StructField("contract_type", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("internet_service", T.StringType()),
    T.StructField("phone_service", T.StringType()),
    T.StructField("online_security", T.StringType()),
    T.StructField("tech_support", T.StringType()),
    T.StructField("senior_citizen", T.IntegerType()),
])

PREDICTIONS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("churn_probability", T.DoubleType()),
    T.StructField("churn_prediction", T.BooleanType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("model_version", T.StringType()),
])

PREDICTION_LOG = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("churn_probability", T.DoubleType()),
    T.StructField("prediction", T.IntegerType()),
    T.StructField("latency_ms", T.DoubleType()),
    T.StructField("model_version", T.StringType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("is_error", T.IntegerType()),
])

VALIDATION_CHECKS = T.StructType([
    T.StructField("check", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("severity", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

MODEL_RUNS = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("train_size", T.LongType()),
    T.StructField("test_size", T.LongType()),
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1_score", T.DoubleType()),
    T.StructField("roc_auc", T.DoubleType()),
    T.StructField("cv_f1_mean", T.DoubleType()),
    T.StructField("cv_f1_std", T.DoubleType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
])
