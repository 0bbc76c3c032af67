"""Quality checks, roll-up, quarantine, request checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..session import materialize, scratch_path
from ..sources import fixtures as FX
from ..sources import sinks
from ..sources.sinks import write_table
from .registry import query

AS_OF_FRESH = "2001-08-05 00:00:00"
AS_OF_STALE = "2002-01-01 00:00:00"

# Written out from the rules themselves, not taken from the code under test.
CRITICAL = ["customer_id", "tenure_months", "monthly_charges", "churned"]
RANGES = {"tenure_months": (0, 100), "monthly_charges": (0, 200), "total_charges": (0, 10000), "senior_citizen": (0, 1), "churned": (0, 1)}
ALLOWED = {
    "contract_type": ["Month-to-month", "One year", "Two year"],
    "payment_method": ["Electronic check", "Mailed check", "Credit card", "Bank transfer"],
    "internet_service": ["DSL", "Fiber optic", "No"],
    "phone_service": ["Yes", "No"],
    "online_security": ["Yes", "No", "No internet"],
    "tech_support": ["Yes", "No", "No internet"],
}
TYPES = {"tenure_months": "int", "monthly_charges": "float", "total_charges": "float", "senior_citizen": "int", "churned": "int"}
OUTLIERS = ["tenure_months", "monthly_charges", "total_charges"]
REQUIRED = ["customer_id", "tenure_months", "monthly_charges", "total_charges", "contract_type", "payment_method", "internet_service",
            "phone_service", "online_security", "tech_support", "senior_citizen"]
REQUEST_RANGES = {"tenure_months": (0, 100), "monthly_charges": (0, 200), "total_charges": (0, None), "senior_citizen": (0, 1)}

CR_COLS = ["customer_id", "tenure_months", "monthly_charges", "total_charges", "contract_type", "payment_method",
           "internet_service", "phone_service", "multiple_lines", "online_security", "online_backup",
           "device_protection", "tech_support", "streaming_tv", "streaming_movies", "paperless_billing",
           "senior_citizen", "partner", "dependents", "churned", "created_at"]
DOUBLE_COLS = {"monthly_charges", "total_charges"}


def _miss_sql(c):
    return f"(\"{c}\" IS NULL OR isnan(\"{c}\"))" if c in DOUBLE_COLS else f"(\"{c}\" IS NULL)"


def _long(check, sev, passed, metrics, src):
    """metrics: (column or None, metric, agg sql). One wide row, then rows."""
    wide = ", ".join(f"{expr} AS m{i}" for i, (_, _, expr) in enumerate(metrics))
    parts = []
    for i, (col, metric, _) in enumerate(metrics):
        colsql = "CAST(NULL AS VARCHAR)" if col is None else f"'{col}'"
        parts.append(f"SELECT '{check}' AS \"check\", {passed} AS passed, '{sev}' AS severity, "
                     f"{colsql} AS \"column\", '{metric}' AS metric, CAST(m{i} AS DOUBLE) AS value FROM w")
    return f"SELECT * FROM (WITH w AS (SELECT {wide} FROM {src}) " + " UNION ALL ".join(parts) + ")"


def _missing_sql(src):
    ms = [(c, "missing_count", f"COUNT(*) FILTER (WHERE {_miss_sql(c)})") for c in CR_COLS]
    total = " + ".join(f"COUNT(*) FILTER (WHERE {_miss_sql(c)})" for c in CR_COLS)
    crit = " + ".join(f"COUNT(*) FILTER (WHERE {_miss_sql(c)})" for c in CRITICAL)
    ms += [(None, "total_missing", total), (None, "critical_missing", crit)]
    return _long("missing_values", "fail", f"(m{len(ms) - 2} = 0)", ms, src)


def _dup_sql(src):
    ms = [("customer_id", "duplicates_count",
           "COUNT(*) - COUNT(DISTINCT customer_id) - CASE WHEN COUNT(*) FILTER (WHERE customer_id IS NULL) > 0 "
           "THEN 1 ELSE 0 END")]
    return _long("duplicates", "fail", "(m0 = 0)", ms, src)


def _range_sql(src):
    ms = [(c, "out_of_range", f"COUNT(*) FILTER (WHERE \"{c}\" < {lo} OR \"{c}\" > {hi})")
          for c, (lo, hi) in RANGES.items()]
    passed = "(" + " AND ".join(f"m{i} = 0" for i in range(len(ms))) + ")"
    return _long("value_ranges", "fail", passed, ms, src)


def _cat_sql(src):
    ms = []
    for c, allowed in ALLOWED.items():
        lst = ", ".join(f"'{v}'" for v in allowed)
        ms.append((c, "invalid_count", f"COUNT(*) FILTER (WHERE NOT coalesce(\"{c}\" IN ({lst}), FALSE))"))
    passed = "(" + " AND ".join(f"m{i} = 0" for i in range(len(ms))) + ")"
    return _long("categorical_values", "fail", passed, ms, src)


def _target_sql(src):
    ms = [("churned", "churn_rate", "AVG(churned)"), ("churned", "churn_count", "SUM(churned)"),
          ("churned", "no_churn_count", "COUNT(*) FILTER (WHERE churned = 0)")]
    return _long("target_distribution", "warning", "coalesce(m0 >= 1e-1 AND m0 <= 5e-1, FALSE)", ms, src)


def _fresh_sql(src, as_of):
    ms = [("created_at", "days_old",
           f"floor((epoch_us(TIMESTAMP '{as_of}') - epoch_us(MAX(created_at))) / 86400000000)")]
    return _long("data_freshness", "warning", "coalesce(m0 <= 7, FALSE)", ms, src)


def _outlier_sql(src):
    cols = OUTLIERS
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in cols)
    cnt = ", ".join(
        f"COUNT(*) FILTER (WHERE {c} < q1_{c} - 1.5e0 * (q3_{c} - q1_{c}) OR {c} > q3_{c} + 1.5e0 * (q3_{c} - q1_{c})) AS o_{c}"
        for c in cols)
    parts = []
    for c in cols:
        parts.append(f"SELECT 'outliers' AS \"check\", TRUE AS passed, 'warning' AS severity, '{c}' AS \"column\", "
                     f"'outlier_count' AS metric, CAST(o_{c} AS DOUBLE) AS value FROM w")
        parts.append(f"SELECT 'outliers', TRUE, 'warning', '{c}', 'outlier_pct', "
                     f"CAST(o_{c} AS DOUBLE) / CAST(n AS DOUBLE) * 1e2 FROM w")
    tot = " + ".join(f"o_{c}" for c in cols)
    parts.append(f"SELECT 'outliers', TRUE, 'warning', CAST(NULL AS VARCHAR), 'total_outliers', CAST({tot} AS DOUBLE) FROM w")
    return (f"SELECT * FROM (WITH qq AS (SELECT {qs} FROM {src}), "
            f"w AS (SELECT COUNT(*) AS n, {cnt} FROM {src}, qq) " + " UNION ALL ".join(parts) + ")")


def _types_sql(src):
    """V3 from the types DuckDB's own derivation gives each column (typeof
    over the whole table), named as Spark's simple type strings."""
    spark_name = ("CASE ty WHEN 'INTEGER' THEN 'int' WHEN 'SMALLINT' THEN 'smallint' WHEN 'TINYINT' THEN 'tinyint' "
                  "WHEN 'VARCHAR' THEN 'string' ELSE lower(ty) END")
    rows = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", MIN(typeof(\"{c}\")) AS ty, '{fam}' AS fam FROM {src}"
                              for c, fam in TYPES.items())
    ok = ("CASE WHEN fam = 'int' THEN ty IN ('TINYINT', 'SMALLINT', 'INTEGER', 'BIGINT') "
          "ELSE ty IN ('FLOAT', 'DOUBLE') END")
    return (f"SELECT * FROM (WITH r AS ({rows}), m AS (SELECT \"column\", {spark_name} AS sty, {ok} AS ok FROM r) "
            "SELECT 'data_types' AS \"check\", bool_and(ok) OVER () AS passed, 'warning' AS severity, \"column\", "
            "concat('type_ok:', sty) AS metric, CASE WHEN ok THEN 1e0 ELSE 0e0 END AS value FROM m)")


@query("check_missing_values", oracle=_missing_sql("customers_dirty"))
def check_missing_values(spark, sf_dir):
    return Q.aggregate_checks(FX.customers_dirty(spark, sf_dir), only=["missing_values"])


@query("check_duplicates", oracle=_dup_sql("customers_dirty"))
def check_duplicates(spark, sf_dir):
    return Q.aggregate_checks(FX.customers_dirty(spark, sf_dir), only=["duplicates"])


@query("check_data_types", oracle=_types_sql("customers_raw"))
def check_data_types(spark, sf_dir):
    """The types are those the stored file itself declares, not a schema given to the reader."""
    return Q.check_data_types(spark.read.parquet(FX.customers_raw_path(spark, sf_dir)))


@query("check_data_types_mistyped", oracle=_types_sql(
    "(SELECT * REPLACE (CAST(tenure_months AS VARCHAR) AS tenure_months, CAST(churned AS DOUBLE) AS churned) FROM customers_raw)"))
def check_data_types_mistyped(spark, sf_dir):
    """A file that stores tenure as text and the label as double fails."""
    bad = FX.customers_raw(spark, sf_dir).withColumns({"tenure_months": F.col("tenure_months").cast("string"),
                                                       "churned": F.col("churned").cast("double")})
    return Q.check_data_types(spark.read.parquet(write_table(bad, scratch_path(spark, "customers_mistyped"))))


@query("check_value_ranges", oracle=_range_sql("customers_dirty"))
def check_value_ranges(spark, sf_dir):
    return Q.aggregate_checks(FX.customers_dirty(spark, sf_dir), only=["value_ranges"])


@query("check_categorical_values", oracle=_cat_sql("customers_dirty"))
def check_categorical_values(spark, sf_dir):
    return Q.aggregate_checks(FX.customers_dirty(spark, sf_dir), only=["categorical_values"])


_INVALID_UNION = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", \"{c}\" AS invalid_value FROM customers_dirty "
    f"WHERE NOT coalesce(\"{c}\" IN ({', '.join(repr(v) for v in vals)}), FALSE)"
    for c, vals in ALLOWED.items())


@query("categorical_invalid_values", oracle=f"""
SELECT "column", invalid_value, COUNT(*) AS n FROM ({_INVALID_UNION}) GROUP BY "column", invalid_value""")
def categorical_invalid_values(spark, sf_dir):
    return Q.categorical_invalid_values(FX.customers_dirty(spark, sf_dir))


@query("check_target_distribution", oracle=_target_sql("customers_raw"))
def check_target_distribution(spark, sf_dir):
    return Q.aggregate_checks(FX.customers_raw(spark, sf_dir), only=["target_distribution"])


@query("check_outliers", oracle=_outlier_sql("customers_raw"))
def check_outliers(spark, sf_dir):
    return Q.check_outliers(FX.customers_raw(spark, sf_dir))


@query("check_data_freshness", oracle=_fresh_sql("customers_raw", AS_OF_FRESH))
def check_data_freshness(spark, sf_dir):
    return Q.aggregate_checks(FX.customers_raw(spark, sf_dir), AS_OF_FRESH, only=["data_freshness"])


@query("check_data_freshness_stale", oracle=_fresh_sql("customers_raw", AS_OF_STALE))
def check_data_freshness_stale(spark, sf_dir):
    return Q.aggregate_checks(FX.customers_raw(spark, sf_dir), AS_OF_STALE, only=["data_freshness"])


def _all_checks_sql(src, as_of):
    return " UNION ALL ".join([_missing_sql(src), _dup_sql(src), _range_sql(src), _cat_sql(src),
                               _target_sql(src), _fresh_sql(src, as_of), _outlier_sql(src), _types_sql(src)])


def _summary_sql(src, as_of):
    return f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_checks,
       CAST(COUNT(*) FILTER (WHERE "check" <> 'outliers' AND ok) AS BIGINT) AS passed,
       CAST(COUNT(*) FILTER (WHERE "check" <> 'outliers' AND NOT ok AND sev = 'fail') AS BIGINT) AS failed,
       CAST(COUNT(*) FILTER (WHERE "check" = 'outliers' OR (NOT ok AND sev = 'warning')) AS BIGINT) AS warnings,
       (SELECT COUNT(*) FROM {src}) AS input_rows,
       COUNT(*) FILTER (WHERE "check" <> 'outliers' AND NOT ok AND sev = 'fail') = 0
         AND (SELECT COUNT(*) FROM {src}) > 0 AS success
FROM (SELECT "check", bool_and(passed) AS ok, first(severity) AS sev
      FROM ({_all_checks_sql(src, as_of)}) GROUP BY "check")"""


@query("validation_summary", oracle=_summary_sql("customers_raw", AS_OF_FRESH))
def validation_summary(spark, sf_dir):
    df = FX.customers_raw(spark, sf_dir)
    return Q.validation_summary(Q.run_all_checks(df, AS_OF_FRESH), df)


@query("validation_summary_dirty", oracle=_summary_sql("customers_dirty", AS_OF_FRESH))
def validation_summary_dirty(spark, sf_dir):
    df = FX.customers_dirty(spark, sf_dir)
    return Q.validation_summary(Q.run_all_checks(df, AS_OF_FRESH), df)


@query("validation_report", oracle=f"""
SELECT '{AS_OF_FRESH}' AS timestamp, s.total_checks, s.failed, s.success, c."check", c.severity,
       bool_and(c.passed) OVER (PARTITION BY c."check") AS passed, concat(coalesce(c."column", '*'), '.', c.metric) AS metric, c.value
FROM ({_all_checks_sql("customers_raw", AS_OF_FRESH)}) c, ({_summary_sql("customers_raw", AS_OF_FRESH)}) s""")
def validation_report(spark, sf_dir):
    """The nested report is written as JSON, read back and laid out one row per metric."""
    df = FX.customers_raw(spark, sf_dir)
    checks = materialize(Q.run_all_checks(df, AS_OF_FRESH))
    report = Q.validation_report(checks, Q.validation_summary(checks, df), AS_OF_FRESH)
    back = sinks.read_json(spark, sinks.write_json(report, scratch_path(spark, "validation_report")), report.schema)
    one = back.select("timestamp", "total_checks", "failed", "success", F.explode("checks").alias("c"))
    return one.select("timestamp", "total_checks", "failed", "success", "c.check", "c.severity", "c.passed",
                      F.explode("c.details").alias("metric", "value"))


def _reasons_sql():
    parts = []
    for c in CRITICAL:
        parts.append(f"CASE WHEN {_miss_sql(c)} THEN 'missing:{c}' END")
    for c, (lo, hi) in RANGES.items():
        parts.append(f"CASE WHEN \"{c}\" < {lo} OR \"{c}\" > {hi} THEN 'range:{c}' END")
    for c, vals in ALLOWED.items():
        lst = ", ".join(f"'{v}'" for v in vals)
        parts.append(f"CASE WHEN NOT coalesce(\"{c}\" IN ({lst}), FALSE) THEN 'category:{c}' END")
    return "concat_ws(',', " + ", ".join(parts) + ")"


_CR = ", ".join(CR_COLS)


@query("quarantine_split", oracle=f"""
SELECT {_CR}, (rs <> '' OR rn > 1) AS quarantined,
       concat_ws(',', CASE WHEN rs <> '' THEN rs END, CASE WHEN rn > 1 THEN 'duplicate' END) AS reasons
FROM (SELECT *, {_reasons_sql()} AS rs,
             row_number() OVER (PARTITION BY customer_id ORDER BY {_CR}) AS rn
      FROM customers_dirty)""")
def quarantine_split(spark, sf_dir):
    q = Q.quarantine_split(FX.customers_dirty(spark, sf_dir))
    return q.withColumn("reasons", F.array_join("reasons", ","))


def _requests(spark, sf_dir):
    return FX.customers_dirty(spark, sf_dir).select(*Q.REQUEST_FIELDS)


def _request_sql():
    parts = [f"CASE WHEN \"{c}\" IS NULL THEN 'missing:{c}' END" for c in REQUIRED]
    for c, (lo, hi) in REQUEST_RANGES.items():
        cond = f"\"{c}\" < {lo}" if hi is None else f"(\"{c}\" < {lo} OR \"{c}\" > {hi})"
        parts.append(f"CASE WHEN {cond} THEN 'range:{c}' END")
    for c, vals in ALLOWED.items():
        lst = ", ".join(f"'{v}'" for v in vals)
        parts.append(f"CASE WHEN \"{c}\" IS NOT NULL AND \"{c}\" NOT IN ({lst}) THEN 'category:{c}' END")
    rs = "concat_ws(',', " + ", ".join(parts) + ")"
    flds = ", ".join(REQUIRED)
    return f"SELECT {flds}, rs = '' AS valid, rs AS reasons FROM (SELECT *, {rs} AS rs FROM customers_dirty)"


@query("request_validation", oracle=_request_sql())
def request_validation(spark, sf_dir):
    return Q.request_validation(_requests(spark, sf_dir))


def json_texts(spark, sf_dir):
    """Requests of all customers as JSON, some of them broken, mistyped, incomplete or out of bounds."""
    x = FX.with_key(FX.customers_raw(spark, sf_dir))
    k = F.col("k")
    text = {c: F.to_json(F.struct(F.col(c).alias("x"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col(c).alias("x")))) - 6) for c in Q.REQUEST_FIELDS}
    tenure, when = F.col("tenure_months").cast("string"), lambda n, c, t: F.when(k % n == 0, F.lit(t)).otherwise(text[c])      # noqa: E731
    text["tenure_months"] = (F.when(k % 59 == 0, "-5").when(k % 37 == 0, F.concat(tenure, F.lit(".5")))
                             .when(k % 31 == 0, F.concat(F.lit('" '), tenure, F.lit('"'))).when(k % 73 == 0, F.concat(tenure, F.lit(".0"))).otherwise(tenure))
    text["monthly_charges"] = when(41, "monthly_charges", "null")
    text["senior_citizen"] = when(53, "senior_citizen", '"yes"')
    text["payment_method"] = when(61, "payment_method", '"Bitcoin"')
    text["total_charges"] = when(67, "total_charges", '" 12.5 "')
    text["phone_service"] = when(71, "phone_service", "1")
    parts = [F.when(k % 43 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit(f'"{c}":'), t)) if c == "contract_type" else F.concat(F.lit(f'"{c}":'), t)
             for c, t in text.items()]
    extra = F.when(k % 47 == 0, '"extra":{"a":[1,null]}')
    body = F.concat_ws(",", *parts, extra)
    return x.select("k", F.concat(F.lit("{"), body, F.when(k % 97 == 0, "").otherwise("}")).alias("json"))


_JSON_SQL = """
SELECT k, CASE WHEN k % 97 <> 0 AND (k % 37 <> 0 OR k % 59 = 0) THEN CASE WHEN k % 59 = 0 THEN -5 ELSE tenure_months END END AS tenure_months,
       CASE WHEN k % 97 <> 0 AND k % 41 <> 0 THEN monthly_charges END AS monthly_charges,
       CASE WHEN k % 97 <> 0 THEN CASE WHEN k % 67 = 0 THEN 12.5e0 ELSE total_charges END END AS total_charges,
       reasons = '' AS valid, reasons
FROM (SELECT *, CASE WHEN k % 97 = 0 THEN 'json' ELSE concat_ws(',',
        CASE WHEN k % 43 = 0 THEN 'missing:contract_type' END,
        CASE WHEN k % 37 = 0 AND k % 59 <> 0 THEN 'type:tenure_months' END, CASE WHEN k % 41 = 0 THEN 'type:monthly_charges' END,
        CASE WHEN k % 71 = 0 THEN 'type:phone_service' END, CASE WHEN k % 53 = 0 THEN 'type:senior_citizen' END,
        CASE WHEN k % 59 = 0 THEN 'range:tenure_months' END, CASE WHEN k % 61 = 0 THEN 'category:payment_method' END) END AS reasons FROM customers_k)"""


@query("request_json_validation", oracle=_JSON_SQL)
def request_json_validation(spark, sf_dir):
    """JSON requests with type errors; what the fields were changed to is known from the key."""
    return Q.json_requests(json_texts(spark, sf_dir), keep=["k"]).select("k", "tenure_months", "monthly_charges", "total_charges", "valid", "reasons")
