"""Warehouse views, KPIs, scans and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import analytics as A
from ..session import scratch_path
from ..sources import fixtures as FX
from ..sources.catalog import create_namespace
from ..sources import sinks
from ..sources import versioned as V
from .registry import query

_CR_COLS = ("customer_id, tenure_months, monthly_charges, total_charges, contract_type, payment_method, "
            "internet_service, phone_service, multiple_lines, online_security, online_backup, device_protection, "
            "tech_support, streaming_tv, streaming_movies, paperless_billing, senior_citizen, partner, dependents, "
            "churned, created_at")


@query("scan_customers", oracle=f"SELECT {_CR_COLS} FROM customers_raw")
def scan_customers(spark, sf_dir):
    """Full scan of the loaded table."""
    return FX.customers_raw(spark, sf_dir)


@query("load_customers_raw", oracle=f"SELECT {_CR_COLS} FROM customers_raw")
def load_customers_raw(spark, sf_dir):
    """The load job itself: customer ⟕ per-customer order aggregate."""
    return FX.derive_customers_raw(spark, sf_dir)


@query("churn_summary", oracle="""
SELECT contract_type, COUNT(*) AS total_customers, CAST(SUM(churned) AS BIGINT) AS churned_customers,
       ROUND(AVG(churned) * 100, 2) AS churn_rate_pct, ROUND(AVG(monthly_charges), 2) AS avg_monthly_charges,
       ROUND(AVG(tenure_months), 1) AS avg_tenure_months
FROM customers_raw GROUP BY contract_type ORDER BY churn_rate_pct DESC, contract_type""")
def churn_summary(spark, sf_dir):
    return A.churn_summary(FX.customers_raw(spark, sf_dir))


@query("high_risk_customers", oracle="""
SELECT customer_id, tenure_months, monthly_charges, contract_type, tech_support, churned
FROM customers_raw
WHERE tenure_months < 12 AND contract_type = 'Month-to-month' AND monthly_charges > 70
ORDER BY monthly_charges DESC, customer_id""")
def high_risk_customers(spark, sf_dir):
    return A.high_risk_customers(FX.customers_raw(spark, sf_dir))


@query("total_customers", oracle="SELECT COUNT(*) AS total_customers FROM customers_raw")
def total_customers(spark, sf_dir):
    return A.total_customers(FX.customers_raw(spark, sf_dir))


@query("churned_customers", oracle="SELECT COUNT(*) AS churned_customers FROM customers_raw WHERE churned = 1")
def churned_customers(spark, sf_dir):
    return A.churned_customers(FX.customers_raw(spark, sf_dir))


@query("churn_rate", oracle="SELECT ROUND(AVG(churned) * 100, 2) AS churn_rate FROM customers_raw")
def churn_rate(spark, sf_dir):
    return A.churn_rate(FX.customers_raw(spark, sf_dir))


@query("avg_revenue", oracle="SELECT ROUND(AVG(monthly_charges), 2) AS avg_revenue FROM customers_raw")
def avg_revenue(spark, sf_dir):
    return A.avg_revenue(FX.customers_raw(spark, sf_dir))


@query("kpi_table", oracle="""
SELECT * FROM (
  SELECT 1 AS ordinal, 'Total customers' AS label, CAST(COUNT(*) AS DOUBLE) AS value FROM customers_raw
  UNION ALL SELECT 2, 'Churned customers', CAST(SUM(CASE WHEN churned = 1 THEN 1 ELSE 0 END) AS DOUBLE) FROM customers_raw
  UNION ALL SELECT 3, 'Churn rate', ROUND(AVG(churned) * 100, 2) FROM customers_raw
  UNION ALL SELECT 4, 'Average revenue', ROUND(AVG(monthly_charges), 2) FROM customers_raw)
ORDER BY ordinal""")
def kpi_table(spark, sf_dir):
    return A.kpi_table(FX.customers_raw(spark, sf_dir))


@query("preview_head", oracle=f"SELECT {_CR_COLS} FROM customers_raw ORDER BY customer_id LIMIT 5")
def preview_head(spark, sf_dir):
    return A.preview_head(FX.customers_raw(spark, sf_dir))


@query("sink_overwrite_roundtrip", oracle=f"SELECT {_CR_COLS} FROM customers_raw")
def sink_overwrite_roundtrip(spark, sf_dir):
    """S3: overwrite-write the table to shared storage and scan it back."""
    return sinks.overwrite_roundtrip(spark, FX.derive_customers_raw(spark, sf_dir), "customers_raw_copy")


@query("versioned_load_history", oracle="""
WITH parts AS (
  SELECT 1 AS version, 'replace' AS operation, churned, tenure_months FROM customers_raw
  UNION ALL SELECT 2, 'append', churned, tenure_months FROM customers_raw
  UNION ALL SELECT 2, 'append', churned, tenure_months FROM customers_raw WHERE churned = 1
  UNION ALL SELECT 3, 'replace', churned, tenure_months FROM customers_raw WHERE churned = 0)
SELECT version, operation, COUNT(*) AS n_rows, CAST(SUM(churned) AS BIGINT) AS churned, CAST(SUM(tenure_months) AS BIGINT) AS tenure_months
FROM parts GROUP BY version, operation""")
def versioned_load_history(spark, sf_dir):
    """S3: the load as commits — all customers, the churned ones once more,
    then the others alone — each version read back after the last commit."""
    table, raw = scratch_path(spark, "customers_versions"), FX.customers_raw(spark, sf_dir)
    snaps = [V.replace(raw, table), V.append(raw.filter("churned = 1"), table), V.replace(raw.filter("churned = 0"), table)]
    out = None
    for s in snaps:
        rows = V.read(spark, table, s.version).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("churned").cast("bigint").alias("churned"),
                                                   F.sum("tenure_months").cast("bigint").alias("tenure_months"))
        rows = rows.select(F.lit(s.version).alias("version"), F.lit(s.operation).alias("operation"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("load_rowcount_check", oracle="""
SELECT COUNT(*) AS source_rows, COUNT(*) AS loaded_rows, TRUE AS "match" FROM customers_raw""")
def load_rowcount_check(spark, sf_dir):
    return A.load_rowcount_check(FX.derive_customers_raw(spark, sf_dir), FX.customers_raw(spark, sf_dir))


@query("view_churn_summary", oracle="""
SELECT contract_type, COUNT(*) AS total_customers, ROUND(AVG(churned) * 100, 2) AS churn_rate_pct
FROM customers_raw GROUP BY contract_type""")
def view_churn_summary(spark, sf_dir):
    """A namespace is created and used, the analytic views are
    registered over the loaded table and read through SQL."""
    before = spark.catalog.currentDatabase()
    create_namespace(spark, "churn_analytics")
    try:
        A.create_views(FX.customers_raw(spark, sf_dir))
        return spark.sql("SELECT contract_type, total_customers, churn_rate_pct FROM churn_summary")
    finally:
        spark.catalog.setCurrentDatabase(before)
