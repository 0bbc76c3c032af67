"""Warehouse views and KPI queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def churn_summary(customers: DataFrame) -> DataFrame:
    """Q1: per contract type — count, churned, rate %, average charges and
    tenure, highest churn rate first.  One partial + final hash aggregate;
    the ordering runs over at most a handful of groups."""
    return (customers.groupBy("contract_type")
            .agg(F.count(F.lit(1)).alias("total_customers"),
                 F.sum("churned").cast("bigint").alias("churned_customers"),
                 F.round(F.avg("churned") * 100, 2).alias("churn_rate_pct"),
                 F.round(F.avg("monthly_charges"), 2).alias("avg_monthly_charges"),
                 F.round(F.avg("tenure_months"), 1).alias("avg_tenure_months"))
            .orderBy(F.desc("churn_rate_pct"), F.asc("contract_type")))


def high_risk_customers(customers: DataFrame) -> DataFrame:
    """Q2: short-tenure month-to-month customers paying > 70, costliest first.
    The three predicates are pushed into the scan when the input is a table."""
    return (customers
            .filter((F.col("tenure_months") < 12) & (F.col("contract_type") == "Month-to-month")
                    & (F.col("monthly_charges") > 70))
            .select("customer_id", "tenure_months", "monthly_charges", "contract_type",
                    "tech_support", "churned")
            .orderBy(F.desc("monthly_charges"), F.asc("customer_id")))


def total_customers(customers: DataFrame) -> DataFrame:
    """Q3."""
    return customers.agg(F.count(F.lit(1)).alias("total_customers"))


def churned_customers(customers: DataFrame) -> DataFrame:
    """Q4."""
    return customers.agg(F.count_if(F.col("churned") == 1).alias("churned_customers"))


def churn_rate(customers: DataFrame) -> DataFrame:
    """Q5."""
    return customers.agg(F.round(F.avg("churned") * 100, 2).alias("churn_rate"))


def avg_revenue(customers: DataFrame) -> DataFrame:
    """Q6."""
    return customers.agg(F.round(F.avg("monthly_charges"), 2).alias("avg_revenue"))


def kpi_table(customers: DataFrame) -> DataFrame:
    """Q7: the four KPIs as (label, value) rows from a single aggregate pass."""
    one = customers.agg(
        F.count(F.lit(1)).cast("double").alias("v_total"),
        F.count_if(F.col("churned") == 1).cast("double").alias("v_churned"),
        F.round(F.avg("churned") * 100, 2).alias("v_rate"),
        F.round(F.avg("monthly_charges"), 2).alias("v_revenue"),
    )
    return one.select(F.expr(
        "stack(4, 1, 'Total customers', v_total, 2, 'Churned customers', v_churned, "
        "3, 'Churn rate', v_rate, 4, 'Average revenue', v_revenue) AS (ordinal, label, value)"))


def preview_head(customers: DataFrame, n: int = 5) -> DataFrame:
    """Preview rows.  The reference's unordered LIMIT is made
    deterministic with an order (TakeOrderedAndProject, no full sort)."""
    return customers.orderBy("customer_id").limit(n)


def load_rowcount_check(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """Row count of the written table against its source."""
    a = source.agg(F.count(F.lit(1)).alias("source_rows"))
    b = loaded.agg(F.count(F.lit(1)).alias("loaded_rows"))
    from .stats import with_one_row
    return with_one_row(a, b).withColumn("match", F.col("source_rows") == F.col("loaded_rows"))


def create_views(customers: DataFrame) -> None:
    """Register the analytic views for SQL users."""
    customers.createOrReplaceTempView("customers_raw")
    churn_summary(customers).createOrReplaceTempView("churn_summary")
    high_risk_customers(customers).createOrReplaceTempView("high_risk_customers")
