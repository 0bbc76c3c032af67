"""Plan properties: no Python UDF and no cross or nested-loop join in any
registered query, pruning and pushdown reach the scan, one-row parameters
arrive as scalar subqueries."""

import pytest

import __spark_entry__ as E
from churnlake.plans.registry import QUERIES, load_all
from conftest import SMOKE

load_all()

SLOW = {"cross_validation", "latest_model_run", "score_with_model", "train_random_forest", "train_gbt_depth6",
        "train_gbt_depth8", "train_gbt_depth5", "feature_importance", "importance_bars", "trained_runs", "trained_best_model",
        "trained_model_comparison", "trained_promotion_gate", "trained_run_settings"}      # each runs the training job at full settings


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_") and n not in SLOW))
def test_no_python_udf(spark, name):
    plan = _plan(QUERIES[name](spark, SMOKE))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF",
                 "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, f"{name} uses {node}"


def test_scan_prunes_columns_and_pushes_filters(spark):
    from churnlake.sources.tables import read_table
    from pyspark.sql import functions as F
    ev = read_table(spark, SMOKE, "events").filter(F.col("event_type") == "error").select("ts")
    plan = _plan(ev)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,error)]" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan


def test_load_prunes_orders_when_unused(spark):
    from churnlake.operators.analytics import avg_revenue
    from churnlake.sources.fixtures import derive_customers_raw
    plan = _plan(avg_revenue(derive_customers_raw(spark, SMOKE)))
    assert "orders" not in plan.lower().split("readschema")[0] or "o_totalprice" not in plan


def test_one_row_parameters_are_scalar_subqueries(spark):
    from churnlake.operators.monitoring import risk_distribution
    from churnlake.sources.fixtures import prediction_log
    plan = _plan(risk_distribution(prediction_log(spark, SMOKE)))
    assert "Subquery" in plan
    assert "Join" not in plan


def test_one_row_parameter_rejects_many_rows(spark):
    from churnlake.operators.stats import with_one_row
    df = spark.range(3)
    many = spark.range(2).withColumnRenamed("id", "p")
    with pytest.raises(Exception):
        with_one_row(df, many).collect()


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["contract_type", "total_customers", "churned_customers", "churn_rate_pct",
                          "avg_monthly_charges", "avg_tenure_months"]
    assert len(rows) == 3


def test_one_row_parameter_empty_gives_empty(spark):
    """Same result as the inner join it replaces: no parameter row, no rows;
    a parameter row of nulls still attaches."""
    from churnlake.operators.stats import with_one_row
    from pyspark.sql import functions as F
    df = spark.range(3)
    empty = spark.range(1).select(F.lit(1.0).alias("p")).filter("p < 0")
    assert with_one_row(df, empty).count() == 0
    nulls = spark.range(1).select(F.lit(None).cast("double").alias("p"))
    assert with_one_row(df, nulls).filter(F.col("p").isNull()).count() == 3


def test_promotion_gate_without_production_run_is_empty(spark):
    from churnlake.operators.evaluation import promotion_gate
    runs = spark.createDataFrame([("a", 0.5, 0), ("b", 0.6, 1)], "run_name string, f1_score double, ordinal int")
    assert promotion_gate(runs).count() == 0


def test_best_model_of_no_runs_is_empty(spark):
    from churnlake.operators.evaluation import best_model
    runs = spark.createDataFrame([("a", None, 0)], "run_name string, f1_score double, ordinal int")
    assert best_model(runs).count() == 0


def test_rows_meet_their_split_without_the_driver(spark):
    """A broadcast side goes through the driver; these sides have a row per customer."""
    import re

    from churnlake.operators import evaluation as EV
    from churnlake.plans.q_evaluation import scorer_long
    from pyspark.sql import functions as F
    df = spark.range(60).select(F.col("id").alias("k"), (F.col("id") % 2).alias("label"))
    joins = [re.findall("SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin", _plan(x))
             for x in (EV.stratified_split(df), EV.stratified_folds(df), scorer_long(spark, SMOKE))]
    assert [j[0] for j in joins] == 3 * ["SortMergeJoin"] and joins[2][:2] == 2 * ["SortMergeJoin"]
    assert EV.stratified_split(df).filter("split = 'test'").count() == 12
