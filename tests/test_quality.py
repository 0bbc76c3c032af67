import math

from pyspark.sql import functions as F

from churnlake.operators import quality as Q


def _checks(df, name, as_of=None):
    return {(r["column"], r["metric"]): (r["value"], r["passed"])
            for r in Q.aggregate_checks(df, as_of).filter(F.col("check") == name).collect()}


def test_missing_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (float("nan"), "c"), (4.0, "d")], "x double, s string")
    m = _checks(df, "missing_values")
    assert m[("x", "missing_count")][0] == 1      # NaN counts as missing
    assert m[("s", "missing_count")][0] == 1
    assert m[(None, "total_missing")] == (2, False)


def test_missing_literal_from_reference_tests(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (4,)], "v int")
    assert _checks(df, "missing_values")[("v", "missing_count")][0] == 1


def test_duplicates_null_ids_group_together(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "customer_id string")
    assert _checks(df, "duplicates")[("customer_id", "duplicates_count")] == (2, False)


def test_value_ranges_ignore_missing_and_nan(spark):
    df = spark.createDataFrame([(5, 50.0), (None, float("nan")), (101, 250.0), (-1, 10.0)],
                               "tenure_months bigint, monthly_charges double")
    m = _checks(df, "value_ranges")
    assert m[("tenure_months", "out_of_range")][0] == 2
    assert m[("monthly_charges", "out_of_range")][0] == 1


def test_categorical_null_is_invalid(spark):
    df = spark.createDataFrame([("DSL",), ("Cable",), (None,)], "internet_service string")
    assert _checks(df, "categorical_values")[("internet_service", "invalid_count")][0] == 2
    inv = {(r["invalid_value"], r["n"]) for r in Q.categorical_invalid_values(df).collect()}
    assert inv == {("Cable", 1), (None, 1)}


def test_target_rate_three_of_eight(spark):
    df = spark.createDataFrame([(v,) for v in [0, 0, 0, 1, 1, 0, 0, 1]], "churned int")
    m = _checks(df, "target_distribution")
    assert m[("churned", "churn_rate")] == (3 / 8, True)


def test_target_absent_adds_no_row(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert Q.aggregate_checks(df).filter(F.col("check") == "target_distribution").count() == 0


def test_outlier_literal_hundred(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 100]], "monthly_charges double")
    rows = {(r["column"], r["metric"]): r["value"] for r in Q.check_outliers(df).collect()}
    assert rows[("monthly_charges", "outlier_count")] == 1
    assert math.isclose(rows[("monthly_charges", "outlier_pct")], 100 / 6)


def test_freshness_whole_days(spark):
    df = spark.createDataFrame([("2001-08-01 23:00:00",)], "t string").select(
        F.col("t").cast("timestamp_ntz").alias("created_at"))
    m = _checks(df, "data_freshness", "2001-08-05 00:00:00")
    assert m[("created_at", "days_old")] == (3, True)           # 3.04 days → 3 whole days
    m = _checks(df, "data_freshness", "2002-01-01 00:00:00")
    assert m[("created_at", "days_old")][1] is False


def test_mock_counters_six_zero_one(spark):
    """Valid data without created_at: 6 passed, 0 failed, 1 warning (outliers)."""
    rows = [(f"C{i:06d}", i % 70, 20.0 + i % 100, 100.0 + i, "One year", "Credit card", "DSL", "Yes",
             "No", "Yes", i % 2, (i % 5 == 0) * 1) for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id string, tenure_months bigint, monthly_charges double, "
                                     "total_charges double, contract_type string, payment_method string, "
                                     "internet_service string, phone_service string, online_security string, "
                                     "tech_support string, senior_citizen int, churned int")
    s = Q.validation_summary(Q.run_all_checks(df), df).first()
    assert (s["passed"], s["failed"], s["warnings"]) == (6, 0, 1)
    assert s["success"] is True


def test_empty_input_fails_gate(spark):
    df = spark.createDataFrame([], "customer_id string, churned int")
    s = Q.validation_summary(Q.run_all_checks(df), df).first()
    assert s["success"] is False


def test_quarantine_keeps_every_row_and_first_copy(spark):
    df = spark.createDataFrame([("C1", 5), ("C1", 5), ("C1", 5), ("C2", -3), ("C3", 7), ("C3", 8)],
                               "customer_id string, tenure_months bigint")
    q = Q.quarantine_split(df).collect()
    assert len(q) == 6
    clean = [(r["customer_id"], r["tenure_months"]) for r in q if not r["quarantined"]]
    assert sorted(clean) == [("C1", 5), ("C3", 7)]
    assert sum("duplicate" in r["reasons"] for r in q) == 3


def test_request_bounds(spark):
    base = dict(customer_id="C1", monthly_charges=50.0, total_charges=100.0, contract_type="One year",
                payment_method="Credit card", internet_service="DSL", phone_service="Yes",
                online_security="Yes", tech_support="No", senior_citizen=0)
    rows = []
    for t in (-5, 0, 100, 101):
        rows.append({**base, "tenure_months": t})
    for m in (-10.0, 300.0):
        rows.append({**base, "tenure_months": 10, "monthly_charges": m})
    for s in (0, 1, 2):
        rows.append({**base, "tenure_months": 10, "senior_citizen": s})
    rows.append({**base, "tenure_months": 10, "contract_type": "Weekly"})
    from churnlake.sources.schemas import SCORING_REQUEST
    df = spark.createDataFrame([tuple(r[f.name] for f in SCORING_REQUEST.fields) for r in rows], SCORING_REQUEST)
    valid = [r["valid"] for r in Q.request_validation(df).collect()]
    assert valid == [False, True, True, False, False, False, True, True, False, False]


def test_report_sinks_roundtrip(spark, tmp_path):
    """The nested validation report written as JSON reads back whole."""
    from churnlake.sources import sinks
    df = spark.createDataFrame([("C1", 5, 0), ("C2", 7, 1)], "customer_id string, tenure_months bigint, churned int")
    checks = Q.run_all_checks(df)
    rep = Q.validation_report(checks, Q.validation_summary(checks, df), "2024-01-31T00:00:00")
    path = sinks.write_json(rep, str(tmp_path / "report"))
    back = spark.read.json(path).first()
    assert back["total_checks"] == rep.first()["total_checks"]
    assert {c["check"] for c in back["checks"]} >= {"missing_values", "duplicates", "outliers"}


def test_namespace_and_views(spark):
    from churnlake.operators.analytics import create_views
    from churnlake.sources.catalog import create_namespace
    create_namespace(spark, "churn_test_ns")
    assert spark.catalog.currentDatabase() == "churn_test_ns"
    spark.sql("USE default")
    df = spark.createDataFrame([("C1", 5, 80.0, "Month-to-month", "No", 1)],
                               "customer_id string, tenure_months bigint, monthly_charges double, "
                               "contract_type string, tech_support string, churned int")
    create_views(df)
    assert spark.sql("SELECT total_customers FROM churn_summary").first()[0] == 1
    assert spark.sql("SELECT count(*) FROM high_risk_customers").first()[0] == 1


def test_json_requests_read_types_leniently_and_report_the_rest(spark):
    import json
    good = {"customer_id": "C1", "tenure_months": 12, "monthly_charges": 70.5, "total_charges": 840, "contract_type": "One year",
            "payment_method": "Mailed check", "internet_service": "DSL", "phone_service": "Yes", "online_security": "No", "tech_support": "No", "senior_citizen": 0}
    edit = lambda **kw: json.dumps({k: v for k, v in (good | kw).items() if v != "absent"})
    cases = [
        (edit(), ""), (edit(tenure_months="12"), ""), (edit(tenure_months=12.0), ""), (edit(tenure_months=" 12.00 "), ""), (edit(total_charges="1e3"), ""),
        (edit(extra=[1, {"a": None}]), ""), (edit(tenure_months=12.5), "type:tenure_months"), (edit(tenure_months="12.5"), "type:tenure_months"),
        (edit(tenure_months=True), "type:tenure_months"), (edit(tenure_months=None), "type:tenure_months"), (edit(tenure_months="absent"), "missing:tenure_months"),
        (edit(monthly_charges="a lot"), "type:monthly_charges"), (edit(monthly_charges=[1]), "type:monthly_charges"), (edit(monthly_charges="NaN"), "type:monthly_charges"),
        (edit(customer_id=7), "type:customer_id"), (edit(tenure_months=-5, payment_method="Bitcoin"), "range:tenure_months,category:payment_method"),
        (edit(senior_citizen="absent", tenure_months="x", monthly_charges=900), "missing:senior_citizen,type:tenure_months,range:monthly_charges"),
        ("{", "json"), ("", "json"), (None, "json"), ("[1]", "json"), ("12", "json"), ("null", "json"), (edit()[:-1], "json"),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "k int, json string").coalesce(1)
    got = {r["k"]: r for r in Q.json_requests(df, keep=["k"]).collect()}
    assert [got[i]["reasons"] for i in range(len(cases))] == [r for _, r in cases]
    assert all(got[i]["valid"] == (r == "") for i, (_, r) in enumerate(cases))
    assert [got[i]["tenure_months"] for i in range(5)] == [12] * 5 and got[4]["total_charges"] == 1000.0
