import fractions
import itertools
import math

import pytest

from pyspark.sql import functions as F

from churnlake.functions.exprs import ks_pvalue, ks_pvalue_asymptotic, ks_pvalue_exact, risk_band_api, risk_band_dash
from churnlake.operators import evaluation as EV
from churnlake.operators import scoring as SC
from churnlake.operators.features import FEATURE_COLUMNS


def test_band_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.4,), (0.7,), (0.69999,), (1.0,)], "p double")
    got = [tuple(r) for r in df.select(risk_band_api(F.col("p")), risk_band_dash(F.col("p"))).collect()]
    assert got == [("LOW", None), ("MEDIUM", "LOW"), ("HIGH", "MEDIUM"), ("MEDIUM", "MEDIUM"), ("HIGH", "HIGH")]


def _req(spark, **kw):
    base = dict(customer_id="C000001", tenure_months=3, monthly_charges=90.0, total_charges=270.0,
                contract_type="Month-to-month", payment_method="Electronic check", internet_service="Fiber optic",
                phone_service="Yes", online_security="No", tech_support="No", senior_citizen=1)
    base.update(kw)
    from churnlake.sources.schemas import SCORING_REQUEST
    return spark.createDataFrame([tuple(base[f.name] for f in SCORING_REQUEST.fields)], SCORING_REQUEST)


def test_rule_score_clamps_high_risk(spark):
    r = SC.score_customers(_req(spark), "2024-01-31T00:00:00").first()
    assert r["churn_probability"] == 1.0 and r["risk_level"] == "HIGH" and r["churn_prediction"]
    assert r["confidence"] == 1.0 and r["model_version"] == "rules-1.0"


def test_rule_score_low_risk(spark):
    r = SC.score_customers(_req(spark, tenure_months=60, monthly_charges=30.0, contract_type="Two year",
                                payment_method="Bank transfer", online_security="Yes", tech_support="Yes",
                                senior_citizen=0, internet_service="DSL"), "t").first()
    assert r["churn_probability"] == 0.0 and r["risk_level"] == "LOW"


def test_serving_alignment_fills_zero(spark):
    al = SC.align_to_model(SC.serving_features(_req(spark)), FEATURE_COLUMNS + ["not_a_feature"])
    assert al.columns == ["customer_id", *FEATURE_COLUMNS, "not_a_feature"]
    assert al.first()["not_a_feature"] == 0
    assert len(SC.serving_features(_req(spark)).columns) == 1 + 45


def test_recommendations_five_actions_above_half(spark):
    resp = SC.score_customers(_req(spark), "t")
    assert SC.recommendations(resp).count() == 5


def test_fallback_uses_rules_when_model_missing(spark):
    df = _req(spark).withColumn("model_probability", F.lit(None).cast("double"))
    r = SC.response_rows(SC.with_fallback(df), "t", F.col("model_mode")).first()
    assert r["model_version"] == "rules-1.0"


def test_pvalue_known_value_and_small_lambda(spark):
    df = spark.createDataFrame([(0.076, 500, 1000), (0.0, 500, 1000)], "d double, n bigint, m bigint")
    p = [r[0] for r in df.select(ks_pvalue_asymptotic(F.col("d"), F.col("n"), F.col("m")).alias("p")).collect()]
    assert math.isclose(p[0], 0.0425307, rel_tol=1e-4)
    assert p[1] == 1.0


def _orders(n, m):
    """KS statistic (times n m) of every order of n + m values."""
    for ref in itertools.combinations(range(n + m), n):
        i = j = most = 0
        for s in range(n + m):
            i, j = (i + 1, j) if s in ref else (i, j + 1)
            most = max(most, abs(i * m - j * n))
        yield most


@pytest.mark.parametrize("n,m", [(1, 1), (1, 6), (3, 2), (4, 4), (6, 3), (5, 7), (7, 7)])
def test_exact_pvalue_is_the_share_of_all_orders(spark, n, m):
    every = list(_orders(n, m))
    hs = sorted({0, *every})
    df = spark.createDataFrame([(h / (n * m), n, m, h) for h in hs], "d double, n bigint, m bigint, h bigint").coalesce(1)
    got = {r["h"]: (r["p"], r["q"]) for r in df.select("h", ks_pvalue_exact(F.col("d"), F.col("n"), F.col("m")).alias("p"),
                                                       ks_pvalue_exact(F.col("d"), F.col("m"), F.col("n")).alias("q")).collect()}
    for h in hs:
        want = sum(x >= h for x in every) / len(every)
        assert math.isclose(got[h][0], want, rel_tol=1e-12) and math.isclose(got[h][1], want, rel_tol=1e-12)


def test_exact_pvalue_of_equal_samples_has_a_closed_form_and_keeps_small_values(spark):
    """n = m: reflection gives 2 * sum (-1)^(k+1) C(2n, n + k c) / C(2n, n)."""
    n, cs = 300, (1, 17, 60, 200, 299, 300)
    df = spark.createDataFrame([(c / n, n) for c in cs], "d double, n bigint").coalesce(1)
    got = [r["p"] for r in df.select(ks_pvalue_exact(F.col("d"), F.col("n"), F.col("n")).alias("p")).collect()]
    for c, p in zip(cs, got):
        want = fractions.Fraction(2 * sum((-1) ** (k + 1) * math.comb(2 * n, n + k * c) for k in range(1, n // c + 1)), math.comb(2 * n, n))
        assert math.isclose(p, float(want), rel_tol=1e-9)


def test_pvalue_changes_to_the_limit_above_the_exact_sizes(spark):
    df = spark.createDataFrame([(0.4, 8, 10), (0.4, 8, 11), (None, 8, 8), (0.4, 0, 4)], "d double, n bigint, m bigint").coalesce(1)
    c = [F.col(x) for x in ("d", "n", "m")]
    r = df.select(ks_pvalue(*c, exact_rows=10).alias("p"), ks_pvalue_exact(*c).alias("e"), ks_pvalue_asymptotic(*c).alias("a")).collect()
    assert r[0]["p"] == r[0]["e"] != r[0]["a"] and r[1]["p"] == r[1]["a"] != r[1]["e"]
    assert r[2]["p"] is None and r[3]["p"] is None


def test_report_and_confusion(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 1 + [(0, 0)] * 4 + [(1, 0)] * 2
    df = spark.createDataFrame(rows, "label int, prediction int")
    cm = {(r["label"], r["prediction"]): r["count"] for r in EV.confusion_matrix(df).collect()}
    assert cm == {(1, 1): 3, (0, 1): 1, (0, 0): 4, (1, 0): 2}
    rep = {r["class"]: r for r in EV.classification_report(df).collect()}
    assert math.isclose(rep["1"]["precision"], 0.75) and math.isclose(rep["1"]["recall"], 0.6)
    assert rep["accuracy"]["precision"] == 0.7


def test_best_model_first_wins_ties(spark):
    runs = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.6), ("c", 2, 0.6), ("d", 3, None)],
                                 "run_name string, ordinal int, f1_score double")
    assert EV.best_model(runs).first()["run_name"] == "b"
