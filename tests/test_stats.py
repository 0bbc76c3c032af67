"""Distributed statistics against brute force on small fixtures, including
a hot key holding a third of the rows and different slice counts."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from churnlake.operators import evaluation as EV
from churnlake.operators import stats as S
from churnlake.operators.drift import ks_statistics
from churnlake.operators.monitoring import drift_timeline


def _np_quantile(xs, p):
    return float(np.quantile(np.array(xs, dtype=float), p, method="linear"))


def test_prefix_sum_matches_cumsum_with_hot_key(spark):
    rng = np.random.default_rng(7)
    vals = list(rng.normal(size=300)) + [0.5] * 150          # a hot value: a third of the rows
    rows = [("a" if i % 2 else "b", float(v)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "g string, v double").groupBy("g", "v").agg(F.count(F.lit(1)).alias("c"))
    for n in (1, 3, 16):
        got = {(r["g"], r["v"]): r["c_cum"] for r in S.prefix_sum(df, ["g"], ["v"], ["c"], n_slices=n).collect()}
        for g in ("a", "b"):
            xs = sorted(v for gg, v in rows if gg == g)
            for v in set(xs):
                assert got[(g, v)] == sum(1 for x in xs if x <= v)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60))
def test_exact_quantiles_match_numpy(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    q = {r["p"]: r["q"] for r in S.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]).collect()}
    for p, v in q.items():
        assert np.isclose(v, _np_quantile(xs, p), rtol=1e-12, atol=1e-9)


def _ks_brute(a, b):
    pts = sorted(set(a) | set(b))
    a, b = np.array(a), np.array(b)
    return max(abs((a <= p).mean() - (b <= p).mean()) for p in pts)


def test_ks_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    a = list(np.round(rng.normal(size=200), 1))
    b = list(np.round(rng.normal(0.3, 1.2, size=120), 1))
    rows = [("ref", float(x)) for x in a] + [("prod", float(x)) for x in b]
    df = spark.createDataFrame(rows, "side string, f1 double")
    ks = ks_statistics(df, ["f1"]).first()
    assert np.isclose(ks["ks_statistic"], _ks_brute(a, b))
    assert (ks["n_ref"], ks["n_prod"]) == (200, 120)


def _auc_brute(y, s):
    pos = [x for x, t in zip(s, y) if t == 1]
    neg = [x for x, t in zip(s, y) if t == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_rank_auc_with_ties(spark):
    rng = np.random.default_rng(11)
    s = list(np.round(rng.uniform(size=300), 1))
    y = [int(rng.uniform() < x) for x in s]
    df = spark.createDataFrame(list(zip(y, [float(v) for v in s])), "label int, score double")
    assert np.isclose(EV.roc_auc(df).first()[0], _auc_brute(y, s))


def test_stratified_split_exact_sizes(spark):
    rows = [(i, int(i % 3 == 0)) for i in range(1, 501)]
    df = spark.createDataFrame(rows, "k bigint, label int")
    out = EV.stratified_split(df).groupBy("label", "split").count().collect()
    sizes = {(r["label"], r["split"]): r["count"] for r in out}
    assert sizes[(1, "test")] == round(0.2 * 167) and sizes[(0, "test")] == round(0.2 * 333)


def test_histogram_counts_and_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "v double")
    h = S.equal_width_histogram(df, "v", 5).orderBy("bin").collect()
    assert [r["count"] for r in h] == [2, 2, 1, 0, 1]


def test_drift_timeline_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for d in range(1, 13):
        for _ in range(25):
            rows.append((f"2024-01-{d:02d} 10:00:00", float(np.round(rng.normal(d / 10), 1))))
    df = spark.createDataFrame(rows, "t string, churn_probability double").select(
        F.col("t").cast("timestamp_ntz").alias("event_time"), "churn_probability")
    got = {r["day"].day: r["ks_statistic"] for r in drift_timeline(df).collect()}
    ref = [v for t, v in rows if int(t[8:10]) <= 7]
    for d in range(8, 13):
        day = [v for t, v in rows if int(t[8:10]) == d]
        assert np.isclose(got[d], _ks_brute(ref, day))


def test_slices_stay_below_the_target_on_a_heavy_tail(spark):
    """Slices follow the data's distribution and are cut again until each is
    below the target; running counts stay exact."""
    rng = np.random.default_rng(2)
    vals = sorted(set((rng.pareto(0.05, 4000) + 1).tolist()))[:4000]
    df = spark.createDataFrame([(float(min(v, 1e300)), 1) for v in vals], "v double, c int").distinct()
    n = df.count()
    x = S.sliced(df, [], ["v"], n_slices=2, target_slice_rows=100)
    assert x.groupBy("_slice").count().agg(F.max("count")).first()[0] <= 100 and x.count() == n
    out = S.prefix_sum(df, [], ["v"], ["c"], n_slices=2, target_slice_rows=100)
    got = [r["c_cum"] for r in out.orderBy("v").collect()]
    assert got == list(range(1, n + 1)) and out.select(F.max("c_tot")).first()[0] == n


def test_one_part_with_most_rows_is_cut(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 2900, "hot").otherwise("cold").alias("g"), F.col("id").alias("v"), F.lit(1).alias("c"))
    x = S.sliced(df, ["g"], ["v"], n_slices=4, target_slice_rows=200)
    assert x.groupBy("_slice").count().agg(F.max("count")).first()[0] <= 200
    plan = S.prefix_sum(df, ["g"], ["v"], ["c"])._jdf.queryExecution().executedPlan().toString()
    rows_by_part = [line for line in plan.splitlines() if "Exchange hashpartitioning(g#" in line and "_slice" not in line]
    assert len(rows_by_part) <= 1      # only the per-part array of slice totals meets on the part key


def test_daily_sketches_merge_to_any_range_of_days(spark):
    """Rank error of every (first, last) range within the bound; the sketches come back from a stored table."""
    import datetime as dt
    from churnlake.operators import monitoring as MO
    from churnlake.session import materialize
    log = spark.range(12_000).select(
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 6).cast("int"), hours=(F.col("id") % 24).cast("int"))).alias("event_time"),
        F.when(F.col("id") % 97 != 0, F.pow(F.lit(1.0007), (F.col("id") * 7919 % 12_000).cast("double"))).alias("latency_ms"))
    sk = materialize(MO.daily_sketches(log), "sketches")
    days = [dt.datetime(2024, 1, 1 + i) for i in range(7)]
    ranges = spark.createDataFrame([(a, b) for i, a in enumerate(days) for b in days[i:]], "first_day timestamp_ntz, last_day timestamp_ntz")
    values = {}
    for r in log.filter("latency_ms is not null").select(F.to_date("event_time").alias("d"), "latency_ms").collect():
        values.setdefault(r["d"], []).append(r["latency_ms"])
    got = MO.range_quantiles(sk, ranges, [0.05, 0.5, 0.95, 0.99]).collect()
    assert len({(r["first_day"], r["last_day"]) for r in got}) == 27      # the range of the empty seventh day alone has no row
    for r in got:
        v = [x for d, xs in values.items() if r["first_day"].date() <= d <= r["last_day"].date() for x in xs]
        assert r["n"] == len(v)
        assert sum(x < r["q"] for x in v) / len(v) <= r["p"] + MO.RANK_ERROR and sum(x <= r["q"] for x in v) / len(v) >= r["p"] - MO.RANK_ERROR
