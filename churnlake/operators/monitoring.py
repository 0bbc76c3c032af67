"""Dashboard and monitoring aggregates (M1–M12) and the batch twins of the
time-series panels (W1–W7).

Input is the prediction log (event_id, event_time, customer_id,
churn_probability, prediction, latency_ms, model_version, risk_level,
is_error).  Every function is a grouped aggregate or a filter/sort; the
time-window functions work unchanged on a streaming DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import equal_width_histogram, prefix_sum, quantiles, with_one_row

# Fixed values (dashboard settings of the reference, plus our bucket bounds).
PROB_BINS = 40
LATENCY_BINS = 40
LATENCY_BUCKETS_MS = [5, 10, 25, 50, 75, 100, 250, 500, 1000]
WINDOW = "5 minutes"
WINDOW_SECONDS = 300
# errors per second over a window above which the alert condition holds
ERROR_RATE_ALERT = 0.05
DRIFT_LINE = 0.10
RANGES = {"Last Hour": "INTERVAL 1 HOUR", "Last 24 Hours": "INTERVAL 24 HOURS", "Last 7 Days": "INTERVAL 7 DAYS"}
# the dashboard's icons before these labels are left out
PREDICTION_LABELS = {0: "No Churn", 1: "Churn"}


def _ts(c: str = "event_time") -> Column:
    return F.col(c).cast("timestamp")


def _day(c: str = "event_time") -> Column:
    return F.date_trunc("day", F.col(c)).cast("timestamp_ntz")


def probability_histogram(log: DataFrame, bins: int = PROB_BINS) -> DataFrame:
    """M1."""
    return equal_width_histogram(log, "churn_probability", bins)


def latency_histogram(log: DataFrame, bins: int = LATENCY_BINS) -> DataFrame:
    """M7."""
    return equal_width_histogram(log, "latency_ms", bins)


def risk_distribution(log: DataFrame) -> DataFrame:
    """M2: count and share per risk band (total from a one-row aggregate)."""
    c = log.groupBy("risk_level").agg(F.count(F.lit(1)).alias("count"))
    tot = log.agg(F.count(F.lit(1)).alias("_n"))
    return with_one_row(c, tot).select("risk_level", "count",
                                       (F.col("count") / F.col("_n") * F.lit(100.0)).alias("percentage"))


def daily_trend(log: DataFrame) -> DataFrame:
    """M3: per day churned (= Σ prediction), total, retained; days without
    rows appear with zeros (calendar from min..max day, one row per day)."""
    per = log.groupBy(_day().alias("date")).agg(F.sum("prediction").cast("bigint").alias("churned"),
                                              F.count(F.lit(1)).alias("total"))
    cal = log.agg(F.explode(F.sequence(F.min(_day()), F.max(_day()), F.expr("INTERVAL 1 DAY"))).alias("date"))
    out = cal.join(per, "date", "left").fillna(0, ["churned", "total"])
    return out.withColumn("retained", F.col("total") - F.col("churned"))


def kpi_cards(log: DataFrame, now: str) -> DataFrame:
    """M4: predictions in the last 24 h, average latency, distinct customers
    currently at high risk — one aggregate pass."""
    recent = F.col("event_time") >= (F.lit(now).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY"))
    return log.agg(F.count_if(recent).alias("predictions_24h"),
                   F.round(F.avg("latency_ms"), 6).alias("avg_latency_ms"),
                   F.count_distinct(F.when(F.col("risk_level") == "HIGH", F.col("customer_id"))).alias("at_risk_customers"))


def filter_predictions(log: DataFrame, risks=("MEDIUM", "HIGH"), prediction: str = "All",
                       start: str | None = None, end: str | None = None) -> DataFrame:
    """M5 filter: risk multi-select, class, time range [start, end)."""
    f = log.filter(F.col("risk_level").isin(list(risks)))
    if prediction == "Churn":
        f = f.filter(F.col("prediction") == 1)
    elif prediction == "No Churn":
        f = f.filter(F.col("prediction") == 0)
    if start:
        f = f.filter(F.col("event_time") >= F.lit(start).cast("timestamp_ntz"))
    if end:
        f = f.filter(F.col("event_time") < F.lit(end).cast("timestamp_ntz"))
    return f


def sort_predictions(f: DataFrame, sort_by: str = "Timestamp") -> DataFrame:
    """M5 sort (offered but never applied by the reference; applied here)."""
    keys = {"Timestamp": [F.desc("event_time")], "Probability": [F.desc("churn_probability")],
            "Risk Level": [F.desc(F.when(F.col("risk_level") == "HIGH", 3).when(F.col("risk_level") == "MEDIUM", 2)
                                   .otherwise(1))]}[sort_by]
    return f.select("event_time", "customer_id", "churn_probability", "prediction", "risk_level", "event_id") \
        .orderBy(*keys, F.asc("event_id"))


def filtered_stats(f: DataFrame) -> DataFrame:
    """M6: n, churn rate %, mean probability (null rate when empty)."""
    return f.agg(F.count(F.lit(1)).alias("total_predictions"),
                 (F.try_divide(F.sum("prediction").cast("double"), F.count(F.lit(1)).cast("double"))
                  * F.lit(100.0)).alias("churn_rate_pct"),
                 F.avg("churn_probability").alias("avg_probability"))


def display_predictions(f: DataFrame) -> DataFrame:
    """Percent string with two decimals and class labels."""
    label = F.when(F.col("prediction") == 1, PREDICTION_LABELS[1]).when(F.col("prediction") == 0, PREDICTION_LABELS[0])
    return f.select(F.col("event_time").alias("Timestamp"), F.col("customer_id").alias("Customer"),
                    F.format_string("%.2f%%", F.col("churn_probability") * 100).alias("Probability"),
                    label.alias("Prediction"), F.col("risk_level").alias("Risk"))


def latency_percentiles(log: DataFrame, exact: bool = True) -> DataFrame:
    """M8: average, p95, p99 latency."""
    q = quantiles(log, ["latency_ms"], [0.95, 0.99], exact=exact)
    p = q.agg(F.max(F.when(F.col("p") == 0.95, F.col("q"))).alias("p95_ms"),
              F.max(F.when(F.col("p") == 0.99, F.col("q"))).alias("p99_ms"))
    return with_one_row(log.agg(F.avg("latency_ms").alias("avg_ms")), p)


#: Size of a latency sketch, and the share of rows its quantiles' ranks may be off by (about 0.2 % is usual at this size).
SKETCH_SIZE, RANK_ERROR = 1600, 0.01


def daily_sketches(log: DataFrame, value: str = "latency_ms", size: int = SKETCH_SIZE) -> DataFrame:
    """A1, M8 as stored state: per day the row count and a KLL sketch of a
    column (a few KB, however many rows the day has).  Sketches of any days
    merge, so quantiles of a range need no second look at its rows."""
    v = F.col(value).cast("double")
    return log.filter(v.isNotNull() & ~F.isnan(v)).groupBy(_day().alias("date")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, F.lit(size)).alias("sketch"))


def range_quantiles(sketches: DataFrame, ranges: DataFrame, probs) -> DataFrame:
    """(first_day, last_day, p, n, q) for day ranges (first_day, last_day):
    approximate quantiles from the merged sketches of their days; ranges
    without any row are left out.  The exact form stays the default."""
    days = ranges.select("first_day", "last_day", F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("date"))
    merged = days.join(sketches, "date").groupBy("first_day", "last_day").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))
    each = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("q")) for p in probs])
    return merged.select("first_day", "last_day", "n", F.inline(each)).select("first_day", "last_day", "p", "n", "q")


def daily_kpi_delta(log: DataFrame) -> DataFrame:
    """Per day predictions and mean latency, with the change against
    the previous calendar day (equi-join on day − 1; no global ordering)."""
    d = log.groupBy(_day().alias("date")).agg(F.count(F.lit(1)).alias("predictions"),
                                            F.avg("latency_ms").alias("avg_latency_ms"))
    prev = d.select((F.col("date") + F.expr("INTERVAL 1 DAY")).alias("date"),
                    F.col("predictions").alias("_pp"), F.col("avg_latency_ms").alias("_pl"))
    return d.join(prev, "date", "left").select(
        "date", "predictions", "avg_latency_ms", (F.col("predictions") - F.col("_pp")).alias("predictions_delta"),
        (F.col("avg_latency_ms") - F.col("_pl")).alias("latency_delta_ms"))


def drift_timeline(log: DataFrame, value: str = "churn_probability", ref_days: int = 7) -> DataFrame:
    """M9: for every day after the first ``ref_days`` days, the two-sample
    KS statistic between that day's values and the reference period's.

    Exact, without pairing reference points with days.  With F_ref the
    reference ECDF and day points d_1 < … < d_m (F_day(d_i) = i-th
    cumulative share):
      D⁻ = max_i F_day(d_i) − F_ref(d_i)
      D⁺ = max_i F_ref(d_{i+1}⁻) − F_day(d_i)     (d_0: F_day = 0; d_{m+1} = +∞)
    since F_ref − F_day only rises at reference points and only falls at
    day points.  F_ref at every day point comes from one global prefix sum
    over the union of reference and day points; per-day ranks and cumulative
    shares from a prefix sum per day; d_{i+1} from an equi-join on rank.
    """
    from ..session import materialize
    # The log is scanned once: distinct (day, value) with counts (partial
    # aggregation first, so a value repeated a million times is one row),
    # written to the shared folder; every branch below reads that table.
    # The first day is taken over all rows, valid values or not.
    counts = materialize(log.select(_day().alias("day"), F.col(value).cast("double").alias("v"))
                         .groupBy("day", "v").agg(F.count(F.lit(1)).alias("c")))
    d0 = counts.agg(F.min("day").alias("_d0"))
    x = with_one_row(counts.filter(F.col("v").isNotNull() & ~F.isnan("v")), d0)
    is_ref = F.col("day") < (F.col("_d0") + F.make_interval(days=F.lit(ref_days)))
    ref = x.filter(is_ref).groupBy("v").agg(F.sum("c").alias("c"))
    day = x.filter(~is_ref).select("day", "v", F.col("c").alias("c_day"))
    # global prefix of reference counts over the union of points; at equal
    # values reference rows (kind 0) come first, so the sum at a day point
    # counts reference values ≤ v
    u = (ref.select("v", F.lit(0).alias("kind"), F.lit(None).cast("timestamp_ntz").alias("day"), F.col("c").alias("c_ref"))
         .unionByName(day.select("v", F.lit(1).alias("kind"), "day", F.lit(0).cast("bigint").alias("c_ref"))))
    u = u.withColumn("_dayord", F.coalesce(F.unix_micros(F.col("day").cast("timestamp")), F.lit(0)))
    cu = prefix_sum(u, [], ["v", "kind", "_dayord"], ["c_ref"]).filter(F.col("kind") == 1)
    at = (cu.join(ref.select("v", F.col("c").alias("_eq")), "v", "left")
          .select("day", "v", (F.col("c_ref_cum") / F.col("c_ref_tot")).alias("f_le"),
                  ((F.col("c_ref_cum") - F.coalesce("_eq", F.lit(0))) / F.col("c_ref_tot")).alias("f_lt")))
    dp = prefix_sum(day.withColumn("one", F.lit(1)), ["day"], ["v"], ["c_day", "one"])
    dp = dp.join(at, ["day", "v"]).withColumn("f_day", F.col("c_day_cum") / F.col("c_day_tot"))
    nxt = dp.select("day", (F.col("one_cum") - 1).alias("one_cum"), F.col("f_lt").alias("f_lt_next"))
    j = dp.join(nxt, ["day", "one_cum"], "left")
    first_gap = F.when(F.col("one_cum") == 1, F.col("f_lt")).otherwise(F.lit(0.0))
    d_plus = F.greatest(F.coalesce(F.col("f_lt_next"), F.lit(1.0)) - F.col("f_day"), first_gap)
    d_minus = F.col("f_day") - F.col("f_le")
    out = j.groupBy("day").agg(F.max(F.greatest(d_plus, d_minus)).alias("ks_statistic"))
    return out.withColumn("above_threshold", F.col("ks_statistic") > DRIFT_LINE)


# -------------------------------------------------------------------------
# time-window panels (W1–W7), batch twins of the streaming jobs

def window_rates(counts: DataFrame, threshold: float = ERROR_RATE_ALERT) -> DataFrame:
    """Rates of windows with columns window_start, requests, errors: requests
    and errors per second (W1, W5), their ratio, and the alert condition
    "errors per second above ``threshold``"."""
    per_second = F.col("errors") / F.lit(float(WINDOW_SECONDS))
    return counts.select("window_start", "requests", "errors",
                         (F.col("requests") / F.lit(float(WINDOW_SECONDS))).alias("request_rate"),
                         per_second.alias("error_rate"), (F.col("errors") / F.col("requests")).alias("error_ratio"),
                         (per_second > threshold).alias("alert"))


def window_counts(log: DataFrame, window: str = WINDOW, threshold: float = ERROR_RATE_ALERT) -> DataFrame:
    """W1 + W5 in one windowed aggregate: requests, errors, rates."""
    g = log.groupBy(F.window(_ts(), window).alias("w")).agg(
        F.count(F.lit(1)).alias("requests"), F.sum("is_error").cast("bigint").alias("errors"))
    return window_rates(g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "requests", "errors"), threshold)


def histogram_quantile(q: float, buckets: DataFrame, group_cols) -> DataFrame:
    """Prometheus ``histogram_quantile`` over cumulative ``le`` buckets:
    rank = q·total; the first bucket whose cumulative count reaches it is
    interpolated linearly from its lower bound (0 for the first bucket); a
    rank in the +Inf bucket returns the largest finite bound."""
    g = list(group_cols)
    w = Window.partitionBy(*g).orderBy("le_idx")
    b = buckets.select(*g, "le_idx", "le", "cum",
                       F.coalesce(F.lag("le").over(w), F.lit(0.0)).alias("lower"),
                       F.coalesce(F.lag("cum").over(w), F.lit(0)).alias("cum_prev"),
                       F.max("cum").over(Window.partitionBy(*g)).alias("total"))
    rank = F.lit(q) * F.col("total")
    hit = b.filter((F.col("cum") >= rank) & (F.col("total") > 0))
    first = hit.groupBy(*g).agg(F.min_by(F.struct("le", "lower", "cum", "cum_prev", "total"), F.col("le_idx")).alias("h"))
    h = F.col("h")
    inf = h["le"].isNull()
    interp = h["lower"] + (h["le"] - h["lower"]) * (F.lit(q) * h["total"] - h["cum_prev"]) / (h["cum"] - h["cum_prev"])
    return first.select(*g, F.when(inf, h["lower"]).otherwise(interp).alias("quantile"))


def latency_buckets(log: DataFrame, window: str = WINDOW, bounds=LATENCY_BUCKETS_MS) -> DataFrame:
    """Cumulative ``le`` bucket counts per window (what a Prometheus
    histogram exports); the last bucket is +Inf (``le`` null)."""
    les = [float(b) for b in bounds] + [None]
    g = log.groupBy(F.window(_ts(), window).alias("w")).agg(
        *[F.count_if(F.col("latency_ms") <= le if le is not None else F.lit(True)).alias(f"b{i}")
          for i, le in enumerate(les)])
    arr = F.array(*[F.struct(F.lit(i).alias("le_idx"), F.lit(le).cast("double").alias("le"), F.col(f"b{i}").alias("cum"))
                    for i, le in enumerate(les)])
    return g.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), F.inline(arr))


def p95_latency(log: DataFrame, window: str = WINDOW) -> DataFrame:
    """Bucketed p95 latency per window."""
    return histogram_quantile(0.95, latency_buckets(log, window), ["window_start"]) \
        .withColumnRenamed("quantile", "p95_latency_ms")


def prediction_volume(log: DataFrame) -> DataFrame:
    """Running total of predictions per model version."""
    return log.groupBy("model_version").agg(F.count(F.lit(1)).alias("predictions_total"))


def high_risk_volume(log: DataFrame) -> DataFrame:
    """Predictions by risk label."""
    return log.groupBy("risk_level").agg(F.count(F.lit(1)).alias("predictions"))


def sustained_alerts(windows: DataFrame, windows_required: int = 2) -> DataFrame:
    """Alert "for 5m" — the windows at which the condition has held for
    ``windows_required`` consecutive 5-minute windows (this one and the ones
    before it).  Equi-joins on shifted window starts; no global ordering."""
    a = windows.filter("alert").select("window_start")
    held = a
    for i in range(1, windows_required):
        prev = a.select((F.col("window_start") + F.expr(f"INTERVAL {i * WINDOW_SECONDS} SECONDS")).alias("window_start"))
        held = held.join(prev, "window_start", "left_semi")
    return held.withColumn("held_windows", F.lit(windows_required))


def latest_f1(runs: DataFrame) -> DataFrame:
    """F1 of the most recent run (ties: the later run id)."""
    order = F.struct("start_time", "run_id")
    return runs.agg(F.max_by("f1_score", order).alias("latest_f1"), F.max_by("run_id", order).alias("run_id"))


def latest_drift(timeline: DataFrame) -> DataFrame:
    """The newest day's drift score (KS statistic)."""
    return timeline.agg(F.max_by("ks_statistic", "day").alias("latest_drift"), F.max("day").alias("drift_day"))


def latest_gauges(runs: DataFrame, timeline: DataFrame) -> DataFrame:
    """Both gauges in one row."""
    return with_one_row(latest_f1(runs), latest_drift(timeline))


def since(log: DataFrame, now: str, span: str) -> DataFrame:
    """M5: rows of the last hour, 24 hours or 7 days before an explicit
    ``now`` (``span``: one of ``RANGES``), ends included."""
    end = F.lit(now).cast("timestamp_ntz")
    return log.filter((F.col("event_time") >= end - F.expr(RANGES[span])) & (F.col("event_time") <= end))
