"""W1–W5, W8–W10 as Structured Streaming runs (AvailableNow) whose final
sink state must equal the batch twin's oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..session import scratch_path
from ..sources import fixtures as FX
from ..sources.tables import read_table
from ..streaming import alerts as SA
from ..streaming import jobs as SJ
from ..operators import monitoring as MO
from ..sources.schemas import CUSTOMERS_RAW
from .q_evaluation import run_log
from .q_monitoring import _WIN_SQL, FIXTURE_ALERT, FOR_SECONDS, GAUGES_SQL, P95_SQL, RATE_THRESHOLD, SUSTAINED_SQL, alert_sql, rates
from .q_quality import _JSON_SQL, _summary_sql, json_texts
from .registry import query

# Rows more than this behind the newest are late; the jobs deal the stored events in time order (log_in_time_order).
DELAY = "10 minutes"
AS_OF = "2024-01-31T00:00:00"
AS_OF_DATA = "2001-08-05 00:00:00"


def _events(sf_dir):
    """The events table where it lies; as a pattern, since a stream takes a
    plain path for a folder and the table may be one file."""
    return f"{sf_dir}/events.parque[t]"


@query("stream_request_rate_5m", oracle=f"SELECT window_start, requests, request_rate FROM ({_WIN_SQL})")
def stream_request_rate_5m(spark, sf_dir):
    return SJ.run_window_counts(spark, _events(sf_dir), DELAY).select("window_start", "requests",
                                                                                  "request_rate")


@query("stream_error_rate_5m", oracle=f"SELECT window_start, errors, error_rate, error_ratio, alert FROM ({_WIN_SQL})")
def stream_error_rate_5m(spark, sf_dir):
    return SJ.run_window_counts(spark, _events(sf_dir), DELAY).select("window_start", "errors", "error_rate",
                                                                            "error_ratio", "alert")


@query("stream_high_risk_volume", oracle="SELECT risk_level, COUNT(*) AS predictions FROM prediction_log GROUP BY 1")
def stream_high_risk_volume(spark, sf_dir):
    return SJ.run_group_counts(spark, _events(sf_dir), "risk_level", "risk_volume") \
        .withColumnRenamed("n", "predictions")


@query("stream_prediction_volume", oracle="SELECT model_version, COUNT(*) AS predictions_total FROM prediction_log GROUP BY 1")
def stream_prediction_volume(spark, sf_dir):
    return SJ.run_group_counts(spark, _events(sf_dir), "model_version", "volume") \
        .withColumnRenamed("n", "predictions_total")


@query("stream_p95_latency_5m", oracle=P95_SQL)
def stream_p95_latency_5m(spark, sf_dir):
    return SJ.run_p95_latency(spark, _events(sf_dir), DELAY)


@query("stream_sustained_alerts", oracle=f"""
SELECT * FROM ({SUSTAINED_SQL})
WHERE window_start + INTERVAL 5 MINUTE <= (SELECT MAX(event_time) FROM prediction_log) - INTERVAL 10 MINUTE""")
def stream_sustained_alerts(spark, sf_dir):
    """W6: "for 5m" alerts by two chained stateful operators; only windows the watermark has closed come out."""
    return SJ.run_sustained_alerts(spark, _events(sf_dir), DELAY, FIXTURE_ALERT)


@query("stream_alert_states", oracle=alert_sql("t <= t_end - 600000"))
def stream_alert_states(spark, sf_dir):
    """Alert states from the evaluated rates, in three runs over one
    checkpoint; changes up to the watermark come out."""
    r = rates(spark, sf_dir).select("series", "t", (F.round(F.col("rates")[1], 9) > RATE_THRESHOLD).alias("held"))
    ends = r.agg(F.min("t").alias("a"), F.max("t").alias("b")).first()
    cut = [ends["a"] + (ends["b"] - ends["a"]) * k // 3 for k in (1, 2)]
    parts = (r.filter(F.col("t") <= cut[0]), r.filter(F.col("t").between(cut[0] + 1, cut[1])), r.filter(F.col("t") > cut[1]))
    return SA.run_alert_states(spark, parts, DELAY, FOR_SECONDS)


@query("stream_late_rows", oracle=f"SELECT window_start, requests FROM ({_WIN_SQL})")
def stream_late_rows(spark, sf_dir):
    """After all events the first half day arrives once more; those rows
    lie far behind the watermark (of the batch before) and change no window."""
    ev = read_table(spark, sf_dir, "events")
    day = F.col("ts") < F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    again = ev.filter(F.col("ts") < F.lit("2024-01-01 12:00:00").cast("timestamp_ntz"))
    return SJ.run_window_counts(spark, SJ.log_in_parts(spark, (ev.filter(day), ev.filter(~day), again)), DELAY, "late_rows").select("window_start", "requests")


@query("stream_scoring", oracle="SELECT * FROM responses")
def stream_scoring(spark, sf_dir):
    return SJ.run_scoring(spark, FX.customers_raw_path(spark, sf_dir), AS_OF)


@query("stream_dedup", oracle="SELECT * FROM prediction_log")
def stream_dedup(spark, sf_dir):
    log = SJ.log_stream(spark, _events(sf_dir))
    again = SJ.log_stream(spark, _events(sf_dir)).filter(F.col("event_id") % 7 == 0)      # every 7th request arrives twice
    return SJ.run_dedup(spark, log.unionByName(again), DELAY)


@query("stream_latest_gauges", oracle=GAUGES_SQL)
def stream_latest_gauges(spark, sf_dir):
    return SJ.run_latest_gauges(spark, run_log(spark, sf_dir), MO.drift_timeline(FX.prediction_log(spark, sf_dir)))


@query("stream_validation", oracle=f"""
WITH part AS (SELECT * EXCLUDE (k) FROM customers_k WHERE k % 3 = 0)
SELECT v.* FROM ({_summary_sql("part", AS_OF_DATA)}) v""")
def stream_validation(spark, sf_dir):
    """All eight checks and the drift of every micro-batch against the
    reference side; with one batch, its counters are those of the whole side."""
    from .q_drift import feature_model, unscaled_features
    mine = F.substring("customer_id", 2, 20).cast("bigint") % 3
    rows = SJ.file_stream(spark, FX.customers_raw_path(spark, sf_dir), CUSTOMERS_RAW).filter(mine == 0)
    ref = unscaled_features(spark, sf_dir).filter(mine != 0)
    out = SJ.run_microbatch_validation(spark, rows, AS_OF_DATA, reference=ref, feature_model=feature_model(spark, sf_dir),
                                       features=FE.FEATURE_COLUMNS)
    return out.select("total_checks", "passed", "failed", "warnings", "input_rows", "success")


@query("stream_feature_drift", oracle="""
SELECT feature, ks_statistic, ROUND(p_value, 10) AS p_value, drift_detected, ROUND(ref_mean, 9) AS ref_mean,
       ROUND(prod_mean, 9) AS prod_mean, ROUND(change_pct, 6) AS change_pct FROM feature_drift""")
def stream_feature_drift(spark, sf_dir):
    """After three micro-batches the drift is that of all their rows."""
    from .q_drift import sides
    x = sides(spark, sf_dir)
    third = F.pmod(F.xxhash64("customer_id"), F.lit(3))
    prod = x.filter("side = 'prod'")
    d = SJ.run_feature_drift(spark, x.filter("side = 'ref'"), [prod.filter(third == k) for k in range(3)], FE.FEATURE_COLUMNS)
    return d.select("feature", "ks_statistic", F.round("p_value", 10).alias("p_value"), "drift_detected",
                    *[F.round(c, n).alias(c) for c, n in (("ref_mean", 9), ("prod_mean", 9), ("change_pct", 6))])


@query("stream_request_json", oracle=_JSON_SQL)
def stream_request_json(spark, sf_dir):
    """The JSON requests as a stream."""
    src = scratch_path(spark, "json_requests")
    json_texts(spark, sf_dir).write.parquet(src)
    return SJ.run_json_requests(spark, src, "k bigint, json string", ["k"]).select("k", "tenure_months", "monthly_charges", "total_charges", "valid", "reasons")
