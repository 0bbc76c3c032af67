"""M1–M12, S14 and the batch twins W1–W7 over the prediction log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counters as CO
from ..operators import monitoring as MO
from ..sources import fixtures as FX
from ..sources import sinks
from ..sources.schemas import PREDICTION_LOG
from ..session import materialize, scratch_path
from .ctes import define
from .registry import query

NOW = "2024-01-31 00:00:00"
F_RISKS = ("MEDIUM", "HIGH")
F_START, F_END = "2024-01-10 00:00:00", "2024-01-20 00:00:00"


def _log(spark, sf_dir):
    return FX.prediction_log(spark, sf_dir)


def _filtered(spark, sf_dir):
    return MO.filter_predictions(_log(spark, sf_dir), F_RISKS, "Churn", F_START, F_END)


def _hist_sql(col, bins):
    b = f"{float(bins)!r}".replace(".0", "e0")
    return f"""
WITH v AS (SELECT CAST({col} AS DOUBLE) AS x FROM prediction_log WHERE {col} IS NOT NULL AND NOT isnan({col})),
r AS (SELECT MIN(x) AS lo, MAX(x) AS hi FROM v),
c AS (SELECT CASE WHEN hi = lo THEN 0 ELSE LEAST(GREATEST(CAST(floor((x - lo) / ((hi - lo) / {b})) AS INTEGER), 0), {bins - 1}) END AS bin,
             COUNT(*) AS cnt FROM v, r GROUP BY 1)
SELECT s.bin, r.lo + s.bin * ((r.hi - r.lo) / {b}) AS bin_start, r.lo + (s.bin + 1) * ((r.hi - r.lo) / {b}) AS bin_end,
       coalesce(c.cnt, 0) AS count
FROM r CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range(0, {bins})) s LEFT JOIN c ON c.bin = s.bin"""


@query("probability_histogram", oracle=_hist_sql("churn_probability", MO.PROB_BINS))
def probability_histogram(spark, sf_dir):
    return MO.probability_histogram(_log(spark, sf_dir))


@query("latency_histogram", oracle=_hist_sql("latency_ms", MO.LATENCY_BINS))
def latency_histogram(spark, sf_dir):
    return MO.latency_histogram(_log(spark, sf_dir))


@query("risk_distribution", oracle="""
SELECT risk_level, COUNT(*) AS count,
       CAST(COUNT(*) AS DOUBLE) / CAST((SELECT COUNT(*) FROM prediction_log) AS DOUBLE) * 1e2 AS percentage
FROM prediction_log GROUP BY risk_level""")
def risk_distribution(spark, sf_dir):
    return MO.risk_distribution(_log(spark, sf_dir))


@query("daily_trend", oracle="""
WITH per AS (SELECT date_trunc('day', event_time) AS date, CAST(SUM(prediction) AS BIGINT) AS churned, COUNT(*) AS total
             FROM prediction_log GROUP BY 1),
cal AS (SELECT generate_series AS date FROM generate_series((SELECT MIN(date) FROM per), (SELECT MAX(date) FROM per), INTERVAL 1 DAY))
SELECT cal.date, coalesce(per.churned, 0) AS churned, coalesce(per.total, 0) AS total,
       coalesce(per.total, 0) - coalesce(per.churned, 0) AS retained
FROM cal LEFT JOIN per USING (date)""")
def daily_trend(spark, sf_dir):
    return MO.daily_trend(_log(spark, sf_dir))


@query("kpi_cards", oracle=f"""
SELECT COUNT(*) FILTER (WHERE event_time >= TIMESTAMP '{NOW}' - INTERVAL 1 DAY) AS predictions_24h,
       ROUND(AVG(latency_ms), 6) AS avg_latency_ms,
       COUNT(DISTINCT CASE WHEN risk_level = 'HIGH' THEN customer_id END) AS at_risk_customers
FROM prediction_log""")
def kpi_cards(spark, sf_dir):
    return MO.kpi_cards(_log(spark, sf_dir), NOW)


_FILTER_SQL = (f"SELECT * FROM prediction_log WHERE risk_level IN ('MEDIUM', 'HIGH') AND prediction = 1 "
               f"AND event_time >= TIMESTAMP '{F_START}' AND event_time < TIMESTAMP '{F_END}'")


@query("filtered_predictions", oracle=f"""
SELECT event_time, customer_id, churn_probability, prediction, risk_level, event_id FROM ({_FILTER_SQL})
ORDER BY churn_probability DESC, event_id""")
def filtered_predictions(spark, sf_dir):
    return MO.sort_predictions(_filtered(spark, sf_dir), "Probability")


@query("filtered_stats", oracle=f"""
SELECT COUNT(*) AS total_predictions,
       CAST(SUM(prediction) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0e0) * 1e2 AS churn_rate_pct,
       ROUND(AVG(churn_probability), 9) AS avg_probability FROM ({_FILTER_SQL})""")
def filtered_stats(spark, sf_dir):
    s = MO.filtered_stats(_filtered(spark, sf_dir))
    return s.withColumn("avg_probability", F.round("avg_probability", 9))


@query("display_predictions", oracle=f"""
SELECT event_time AS "Timestamp", customer_id AS "Customer", printf('%.2f%%', churn_probability * 100) AS "Probability",
       CASE WHEN prediction = 1 THEN 'Churn' WHEN prediction = 0 THEN 'No Churn' END AS "Prediction",
       risk_level AS "Risk" FROM ({_FILTER_SQL})""")
def display_predictions(spark, sf_dir):
    return MO.display_predictions(_filtered(spark, sf_dir))


@query("latency_percentiles", oracle="""
SELECT ROUND(AVG(latency_ms), 9) AS avg_ms, quantile_cont(latency_ms, 0.95) AS p95_ms,
       quantile_cont(latency_ms, 0.99) AS p99_ms FROM prediction_log""")
def latency_percentiles(spark, sf_dir):
    return MO.latency_percentiles(_log(spark, sf_dir)).withColumn("avg_ms", F.round("avg_ms", 9))


@query("weekly_latency_sketches", oracle="""
WITH d AS (SELECT DISTINCT date_trunc('day', event_time) AS last_day FROM prediction_log)
SELECT CAST(d.last_day AS TIMESTAMP) AS last_day, t.p, COUNT(*) AS n, TRUE AS within_bound
FROM d JOIN prediction_log l ON date_trunc('day', l.event_time) BETWEEN d.last_day - INTERVAL 6 DAY AND d.last_day,
     (VALUES (5e-1), (9.5e-1), (9.9e-1)) t(p)
GROUP BY d.last_day, t.p""")
def weekly_latency_sketches(spark, sf_dir):
    """A1, M8: quantiles of the seven days up to each day from stored daily
    sketches, and whether their ranks among all those days' rows are within the bound."""
    log = _log(spark, sf_dir)
    stored = materialize(MO.daily_sketches(log), "latency_sketches")
    ranges = stored.select((F.col("date") - F.expr("INTERVAL 6 DAYS")).alias("first_day"), F.col("date").alias("last_day"))
    q = MO.range_quantiles(stored, ranges, [0.5, 0.95, 0.99])
    day = F.date_trunc("day", F.col("event_time")).cast("timestamp_ntz")
    rows = log.select("latency_ms", F.explode(F.sequence(day, day + F.expr("INTERVAL 6 DAYS"), F.expr("INTERVAL 1 DAY"))).alias("last_day"))
    rank = rows.join(q, "last_day").groupBy("last_day", "p", "n").agg(
        F.count_if(F.col("latency_ms") < F.col("q")).alias("below"), F.count_if(F.col("latency_ms") <= F.col("q")).alias("upto"))
    within = (F.col("below") / F.col("n") <= F.col("p") + MO.RANK_ERROR) & (F.col("upto") / F.col("n") >= F.col("p") - MO.RANK_ERROR)
    return rank.select("last_day", "p", "n", within.alias("within_bound"))


@query("daily_kpi_delta", oracle="""
WITH d AS (SELECT date_trunc('day', event_time) AS date, COUNT(*) AS predictions, AVG(latency_ms) AS avg_latency_ms
           FROM prediction_log GROUP BY 1)
SELECT d.date, d.predictions, ROUND(d.avg_latency_ms, 9) AS avg_latency_ms, d.predictions - p.predictions AS predictions_delta,
       ROUND(d.avg_latency_ms - p.avg_latency_ms, 6) AS latency_delta_ms
FROM d LEFT JOIN d p ON p.date = d.date - INTERVAL 1 DAY""")
def daily_kpi_delta(spark, sf_dir):
    d = MO.daily_kpi_delta(_log(spark, sf_dir))
    return d.withColumns({"avg_latency_ms": F.round("avg_latency_ms", 9),
                          "latency_delta_ms": F.round("latency_delta_ms", 6)})


TIMELINE_SQL = """
WITH x AS (SELECT date_trunc('day', event_time) AS day, churn_probability AS v FROM prediction_log WHERE churn_probability IS NOT NULL),
d0 AS (SELECT MIN(day) AS d0 FROM x),
ref AS (SELECT v FROM x, d0 WHERE day < d0 + INTERVAL 7 DAY),
days AS (SELECT DISTINCT day FROM x, d0 WHERE day >= d0 + INTERVAL 7 DAY),
u AS (SELECT days.day AS grp, ref.v, 1 AS is_ref FROM days, ref
      UNION ALL SELECT x.day, x.v, 0 FROM x JOIN days USING (day)),
c AS (SELECT grp, v, SUM(is_ref) AS cr, SUM(1 - is_ref) AS cd FROM u GROUP BY grp, v),
w AS (SELECT grp, SUM(cr) OVER (PARTITION BY grp ORDER BY v ROWS UNBOUNDED PRECEDING) AS cumr,
             SUM(cd) OVER (PARTITION BY grp ORDER BY v ROWS UNBOUNDED PRECEDING) AS cumd,
             SUM(cr) OVER (PARTITION BY grp) AS nr, SUM(cd) OVER (PARTITION BY grp) AS nd FROM c)
SELECT grp AS day, MAX(abs(CAST(cumr AS DOUBLE) / CAST(nr AS DOUBLE) - CAST(cumd AS DOUBLE) / CAST(nd AS DOUBLE))) AS ks_statistic,
       MAX(abs(CAST(cumr AS DOUBLE) / CAST(nr AS DOUBLE) - CAST(cumd AS DOUBLE) / CAST(nd AS DOUBLE))) > 1e-1 AS above_threshold
FROM w GROUP BY grp"""


@query("drift_timeline", oracle=TIMELINE_SQL)
def drift_timeline(spark, sf_dir):
    return MO.drift_timeline(_log(spark, sf_dir))


def win_sql(threshold="5e-2"):
    return f"""SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start, COUNT(*) AS requests,
       CAST(SUM(is_error) AS BIGINT) AS errors, COUNT(*) / 3e2 AS request_rate, SUM(is_error) / 3e2 AS error_rate,
       CAST(SUM(is_error) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE) AS error_ratio, SUM(is_error) / 3e2 > {threshold} AS alert
FROM prediction_log GROUP BY 1"""


_WIN_SQL = win_sql()
# The fixture's traffic is about one request a window; the sustained-alert
# queries pass a threshold that one error in five minutes exceeds.
FIXTURE_ALERT = 0.003


@query("request_rate_5m", oracle=f"SELECT window_start, requests, request_rate FROM ({_WIN_SQL})")
def request_rate_5m(spark, sf_dir):
    return MO.window_counts(_log(spark, sf_dir)).select("window_start", "requests", "request_rate")


@query("error_rate_5m", oracle=f"SELECT window_start, errors, error_rate, error_ratio, alert FROM ({_WIN_SQL})")
def error_rate_5m(spark, sf_dir):
    return MO.window_counts(_log(spark, sf_dir)).select("window_start", "errors", "error_rate", "error_ratio", "alert")


SUSTAINED_SQL = f"""
WITH w AS ({win_sql("3e-3")})
SELECT a.window_start, 2 AS held_windows FROM w a JOIN w b ON b.window_start = a.window_start - INTERVAL 5 MINUTE
WHERE a.alert AND b.alert"""


@query("sustained_alerts", oracle=SUSTAINED_SQL)
def sustained_alerts(spark, sf_dir):
    return MO.sustained_alerts(MO.window_counts(_log(spark, sf_dir), threshold=FIXTURE_ALERT))


_BOUNDS = MO.LATENCY_BUCKETS_MS
_BKT = ", ".join([f"COUNT(*) FILTER (WHERE latency_ms <= {b}) AS b{i}" for i, b in enumerate(_BOUNDS)]
                 + [f"COUNT(*) AS b{len(_BOUNDS)}"])
_BLONG = " UNION ALL ".join([f"SELECT ws, {i} AS le_idx, CAST({b} AS DOUBLE) AS le, b{i} AS cum FROM b"
                             for i, b in enumerate(_BOUNDS)]
                            + [f"SELECT ws, {len(_BOUNDS)}, CAST(NULL AS DOUBLE), b{len(_BOUNDS)} FROM b"])


P95_SQL = f"""
WITH b AS (SELECT time_bucket(INTERVAL '5 minutes', event_time) AS ws, {_BKT} FROM prediction_log GROUP BY 1),
l AS ({_BLONG}),
w AS (SELECT *, coalesce(lag(le) OVER (PARTITION BY ws ORDER BY le_idx), 0e0) AS lower,
             coalesce(lag(cum) OVER (PARTITION BY ws ORDER BY le_idx), 0) AS cum_prev,
             MAX(cum) OVER (PARTITION BY ws) AS total FROM l),
h AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ws ORDER BY le_idx) AS rn FROM w
                     WHERE cum >= 9.5e-1 * total AND total > 0) WHERE rn = 1)
SELECT ws AS window_start,
       CASE WHEN le IS NULL THEN lower ELSE lower + (le - lower) * (9.5e-1 * total - cum_prev) / (cum - cum_prev) END
         AS p95_latency_ms FROM h"""


@query("p95_latency_5m", oracle=P95_SQL)
def p95_latency_5m(spark, sf_dir):
    return MO.p95_latency(_log(spark, sf_dir))


@query("prediction_volume", oracle="SELECT model_version, COUNT(*) AS predictions_total FROM prediction_log GROUP BY 1")
def prediction_volume(spark, sf_dir):
    return MO.prediction_volume(_log(spark, sf_dir))


@query("high_risk_volume", oracle="SELECT risk_level, COUNT(*) AS predictions FROM prediction_log GROUP BY 1")
def high_risk_volume(spark, sf_dir):
    return MO.high_risk_volume(_log(spark, sf_dir))


GAUGES_SQL = f"""
SELECT r.latest_f1, r.run_id, t.ks_statistic AS latest_drift, t.day AS drift_day
FROM (SELECT f1_score AS latest_f1, run_id FROM run_log ORDER BY run_id DESC LIMIT 1) r,
     (SELECT * FROM ({TIMELINE_SQL}) ORDER BY day DESC LIMIT 1) t"""


@query("latest_gauges", oracle=GAUGES_SQL)
def latest_gauges(spark, sf_dir):
    """The scorer runs of the run log all carry one start time, so the newest is the one with the largest id."""
    from .q_evaluation import run_log
    return MO.latest_gauges(run_log(spark, sf_dir), MO.drift_timeline(_log(spark, sf_dir)))


_NOW = "2024-01-20 12:00:00"


@query("recent_predictions", oracle=f"""
SELECT 'Last Hour' AS span, COUNT(*) AS n FROM prediction_log WHERE event_time BETWEEN TIMESTAMP '{_NOW}' - INTERVAL 1 HOUR AND TIMESTAMP '{_NOW}'
UNION ALL SELECT 'Last 24 Hours', COUNT(*) FROM prediction_log WHERE event_time BETWEEN TIMESTAMP '{_NOW}' - INTERVAL 24 HOUR AND TIMESTAMP '{_NOW}'
UNION ALL SELECT 'Last 7 Days', COUNT(*) FROM prediction_log WHERE event_time BETWEEN TIMESTAMP '{_NOW}' - INTERVAL 7 DAY AND TIMESTAMP '{_NOW}'""")
def recent_predictions(spark, sf_dir):
    """M5: row counts of the relative time ranges against an explicit now."""
    log = _log(spark, sf_dir)
    parts = [MO.since(log, _NOW, span).agg(F.lit(span).alias("span"), F.count(F.lit(1)).alias("n")) for span in MO.RANGES]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("export_csv_roundtrip", oracle=f"SELECT * FROM ({_FILTER_SQL})")
def export_csv_roundtrip(spark, sf_dir):
    """Filtered predictions → CSV with header and microsecond
    timestamps in the shared folder → read back with the same schema."""
    path = sinks.write_csv(_filtered(spark, sf_dir), scratch_path(spark, "predictions_csv"))
    return sinks.read_csv(spark, path, PREDICTION_LOG)


# ---------------------------------------------------------------- sliding rates and alert states

RATE_THRESHOLD = FIXTURE_ALERT
FOR_SECONDS = 120
_SERIES = 2


def samples(spark, sf_dir):
    """Scraped counters of the prediction log, written once."""
    return FX.session_artifact(spark, "counter_samples", sf_dir, lambda: materialize(CO.counter_samples(_log(spark, sf_dir), _BOUNDS, _SERIES), "counter_samples"))


def rates(spark, sf_dir):
    """Requests, errors and latency buckets a second at every step."""
    return FX.session_artifact(spark, "counter_rates", sf_dir,
                               lambda: materialize(CO.counter_rates(samples(spark, sf_dir), 3 + len(_BOUNDS)), "counter_rates"))


_N = 3 + len(_BOUNDS)
_SAMPLE = ["COUNT(e.ms)", "COUNT(e.ms) FILTER (WHERE e.is_error = 1)"] + [f"COUNT(e.ms) FILTER (WHERE e.latency_ms <= {b})" for b in _BOUNDS] + ["COUNT(e.latency_ms)"]
define("scraped", ["prediction_log"], f"""
  SELECT series, t, {', '.join(f'CAST(SUM(c{i}) OVER (PARTITION BY series, slot ORDER BY t) AS DOUBLE) AS v{i}' for i in range(_N))}
  FROM (SELECT g.series, g.slot, g.t, {', '.join(f'{c} AS c{i}' for i, c in enumerate(_SAMPLE))}
        FROM (SELECT i.series, i.slot, CAST(ceil((i.slot * 21600000 - i.series * 4000) / 15000e0) AS BIGINT) * 15000 + i.series * 4000 + r.n * 15000 AS t
              FROM (SELECT DISTINCT series, ms // 21600000 AS slot FROM requests) i, range(0, 1440) r(n)) g
        LEFT JOIN requests e ON e.series = g.series AND e.slot = g.slot
             AND CAST(ceil((e.ms - e.series * 4000) / 15000e0) AS BIGINT) * 15000 + e.series * 4000 = g.t
        GROUP BY g.series, g.slot, g.t)""")
define("requests", ["prediction_log"], f"""
  SELECT CAST(CAST(regexp_replace(customer_id, '[^0-9]', '', 'g') AS BIGINT) % {_SERIES} AS INTEGER) AS series, epoch_ms(event_time) AS ms,
         epoch_ms(event_time) // 21600000 AS slot, is_error, latency_ms FROM prediction_log""")
define("read_samples", ["scraped"], f"""
  SELECT *, {', '.join(f'CASE WHEN v{i} < lag(v{i}) OVER w THEN lag(v{i}) OVER w ELSE 0e0 END AS d{i}' for i in range(_N))}
  FROM scraped WHERE (t // 1000 * 1103515245 + series * 12345) % 2147483647 % 10 <> 0 AND (t // 3600000 * 48271 + series * 7) % 2147483647 % 17 <> 0
  WINDOW w AS (PARTITION BY series ORDER BY t)""")
# every sample to the 20 steps whose range holds it; falls of the value inside a range, its first sample's own left out
_RISE = ", ".join(f"arg_max(v{i}, t) - arg_min(v{i}, t) + SUM(d{i}) - arg_min(d{i}, t) AS rise{i}, arg_min(v{i}, t) AS first{i}" for i in range(_N))
_RATE = ", ".join(f"""rise{i} * ((sampled + CASE WHEN rise{i} > 0 AND sampled * first{i} / rise{i} < b THEN sampled * first{i} / rise{i} ELSE b END + e)
         / sampled) / 3e2 AS r{i}""" for i in range(_N))
define("sliding", ["read_samples"], f"""
  SELECT series, step, {_RATE} FROM (
    SELECT *, CASE WHEN to_start >= sampled / (n - 1) * 1.1e0 THEN sampled / (n - 1) / 2e0 ELSE to_start END AS b,
           CASE WHEN to_end >= sampled / (n - 1) * 1.1e0 THEN sampled / (n - 1) / 2e0 ELSE to_end END AS e
    FROM (SELECT series, step, COUNT(*) AS n, (MAX(t) - MIN(t)) / 1e3 AS sampled, (MIN(t) - (step - 300000)) / 1e3 AS to_start,
                 (step - MAX(t)) / 1e3 AS to_end, {_RISE}
          FROM (SELECT s.*, CAST(ceil(s.t / 15000e0) AS BIGINT) * 15000 + r.k * 15000 AS step FROM read_samples s, range(0, 20) r(k))
          WHERE step - t < 300000 GROUP BY series, step HAVING COUNT(*) >= 2))""")


@query("rate_5m_sliding", oracle="SELECT series, step AS t, ROUND(r0, 9) AS request_rate, ROUND(r1, 9) AS error_rate FROM sliding")
def rate_5m_sliding(spark, sf_dir):
    """rate() of requests and errors over five minutes, evaluated every 15 seconds, per instance."""
    return rates(spark, sf_dir).select("series", "t", F.round(F.col("rates")[0], 9).alias("request_rate"), F.round(F.col("rates")[1], 9).alias("error_rate"))


_LEVEL = [f"greatest({', '.join(f'r{j}' for j in range(2, 3 + i))}, 0e0)" for i in range(len(_BOUNDS) + 1)]
_CASES = " ".join(f"WHEN {_LEVEL[i]} >= {_LEVEL[-1]} * 9.5e-1 THEN {_BOUNDS[i - 1] if i else 0} + ({b} - {_BOUNDS[i - 1] if i else 0}) * "
                  f"({_LEVEL[-1]} * 9.5e-1 - {_LEVEL[i - 1] if i else '0e0'}) / NULLIF({_LEVEL[i]} - {_LEVEL[i - 1] if i else '0e0'}, 0e0)"
                  for i, b in enumerate(_BOUNDS))


@query("p95_rate_5m", oracle=f"""
SELECT series, step AS t, ROUND(CASE WHEN {_LEVEL[-1]} > 0 THEN CASE {_CASES} ELSE {float(_BOUNDS[-1])!r} END END + 1e-9, 6) AS p95_latency_ms FROM sliding""")
def p95_rate_5m(spark, sf_dir):
    """histogram_quantile(0.95, rate(buckets[5m])), every 15 seconds, per instance."""
    r = [F.col("rates")[i] for i in range(2, _N)]
    return rates(spark, sf_dir).select("series", "t", F.round(CO.quantile_of_rates(0.95, r, _BOUNDS) + 1e-9, 6).alias("p95_latency_ms"))


def alert_sql(closed: str = "TRUE") -> str:
    """Runs of steps by the difference of time and row number."""
    return f"""
WITH e AS (SELECT MAX(step) AS t_end FROM sliding),
h AS (SELECT series, step, step - 15000 * row_number() OVER (PARTITION BY series ORDER BY step) AS run
      FROM sliding WHERE ROUND(r1, 9) > {RATE_THRESHOLD!r}),
i AS (SELECT series, MIN(step) AS a, MAX(step) AS b FROM h GROUP BY series, run)
SELECT series, t, state, active_at FROM (
  SELECT series, a AS t, 'pending' AS state, a AS active_at FROM i
  UNION ALL SELECT series, a + {FOR_SECONDS * 1000}, 'firing', a FROM i WHERE b - a >= {FOR_SECONDS * 1000}
  UNION ALL SELECT series, b + 15000, CASE WHEN b - a >= {FOR_SECONDS * 1000} THEN 'resolved' ELSE 'inactive' END, a FROM i, e WHERE b + 15000 <= t_end), e
WHERE {closed}"""


def held(df):
    return df.filter(F.round(F.col("rates")[1], 9) > RATE_THRESHOLD)


@query("alert_state_changes", oracle=alert_sql())
def alert_state_changes(spark, sf_dir):
    """Pending, firing, resolved and inactive, "for" any duration."""
    r = rates(spark, sf_dir)
    end = r.agg(F.max("t").alias("t")).first()["t"]
    return CO.alert_states(held(r), FOR_SECONDS, end)
