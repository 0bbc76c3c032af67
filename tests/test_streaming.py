import datetime as dt
import os
import shutil
import time

from pyspark.sql import functions as F

from churnlake.operators import monitoring as MO
from churnlake.session import scratch_path
from churnlake.sources import fixtures as FX
from churnlake.streaming import jobs as SJ
from conftest import SMOKE


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id bigint, t string, user_id bigint, event_type string, value double, "
                                       "props string").select(
        "event_id", F.col("t").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value", "props")


def test_late_rows_are_dropped_behind_watermark(spark):
    # Late rows are filtered against the watermark of the previous batch
    # (Spark ≥ 3.4), so the late row comes in the third micro-batch.
    src = scratch_path(spark, "late_src")
    files = [[(1, "2024-01-01 10:00:00", 1, "view", 5.0, "{}")],
             [(2, "2024-01-01 10:31:00", 1, "error", 5.0, "{}")],
             [(3, "2024-01-01 09:00:00", 2, "view", 5.0, "{}"),      # 60 min behind the watermark → dropped
              (4, "2024-01-01 10:32:00", 2, "view", 5.0, "{}")]]
    for rows in files:
        _events(spark, rows).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)   # the file source orders files by modification time
    out = {r["window_start"].strftime("%H:%M"): r["requests"]
           for r in SJ.run_window_counts(spark, src, "10 minutes", "late", {"maxFilesPerTrigger": 1}).collect()}
    assert "09:00" not in out
    assert out["10:30"] == 2 and out["10:00"] == 1


def test_stream_equals_batch_and_closes_windows(spark):
    """A time-ordered source in three files: a delay of minutes loses nothing,
    and the append-mode alerts come out only for windows that are closed."""
    from churnlake.sources.tables import read_table
    src = scratch_path(spark, "ev_parts")
    ev = read_table(spark, SMOKE, "events")
    for lo, hi in ((-1, 330), (330, 660), (660, 10 ** 9)):
        ev.filter((F.col("event_id") > lo) & (F.col("event_id") <= hi)).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    one = {"maxFilesPerTrigger": 1}
    s = SJ.run_window_counts(spark, src, "10 minutes", "eq", one)
    b = MO.window_counts(FX.prediction_log(spark, SMOKE))
    assert sorted(s.collect()) == sorted(b.collect())
    held = MO.sustained_alerts(MO.window_counts(FX.prediction_log(spark, SMOKE), threshold=0.003))
    end = FX.prediction_log(spark, SMOKE).agg(F.max("event_time")).first()[0]
    closed = [r["window_start"] for r in held.collect() if r["window_start"] + dt.timedelta(minutes=5) <= end - dt.timedelta(minutes=10)]
    got = SJ.run_sustained_alerts(spark, src, "10 minutes", 0.003, one)
    assert sorted(r["window_start"] for r in got.collect()) == sorted(closed)


def test_dedup_within_watermark(spark):
    src = scratch_path(spark, "dup_src")
    rows = [(1, "2024-01-01 10:00:00", 1, "view", 5.0, "{}"), (1, "2024-01-01 10:00:00", 1, "view", 5.0, "{}"),
            (2, "2024-01-01 10:01:00", 1, "view", 6.0, "{}")]
    _events(spark, rows).write.mode("overwrite").parquet(src)
    out = SJ.run_dedup(spark, SJ.log_stream(spark, src), "1 hour")
    assert sorted(r["event_id"] for r in out.collect()) == [1, 2]


def test_overlapping_files_over_several_batches(spark, monkeypatch):
    """Files that all overlap in time, more than one micro-batch takes: no row counts as late."""
    from churnlake.sources.tables import read_table
    src = scratch_path(spark, "overlap")
    ev = read_table(spark, SMOKE, "events")
    for k in (2, 0, 1):
        ev.filter(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    monkeypatch.setattr(SJ, "PER_TRIGGER", {"maxBytesPerTrigger": 12000})
    monkeypatch.setattr(SJ, "PART_FILES", 2, raising=False)
    log = FX.prediction_log(spark, SMOKE)
    assert sorted(SJ.run_window_counts(spark, src, "10 minutes").collect()) == sorted(MO.window_counts(log).collect())
    assert sorted(SJ.run_p95_latency(spark, src, "10 minutes").collect()) == sorted(MO.p95_latency(log).collect())
    end = log.agg(F.max("event_time")).first()[0] - dt.timedelta(minutes=10)
    held = MO.sustained_alerts(MO.window_counts(log, threshold=0.003)).collect()
    got = SJ.run_sustained_alerts(spark, src, "10 minutes", 0.003)
    assert sorted(r["window_start"] for r in got.collect()) == sorted(
        r["window_start"] for r in held if r["window_start"] + dt.timedelta(minutes=5) <= end)


def test_alert_states_over_several_runs_equal_batch(spark):
    """Any duration, missing steps, rows out of order within the delay, restarts from the checkpoint."""
    import random

    from churnlake.operators import counters as CO
    from churnlake.streaming import alerts as SA
    rng = random.Random(5)
    base, rows = 1_704_067_200_000, []
    for s in range(3):
        t = base
        while t < base + 4 * 3_600_000:
            held = rng.random() < 0.6
            for _ in range(rng.randrange(1, 25)):
                if rng.random() < 0.97:
                    rows.append((s, t, held))
                t += 15_000
    rows.sort(key=lambda r: (r[1] // 600_000, rng.random()))      # shuffled inside ten minutes
    parts = [rows[:len(rows) // 4], rows[len(rows) // 4:len(rows) // 2], rows[len(rows) // 2:]]
    frame = lambda r: spark.createDataFrame(r, "series int, t bigint, held boolean")
    for hold in (0, 100):
        got = sorted(tuple(r) for r in SA.run_alert_states(spark, map(frame, parts), "15 minutes", hold).collect())
        end = max(t for _, t, _ in rows)
        want = CO.alert_states(frame(rows).filter("held"), hold, end).filter(F.col("t") <= end - 900_000)
        assert got == sorted(tuple(r) for r in want.collect()) and got


def test_steps_are_played_in_order():
    from churnlake.streaming.alerts import played
    a = played(-1, 0, False, [30, 10, 20, 60], 45, 10, 20)
    assert a[4] == [(10, "pending", 10), (30, "firing", 10), (40, "resolved", 10)] and a[:4] == (-1, 30, False, [60])
    b = played(10, 20, False, [30, 40], 35, 10, 20)
    assert b[4] == [(30, "firing", 10)] and b[:4] == (10, 30, True, [40])
    assert played(10, 20, False, [], 29, 10, 20)[4] == [] and played(10, 20, False, [], 30, 10, 20)[4] == [(30, "inactive", 10)]


def test_running_drift_equals_batch_and_a_replayed_batch_changes_nothing(spark):
    from churnlake.operators import drift as DR
    feats = ["a", "b"]
    x = spark.range(900).select(F.when(F.col("id") % 3 == 0, "prod").otherwise("ref").alias("side"), (F.col("id") % 17).cast("double").alias("a"),
                                F.when(F.col("id") % 5 != 0, (F.col("id") * 7 % 31 + (F.col("id") % 3 == 0).cast("int") * 4).cast("double")).alias("b"))
    prod, ref = x.filter("side = 'prod'"), x.filter("side = 'ref'")
    rounded = lambda d: sorted((r["feature"], r["ks_statistic"], round(r["p_value"], 10), r["drift_detected"], round(r["ref_mean"], 9), round(r["prod_mean"], 9))
                               for r in d.collect())
    want = rounded(DR.feature_drift(x, feats))
    assert rounded(SJ.run_feature_drift(spark, ref, [prod.filter(F.col("a") % 2 == k) for k in range(2)], feats)) == want
    counts = scratch_path(spark, "replayed_counts")
    ref_counts = DR.value_counts(ref, feats)
    for epoch, part in ((0, prod.filter("a < 5")), (1, prod.filter("a >= 5")), (1, prod.filter("a >= 5")), (0, prod.filter("a < 5"))):
        SJ.write_value_counts(part.drop("side"), epoch, counts, feats)
    assert rounded(SJ.running_drift(ref_counts, counts, feats)) == want


def _elsewhere(spark, checkpoint):
    """A copy of the checkpoint: no executor holds state for its path, as if all had lost their disks."""
    copy = scratch_path(spark, "ckpt_copy")
    if os.path.exists(checkpoint.removeprefix("file:")):
        shutil.copytree(checkpoint.removeprefix("file:"), copy.removeprefix("file:"))
    return copy


def test_resumes_after_failures_and_lost_state(spark):
    """Three parts of events in three runs over one checkpoint, a batch that
    fails after its rows were committed, local state lost before every run:
    the table holds what an uninterrupted run writes, and so do the windows."""
    from churnlake.sources import versioned as V
    from churnlake.sources.tables import read_table
    ev = read_table(spark, SMOKE, "events")
    edges = ev.selectExpr("percentile(event_id, array(0.33, 0.66)) AS q").first()["q"]
    parts = [ev.filter(F.col("event_id") <= edges[0]), ev.filter((F.col("event_id") > edges[0]) & (F.col("event_id") <= edges[1])).unionByName(ev.limit(50)),
             ev.filter(F.col("event_id") > edges[1])]
    table, ckpt, failed = scratch_path(spark, "deduped"), scratch_path(spark, "ckpt"), []
    commit = SJ.versioned_sink(table, "dedup")

    def flaky(batch, epoch):
        commit(batch, epoch)
        if epoch == 1 and not failed:
            failed.append(epoch)
            raise RuntimeError("lost after the commit")

    def deduped(log):
        return log.withWatermark("event_time", "4000 days").dropDuplicatesWithinWatermark(["event_id"])

    for log in SJ.log_in_parts(spark, parts):
        ckpt = _elsewhere(spark, ckpt)
        try:
            SJ.run_available_now(deduped(log), "", ckpt, mode="append", foreach=flaky)
        except Exception:
            assert failed == [1]
            ckpt = _elsewhere(spark, ckpt)
            SJ.run_available_now(deduped(log), "", ckpt, mode="append", foreach=flaky)
    assert failed == [1]
    got = [r["event_id"] for r in V.read(spark, table).select("event_id").collect()]
    assert len(got) == len(set(got)) and set(got) == {r["event_id"] for r in ev.select("event_id").collect()}

    sink, ckpt = scratch_path(spark, "windows"), scratch_path(spark, "ckpt")
    for log in SJ.log_in_parts(spark, [parts[0], ev.filter((F.col("event_id") > edges[0]) & (F.col("event_id") <= edges[1])), parts[2]]):
        ckpt = _elsewhere(spark, ckpt)
        SJ.run_available_now(SJ.windowed_counts_stream(log, "4000 days").selectExpr("w.start AS window_start", "requests", "errors"), sink, ckpt)
    state = SJ.latest_per_key(spark, sink, ["window_start"], ["requests", "errors"])
    total = state.agg(F.sum("requests").alias("a"), F.sum("errors").alias("b")).first()
    want = FX.prediction_log(spark, SMOKE).agg(F.count(F.lit(1)).alias("a"), F.sum("is_error").alias("b")).first()
    assert tuple(total) == tuple(want)
