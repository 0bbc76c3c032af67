"""Structured Streaming jobs.

Sources are file streams with explicit schemas; every stateful job has an
event-time watermark so its state is bounded; sinks are ``foreachBatch``
writers that tag rows with the micro-batch id, so a retried batch is
idempotent after the final ``max_by(epoch)`` read.  Checkpoints live under
the cluster's shared checkpoint folder, so a restarted query resumes where
it stopped.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import monitoring as MO
from ..operators import quality as Q
from ..operators import scoring as SC
from ..operators.stats import with_one_row
from ..session import materialize, scratch_path
from ..sources import versioned as V
from ..sources.fixtures import prediction_columns
from ..sources.schemas import BASE_SCHEMAS, CUSTOMERS_RAW

EVENT_SCHEMA = BASE_SCHEMAS["events"]


# Input taken by one micro-batch; the sources are read where they lie.
PER_TRIGGER = {"maxBytesPerTrigger": 8 << 30}
# Files (tasks) of one time-ordered part.
PART_FILES = 32


def file_stream(spark: SparkSession, path: str, schema, per_trigger: dict | None = None) -> DataFrame:
    return spark.readStream.schema(schema).options(**(PER_TRIGGER if per_trigger is None else per_trigger)).parquet(path)


def log_stream(spark: SparkSession, path: str, per_trigger: dict | None = None) -> DataFrame:
    """The prediction log as a stream over the events table, with
    ``event_time`` as a timestamp for watermarking."""
    log = prediction_columns(file_stream(spark, path, EVENT_SCHEMA, per_trigger))
    return log.withColumn("event_time", F.col("event_time").cast("timestamp"))


def log_in_parts(spark: SparkSession, parts: Iterable[DataFrame]) -> Iterator[DataFrame]:
    """For runs one after another over one checkpoint: the log after each part
    of events has arrived.  A run takes its part as one micro-batch."""
    src = scratch_path(spark, "event_parts")
    for part in parts:
        part.write.mode("append").parquet(src)
        yield log_stream(spark, src, {})


def log_in_time_order(spark: SparkSession, source: str, per_trigger: dict | None = None) -> Iterator[DataFrame]:
    """The log in one run, or in several over one checkpoint.  The file source
    takes files by modification time, so where the events need more than one
    micro-batch they are dealt by time into parts first: no row of a later
    part is older than any of an earlier one, and none is late, however the
    files overlap.  With ``per_trigger`` the files are taken as they lie."""
    if per_trigger is not None:
        yield log_stream(spark, source, per_trigger)
        return
    events = spark.read.schema(EVENT_SCHEMA).parquet(source)
    files = events.groupBy("_metadata.file_path").agg(F.max("_metadata.file_size").alias("size"))
    n = -(-(files.agg(F.sum("size")).first()[0] or 0) // PER_TRIGGER["maxBytesPerTrigger"])
    if n <= 1:
        yield log_stream(spark, source, {})
        return
    dealt = scratch_path(spark, "events_by_time")
    part = F.floor(F.spark_partition_id() / PART_FILES).cast("int")      # range partitions are numbered in time order
    events.repartitionByRange(n * PART_FILES, "ts").withColumn("_part", part).write.partitionBy("_part").parquet(dealt)
    by_time = spark.read.parquet(dealt)
    yield from log_in_parts(spark, (by_time.filter(F.col("_part") == k).drop("_part") for k in range(n)))


def write_epoch(batch: DataFrame, path: str, epoch: int) -> None:
    """Idempotent micro-batch write: each epoch overwrites its own folder
    (``_epoch=<n>``), so a retried batch replaces its earlier attempt."""
    batch.write.mode("overwrite").parquet(f"{path}/_epoch={epoch}")


def _epoch_sink(path: str):
    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch, path, epoch)
    return write


def versioned_sink(table: str, stream: str):
    """Micro-batches as commits of a versioned table: readers see whole batches, a replayed one is added once."""
    def write(batch: DataFrame, epoch: int) -> None:
        V.append(batch, table, stream=stream, epoch=epoch)
    return write


#: Fixed settings: state on local disk instead of the executors' heap; a batch's changes go to the checkpoint.
ROCKSDB = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
           "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


@contextmanager
def state_in_rocksdb(spark: SparkSession):
    """Queries started inside keep their state in RocksDB; the session's own settings come back after."""
    before = {k: spark.conf.get(k, None) for k in ROCKSDB}
    for k, v in ROCKSDB.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_available_now(stream: DataFrame, sink_path: str, checkpoint: str, mode: str = "update",
                      foreach=None) -> None:
    """Process everything available, then stop (``Trigger.AvailableNow``).
    State lies in RocksDB; a run that failed or lost its executors' disks goes
    on from the checkpoint."""
    w = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    w = w.foreachBatch(foreach or _epoch_sink(sink_path))
    with state_in_rocksdb(stream.sparkSession):
        q = w.start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def latest_per_key(spark: SparkSession, sink_path: str, keys, schema_cols) -> DataFrame:
    """Final state of an update-mode aggregate: the last emitted row per key."""
    df = spark.read.parquet(sink_path)
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*schema_cols), F.col("_epoch")).alias("r"))
    return last.select(*keys, *[F.col(f"r.{c}").alias(c) for c in schema_cols])


# ---------------------------------------------------------------- W1 / W5

def windowed_counts_stream(log: DataFrame, delay: str, window: str = MO.WINDOW) -> DataFrame:
    """Requests and errors per tumbling window with a watermark (state for
    windows older than the watermark is dropped; rows behind it are late
    and ignored — W11)."""
    return (log.withWatermark("event_time", delay)
            .groupBy(F.window("event_time", window).alias("w"))
            .agg(F.count(F.lit(1)).alias("requests"), F.sum("is_error").cast("bigint").alias("errors")))


def run_window_counts(spark: SparkSession, source: str | Iterable[DataFrame], delay: str, name: str = "window_counts",
                      per_trigger: dict | None = None) -> DataFrame:
    """``source``: a folder of events, or the log stream of each run (``log_in_parts``)."""
    sink, ckpt = scratch_path(spark, f"{name}_sink"), scratch_path(spark, f"{name}_ckpt")
    for log in log_in_time_order(spark, source, per_trigger) if isinstance(source, str) else source:
        s = windowed_counts_stream(log, delay)
        s = s.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "requests", "errors")
        run_available_now(s, sink, ckpt, "update")
    return MO.window_rates(latest_per_key(spark, sink, ["window_start"], ["requests", "errors"]))


# ---------------------------------------------------------------- W6

def run_sustained_alerts(spark: SparkSession, source: str, delay: str, threshold: float,
                         per_trigger: dict | None = None) -> DataFrame:
    """W6 in the stream: the alert condition of each closed window, then a
    sliding window over two neighbours; both held → the later window's start.
    Append mode: a row comes out once the watermark has passed its window."""
    sink, ckpt = scratch_path(spark, "alerts_sink"), scratch_path(spark, "alerts_ckpt")
    for log in log_in_time_order(spark, source, per_trigger):
        counts = windowed_counts_stream(log, delay)
        alerts = counts.filter(F.col("errors") / F.lit(float(MO.WINDOW_SECONDS)) > threshold)
        pairs = (alerts.groupBy(F.window(F.window_time("w"), f"{2 * MO.WINDOW_SECONDS} seconds", f"{MO.WINDOW_SECONDS} seconds").alias("p"))
                 .agg(F.count(F.lit(1)).alias("held_windows")).filter("held_windows = 2"))
        start = F.col("p.end") - F.expr(f"INTERVAL {MO.WINDOW_SECONDS} SECONDS")
        rows = pairs.select(start.cast("timestamp_ntz").alias("window_start"), F.col("held_windows").cast("int").alias("held_windows"))
        run_available_now(rows, sink, ckpt, "append")
    return spark.read.schema("window_start timestamp_ntz, held_windows int, _epoch int").parquet(sink).drop("_epoch")


# ---------------------------------------------------------------- W3 / W4

def run_group_counts(spark: SparkSession, source: str, key: str, name: str) -> DataFrame:
    """Running totals per key (update mode; one state row per key)."""
    sink, ckpt = scratch_path(spark, f"{name}_sink"), scratch_path(spark, f"{name}_ckpt")
    s = log_stream(spark, source).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    run_available_now(s, sink, ckpt, "update")
    return latest_per_key(spark, sink, [key], ["n"])


# ---------------------------------------------------------------- W2

def run_p95_latency(spark: SparkSession, source: str, delay: str) -> DataFrame:
    """Cumulative latency buckets per window in the stream; the quantile is
    read from the final bucket counts."""
    sink, ckpt = scratch_path(spark, "p95_sink"), scratch_path(spark, "p95_ckpt")
    les = [float(b) for b in MO.LATENCY_BUCKETS_MS] + [None]
    for log in log_in_time_order(spark, source):
        s = log.withWatermark("event_time", delay).groupBy(F.window("event_time", MO.WINDOW).alias("w")).agg(
            *[F.count_if(F.col("latency_ms") <= le if le is not None else F.lit(True)).alias(f"b{i}")
              for i, le in enumerate(les)])
        s = s.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), *[f"b{i}" for i in range(len(les))])
        run_available_now(s, sink, ckpt, "update")
    final = latest_per_key(spark, sink, ["window_start"], [f"b{i}" for i in range(len(les))])
    arr = F.array(*[F.struct(F.lit(i).alias("le_idx"), F.lit(le).cast("double").alias("le"), F.col(f"b{i}").alias("cum"))
                    for i, le in enumerate(les)])
    buckets = final.select("window_start", F.inline(arr))
    return MO.histogram_quantile(0.95, buckets, ["window_start"]).withColumnRenamed("quantile", "p95_latency_ms")


# ---------------------------------------------------------------- W8 / W10

def run_scoring(spark: SparkSession, source: str, as_of: str) -> DataFrame:
    """Request stream → constraint check → rule scoring → response rows
    appended to the prediction sink (stateless, append mode); rejected
    requests go to a quarantine sink with their reasons."""
    sink, bad, ckpt = (scratch_path(spark, "scored_sink"), scratch_path(spark, "rejected_sink"),
                       scratch_path(spark, "scoring_ckpt"))
    reqs = file_stream(spark, source, CUSTOMERS_RAW).select(*Q.REQUEST_FIELDS)
    checked = Q.request_validation(reqs)

    def write(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()
        write_epoch(SC.score_customers(batch.filter("valid").drop("valid", "reasons"), as_of), sink, epoch)
        write_epoch(batch.filter(~F.col("valid")), bad, epoch)
        batch.unpersist()

    run_available_now(checked, sink, ckpt, "append", foreach=write)
    return spark.read.parquet(sink).drop("_epoch")


def run_dedup(spark: SparkSession, log: DataFrame, delay: str) -> DataFrame:
    """Duplicate requests removed within the watermark (ids older than
    the delay leave the state)."""
    sink, ckpt = scratch_path(spark, "dedup_sink"), scratch_path(spark, "dedup_ckpt")
    s = log.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])
    run_available_now(s, sink, ckpt, "append")
    return spark.read.parquet(sink).drop("_epoch").withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


# ---------------------------------------------------------------- W7

def run_latest_gauges(spark: SparkSession, runs: DataFrame, timeline: DataFrame) -> DataFrame:
    """The newest F1 and drift score as global streaming aggregates (one
    state row each) over the stored run and drift tables, as they grow."""
    out = []
    for name, table, gauge in (("f1", runs, MO.latest_f1), ("drift", timeline, MO.latest_drift)):
        src, sink, ckpt = (scratch_path(spark, f"{name}_{x}") for x in ("source", "sink", "ckpt"))
        table.write.parquet(src)
        g = gauge(file_stream(spark, src, table.schema))
        run_available_now(g, sink, ckpt, "update")
        out.append(latest_row(spark, sink, g.columns))
    return with_one_row(out[0], out[1])


def latest_row(spark: SparkSession, sink: str, cols) -> DataFrame:
    """The last state of a global aggregate."""
    r = spark.read.parquet(sink).agg(F.max_by(F.struct(*cols), F.col("_epoch")).alias("r"))
    return r.select(*[F.col(f"r.{c}").alias(c) for c in cols])


# ---------------------------------------------------------------- W9

def run_microbatch_validation(spark: SparkSession, rows: DataFrame, as_of: str, reference: DataFrame | None = None,
                              feature_model=None, features=None) -> DataFrame:
    """Every micro-batch of customer rows (a streaming frame) gets all
    eight checks and their roll-up (V9) and, given a reference feature table,
    the drift summary of the batch against it (D6); one result row per batch.
    The reference side's distinct values are counted once, before the stream
    starts."""
    from ..operators import drift as DR
    sink, ckpt = scratch_path(spark, "mb_checks_sink"), scratch_path(spark, "mb_checks_ckpt")
    ref = materialize(DR.value_counts(reference.withColumn("side", F.lit("ref")), features)) if reference is not None else None
    means = DR.side_means(reference.withColumn("side", F.lit("ref")), features) if reference is not None else None

    def write(batch: DataFrame, epoch: int) -> None:
        batch = materialize(batch)      # read by several checks
        if batch.isEmpty():
            return
        out = Q.validation_summary(Q.run_all_checks(batch, as_of), batch)
        if ref is not None:
            prod = feature_model.transform(batch, scale=False).select(*features).withColumn("side", F.lit("prod"))
            d = DR.drift_summary(DR.drift_from_counts(ref.unionByName(DR.value_counts(prod, features)),
                                                      means.unionByName(DR.side_means(prod, features))))
            out = with_one_row(out, d.select("features_with_drift", "drift_percentage", "overall_drift_status"))
        write_epoch(out, sink, epoch)

    run_available_now(rows, sink, ckpt, "append", foreach=write)
    return spark.read.parquet(sink)


def write_value_counts(batch: DataFrame, epoch: int, path: str, features) -> None:
    """The production side's rows per (feature, value) of one micro-batch; a
    replayed batch replaces its own counts."""
    from ..operators import drift as DR
    write_epoch(DR.value_counts(batch.withColumn("side", F.lit("prod")), features), path, epoch)


def running_drift(reference_counts: DataFrame, path: str, features) -> DataFrame:
    """D1–D4 of all rows that have arrived: the counts of every batch add up,
    and means are read from them, so no row is kept."""
    from ..operators import drift as DR
    seen = reference_counts.sparkSession.read.schema(reference_counts.schema).parquet(path).drop("_epoch")
    counts = materialize(reference_counts.unionByName(seen).groupBy("feature", "value").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_prod").alias("c_prod")),
                         "drift_counts")
    mean = lambda c: F.try_divide(F.sum(F.col("value") * F.col(c)), F.sum(c)).alias(c)
    means = counts.groupBy("feature").agg(mean("c_ref"), mean("c_prod")).select("feature", F.col("c_ref").alias("ref_mean"), F.col("c_prod").alias("prod_mean"))
    return DR.drift_from_counts(counts, means, features)


def run_feature_drift(spark: SparkSession, reference: DataFrame, parts: Iterable[DataFrame], features) -> DataFrame:
    """Drift of a growing production side against a reference.  Every
    micro-batch leaves its value counts under its number; the drift is read
    from the counts of all batches.  The parts arrive one after another, a run
    over one checkpoint for each."""
    from ..operators import drift as DR
    src, counts, ckpt = (scratch_path(spark, f"running_drift_{x}") for x in ("rows", "counts", "ckpt"))
    ref = materialize(DR.value_counts(reference.withColumn("side", F.lit("ref")), features), "reference_counts")
    for part in parts:
        part = part.select(*features)
        part.write.mode("append").parquet(src)
        run_available_now(file_stream(spark, src, part.schema, {}), counts, ckpt, "append",
                          foreach=lambda batch, epoch: write_value_counts(batch, epoch, counts, features))
    return running_drift(ref, counts, features)


def run_json_requests(spark: SparkSession, source: str, schema: str, keep=()) -> DataFrame:
    """S16 in the stream: JSON texts (column json) checked as they arrive (stateless, append mode)."""
    sink, ckpt = scratch_path(spark, "json_requests_sink"), scratch_path(spark, "json_requests_ckpt")
    run_available_now(Q.json_requests(file_stream(spark, source, schema), keep=keep), sink, ckpt, "append")
    return spark.read.parquet(sink).drop("_epoch")
