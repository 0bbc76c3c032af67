"""Alert states in the stream (W6): a stateful operator with event-time timers.

Per series the operator keeps the alert (since when its condition holds, up to
which step, whether it fires) and the steps that the watermark has not passed
yet, so rows may come in any order within the watermark's delay.  Timers are
set where a run of steps can change the state: at its start, at start plus
``for`` and one step after its end.  When the watermark passes one, all steps
up to it are played through in order.  A restarted query goes on with the
state of its checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.counters import SCRAPE_SECONDS
from ..session import scratch_path
from .jobs import run_available_now, state_in_rocksdb

CHANGES = "series int, t bigint, state string, active_at bigint"
_STATE = "active bigint, last bigint, firing boolean, waiting array<bigint>"


def played(active: int, last: int, firing: bool, waiting: list[int], upto: int, step: int, hold: int):
    """The state after all steps up to ``upto`` (active -1: no alert), and its changes on the way."""
    out = []
    for t in [*sorted(x for x in set(waiting) if x <= upto), None]:
        if active >= 0 and (t > last + step if t is not None else last + step <= upto):
            out.append((last + step, "resolved" if firing else "inactive", active))
            active, firing = -1, False
        if t is None:
            break
        if active < 0:
            active = t
            if hold > 0:
                out.append((t, "pending", t))
        last = t
        if not firing and t - active >= hold:
            firing = True
            out.append((t, "firing", active))
    return active, last, firing, [x for x in set(waiting) if x > upto], out


class AlertProcessor(StatefulProcessor):
    def __init__(self, for_seconds: int, step_seconds: int):
        self.hold, self.step = for_seconds * 1000, step_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.alert = handle.getValueState("alert", _STATE)

    def _get(self) -> tuple[int, int, bool, list[int]]:
        got = self.alert.get()
        return (int(got[0]), int(got[1]), bool(got[2]), [int(x) for x in got[3]]) if got is not None else (-1, 0, False, [])

    def _play(self, key, upto: int) -> pd.DataFrame:
        active, last, firing, waiting, out = played(*self._get(), upto, self.step, self.hold)
        if active < 0 and not waiting:
            self.alert.clear()
        else:
            self.alert.update((active, last, firing, waiting))
        return pd.DataFrame([(int(key[0]), *c) for c in out], columns=["series", "t", "state", "active_at"])

    def handleInputRows(self, key, rows, timerValues):
        active, last, firing, waiting = self._get()
        new = sorted({int(t) for part in rows for t in part["t"]})
        now = timerValues.getCurrentWatermarkInMs()
        self.alert.update((active, last, firing, sorted({*waiting, *(t for t in new if t > now)})))
        start = None
        for i, t in enumerate(new):
            start = t if start is None else start
            if i + 1 == len(new) or new[i + 1] > t + self.step:
                begun = active if active >= 0 and start <= last + self.step else start
                for at in (start, begun + -(-self.hold // self.step) * self.step, t + self.step):
                    if at > now:
                        self.handle.registerTimer(at)
                start = None
        yield self._play(key, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield self._play(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass


def alert_changes(steps: DataFrame, delay: str, for_seconds: int, step_seconds: int = SCRAPE_SECONDS) -> DataFrame:
    """Changes from a stream of steps (series, t in ms, held: whether the condition holds)."""
    seen = steps.withColumn("at", F.timestamp_millis("t")).withWatermark("at", delay)
    # a condition that names the event time stays above the watermark, which all steps must move on
    return (seen.filter(F.when(F.col("at").isNotNull(), F.col("held"))).select("series", "t", "at").groupBy("series")
            .transformWithStateInPandas(AlertProcessor(for_seconds, step_seconds), CHANGES, "Append", "EventTime"))


def run_alert_states(spark: SparkSession, parts: Iterable[DataFrame], delay: str, for_seconds: int) -> DataFrame:
    """Steps (series, t, held) arrive part by part; a run over one checkpoint
    for each, so every run but the first restarts from stored state."""
    src, sink, ckpt = (scratch_path(spark, f"alert_states_{x}") for x in ("steps", "sink", "ckpt"))
    for part in parts:
        part.select("series", "t", "held").write.mode("append").parquet(src)
        with state_in_rocksdb(spark):
            run_available_now(alert_changes(spark.readStream.schema("series int, t bigint, held boolean").parquet(src), delay, for_seconds), sink, ckpt, "append")
    return spark.read.schema(CHANGES + ", _epoch int").parquet(sink).drop("_epoch")
