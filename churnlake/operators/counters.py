"""Counters as a scraper sees them, sliding rates, and alert states.

``counter_rates`` is ``rate(counter[range])`` evaluated every few seconds:
the increase over the samples in (t - range, t], with every fall of the value
taken for a restart from zero, extrapolated to the borders of the range and
divided by its length.  A step with fewer than two samples has no rate.

Series are cut into chunks of an hour; a chunk also gets the samples of the
range before it, so that each (series, chunk) is worked on by itself however
long or busy a series is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stats import prefix_sum

# Seconds between scrapes and between evaluations, and the range of the panels.
SCRAPE_SECONDS = 15
RANGE_SECONDS = 300
#: Milliseconds of a chunk.
CHUNK_MS = 3_600_000


# ---- counters ------------------------------------------------------------------------------------------


def counter_samples(log: DataFrame, bounds, instances: int = 2, slot_hours: int = 6, lost_one_in: int = 10) -> DataFrame:
    """(series, t, v): what a scraper reads every ``SCRAPE_SECONDS`` from the
    instances that serve the requests of ``log`` (event_time, customer, error
    flag, latency).  ``v`` holds the running counts of requests, errors and
    latencies up to each bound and of any length.  An instance restarts, and
    counts from zero, every ``slot_hours``; one scrape in ``lost_one_in`` is
    lost by a hash, and so is every scrape of an hour in seventeen."""
    ms = F.unix_millis(F.col("event_time").cast("timestamp"))
    number = F.regexp_replace("customer_id", "[^0-9]", "").cast("bigint")
    slot_ms, step = slot_hours * 3_600_000, SCRAPE_SECONDS * 1000
    x = log.select((number % instances).cast("int").alias("series"), ms.alias("ms"), "is_error", "latency_ms")
    # scrapes lie at multiples of the step plus an offset of the instance's own; a request counts from the next scrape on
    offset = F.col("series") * 4000
    x = x.withColumns({"slot": F.floor(F.col("ms") / slot_ms), "t": F.ceil((F.col("ms") - offset) / step) * step + offset})
    counts = [F.count(F.lit(1)), F.sum(F.col("is_error").cast("bigint"))] + [F.count_if(F.col("latency_ms") <= float(b)) for b in bounds] + [F.count("latency_ms")]
    names = [f"c{i}" for i in range(len(counts))]
    seen = x.groupBy("series", "slot", "t").agg(*[c.alias(n) for c, n in zip(counts, names)])
    first = F.ceil((F.col("slot") * slot_ms - offset) / step) * step + offset
    grid = seen.select("series", "slot").distinct().select("series", "slot", F.explode(F.sequence(first, first + slot_ms - step, F.lit(step).cast("bigint"))).alias("t"))
    w = Window.partitionBy("series", "slot").orderBy("t")      # the scrapes of one slot
    runs = grid.join(seen, ["series", "slot", "t"], "left").select(
        "series", "t", F.array(*[F.sum(F.coalesce(n, F.lit(0))).over(w).cast("double") for n in names]).alias("v"))
    lost = ((F.col("t") / 1000).cast("bigint") * 1103515245 + F.col("series") * 12345) % 2147483647 % lost_one_in == 0
    outage = (F.floor(F.col("t") / 3_600_000) * 48271 + F.col("series") * 7) % 2147483647 % 17 == 0
    return runs.filter(~lost & ~outage)


# ---- rates ---------------------------------------------------------------------------------------------


def counter_rates(samples: DataFrame, n_counters: int, range_seconds: int = RANGE_SECONDS, step_seconds: int = SCRAPE_SECONDS,
                  chunk_ms: int = CHUNK_MS) -> DataFrame:
    """(series, t, rates) from samples (series, t in ms, v: array of
    ``n_counters`` doubles), at every multiple of the step with at least two
    samples in its range; ``rates`` per second, in the order of ``v``."""
    span, step = range_seconds * 1000, step_seconds * 1000
    home = F.floor(F.col("t") / chunk_ms)
    carried = F.when(F.col("t") > (home + 1) * chunk_ms - span, F.array(home, home + 1)).otherwise(F.array(home))
    x = samples.select("series", "t", "v", F.explode(carried).alias("chunk"))
    w = Window.partitionBy("series", "chunk").orderBy("t")
    fell = [F.when(F.col("v")[i] < F.lag(F.col("v")[i]).over(w), F.lag(F.col("v")[i]).over(w)).otherwise(0.0) for i in range(n_counters)]
    x = x.withColumns({f"_d{i}": c for i, c in enumerate(fell)})
    # repaired: what the counters would show had they never restarted
    x = x.withColumn("up", F.array(*[F.col("v")[i] + F.sum(f"_d{i}").over(w) for i in range(n_counters)]))
    x = x.select("series", "chunk", "t", F.struct("t", "v", "up").alias("s"))
    steps = x.select("series", "chunk").distinct().select(
        "series", "chunk", F.explode(F.sequence(F.ceil(F.col("chunk") * chunk_ms / step) * step, (F.col("chunk") + 1) * chunk_ms - 1, F.lit(step).cast("bigint"))).alias("t"),
        F.lit(None).cast(x.schema["s"].dataType).alias("s"))
    inside = Window.partitionBy("series", "chunk").orderBy("t").rangeBetween(1 - span, 0)
    got = x.withColumn("step", F.lit(False)).unionByName(steps.withColumn("step", F.lit(True))).select(
        "series", "t", "step", F.count("s").over(inside).alias("n"), F.first("s", ignorenulls=True).over(inside).alias("a"),
        F.last("s", ignorenulls=True).over(inside).alias("b")).filter(F.col("step") & (F.col("n") >= 2))
    sampled = (F.col("b.t") - F.col("a.t")) / 1000.0
    between = sampled / (F.col("n") - 1)
    to_start = (F.col("a.t") - (F.col("t") - span)) / 1000.0
    to_end = (F.col("t") - F.col("b.t")) / 1000.0
    got = got.withColumns({"_sampled": sampled, "_start": F.when(to_start >= between * 1.1, between / 2.0).otherwise(to_start),
                           "_end": F.when(to_end >= between * 1.1, between / 2.0).otherwise(to_end)})

    def rate(i: int) -> Column:
        rise = F.col("b.up")[i] - F.col("a.up")[i]
        zero = F.try_divide(F.col("_sampled") * F.col("a.v")[i], rise)      # a counter can't have been below zero
        start = F.when((rise > 0) & (zero < F.col("_start")), zero).otherwise(F.col("_start"))
        return rise * ((F.col("_sampled") + start + F.col("_end")) / F.col("_sampled")) / float(range_seconds)

    return got.select("series", "t", F.array(*[rate(i) for i in range(n_counters)]).alias("rates"))


def quantile_of_rates(q: float, rates: list[Column], bounds) -> Column:
    """``histogram_quantile`` over the rates of cumulative buckets (the last
    one unbounded): linear inside the bucket that holds the rank, the largest
    bound where that is the unbounded one, null without any rate.  Rates that
    fall below an earlier bucket's are raised to it."""
    level = [rates[0]]
    for r in rates[1:]:
        level.append(F.greatest(level[-1], r))
    rank = level[-1] * q
    out = None
    for i, b in enumerate(bounds):
        low, below = (float(bounds[i - 1]), level[i - 1]) if i else (0.0, F.lit(0.0))
        value = low + (float(b) - low) * F.try_divide(rank - below, level[i] - below)
        out = F.when(level[i] >= rank, value) if out is None else out.when(level[i] >= rank, value)
    return F.when(level[-1] > 0, out.otherwise(float(bounds[-1])))


# ---- alert states --------------------------------------------------------------------------------------


def alert_states(held: DataFrame, for_seconds: int, end_ms, step_seconds: int = SCRAPE_SECONDS) -> DataFrame:
    """(series, t, state, active_at): every change of an alert's state, from
    the steps (series, t in ms) at which its condition holds.

    A first such step makes the alert "pending"; once it has held for
    ``for_seconds`` it is "firing"; the first step without it (a step that is
    missing counts as such) makes a firing alert "resolved" and a pending one
    "inactive".  Steps up to ``end_ms`` have been evaluated, so an alert whose
    condition holds there stays open.  Runs of steps are found by joins on the
    neighbouring step, their starts and ends meet by rank, so a series of any
    length is spread over tasks."""
    step = step_seconds * 1000
    x = held.select("series", "t").distinct()
    first = x.join(x.select("series", (F.col("t") + step).alias("t")), ["series", "t"], "left_anti")
    last = x.join(x.select("series", (F.col("t") - step).alias("t")), ["series", "t"], "left_anti")

    def ranked(d: DataFrame, name: str) -> DataFrame:
        return prefix_sum(d.withColumn("one", F.lit(1)), ["series"], ["t"], ["one"]).select("series", F.col("one_cum").alias("no"), F.col("t").alias(name))

    runs = ranked(first, "a").join(ranked(last, "b"), ["series", "no"])
    fires = F.col("b") - F.col("a") >= for_seconds * 1000
    closed = F.col("b") + step <= end_ms
    changes = F.array_compact(F.array(
        F.when(F.lit(for_seconds > 0), F.struct(F.col("a").alias("t"), F.lit("pending").alias("state"))),
        F.when(fires, F.struct((F.col("a") + -(-for_seconds // step_seconds) * step).alias("t"), F.lit("firing").alias("state"))),
        F.when(closed, F.struct((F.col("b") + step).alias("t"), F.when(fires, F.lit("resolved")).otherwise(F.lit("inactive")).alias("state")))))
    return runs.select("series", F.col("a").alias("active_at"), F.inline(changes)).select("series", "t", "state", "active_at")
