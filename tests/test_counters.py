"""Sliding rates against a plain reading of the samples; alert states step by step."""

import math
import random

import pytest
from pyspark.sql import functions as F

from churnlake.operators import counters as CO


def brute_rates(samples, step=15, span=300):
    """samples: {series: [(ms, [v…])]}; every multiple of the step with two samples in (t - span, t]."""
    out = {}
    for series, rows in samples.items():
        rows = sorted(rows)
        lo, hi = rows[0][0], rows[-1][0] + span * 1000
        for t in range(-(-lo // (step * 1000)) * step * 1000, hi + 1, step * 1000):
            inside = [(x, v) for x, v in rows if t - span * 1000 < x <= t]
            if len(inside) < 2:
                continue
            sampled = (inside[-1][0] - inside[0][0]) / 1000
            between = sampled / (len(inside) - 1)
            got = []
            for i in range(len(inside[0][1])):
                v = [x[1][i] for x in inside]
                rise = v[-1] - v[0] + sum(a for a, b in zip(v, v[1:]) if b < a)
                start, end = (inside[0][0] - (t - span * 1000)) / 1000, (t - inside[-1][0]) / 1000
                start = between / 2 if start >= between * 1.1 else start
                end = between / 2 if end >= between * 1.1 else end
                if rise > 0:
                    start = min(start, sampled * v[0] / rise)
                got.append(rise * (sampled + start + end) / sampled / span)
            out[series, t] = got
    return out


def series(rng, n, base=1_704_067_200_000):
    """Counters with resets, lost samples, a long gap and lone samples."""
    rows, t, v = [], base + rng.randrange(15_000), [0.0, 0.0]
    for i in range(n):
        t += 15_000 if rng.random() < 0.9 else rng.choice([30_000, 200_000, 310_000, 4_000_000])
        v = [0.0, 0.0] if rng.random() < 0.05 else [v[0] + rng.randrange(4), v[1] + (rng.random() < 0.2)]
        rows.append((t, list(v)))
    return rows


@pytest.mark.parametrize("chunk_ms", [CO.CHUNK_MS, 600_000])
def test_rates_with_resets_gaps_and_single_samples(spark, chunk_ms):
    rng = random.Random(chunk_ms)
    data = {0: series(rng, 500), 1: series(rng, 40), 2: [(1_704_067_200_000, [5.0, 1.0])],
            3: [(1_704_067_200_000, [5.0, 1.0]), (1_704_070_799_999, [7.0, 1.0]), (1_704_070_800_000, [9.0, 1.0])]}
    df = spark.createDataFrame([(s, t, v) for s, rows in data.items() for t, v in rows], "series int, t bigint, v array<double>")
    got = {(r["series"], r["t"]): r["rates"] for r in CO.counter_rates(df, 2, chunk_ms=chunk_ms).collect()}
    want = brute_rates(data)
    assert got.keys() == want.keys()
    assert all(math.isclose(x, y, rel_tol=1e-9, abs_tol=1e-12) for k in want for x, y in zip(got[k], want[k]))
    assert not any(s == 2 for s, _ in got)


def test_quantile_of_rates(spark):
    rows = [([1.0, 2.0, 4.0],), ([0.0, 0.0, 0.0],), ([0.0, 0.0, 2.0],), ([2.0, 1.0, 2.0],), ([0.0, 10.0, 10.0],)]
    df = spark.createDataFrame(rows, "r array<double>").coalesce(1)
    q = lambda p: [x[0] for x in df.select(CO.quantile_of_rates(p, [F.col("r")[i] for i in range(3)], [10, 20]).alias("q")).collect()]
    assert q(0.5) == [20.0, None, 20.0, 5.0, 15.0]
    assert q(0.25) == [10.0, None, 20.0, 2.5, 12.5]


def brute_states(steps, for_s, end, step=15_000):
    out, active, firing = [], None, False
    for t in range(min(steps), end + 1, step):
        if t in steps:
            if active is None:
                active = t
                out += [(t, "pending", t)] if for_s else []
            if not firing and t - active >= for_s * 1000:
                firing = True
                out.append((t, "firing", active))
        elif active is not None:
            out.append((t, "resolved" if firing else "inactive", active))
            active, firing = None, False
    return out


@pytest.mark.parametrize("for_s", [0, 15, 100, 300])
def test_alert_states(spark, for_s):
    rng = random.Random(for_s)
    base, data = 1_704_067_200_000, {}
    for s in range(4):
        t, steps = base, set()
        for _ in range(25):
            t += 15_000 * rng.randrange(1, 9)
            for _ in range(rng.randrange(1, 40)):
                steps.add(t)
                t += 15_000
        data[s] = steps
    end = max(max(x) for x in data.values())
    df = spark.createDataFrame([(s, t) for s, x in data.items() for t in x], "series int, t bigint")
    got = sorted((r["series"], r["t"], r["state"], r["active_at"]) for r in CO.alert_states(df.unionByName(df), for_s, end).collect())
    assert got == sorted((s, *x) for s, steps in data.items() for x in brute_states(steps, for_s, end))
    assert CO.alert_states(df.filter("t < 0"), for_s, end).count() == 0
