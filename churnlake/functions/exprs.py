"""Reusable column expressions.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen.  Double literals are written as Python
floats (``F.lit(0.3)`` is a double) — never as SQL text ``0.3``, which Spark
types as a decimal.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "MODULUS", "hkey", "hunif", "padded_id", "flag", "right_closed_bucket",
    "missing", "not_nan", "weighted_sum", "risk_band_api", "risk_band_dash", "ks_pvalue", "ks_pvalue_exact", "ks_pvalue_asymptotic",
]

# The multiplicative hash used by every test fixture.
MODULUS = 2147483647


def hkey(key: Column | str, a: int) -> Column:
    """H(A) = ((k + 1) * A) mod (2^31 - 1), a deterministic per-key hash."""
    k = F.col(key) if isinstance(key, str) else key
    return ((k + F.lit(1)) * F.lit(a)) % F.lit(MODULUS)


def hunif(key: Column | str, a: int) -> Column:
    """U(A) = H(A) / (2^31 - 1) as a double in [0, 1)."""
    return hkey(key, a) / F.lit(float(MODULUS))


def padded_id(key: Column | str, prefix: str = "C", width: int = 6) -> Column:
    """Prefix and the key with leading zeros up to ``width`` digits; longer
    keys keep all their digits."""
    digits = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def flag(cond: Column) -> Column:
    """Boolean → 0/1 int (pandas ``astype(int)``); null counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def right_closed_bucket(c: Column, edges, labels) -> Column:
    """``pd.cut`` semantics: bins (e0, e1], (e1, e2], …; outside → null."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def missing(c: Column, is_double: bool) -> Column:
    """pandas ``isnull``: null, and NaN for floating columns."""
    return (c.isNull() | F.isnan(c)) if is_double else c.isNull()


def not_nan(c: Column) -> Column:
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def weighted_sum(terms) -> Column:
    """Σ weight·indicator, added left to right (fixed order → identical
    rounding in every engine)."""
    cols = [F.when(cond, F.lit(float(w))).otherwise(F.lit(0.0)) for w, cond in terms]
    return reduce(lambda a, b: a + b, cols)


def risk_band_api(p: Column) -> Column:
    """Scoring bands: ≥ .7 HIGH, ≥ .4 MEDIUM, else LOW."""
    return F.when(p >= 0.7, "HIGH").when(p >= 0.4, "MEDIUM").otherwise("LOW")


def risk_band_dash(p: Column) -> Column:
    """Dashboard bands, right-closed: (0,.4] LOW, (.4,.7] MEDIUM, (.7,1] HIGH."""
    return right_closed_bucket(p, [0.0, 0.4, 0.7, 1.0], ["LOW", "MEDIUM", "HIGH"])


#: Samples up to this size get the exact distribution, larger ones the limit (fixed value).
KS_EXACT_ROWS = 10_000


def ks_pvalue(d: Column, n: Column, m: Column, exact_rows: int = KS_EXACT_ROWS) -> Column:
    """Two-sided p-value of the two-sample KS statistic ``d`` of ``n`` and
    ``m`` values: exact while both samples have at most ``exact_rows`` values,
    asymptotic beyond."""
    return F.when(F.greatest(n, m) <= exact_rows, ks_pvalue_exact(d, n, m)).otherwise(ks_pvalue_asymptotic(d, n, m))


def ks_pvalue_exact(d: Column, n: Column, m: Column) -> Column:
    """Share of all orders of n + m values whose KS statistic is at least ``d``.

    An order is a lattice path from (0, 0) to (n, m); its statistic reaches d
    where the path meets a point (i, j) with ``|i/n - j/m| >= d``, that is
    ``|i (n + m) - s n| >= h`` for s = i + j and the whole number h = d n m.
    The share q(i, j) of the paths to (i, j) that have met such a point is 1
    at one, and ``(i q(i-1, j) + j q(i, j-1)) / s`` at any other: shares, all
    terms positive, so nothing overflows and small p-values keep their digits.
    The state is one antidiagonal at a time, between the two borders only."""
    h = F.round(d * n * m).cast("long")
    both = n + m
    state = F.struct(F.lit(0).cast("long").alias("low"), F.array(F.lit(0.0)).alias("q"))

    def step(acc, s):
        low = F.greatest(F.floor((s * n - h) / both) + 1, s - m, F.lit(0).cast("long"))
        high = F.least(F.ceil((s * n + h) / both) - 1, s, n)

        def share(i):
            at = (i - acc["low"]).cast("int")
            before, same = (F.coalesce(F.get(acc["q"], x), F.lit(1.0)) for x in (at - 1, at))
            return (before * i + same * (s - i)) / s

        q = F.when(low <= high, F.transform(F.sequence(low, F.greatest(low, high)), share)).otherwise(F.array().cast("array<double>"))
        return F.struct(low.alias("low"), q.alias("q"))

    last = F.aggregate(F.sequence(F.lit(1).cast("long"), both), state, step, lambda acc: F.get(acc["q"], F.size(acc["q"]) - 1))
    return (F.when(d.isNull() | (n < 1) | (m < 1), F.lit(None).cast("double"))
            .when(h <= 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.coalesce(last, F.lit(1.0)))))


def ks_pvalue_asymptotic(d: Column, n: Column, m: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample KS p-value (Kolmogorov distribution):
    Q(λ) = 2 Σ_{k≥1} (-1)^(k-1) exp(-2 k² λ²), λ = D·sqrt(n·m/(n+m)),
    clamped to [0, 1].  Below λ = 0.1 the distribution's survival function
    is 1 to double precision, where the truncated alternating series would
    not have converged, so 1 is returned directly."""
    lam = d * F.sqrt((n * m).cast("double") / (n + m).cast("double"))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    p = F.when(lam < 0.1, F.lit(1.0)).otherwise(F.lit(2.0) * series)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), p))
