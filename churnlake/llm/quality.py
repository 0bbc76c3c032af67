"""Quality rules with risk-controlled thresholds.

Base rules per document: fewer than 50 words, or more than half of the words
inside repeated three-word windows.

The other rules reject a document whose metric exceeds a cutoff.  Cutoffs are
learned per stratum (language) from labelled documents, so that at most a
stated share of good documents is rejected by mistake, by all rules together:

* every (rule, grid cell) has a badness level: the best share of labelled bad
  documents among all documents of a tail of that rule that holds the cell;
  a document's level is the highest of its rules', so a limit on the level is
  one cutoff per rule, and limits are nested.  Levels depend on the table and
  the bad labels alone, not on the good labels that test them;
* limits are tested from the mildest on; one passes if the exact
  (Clopper-Pearson) upper bound of the joint false rejection rate on the
  stratum's good labelled documents is at most ``risk``; testing stops at the
  first that fails (fixed sequence testing needs no correction along the way);
* the error probability ``delta`` is divided by the number of strata
  (Bonferroni), so all limits hold together with probability 1 - delta;
* of the passing limits the one with the most bad documents rejected, less
  ``COST`` times the good ones, is used (the mildest of equals);
* strata with fewer good labels than any limit needs (``labels_needed``),
  strata without labels and documents without language form one pooled stratum
  with a bound of its own: it holds for the pool as a whole, as far as the
  pool's labels are drawn from all of it.  A pool with too few labels, or a
  stratum without a gain, gets no cutoffs.

Metrics are computed once per document in Arrow batches and written to the
shared folder; only counts per (stratum, rule, grid cell, label) reach the
driver.  Null text has no words and fails the base rules.  Repeated doc_ids are rows of
their own; of contradicting labels the better one counts.  Without labels
only the base rules apply.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import in_tasks, steps, texts_of

#: Share of a stratum's good documents that all learned rules together may reject, and the probability of exceeding it.
RISK = 0.03
DELTA = 0.05
GRID = 200
#: Bad documents that a cutoff must reject for each good one it rejects, to be worth it.
COST = 5
#: Documents added to a tail's size in its badness, so that a few extreme documents do not rank before a large tail.
SMOOTH = 5
MIN_WORDS = 50

_SYMBOLS = b"#*$%&|<>"
_SPACES = b" \t\n\x0b\x0c\r"
_TAILS = bytes(range(0x80, 0xC0))
_UPPER = bytes(range(65, 91))
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_ascii_letters"]


def repeat_words(w: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    n = len(w) - 2
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(x, len(seen)) for x in w), np.int64, len(w))
    size = len(seen)
    if size < 2_000_000:
        key = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
    else:
        pair = np.unique(ids[:-2] * size + ids[1:-1], return_inverse=True)[1]
        key = pair * size + ids[2:]
    order = np.argsort(key)
    equal = key[order[1:]] == key[order[:-1]]
    if not equal.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    cover = np.zeros(n + 2, bool)
    for k in range(3):
        cover[k:k + n] |= twice
    return int(cover.sum())


def counts(text: bytes) -> tuple[int, ...]:
    w = text.split()
    lines = text.split(b"\n")
    seen: set[bytes] = set()
    dup = full = 0
    for line in lines:
        if line.strip():
            full += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return (len(w), len(text.translate(None, _SPACES + _TAILS)), len(text) - len(text.translate(None, _SYMBOLS)), dup,
            repeat_words(w), full, len(text) - len(text.translate(None, _UPPER)), len(text) - len(text.translate(None, _LETTERS)))


def document_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(id, stratum, counts…) for every row."""

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, "text"):
            got = [counts(x) for x in texts_of(b.column(2)).cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *[pa.array(x, pa.int64()) for x in zip(*got)]],
                                             ["id", "stratum", *COUNTS])

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(stratum_col).cast("string").alias("stratum"), F.col(text_col).alias("text"))
    return src.transform(in_tasks(rows, f"id {kind}, stratum string, " + ", ".join(f"{c} long" for c in COUNTS)))


def base_failed(at: str = "") -> Column:
    """``at``: prefix of the counts' column names."""
    n, repeated = F.col(f"{at}n_words"), F.col(f"{at}n_repeat_words")
    return (n < MIN_WORDS) | (100 * repeated > 50 * n)


def rule_metrics(at: str = "") -> dict[str, Column]:
    """Each rule's metric in [0, 1]; larger is worse."""

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(at + a), F.col(at + b)), F.lit(0.0)).cast("double")

    one = F.lit(1.0)
    return {
        "symbols_per_word": F.least(one, share("n_symbols", "n_words") / 4.0),
        "duplicate_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "upper_case": share("n_upper", "n_ascii_letters"),
        "long_words": F.least(one, share("word_chars", "n_words") / 25.0),
        "short_words": one - F.least(one, share("word_chars", "n_words") / 10.0),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p)."""
    if n == 0 or p <= 0:
        return 1.0
    top = math.lgamma(n + 1)
    return min(1.0, math.fsum(math.exp(top - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
                              for i in range(k + 1)))


def within_risk(rejected: int, good: int, risk: float, delta: float) -> bool:
    """Whether the exact upper confidence bound (level 1 - delta) of the
    rejection rate is at most ``risk``."""
    return rejected <= risk * good and binomial_tail(rejected, good, risk) <= delta


def choose_cutoffs(cells: dict, risk: float = RISK, delta: float = DELTA, grid: int = GRID) -> dict[str, dict[str, float]]:
    """``cells``: (stratum, rule, cell, good?) -> documents; the cutoff of a
    cell rejects documents in higher cells.  Returns rule -> stratum -> cutoff."""
    strata = sorted({s for s, _, _, _ in cells})
    rules = sorted({r for _, r, _, _ in cells})
    out: dict[str, dict[str, float]] = defaultdict(dict)
    for s in strata:
        for r in rules:
            good = [cells.get((s, r, c, True), 0) for c in range(grid + 1)]
            bad = [cells.get((s, r, c, False), 0) for c in range(grid + 1)]
            n, hit_good, hit_bad, best = sum(good), 0, 0, (0, None)
            for c in range(grid - 1, -1, -1):      # from mild to strict
                hit_good += good[c + 1]
                hit_bad += bad[c + 1]
                if not within_risk(hit_good, n, risk / len(rules), delta / (len(rules) * len(strata))):
                    break
                if hit_bad - COST * hit_good > best[0]:
                    best = (hit_bad - COST * hit_good, c)
            if best[1] is not None:
                out[r][s] = best[1] / grid
    return dict(out)


def _cell(metric: Column, grid: int) -> Column:
    return F.ceil(metric * grid).cast("int")


def labels_needed(strata: int, risk: float = RISK, delta: float = DELTA) -> int:
    """Good labelled documents without which no limit can pass."""
    return math.ceil(math.log(delta / strata) / math.log1p(-risk))


def badness_levels(found: dict[str, dict[int, int]], bad: dict[str, dict[int, int]], grid: int = GRID) -> dict[str, list[int]]:
    """``found``, ``bad``: rule -> cell -> all documents, bad labelled ones.
    Returns rule -> level per cell; levels rise with the cell, 0 is never rejected."""
    share: dict[str, list[float]] = {}
    for rule in found:
        n = hit = 0
        tail = [0.0] * (grid + 1)
        for c in range(grid, 0, -1):
            n += found[rule].get(c, 0)
            hit += bad.get(rule, {}).get(c, 0)
            tail[c] = hit / (n + SMOOTH)
        share[rule] = np.maximum.accumulate(tail).tolist()
    rank = {x: i for i, x in enumerate(sorted({0.0, *(x for xs in share.values() for x in xs)}))}
    return {rule: [rank[x] for x in xs] for rule, xs in share.items()}


def fit_cutoffs(measured: DataFrame, labels: DataFrame, label_id: str = "doc_id", label_col: str = "quality",
                risk: float = RISK, delta: float = DELTA, grid: int = GRID) -> dict[str, dict[str | None, float]]:
    """Rule -> stratum -> cutoff from the labelled documents that pass the base
    rules.  Stratum None stands for all that are not named."""
    lab = (labels.select(F.col(label_id).alias("id"), F.col(label_col).alias("label")).filter("id is not null and label is not null")
           .groupBy("id").agg(F.max("label").alias("label")))
    rules = rule_metrics()
    passed = measured.filter(~base_failed()).select("id", "stratum", F.array(*[_cell(m, grid) for m in rules.values()]).alias("cells"))
    seen = materialize(passed.join(lab, "id").select("stratum", (F.col("label") > 0).alias("good"), "cells"), "quality_labelled")
    good = {r["stratum"]: r["count"] for r in seen.filter("good").groupBy("stratum").count().collect()}
    if not good:
        return {}
    need = labels_needed(len(good.keys() - {None}) + 1, risk, delta)
    own = sorted(s for s, n in good.items() if s is not None and n >= need)
    # a group is a stratum of its own or the pool
    group = F.when(F.col("stratum").isin(own), F.concat(F.lit("="), "stratum")).otherwise(F.lit("")) if own else F.lit("")

    def tally(df: DataFrame) -> dict[str, dict[str, dict[int, int]]]:
        out: dict = defaultdict(lambda: {r: {} for r in rules})
        rows = df.select(group.alias("group"), F.posexplode("cells").alias("rule", "cell")).groupBy("group", "rule", "cell").count()
        for r in rows.collect():      # strata x rules x grid
            out[r["group"]][list(rules)[r["rule"]]][r["cell"]] = r["count"]
        return out

    found, bad = tally(passed), tally(seen.filter(~F.col("good")))
    levels = {g: badness_levels(found[g], bad[g], grid) for g in found}
    small = seen.sparkSession.createDataFrame([(g, [per[r] for r in rules]) for g, per in levels.items()], "group string, levels array<array<int>>")
    worst = F.array_max(F.zip_with("levels", "cells", lambda xs, c: F.get(xs, c)))
    joint = seen.withColumn("group", group).join(F.broadcast(small), "group").groupBy("group", worst.alias("level"), "good").count()
    cells = {(r["group"], "badness", r["level"], r["good"]): r["count"] for r in joint.collect()}
    most = max([1, *(x for per in levels.values() for xs in per.values() for x in xs)])
    limits = choose_cutoffs(cells, risk, delta, most).get("badness", {})
    out: dict[str, dict[str | None, float]] = {r: {s: 1.0 for s in own} for r in rules}
    for g, limit in limits.items():
        for r in rules:
            first = next((c for c, x in enumerate(levels[g][r]) if x > round(limit * most)), grid + 1)
            out[r][g[1:] if g else None] = (first - 1) / grid
    return out


def verdict(cutoffs: dict[str, dict[str | None, float]], grid: int = GRID, at: str = "", stratum: Column | None = None) -> Column:
    """False if a base rule or a learned rule rejects."""
    stratum = F.col("stratum") if stratum is None else stratum
    bad = base_failed(at)
    for rule, metric in rule_metrics(at).items():
        per = cutoffs.get(rule)
        if per:
            named = {s: int(round(c * grid)) for s, c in per.items() if s is not None}
            limit = F.lit(int(round(per.get(None, 1.0) * grid)))
            if named:
                table = F.create_map(*[F.lit(x) for s, c in sorted(named.items()) for x in (s, c)])
                limit = F.coalesce(F.when(stratum.isNotNull(), F.try_element_at(table, stratum)), limit)
            bad = bad | F.coalesce(_cell(metric, grid) > limit, F.lit(False))
    return ~bad


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """Per document row: id, counts, base_failed, kept."""
    measured = materialize(document_counts(docs, id_col), "quality_counts")
    cutoffs = fit_cutoffs(measured, labels, **how)
    return (measured.withColumn("base_failed", base_failed())
            .withColumn("kept", verdict(cutoffs, how.get("grid", GRID))).withColumnRenamed("id", id_col))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
              **how) -> DataFrame:
    """The rows that the rules keep, with their columns.  Counts are added
    beside the columns in one pass and written, so that learning the cutoffs
    and filtering read them back without a shuffle of texts."""
    extra = "_quality"
    while extra in docs.columns:
        extra += "_"

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for b in steps(batches, text_col):
            got = [counts(x) for x in texts_of(b.column(b.schema.get_field_index(text_col))).cast(pa.large_binary()).to_pylist()]
            struct = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in zip(*got)], COUNTS)
            yield pa.RecordBatch.from_arrays([*b.columns, struct], [*b.schema.names, extra])

    counted = materialize(docs.transform(in_tasks(rows, T.StructType([*docs.schema, T.StructField(extra, T.StructType.fromDDL(
        ", ".join(f"{c} long" for c in COUNTS)))]))), "quality_counted")
    measured = counted.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{stratum_col}`").cast("string").alias("stratum"), F.col(f"{extra}.*"))
    cutoffs = fit_cutoffs(measured, labels, **how)
    keep = verdict(cutoffs, how.get("grid", GRID), f"{extra}.", F.col(f"`{stratum_col}`").cast("string"))
    return counted.filter(keep).select(*[F.col(f"`{c}`") for c in docs.columns])
