"""Distributed statistics building blocks.

``prefix_sum`` is the core: an exact running sum ordered by a key inside each
part, computed without putting a whole part into one task.  Exact quantiles,
KS statistics, average-rank AUC, the exact stratified split and the drift
timeline are written on top of it.

Plan shape:

1. the (pre-aggregated) input is range-partitioned on (part, order key):
   Spark samples the keys themselves, so slices follow the data's own
   distribution, however heavy its tail, and a part with most of the rows is
   cut into as many slices as its rows need.  Each row keeps the number of
   its slice and the rows are written once;
2. the rows per slice are counted; while any slice exceeds the target, the
   rows are dealt again into twice as many slices (order keys are unique
   within a part, so every slice can be cut);
3. per (part, slice) totals — one row a slice plus one a part border — give
   each slice its offset;
4. local running sum inside (part, slice) plus the offset.

Callers pre-aggregate to distinct keys with counts first, so a key that holds
a third of all rows is a single row here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# rows of a slice (the unit one task sorts for the local running sum)
TARGET_SLICE_ROWS = 2_000_000


def sliced(df: DataFrame, part_cols, order_cols, n_slices: int | None = None,
           target_slice_rows: int = TARGET_SLICE_ROWS) -> DataFrame:
    """``df`` with ``_slice``, a number that rises with (part, order key); no
    slice has more than ``target_slice_rows`` rows."""
    from ..session import drop_path, scratch_path
    spark = df.sparkSession
    keys = [*part_cols, *order_cols]
    n = n_slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    source, old = df, None
    while True:
        path = scratch_path(spark, "slices")
        rows = source.repartitionByRange(n, *keys).withColumn("_slice", F.spark_partition_id())
        rows.write.parquet(path)
        made = spark.read.schema(rows.schema).parquet(path)
        if old:
            drop_path(spark, old)
        largest, total = made.groupBy("_slice").count().agg(F.max("count"), F.sum("count")).first()
        if largest is None or largest <= target_slice_rows:
            return made
        source, old = made.drop("_slice"), path
        n = max(2 * n, -(-2 * total // target_slice_rows))


def prefix_sum(df: DataFrame, part_cols, order_cols, sum_cols, n_slices: int | None = None,
               inclusive: bool = True, target_slice_rows: int = TARGET_SLICE_ROWS) -> DataFrame:
    """Add ``<c>_cum`` (running sum of ``c`` ordered by ``order_cols`` within
    ``part_cols``, inclusive of the current row) and ``<c>_tot`` (part total)
    for every ``c`` in ``sum_cols``.  ``order_cols`` must be unique within a
    part (callers aggregate to distinct keys first)."""
    part_cols, order_cols, sum_cols = list(part_cols), list(order_cols), list(sum_cols)
    x = sliced(df, part_cols, order_cols, n_slices, target_slice_rows)
    tot = x.groupBy(*part_cols, "_slice").agg(*[F.sum(c).alias(f"_s_{c}") for c in sum_cols])
    off = _offsets(tot, part_cols, sum_cols)
    w_loc = (Window.partitionBy(*part_cols, "_slice").orderBy(*order_cols)
             .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    out = x.join(off, [*part_cols, "_slice"])
    return out.select(
        *df.columns,
        *[(F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(w_loc), F.lit(0))).alias(f"{c}_cum") for c in sum_cols],
        *[F.col(f"{c}_tot") for c in sum_cols],
    )


def _offsets(tot: DataFrame, part_cols, sum_cols) -> DataFrame:
    """Sums before each slice and part totals.  The slices of a part (one
    entry each) meet in one array and are summed up in it."""
    slices = F.array_sort(F.collect_list(F.struct("_slice", *[f"_s_{c}" for c in sum_cols])))
    per = tot.groupBy(*part_cols).agg(slices.alias("_all"), *[F.sum(f"_s_{c}").alias(f"{c}_tot") for c in sum_cols])

    def running(c: str):
        kind = tot.schema[f"_s_{c}"].dataType

        def step(acc, v):
            return F.array_append(acc, F.element_at(acc, -1) + F.coalesce(v[f"_s_{c}"], F.lit(0).cast(kind)))

        return F.aggregate("_all", F.array(F.lit(0).cast(kind)), step)

    zipped = F.arrays_zip(F.col("_all").alias("_all"), *[F.slice(running(c), F.lit(1), F.size("_all")).alias(f"_o_{c}") for c in sum_cols])
    rows = per.select(*part_cols, F.explode(zipped).alias("_z"), *[f"{c}_tot" for c in sum_cols])
    return rows.select(*part_cols, F.col("_z._all._slice").alias("_slice"), *[F.col(f"_z._o_{c}").alias(f"_o_{c}") for c in sum_cols],
                       *[f"{c}_tot" for c in sum_cols])


def to_long(df: DataFrame, value_cols, keep_cols=(), value_type: str = "double") -> DataFrame:
    """Wide → long (column, value) with ``stack``; NaN becomes null."""
    keep = list(keep_cols)
    if not value_cols:
        raise ValueError("no value columns")
    args = ", ".join(f"'{c}', CAST(`{c}` AS {value_type})" for c in value_cols)
    long = df.select(*keep, F.expr(f"stack({len(value_cols)}, {args}) AS (`column`, `value`)"))
    if value_type == "double":
        long = long.withColumn("value", F.when(F.isnan("value"), F.lit(None)).otherwise(F.col("value")))
    return long


def exact_quantiles(df: DataFrame, cols, probs, group_cols=(), n_slices: int | None = None) -> DataFrame:
    """Linear-interpolated quantiles (pandas ``quantile`` / SQL
    ``quantile_cont``): for p, h = (n−1)·p, q = v[⌊h⌋] + (h−⌊h⌋)·(v[⌈h⌉] − v[⌊h⌋]).

    Returns (group…, column, p, q).  Distributed: distinct values are counted
    (partial aggregation), ranked by ``prefix_sum``, and only the rows whose
    rank range covers ⌊h⌋ or ⌈h⌉ survive — no group is ever held in memory.
    """
    g = list(group_cols)
    long = to_long(df, cols, g).filter(F.col("value").isNotNull())
    counts = long.groupBy(*g, "column", "value").agg(F.count(F.lit(1)).alias("c"))
    cum = prefix_sum(counts, [*g, "column"], ["value"], ["c"], n_slices)
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    h = (F.col("c_tot") - 1).cast("double") * F.col("p")
    x = (cum.select(*g, "column", "value", "c", "c_cum", "c_tot", F.explode(probs_arr).alias("p"))
         .withColumn("h", h)
         .withColumn("lo", F.floor("h"))
         .withColumn("hi", F.ceil("h"))
         .withColumn("start", F.col("c_cum") - F.col("c")))
    hit_lo = (F.col("lo") >= F.col("start")) & (F.col("lo") < F.col("c_cum"))
    hit_hi = (F.col("hi") >= F.col("start")) & (F.col("hi") < F.col("c_cum"))
    picked = (x.filter(hit_lo | hit_hi)
              .groupBy(*g, "column", "p")
              .agg(F.max(F.when(hit_lo, F.col("value"))).alias("v_lo"),
                   F.max(F.when(hit_hi, F.col("value"))).alias("v_hi"),
                   F.first("h").alias("h"), F.first("lo").alias("lo")))
    frac = F.col("h") - F.col("lo")
    return picked.select(*g, "column", "p",
                         (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * frac).alias("q"))


def approx_quantiles(df: DataFrame, cols, probs, group_cols=(), accuracy: int = 10000) -> DataFrame:
    """Same output as ``exact_quantiles`` with ``percentile_approx``
    (bounded-memory sketch per group; the scale option)."""
    g = list(group_cols)
    long = to_long(df, cols, g).filter(F.col("value").isNotNull())
    probs_arr = F.array(*[F.lit(float(p)) for p in probs])
    q = long.groupBy(*g, "column").agg(F.percentile_approx("value", probs_arr, accuracy).alias("qs"))
    return q.select(*g, "column", F.posexplode(F.arrays_zip(probs_arr.alias("p"), F.col("qs").alias("q"))))\
        .select(*g, "column", F.col("col.p").alias("p"), F.col("col.q").alias("q"))


def quantiles(df: DataFrame, cols, probs, group_cols=(), exact: bool = True) -> DataFrame:
    return exact_quantiles(df, cols, probs, group_cols) if exact else approx_quantiles(df, cols, probs, group_cols)


def quantile_row(df: DataFrame, cols, probs, exact: bool = True) -> DataFrame:
    """One-row frame with ``q_<col>_<pct>`` columns (pivot of ``quantiles``);
    the output is provably one row, so callers attach it with ``with_one_row``."""
    q = quantiles(df, cols, probs, exact=exact)
    aggs = [F.max(F.when((F.col("column") == c) & (F.col("p") == float(p)), F.col("q"))).alias(qname(c, p))
            for c in cols for p in probs]
    return q.agg(*aggs)


def qname(col: str, p: float) -> str:
    return f"q_{col}_{int(round(p * 100))}"


def with_one_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a frame that is one row by construction (a
    global aggregate) as a scalar subquery: Spark runs the aggregate once,
    fails if it ever returned more than one row, and inlines the values into
    the projection — no join of any kind, nothing data-sized is shipped.
    An empty ``one_row`` gives an empty result, as the join it replaces
    would (a present row packs to a non-null struct, an absent one to null)."""
    packed = one_row.select(F.struct(*[F.col(f"`{c}`") for c in one_row.columns]).alias("_p")).scalar()
    tmp = "__one_row"
    return (df.withColumn(tmp, packed)
            .filter(F.col(tmp).isNotNull())
            .withColumns({c: F.col(tmp).getField(c) for c in one_row.columns})
            .drop(tmp))


def equal_width_histogram(df: DataFrame, col: str, bins: int, group_cols=(), density: bool = False,
                          lo=None, hi=None) -> DataFrame:
    """A5: ``bins`` equal-width bins over [min, max] of each group (NumPy
    rule: the last bin is closed on the right).  Groups are few (features,
    sides); the range is one aggregate row per group; counts are one grouped aggregate; empty bins appear with
    count 0 from a generated sequence of exactly ``bins`` rows per group."""
    g = list(group_cols)
    base = df.select(*g, F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if lo is None or hi is None:
        rng = base.groupBy(*g).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"),
                                   F.count(F.lit(1)).alias("_n"))
    else:
        rng = base.groupBy(*g).agg(F.lit(float(lo)).alias("_lo"), F.lit(float(hi)).alias("_hi"),
                                   F.count(F.lit(1)).alias("_n"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.greatest(F.floor((F.col("_v") - F.col("_lo")) / width).cast("int"), F.lit(0)), F.lit(bins - 1)))
    if g:      # a few groups: their ranges travel as one map, looked up in the projection
        table = rng.agg(F.map_from_entries(F.collect_list(F.struct(F.struct(*g), F.struct("_lo", "_hi", "_n")))).alias("_rng"))
        joined = with_one_row(base, table).withColumn("_r", F.try_element_at("_rng", F.struct(*g))).select(*g, "_v", "_r.*")
    else:
        joined = with_one_row(base, rng)
    counted = joined.withColumn("bin", idx).groupBy(*g, "bin").agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(*g, "_lo", "_hi", "_n", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counted, [*g, "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)).cast("bigint"))
    out = out.select(*g, "bin",
                     (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
                     (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
                     "count", "_n")
    if density:
        out = out.withColumn("density", F.try_divide(F.col("count").cast("double"),
                                                     F.col("_n") * (F.col("bin_end") - F.col("bin_start"))))
    return out.drop("_n")
