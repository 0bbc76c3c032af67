"""Data-quality checks (V1–V10), report (S10) and request validation.

Check rows have the schema (check, passed, severity, column, metric, value).
The reference scans the frame once per check; here every aggregate-based
check (missing, duplicates, ranges, categories, target, freshness) is one
fused aggregate pass, outliers need one quantile job plus one counting pass,
and the type check reads only the schema.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stats import qname, quantile_row, with_one_row

# Fixed values (validation rules of the reference).
CRITICAL_COLUMNS = ["customer_id", "tenure_months", "monthly_charges", "churned"]
VALUE_RANGES = {
    "tenure_months": (0, 100),
    "monthly_charges": (0, 200),
    "total_charges": (0, 10000),
    "senior_citizen": (0, 1),
    "churned": (0, 1),
}
ALLOWED_VALUES = {
    "contract_type": ["Month-to-month", "One year", "Two year"],
    "payment_method": ["Electronic check", "Mailed check", "Credit card", "Bank transfer"],
    "internet_service": ["DSL", "Fiber optic", "No"],
    "phone_service": ["Yes", "No"],
    "online_security": ["Yes", "No", "No internet"],
    "tech_support": ["Yes", "No", "No internet"],
}
EXPECTED_TYPES = {
    "tenure_months": "int",
    "monthly_charges": "float",
    "total_charges": "float",
    "senior_citizen": "int",
    "churned": "int",
}
OUTLIER_COLUMNS = ["tenure_months", "monthly_charges", "total_charges"]
IQR_FACTOR = 1.5
TARGET_RATE_BOUNDS = (0.10, 0.50)
FRESHNESS_DAYS = 7
SEVERITY = {
    "missing_values": "fail",
    "duplicates": "fail",
    "data_types": "warning",
    "value_ranges": "fail",
    "categorical_values": "fail",
    "target_distribution": "warning",
    "outliers": "warning",
    "data_freshness": "warning",
}
CHECK_ORDER = list(SEVERITY)

_INT_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOAT_TYPES = (T.FloatType, T.DoubleType)


@dataclass
class _Check:
    name: str
    metrics: list = field(default_factory=list)   # (column, metric, SQL aggregate)
    passed: object = None                         # fn(list[metric alias]) -> SQL predicate


def _is_double(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, _FLOAT_TYPES)


def _q(c: str) -> str:
    return f"`{c}`"


def _missing_sql(dtypes: dict, c: str) -> str:
    return f"({_q(c)} IS NULL OR isnan({_q(c)}))" if dtypes[c] in ("double", "float") else f"({_q(c)} IS NULL)"


def _not_nan_sql(dtypes: dict, c: str) -> str:
    return f"NOT isnan({_q(c)})" if dtypes[c] in ("double", "float") else "TRUE"


def _lit(v) -> str:
    return "'" + str(v).replace("'", "\\'") + "'"


def _missing(df: DataFrame, c: str) -> Column:
    return F.expr(_missing_sql(dict(df.dtypes), c))


def _not_nan(df: DataFrame, c: str) -> Column:
    return F.expr(_not_nan_sql(dict(df.dtypes), c))


def _checks(df: DataFrame, as_of: str | None) -> list[_Check]:
    """Checks as SQL aggregate texts — the whole fused pass is parsed from
    a handful of strings instead of being assembled call by call."""
    dt = dict(df.dtypes)
    cols = df.columns
    out: list[_Check] = []

    # V1 — missing per column (null, and NaN for doubles); passes only at zero.
    miss = [(c, "missing_count", f"count_if({_missing_sql(dt, c)})") for c in cols]
    crit = [c for c in CRITICAL_COLUMNS if c in cols]
    total = " + ".join(f"count_if({_missing_sql(dt, c)})" for c in cols) or "0"
    crit_total = " + ".join(f"count_if({_missing_sql(dt, c)})" for c in crit) or "0"
    out.append(_Check("missing_values",
                      miss + [(None, "total_missing", total), (None, "critical_missing", crit_total)],
                      lambda m: f"{m[-2]} = 0"))

    # V4 — inclusive bounds; missing is not out of range.
    rng = [(c, "out_of_range", f"count_if(({_q(c)} < {lo} OR {_q(c)} > {hi}) AND {_not_nan_sql(dt, c)})")
           for c, (lo, hi) in VALUE_RANGES.items() if c in cols]
    if rng:
        out.append(_Check("value_ranges", rng, lambda m: " AND ".join(f"{x} = 0" for x in m)))

    # V5 — membership; a null category counts as invalid.
    cat = []
    for c, allowed in ALLOWED_VALUES.items():
        if c in cols:
            lst = ", ".join(_lit(v) for v in allowed)
            cat.append((c, "invalid_count", f"count_if(NOT coalesce({_q(c)} IN ({lst}), FALSE))"))
    if cat:
        out.append(_Check("categorical_values", cat, lambda m: " AND ".join(f"{x} = 0" for x in m)))

    # V6 — churn rate within [0.10, 0.50]; absent column → no check row.
    if "churned" in cols:
        lo, hi = TARGET_RATE_BOUNDS
        out.append(_Check("target_distribution",
                          [("churned", "churn_rate", "avg(churned)"), ("churned", "churn_count", "sum(churned)"),
                           ("churned", "no_churn_count", "count_if(churned = 0)")],
                          lambda m: f"coalesce({m[0]} >= {lo!r}D AND {m[0]} <= {hi!r}D, FALSE)"))

    # V8 — whole days since the newest created_at ≤ 7; absent → skipped.
    if "created_at" in cols and as_of is not None:
        days = (f"floor((unix_micros(CAST({_lit(as_of)} AS TIMESTAMP)) - "
                f"unix_micros(max(CAST(created_at AS TIMESTAMP)))) / 86400000000)")
        out.append(_Check("data_freshness", [("created_at", "days_old", days)],
                          lambda m: f"coalesce({m[0]} <= {FRESHNESS_DAYS}, FALSE)"))
    return out


def _stack_rows(wide: DataFrame, rows) -> DataFrame:
    """rows: (check, passed SQL, severity, column, metric, value SQL) → long
    rows via one ``stack`` expression."""
    args = []
    for check, passed, sev, column, metric, value in rows:
        col_sql = "CAST(NULL AS STRING)" if column is None else _lit(column)
        args.append(f"{_lit(check)}, ({passed}), {_lit(sev)}, {col_sql}, {_lit(metric)}, CAST({value} AS DOUBLE)")
    expr = f"stack({len(rows)}, {', '.join(args)}) AS (`check`, passed, severity, `column`, metric, value)"
    return wide.selectExpr(expr)


def check_duplicates(df: DataFrame) -> DataFrame:
    """V2: rows beyond the first per customer_id (null ids form one group).
    The only check that groups by id, so it has an aggregate of its own."""
    per = df.groupBy("customer_id").agg((F.count(F.lit(1)) - 1).alias("extra"))
    wide = per.agg(F.coalesce(F.sum("extra"), F.lit(0)).alias("m0"))
    return _stack_rows(wide, [("duplicates", "m0 = 0", SEVERITY["duplicates"], "customer_id", "duplicates_count", "m0")])


def aggregate_checks(df: DataFrame, as_of: str | None = None, only=None) -> DataFrame:
    """V1, V4, V5, V6, V8 in one aggregate pass (partial sums per task, one
    row a task shuffled) and V2 by its own grouping; ``only`` names the
    checks to compute."""
    wanted = CHECK_ORDER if only is None else only
    checks = [c for c in _checks(df, as_of) if c.name in wanted]
    dup = check_duplicates(df) if "duplicates" in wanted and "customer_id" in df.columns else None
    if not checks:
        return dup if dup is not None else check_data_types(df.select())
    aggs, rows = [], []
    for ch in checks:
        names = []
        for col, metric, expr in ch.metrics:
            names.append(f"m{len(aggs)}")
            aggs.append(f"{expr} AS m{len(aggs)}")
        passed = ch.passed(names)
        for (col, metric, _), n in zip(ch.metrics, names):
            rows.append((ch.name, passed, SEVERITY[ch.name], col, metric, n))
    out = _stack_rows(df.agg(*[F.expr(a) for a in aggs]), rows)
    return out if dup is None else out.unionByName(dup)


def check_data_types(df: DataFrame) -> DataFrame:
    """V3: schema inspection (int family / float family), one row per column;
    value 1 when the type matches."""
    spark = df.sparkSession
    rows = []
    for c, fam in EXPECTED_TYPES.items():
        if c in df.columns:
            dt = df.schema[c].dataType
            ok = isinstance(dt, _INT_TYPES) if fam == "int" else isinstance(dt, _FLOAT_TYPES)
            rows.append((c, dt.simpleString(), float(ok)))
    if not rows:
        return spark.createDataFrame([], "check string, passed boolean, severity string, column string, "
                                         "metric string, value double")
    all_ok = all(r[2] == 1.0 for r in rows)
    return spark.createDataFrame(
        [("data_types", all_ok, SEVERITY["data_types"], c, f"type_ok:{t}", v) for c, t, v in rows],
        "check string, passed boolean, severity string, column string, metric string, value double")


def check_outliers(df: DataFrame, exact: bool = True) -> DataFrame:
    """V7: IQR fences (Q1 − 1.5·IQR, Q3 + 1.5·IQR), strict comparisons,
    count and percentage per column; always passes (informative).  One
    quantile job (one row), then the fences enter one counting pass as
    literals."""
    cols = [c for c in OUTLIER_COLUMNS if c in df.columns]
    if not cols:
        return check_data_types(df.select()).limit(0)
    qrow = quantile_row(df, cols, [0.25, 0.75], exact=exact).first()
    aggs = ["count(1) AS _n"]
    for c in cols:
        q1, q3 = qrow[qname(c, 0.25)], qrow[qname(c, 0.75)]
        if q1 is None or q3 is None:
            aggs.append(f"CAST(0 AS BIGINT) AS o_{c}")
            continue
        iqr = f"(CAST({q3!r} AS DOUBLE) - CAST({q1!r} AS DOUBLE))"
        lo = f"(CAST({q1!r} AS DOUBLE) - {IQR_FACTOR!r}D * {iqr})"
        hi = f"(CAST({q3!r} AS DOUBLE) + {IQR_FACTOR!r}D * {iqr})"
        aggs.append(f"count_if({_q(c)} < {lo} OR {_q(c)} > {hi}) AS o_{c}")
    wide = df.agg(*[F.expr(a) for a in aggs])
    rows = []
    for c in cols:
        rows.append(("outliers", "TRUE", SEVERITY["outliers"], c, "outlier_count", f"o_{c}"))
        rows.append(("outliers", "TRUE", SEVERITY["outliers"], c, "outlier_pct",
                     f"try_divide(CAST(o_{c} AS DOUBLE), CAST(_n AS DOUBLE)) * 100.0D"))
    rows.append(("outliers", "TRUE", SEVERITY["outliers"], None, "total_outliers",
                 " + ".join(f"o_{c}" for c in cols)))
    return _stack_rows(wide, rows)


def run_all_checks(df: DataFrame, as_of: str | None = None, exact: bool = True) -> DataFrame:
    """Union of every check's rows (V1–V8)."""
    return (aggregate_checks(df, as_of)
            .unionByName(check_data_types(df))
            .unionByName(check_outliers(df, exact)))


def validation_summary(checks: DataFrame, input_rows: DataFrame | None = None) -> DataFrame:
    """V9: counters over checks.  A passing check counts as passed; a
    failing one as failed or warning by severity; outliers always count as
    a warning.  The gate passes iff no check failed and the input had rows."""
    per = checks.groupBy("check").agg(F.bool_and("passed").alias("ok"), F.first("severity").alias("sev"))
    is_warn_always = F.col("check") == "outliers"
    s = per.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(~is_warn_always & F.col("ok")).alias("passed"),
        F.count_if(~is_warn_always & ~F.col("ok") & (F.col("sev") == "fail")).alias("failed"),
        F.count_if(is_warn_always | (~F.col("ok") & (F.col("sev") == "warning"))).alias("warnings"),
    )
    if input_rows is not None:
        n = input_rows.agg(F.count(F.lit(1)).alias("input_rows"))
        s = with_one_row(s, n)
    else:
        s = s.withColumn("input_rows", F.lit(None).cast("bigint"))
    return s.withColumn("success", (F.col("failed") == 0) & F.coalesce(F.col("input_rows") > 0, F.lit(True)))


def validation_report(checks: DataFrame, summary: DataFrame, as_of: str) -> DataFrame:
    """One nested record — summary counters plus an array of checks,
    each with a metric map.  The array is bounded by the number of checks."""
    per = (checks.groupBy("check", "severity")
           .agg(F.bool_and("passed").alias("passed"),
                F.map_from_entries(F.collect_list(F.struct(
                    F.concat_ws(".", F.coalesce("column", F.lit("*")), "metric"), "value"))).alias("details")))
    by_name = lambda a, b: F.when(a["check"] < b["check"], -1).when(a["check"] > b["check"], 1).otherwise(0)
    arr = per.agg(F.array_sort(F.collect_list(F.struct("check", "passed", "severity", "details")), by_name)
                  .alias("checks"))
    return with_one_row(summary, arr).select(F.lit(as_of).alias("timestamp"), "*")


# --------------------------------------------------------------------------
# V10 — clean / quarantine split


def row_reasons(df: DataFrame) -> Column:
    """Array of row-level rule violations (missing critical value, value out
    of range, category not allowed)."""
    reasons = []
    for c in CRITICAL_COLUMNS:
        if c in df.columns:
            reasons.append(F.when(_missing(df, c), F.lit(f"missing:{c}")))
    for c, (lo, hi) in VALUE_RANGES.items():
        if c in df.columns:
            v = F.col(c)
            reasons.append(F.when(((v < lo) | (v > hi)) & _not_nan(df, c), F.lit(f"range:{c}")))
    for c, allowed in ALLOWED_VALUES.items():
        if c in df.columns:
            reasons.append(F.when(~F.coalesce(F.col(c).isin(allowed), F.lit(False)), F.lit(f"category:{c}")))
    return F.filter(F.array(*reasons), lambda x: x.isNotNull())


# copies of one distinct row produced by one generated row (quarantine split)
COPY_CHUNK = 1 << 16


def _with_reasons(df: DataFrame, cols, dup) -> DataFrame:
    reasons = F.array_union(row_reasons(df), F.when(dup, F.array(F.lit("duplicate"))).otherwise(F.array().cast("array<string>")))
    return df.select(*cols, (F.size(reasons) > 0).alias("quarantined"), reasons.alias("reasons"))


def _copies_marked(df: DataFrame, cols, first: DataFrame, key: str | None) -> DataFrame:
    """Rows of repeated ids: identical rows are collapsed with a count, the
    smallest row of an id is its first, and copies are re-expanded from the
    count in chunks of at most COPY_CHUNK that a shuffle spreads over tasks."""
    distinct = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_mult"))
    j = distinct.join(first, key) if key else with_one_row(distinct, first)
    j = j.withColumn("_is_first", F.coalesce(F.col("_first") == F.struct(*cols), F.lit(False)))
    n_chunks = F.ceil(F.col("_mult") / F.lit(COPY_CHUNK)).cast("int")
    chunked = j.select(*cols, "_is_first", "_mult", F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("_chunk"))
    spread = chunked.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols, "_chunk")
    size = F.least(F.lit(COPY_CHUNK).cast("bigint"), F.col("_mult") - F.col("_chunk").cast("bigint") * F.lit(COPY_CHUNK)).cast("int")
    expanded = spread.select(*cols, "_is_first", "_chunk", F.posexplode(F.array_repeat(F.lit(True), size)).alias("_copy", "_x"))
    return _with_reasons(expanded, cols, ~(F.col("_is_first") & (F.col("_chunk") == 0) & (F.col("_copy") == 0)))


def quarantine_split(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """Every input row once, with ``quarantined`` and ``reasons``.

    Duplicates: the first row per key (smallest full row) stays; further
    copies go to quarantine with reason ``duplicate``.  Ids that occur once
    need no comparison, so only the rows of repeated ids (found by a
    map-side combined count) are grouped by their columns.  Rows without an
    id form one group, whose smallest row is a global aggregate, not a join.
    """
    cols = df.columns
    known, unknown = df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())
    repeated = known.groupBy(key).count().filter("count > 1").select(key)
    once = _with_reasons(known.join(repeated, key, "left_anti").select(*cols), cols, F.lit(False))
    many = known.join(repeated, key, "left_semi").select(*cols)
    smallest = F.min(F.struct(*cols)).alias("_first")
    return (once.unionByName(_copies_marked(many, cols, many.groupBy(key).agg(smallest), key))
            .unionByName(_copies_marked(unknown, cols, unknown.agg(smallest), None)))


# --------------------------------------------------------------------------
# S16 — scoring-request constraints

REQUEST_BOUNDS = {
    "tenure_months": (0, 100),
    "monthly_charges": (0, 200),
    "total_charges": (0, None),
    "senior_citizen": (0, 1),
}
REQUEST_CATEGORIES = {
    "contract_type": ALLOWED_VALUES["contract_type"],
    "payment_method": ALLOWED_VALUES["payment_method"],
    "internet_service": ALLOWED_VALUES["internet_service"],
    "phone_service": ALLOWED_VALUES["phone_service"],
    "online_security": ALLOWED_VALUES["online_security"],
    "tech_support": ALLOWED_VALUES["tech_support"],
}
REQUEST_FIELDS = ["customer_id", "tenure_months", "monthly_charges", "total_charges", "contract_type",
                  "payment_method", "internet_service", "phone_service", "online_security", "tech_support",
                  "senior_citizen"]


def _value_violations() -> list:
    """Bounds and categories of present values, null where kept."""
    rs = []
    for c, (lo, hi) in REQUEST_BOUNDS.items():
        v = F.col(c)
        cond = v < lo if hi is None else (v < lo) | (v > hi)
        rs.append(F.when(cond, F.lit(f"range:{c}")))
    for c, allowed in REQUEST_CATEGORIES.items():
        rs.append(F.when(F.col(c).isNotNull() & ~F.col(c).isin(allowed), F.lit(f"category:{c}")))
    return rs


def request_validation(requests: DataFrame) -> DataFrame:
    """Typed request rows → valid flag + ordered list of violations
    (required field missing, bound violated, category not allowed)."""
    rs = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in REQUEST_FIELDS] + _value_violations()
    reasons = F.filter(F.array(*rs), lambda x: x.isNotNull())
    return requests.select(*REQUEST_FIELDS, (F.size(reasons) == 0).alias("valid"),
                           F.array_join(reasons, ",").alias("reasons"))


REQUEST_TYPES = {c: "int" if c in ("tenure_months", "senior_citizen") else "float" if c in ("monthly_charges", "total_charges") else "str"
                 for c in REQUEST_FIELDS}


def json_requests(texts: DataFrame, json_col: str = "json", keep=()) -> DataFrame:
    """Requests as JSON text → ``keep`` columns, typed fields, valid flag
    and ordered violations.

    Text that is no JSON object gives "json" alone.  A field that is absent
    is "missing"; one that can't be read as its type, null included, is
    "type" and stays null: whole numbers take integers, numbers without a
    fraction and strings of either; numbers take numbers and strings of them;
    strings take strings only.  Unknown fields are ignored.  Then bounds and
    categories hold as for typed rows."""
    x = texts.select(*keep, F.try_parse_json(F.col(json_col)).alias("_v"))
    whole = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    x = x.withColumn("_v", F.when(whole, F.col("_v")))

    def field(c: str):
        raw = F.expr(f"try_variant_get(_v, '$.{c}', 'variant')")
        kind, text, number = F.schema_of_variant(raw), F.expr(f"try_variant_get(_v, '$.{c}', 'string')"), F.expr(f"try_variant_get(_v, '$.{c}', 'double')")
        is_number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
        if REQUEST_TYPES[c] == "str":
            value = F.when(kind == "STRING", text)
        elif REQUEST_TYPES[c] == "float":
            read = F.trim(text).try_cast("double")
            value = F.when(is_number, number).when((kind == "STRING") & ~F.isnan(read), read)
        else:
            digits = F.regexp_extract(text, r"^\s*([+-]?[0-9]{1,18})(?:\.0*)?\s*$", 1)
            value = (F.when(kind == "BIGINT", F.expr(f"try_variant_get(_v, '$.{c}', 'bigint')"))
                     .when(is_number & (number == F.floor(number)), number.cast("bigint"))
                     .when((kind == "STRING") & (digits != ""), digits.cast("bigint")))
        return raw.isNull(), value

    got = {c: field(c) for c in REQUEST_FIELDS}
    x = x.select(*keep, F.col("_v").isNull().alias("_broken"), *[v.alias(c) for c, (_, v) in got.items()],
                 *[absent.alias(f"_absent_{c}") for c, (absent, _) in got.items()])
    rs = ([F.when(F.col(f"_absent_{c}"), F.lit(f"missing:{c}")) for c in REQUEST_FIELDS]
          + [F.when(~F.col(f"_absent_{c}") & F.col(c).isNull(), F.lit(f"type:{c}")) for c in REQUEST_FIELDS] + _value_violations())
    reasons = F.when(F.col("_broken"), F.array(F.lit("json"))).otherwise(F.filter(F.array(*rs), lambda r: r.isNotNull()))
    return x.select(*keep, *REQUEST_FIELDS, (F.size(reasons) == 0).alias("valid"), F.array_join(reasons, ",").alias("reasons"))


def categorical_invalid_values(df: DataFrame) -> DataFrame:
    """V5 detail: one row per (column, distinct invalid value) with its
    count — the reference's list of unique invalid values, kept as rows so
    no list of unbounded length is built."""
    cols = [c for c in ALLOWED_VALUES if c in df.columns]
    args = ", ".join(f"'{c}', `{c}`, NOT coalesce(`{c}` IN ({', '.join(repr(v) for v in ALLOWED_VALUES[c])}), FALSE)"
                     for c in cols)
    long = df.select(F.expr(f"stack({len(cols)}, {args}) AS (`column`, invalid_value, bad)"))
    return (long.filter("bad").groupBy("column", "invalid_value")
            .agg(F.count(F.lit(1)).alias("n")))
