"""Feature engineering.

The row path is one lazy projection.  Fitted state — the p75 threshold,
label-encoder codes and scaler moments — is computed by small aggregate jobs
into parameter tables (S12) that can be written, re-read and applied to new
data without refitting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import flag, right_closed_bucket, weighted_sum
from .stats import prefix_sum, qname, quantile_row, with_one_row

# Fixed values (feature definitions of the reference).
SERVICE_COLUMNS = ["online_security", "online_backup", "device_protection", "tech_support",
                   "streaming_tv", "streaming_movies"]
TENURE_EDGES = [0, 12, 24, 48, 100]
TENURE_LABELS = ["0-1yr", "1-2yr", "2-4yr", "4yr+"]
CATEGORICAL_COLUMNS = ["contract_type", "payment_method", "internet_service", "phone_service", "multiple_lines",
                       "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv",
                       "streaming_movies", "paperless_billing", "partner", "dependents", "tenure_group"]
NUMERICAL_COLUMNS = ["tenure_months", "monthly_charges", "total_charges", "avg_monthly_spend",
                     "charges_to_tenure_ratio", "total_services", "risk_score"]
FEATURE_COLUMNS = [
    "tenure_months", "monthly_charges", "total_charges", "avg_monthly_spend", "charges_to_tenure_ratio",
    "total_services", "risk_score", "senior_citizen", "is_new_customer", "is_loyal_customer", "high_spender",
    "has_premium_services", "high_risk_contract", "risky_payment", "no_protection", "has_phone_internet",
    "paperless_engaged", "online_security_yes", "online_backup_yes", "device_protection_yes", "tech_support_yes",
    "streaming_tv_yes", "streaming_movies_yes", "contract_type_encoded", "payment_method_encoded",
    "internet_service_encoded", "phone_service_encoded",
]
LABEL = "churned"
ID = "customer_id"
HIGH_SPENDER_QUANTILE = 0.75


def p75_params(df: DataFrame, exact: bool = True) -> DataFrame:
    """One-row parameter table with the monthly-charges p75."""
    return quantile_row(df, ["monthly_charges"], [HIGH_SPENDER_QUANTILE], exact=exact)


def p75_value(df: DataFrame, exact: bool = True) -> float | None:
    """F3 threshold as a driver-side number (one aggregate job, one row)."""
    return p75_params(df, exact).first()[0]


def business_features(df: DataFrame, p75: float | None = None, exact: bool = True) -> DataFrame:
    """F1–F20 as one projection.  ``p75`` is the fitted threshold (fitted on
    this frame when not given); it enters the plan as a literal, like the
    fitted state of any ``pyspark.ml`` model."""
    if p75 is None:
        p75 = p75_value(df, exact)
    ten, mon, tot = F.col("tenure_months"), F.col("monthly_charges"), F.col("total_charges")
    yes = {c: flag(F.col(c) == "Yes") for c in SERVICE_COLUMNS}
    total_services = None
    for c in SERVICE_COLUMNS:
        total_services = yes[c] if total_services is None else total_services + yes[c]
    new = flag(ten <= 6)
    hrc = flag(F.col("contract_type") == "Month-to-month")
    risky = flag(F.col("payment_method") == "Electronic check")
    noprot = flag((F.col("online_security") == "No") & (F.col("tech_support") == "No"))
    return df.withColumns({
        "avg_monthly_spend": tot / (ten + 1),
        "charges_to_tenure_ratio": mon / (ten + 1),
        "high_spender": flag(mon > F.lit(p75).cast("double")),
        "is_new_customer": new,
        "is_loyal_customer": flag(ten >= 36),
        "tenure_group": right_closed_bucket(ten, TENURE_EDGES, TENURE_LABELS),
        **{f"{c}_yes": yes[c] for c in SERVICE_COLUMNS},
        "total_services": total_services,
        "has_premium_services": flag(total_services >= 4),
        "high_risk_contract": hrc,
        "risky_payment": risky,
        "no_protection": noprot,
        "has_phone_internet": flag((F.col("phone_service") == "Yes") & (F.col("internet_service") != "No")),
        "paperless_engaged": flag(F.col("paperless_billing") == "Yes"),
        "risk_score": weighted_sum([(0.3, new == 1), (0.25, hrc == 1), (0.15, risky == 1), (0.15, noprot == 1),
                                    (0.15, total_services == 0)]),
    })


# --------------------------------------------------------------------------
# label encoder

def _as_label(c: str) -> F.Column:
    """String form used for encoding: missing buckets become 'nan' (pandas
    categorical), other missing strings 'None'."""
    v = F.col(c).cast("string")
    return F.coalesce(v, F.lit("nan" if c == "tenure_group" else "None"))


def _sql_label(c: str) -> str:
    return f"coalesce(CAST(`{c}` AS STRING), '{'nan' if c == 'tenure_group' else 'None'}')"


def fit_label_encoders(df: DataFrame, columns=None) -> DataFrame:
    """Parameter table (column, value, code): codes 0..n−1 in lexicographic
    (UTF-8) order of the string form, per column.  Distinct values are found
    with a partial aggregate and ranked by the distributed prefix sum, so no
    task or driver holds a column's domain; the table is written."""
    from ..session import materialize
    cols = [c for c in (columns or CATEGORICAL_COLUMNS) if c in df.columns]
    args = ", ".join(f"'{c}', {_sql_label(c)}" for c in cols)
    long = df.select(F.expr(f"stack({len(cols)}, {args}) AS (`column`, `value`)"))
    distinct = long.groupBy("column", "value").agg(F.lit(1).alias("one"))
    ranked = prefix_sum(distinct, ["column"], ["value"], ["one"])
    return materialize(ranked.select("column", "value", (F.col("one_cum") - 1).cast("int").alias("code")))


#: Codes and characters of a parameter table up to which it travels as maps.
MAP_CODES, MAP_CHARS = 20_000, 1_000_000


def apply_label_encoders(df: DataFrame, params: DataFrame, columns=None, unseen: int = -1, map_codes: int = MAP_CODES) -> DataFrame:
    """Add ``<col>_encoded`` from the stored parameter table; a value not seen
    at fit time gets ``unseen``.  A table of at most ``map_codes`` codes (its
    size is measured) becomes one row with a map per column, looked up in the
    projection; a larger one is joined column by column."""
    cols = [c for c in (columns or CATEGORICAL_COLUMNS) if c in df.columns]
    mine = params.filter(F.col("column").isin(cols))
    codes, chars = mine.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("value")), F.lit(0))).first()
    if codes > map_codes or chars > MAP_CHARS:
        return _join_label_encoders(df, mine, cols, unseen)
    maps = mine.agg(*[F.map_from_entries(F.collect_list(F.when(F.col("column") == c, F.struct("value", "code")))).alias(f"_m_{c}") for c in cols])
    return with_one_row(df, maps).withColumns({
        f"{c}_encoded": F.coalesce(F.try_element_at(f"_m_{c}", _as_label(c)), F.lit(unseen)).cast("int") for c in cols}).drop(*maps.columns)


def _join_label_encoders(df: DataFrame, params: DataFrame, cols, unseen: int) -> DataFrame:
    out = df
    for c in cols:
        p = params.filter(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"{c}_encoded"))
        out = (out.join(p, _as_label(c) == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
               .withColumn(f"{c}_encoded", F.coalesce(F.col(f"{c}_encoded"), F.lit(unseen)).cast("int")))
    return out


# --------------------------------------------------------------------------
# standard scaler with population std

def fit_scaler(df: DataFrame, columns=None) -> DataFrame:
    """Parameter table (column, mean, std): population std; a zero std is
    stored as 1 so the transform divides by 1 (scikit-learn behaviour)."""
    cols = [c for c in (columns or NUMERICAL_COLUMNS) if c in df.columns]
    aggs = []
    for c in cols:
        v = F.col(c).cast("double")
        aggs += [F.avg(v).alias(f"m_{c}"), F.stddev_pop(v).alias(f"s_{c}")]
    row = df.agg(*aggs)
    args = ", ".join(f"'{c}', m_{c}, s_{c}" for c in cols)
    return row.select(F.expr(f"stack({len(cols)}, {args}) AS (`column`, mean, std_raw)")).select(
        "column", "mean", F.when((F.col("std_raw") == 0) | F.col("std_raw").isNull(), F.lit(1.0))
        .otherwise(F.col("std_raw")).alias("std"))


def collect_scaler(params: DataFrame) -> dict[str, tuple[float, float]]:
    """``{column: (mean, std)}`` — one row per scaled column."""
    return {r["column"]: (r["mean"], r["std"]) for r in params.collect()}


def apply_scaler(df: DataFrame, params, columns=None) -> DataFrame:
    """Replace each column by (x − mean) / std with the fitted moments as
    literals (``params``: dict or the parameter table)."""
    if isinstance(params, DataFrame):
        params = collect_scaler(params)
    cols = [c for c in (columns or NUMERICAL_COLUMNS) if c in df.columns and c in params]
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(params[c][0]).cast("double"))
                           / F.lit(params[c][1]).cast("double") for c in cols})


# --------------------------------------------------------------------------
# assembly (F25–F27)

def select_features(df: DataFrame, with_id: bool = True, with_label: bool = True) -> DataFrame:
    """id + the 27 model features in their fixed order + label;
    columns absent from the input are skipped (keep-if-present)."""
    cols = ([ID] if with_id and ID in df.columns else []) + [c for c in FEATURE_COLUMNS if c in df.columns]
    if with_label and LABEL in df.columns:
        cols.append(LABEL)
    return df.select(*cols)


class FeatureModel:
    """Fitted state of the feature pipeline: the p75 threshold and the scaler
    moments (a few numbers, literals in plans) and the label-encoder codes (a
    stored table that transforms join); ``save``/``load`` persist all three as
    parameter tables (S12)."""

    def __init__(self, p75: float | None, encoders: DataFrame, scaler: dict):
        self.p75, self.encoders, self.scaler = p75, encoders, scaler

    @classmethod
    def fit(cls, raw: DataFrame, exact: bool = True) -> "FeatureModel":
        p75 = p75_value(raw, exact)
        biz = business_features(raw, p75)
        enc = fit_label_encoders(biz)
        return cls(p75, enc, collect_scaler(fit_scaler(apply_label_encoders(biz, enc))))

    def transform(self, raw: DataFrame, scale: bool = True) -> DataFrame:
        x = business_features(raw, self.p75)
        x = apply_label_encoders(x, self.encoders)
        if scale:
            x = apply_scaler(x, self.scaler)
        return x

    def tables(self, spark):
        p75 = spark.createDataFrame([(self.p75,)], f"{qname('monthly_charges', HIGH_SPENDER_QUANTILE)} double")
        sc = spark.createDataFrame([(c, m, s) for c, (m, s) in self.scaler.items()],
                                   "column string, mean double, std double")
        return p75, self.encoders, sc

    def save(self, path: str) -> None:
        """Parameter tables as parquet under one folder."""
        from pyspark.sql import SparkSession
        p75, enc, sc = self.tables(SparkSession.getActiveSession())
        p75.write.mode("overwrite").parquet(f"{path}/p75")
        enc.write.mode("overwrite").parquet(f"{path}/label_encoders")
        sc.write.mode("overwrite").parquet(f"{path}/scaler")

    @classmethod
    def load(cls, spark, path: str) -> "FeatureModel":
        p75 = spark.read.parquet(f"{path}/p75").first()[0]
        return cls(p75, spark.read.parquet(f"{path}/label_encoders"), collect_scaler(spark.read.parquet(f"{path}/scaler")))


def feature_table(raw: DataFrame, model: FeatureModel | None = None, scale: bool = True) -> DataFrame:
    """customer_id + 27 features + churned."""
    model = model or FeatureModel.fit(raw)
    return select_features(model.transform(raw, scale))


def feature_summary(features: DataFrame) -> DataFrame:
    """feature count, rows, churn rate."""
    n_feat = len([c for c in FEATURE_COLUMNS if c in features.columns])
    return features.agg(F.lit(n_feat).alias("feature_count"), F.count(F.lit(1)).alias("rows"),
                        F.avg(LABEL).alias("churn_rate"))


def split_xy(features: DataFrame):
    """X = features without id and label, y = label."""
    return features.drop(ID, LABEL), features.select(LABEL)
