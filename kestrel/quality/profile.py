"""Data-quality checks: column profile with IQR outliers, uniqueness,
required fields, completeness KPI, volume anomalies, schema drift, feature
jumps.  Profiles run over the long (column, value) form so every column is
profiled by the same single aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: rows, missing, % missing, distinct, min, max, mean, and
    IQR outliers (below q1 - 1.5 IQR or above q3 + 1.5 IQR)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value"))
                                         for c in cols])).alias("kv")).select("kv.*")
    from kestrel.operators.ordering import exact_quantiles
    stats = long.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("value").isNull()).alias("n_missing"),
        F.count_distinct("value").alias("n_distinct"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.round(F.avg("value"), 6).alias("mean"))
    # quartiles from per-(column, value) counts: a high-cardinality column
    # (an id, an amount) never has its distinct values gathered in one task
    quart = exact_quantiles(long, "value", [0.25, 0.75], ["q1", "q3"], group=["column_name"])
    stats = stats.join(quart, "column_name", "left")
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    out = long.join(F.broadcast(stats.select("column_name", "q1", "q3")), "column_name") \
        .groupBy("column_name").agg(F.count_if((F.col("value") < lo) | (F.col("value") > hi)).alias("n_outliers"))
    return stats.join(out, "column_name").select(
        "column_name", "n", "n_missing", F.round(F.col("n_missing") * 100.0 / F.col("n"), 6).alias("pct_missing"),
        "n_distinct", "min", "max", "mean", F.round("q1", 6).alias("q1"), F.round("q3", 6).alias("q3"), "n_outliers")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier identical row."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
    return g.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("n_duplicate_rows"))


def non_unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def required_fields(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Add ``missing_fields`` (names of NULL mandatory fields) and ``is_valid``;
    invalid rows are the quarantine."""
    missing = F.filter(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return df.withColumn("missing_fields", missing).withColumn("is_valid", F.size("missing_fields") == 0)


def completeness_kpi(valid_flags: Sequence[Column], min_valid: int, targets=(0.92, 0.97, 0.99)) -> list[Column]:
    """Aggregate expressions: share of records with >= ``min_valid`` valid
    fields, and whether each target is met."""
    n_valid = sum((f.cast("int") for f in valid_flags), F.lit(0))
    share = F.avg((n_valid >= min_valid).cast("int"))
    out = [F.count(F.lit(1)).alias("n_records"), F.round(share * 100, 6).alias("pct_complete")]
    out += [(share >= t).alias(f"meets_{int(round(t * 100))}") for t in targets]
    return out


def volume_anomaly(daily: DataFrame, day: str, value: str, lookback: int = 7, min_days: int = 3,
                   low: float = 0.5, high: float = 2.0) -> DataFrame:
    """Daily value vs the mean of the previous ``lookback`` calendar days
    (current excluded, at least ``min_days`` of them).  ``daily`` is already
    aggregated per day (bounded by the calendar), so the frame runs over days."""
    dn = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    w = Window.orderBy("_dn").rangeBetween(-lookback, -1)
    d = daily.withColumn("_dn", dn)
    d = d.withColumns({"trailing_mean": F.avg(value).over(w), "_k": F.count(value).over(w)})
    ratio = F.when(F.col("_k") >= min_days, F.col(value) / F.col("trailing_mean"))
    return d.select(day, value, F.round("trailing_mean", 6).alias("trailing_mean"), F.round(ratio, 6).alias("ratio"),
                    F.coalesce((ratio < low) | (ratio > high), F.lit(False)).alias("anomaly"))


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def schema_drift(spark, old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns added / removed / retyped between two schemas (metadata only)."""
    a = spark.createDataFrame(schema_rows(old), "column_name string, old_type string")
    b = spark.createDataFrame(schema_rows(new), "column_name string, new_type string")
    j = a.join(b, "column_name", "full_outer")
    change = (F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed")
              .when(F.col("old_type") != F.col("new_type"), "retyped"))
    return j.select("column_name", "old_type", "new_type", change.alias("change")).where(F.col("change").isNotNull())


def feature_jump(df: DataFrame, ts: str, value: str, factor: float = 2.0) -> DataFrame:
    """Weekly mean of a feature and its ratio to the previous week."""
    wk = df.groupBy(F.date_trunc("week", ts).cast("date").alias("week")).agg(F.avg(value).alias("mean_value"))
    w = Window.orderBy("week")
    ratio = F.col("mean_value") / F.lag("mean_value").over(w)
    return wk.select("week", F.round("mean_value", 6).alias("mean_value"), F.round(ratio, 6).alias("ratio"),
                     F.coalesce(ratio >= factor, F.lit(False)).alias("jump"))
