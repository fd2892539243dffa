"""Column drift between a reference and a current sample.

Numeric columns: two-sample Kolmogorov-Smirnov statistic with its
asymptotic p-value.  Categorical columns: Jensen-Shannon distance of level
shares (natural log).  Both are computed from per-(column, value) counts in
long form, so all monitored columns go through one aggregation and one
range-partitioned prefix sum; no column is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.ordering import running_sums

KS_TERMS = 100  # terms of the Kolmogorov series (converges long before)


def _long(df: DataFrame, cols: Sequence[str], cast: str) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(cast).alias("value"))
                                         for c in cols])).alias("kv")).select("kv.*").where(F.col("value").isNotNull())


def kolmogorov_pvalue(lam: Column) -> Column:
    """Q_KS(lambda) = 2 * sum_{j>=1} (-1)^(j-1) exp(-2 j^2 lambda^2), clipped to [0, 1].

    The series is folded with the ``aggregate`` higher-order function over
    ``sequence(1, KS_TERMS)``, keeping the expression small."""
    js = F.sequence(F.lit(1), F.lit(KS_TERMS))
    s = F.aggregate(js, F.lit(0.0), lambda acc, j: acc + F.when(j % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
                    * F.exp(F.lit(-2.0) * (j * j).cast("double") * lam * lam))
    return F.when(lam <= 0, F.lit(1.0)).otherwise(F.least(F.greatest(F.lit(2.0) * s, F.lit(0.0)), F.lit(1.0)))


def ks_columns(ref: DataFrame, cur: DataFrame, cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    r = _long(ref, cols, "double").withColumn("side", F.lit(0))
    c = _long(cur, cols, "double").withColumn("side", F.lit(1))
    counts = r.unionByName(c).groupBy("column_name", "value").agg(
        F.count_if(F.col("side") == 0).alias("n_ref"), F.count_if(F.col("side") == 1).alias("n_cur"))
    tot = counts.groupBy("column_name").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    before = Window.orderBy("column_name").rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select("column_name", "t_ref", "t_cur",
                      F.coalesce(F.sum("t_ref").over(before), F.lit(0)).alias("o_ref"),
                      F.coalesce(F.sum("t_cur").over(before), F.lit(0)).alias("o_cur"))  # one row per column
    cum = running_sums(counts, [F.col("column_name"), F.col("value")], {"c_ref": F.col("n_ref"), "c_cur": F.col("n_cur")})
    cum = cum.join(F.broadcast(offs), "column_name")
    # an empty side has no distribution: statistic and verdict are NULL
    gap = F.abs(F.try_divide(F.col("c_ref") - F.col("o_ref"), F.col("t_ref"))
                - F.try_divide(F.col("c_cur") - F.col("o_cur"), F.col("t_cur")))
    d = cum.groupBy("column_name").agg(F.max(gap).alias("_d"), F.first("t_ref").alias("n_ref"),
                                      F.first("t_cur").alias("n_cur"))
    ne = F.try_divide(F.col("n_ref") * F.col("n_cur"), F.col("n_ref") + F.col("n_cur"))
    # p-value in its own projection: the series' lambda must see the raw
    # statistic, not the rounded output column
    d = d.withColumn("_p", kolmogorov_pvalue(F.sqrt(ne) * F.col("_d")))
    return d.select("column_name", F.lit("ks").alias("test"), F.round("_d", 6).alias("statistic"),
                    F.round("_p", 6).alias("p_value"), (F.col("_p") < alpha).alias("drifted"))


def js_columns(ref: DataFrame, cur: DataFrame, cols: Sequence[str], threshold: float = 0.1) -> DataFrame:
    r = _long(ref, cols, "string").withColumn("side", F.lit(0))
    c = _long(cur, cols, "string").withColumn("side", F.lit(1))
    counts = r.unionByName(c).groupBy("column_name", "value").agg(
        F.count_if(F.col("side") == 0).alias("n_ref"), F.count_if(F.col("side") == 1).alias("n_cur"))
    tot = counts.groupBy("column_name").agg(F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur"))
    s = counts.join(F.broadcast(tot), "column_name")  # one row per column
    p, q = F.col("n_ref") / F.col("t_ref"), F.col("n_cur") / F.col("t_cur")
    m = (p + q) / 2

    def kl(a):
        return F.when(a > 0, a * F.log(a / m)).otherwise(F.lit(0.0))

    div = s.groupBy("column_name").agg((F.lit(0.5) * F.sum(kl(p)) + F.lit(0.5) * F.sum(kl(q))).alias("js"))
    dist = F.sqrt(F.greatest(F.col("js"), F.lit(0.0)))
    return div.select("column_name", F.lit("jensenshannon").alias("test"), F.round(dist, 6).alias("statistic"),
                      F.lit(None).cast("double").alias("p_value"), (dist >= threshold).alias("drifted"))


def drift_columns(ref: DataFrame, cur: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                  alpha: float = 0.05, js_threshold: float = 0.1) -> DataFrame:
    return ks_columns(ref, cur, numeric, alpha).unionByName(js_columns(ref, cur, categorical, js_threshold))


def dataset_drift(cols: DataFrame, share: float = 0.5) -> DataFrame:
    """Share of drifted columns; the dataset drifts when share >= ``share``."""
    return cols.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("drifted").alias("n_drifted")) \
        .withColumn("share_drifted", F.round(F.col("n_drifted") / F.col("n_columns"), 6)) \
        .withColumn("dataset_drift", F.col("share_drifted") >= share)


def drift_tests(cols: DataFrame, max_columns: int = 3, max_share: float = 0.1) -> DataFrame:
    """Pass when drifted columns < max_columns and their share < max_share."""
    d = dataset_drift(cols)
    a = d.select(F.lit("number_of_drifted_columns").alias("test"), F.col("n_drifted").cast("double").alias("value"),
                 F.lit(f"lt {max_columns}").alias("condition"),
                 F.when(F.col("n_drifted") < max_columns, "SUCCESS").otherwise("FAIL").alias("status"))
    b = d.select(F.lit("share_of_drifted_columns").alias("test"), F.col("share_drifted").alias("value"),
                 F.lit(f"lt {max_share}").alias("condition"),
                 F.when(F.col("share_drifted") < max_share, "SUCCESS").otherwise("FAIL").alias("status"))
    return a.unionByName(b)
