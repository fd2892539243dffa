"""Generic statistical aggregates, most of them single-pass ``agg`` plans.

They compile to a partial + final hash aggregate (one shuffle of
pre-aggregated rows); exact quantiles take a few such passes
(``selection``).  Many-column results (correlations) unnest
each row into (pair, x, y) records inside the task and run one grouped
aggregate, never one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.selection import mode, quantiles

R = 6  # fixed rounding of floating results (stable across engines)


def rnd(c: Column, digits: int = R) -> Column:
    return F.round(c, digits)


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max (pandas describe);
    the quartiles by ``selection.quantiles``."""
    c = F.col(col)
    plain = df.agg(F.count(c).alias("count"), rnd(F.avg(c)).alias("mean"), rnd(F.stddev_samp(c)).alias("std"),
                   F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"))
    q = quantiles(df, col, (0.25, 0.5, 0.75), ("p25", "p50", "p75"))
    return plain.crossJoin(F.broadcast(q)).select(  # one row each
        "count", "mean", "std", "min", rnd(F.col("p25")).alias("p25"), rnd(F.col("p50")).alias("p50"),
        rnd(F.col("p75")).alias("p75"), "max")


def median_mode(df: DataFrame, col: str) -> DataFrame:
    """Median and the smallest most frequent value (pandas ``mode()[0]``)."""
    q = quantiles(df, col, (0.5,), ("median",)).select(rnd(F.col("median")).alias("median"))
    return q.crossJoin(F.broadcast(mode(df, col)))  # one row each


def conditional_stats(df: DataFrame, col: str, cond: Column, scale: float = 60.0) -> DataFrame:
    """Mean / sample std overall and where ``cond``, in ``col/scale`` units,
    plus the share of rows meeting ``cond``."""
    c = F.col(col)
    cc = F.when(cond, c)
    return df.agg(
        F.count(c).alias("n"),
        rnd(F.avg(c) / scale).alias("mean_all"),
        rnd(F.avg(cc) / scale).alias("mean_cond"),
        rnd(F.stddev_samp(c) / scale).alias("std_all"),
        rnd(F.stddev_samp(cc) / scale).alias("std_cond"),
        rnd(F.count(cc) * 100.0 / F.count(c)).alias("pct_cond"),
    )


def five_numbers(df: DataFrame, col: str, group: Column) -> DataFrame:
    """Boxplot numbers (min, q1, median, q3, max) per class."""
    names = ["min", "q1", "median", "q3", "max"]
    q = quantiles(df.withColumn("class", group), col, (0.0, 0.25, 0.5, 0.75, 1.0), names, ["class"])
    return q.select("class", "n", *[rnd(F.col(n)).alias(n) for n in names])


def span(df: DataFrame, ts: str) -> DataFrame:
    c = F.col(ts)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(c).alias("first_ts"), F.max(c).alias("last_ts"),
                  F.count_distinct(F.to_date(c)).alias("n_days"))


def levels(df: DataFrame, col: str) -> DataFrame:
    c = F.col(col).cast("string")
    return df.agg(F.count_distinct(c).alias("n_levels"), F.sort_array(F.collect_set(c)).alias("levels"))


def right_closed_bins(x: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut``: (lo, hi] bins with labels; outside -> NULL."""
    out = F.lit(None).cast("string")
    for lo, hi, lab in reversed(list(zip(edges[:-1], edges[1:], labels))):
        out = F.when((x > lo) & (x <= hi), F.lit(lab)).otherwise(out)
    return out


def bin_shares(df: DataFrame, x: Column, edges, labels) -> DataFrame:
    """Counts and % per bin, share over rows that fall into a bin."""
    from pyspark.sql import Window
    b = df.select(right_closed_bins(x, edges, labels).alias("bin")).where(F.col("bin").isNotNull())
    g = b.groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    # window over the (bounded, len(labels)-row) aggregate, not over rows
    return g.withColumn("pct", rnd(F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy())))


def equal_width_histogram(df: DataFrame, col: str, n_bins: int, by: Column | None = None) -> DataFrame:
    """Equal-width bins between the column's min and max (max -> last bin)."""
    c = F.col(col)
    stats = df.select(F.min(c).alias("lo"), F.max(c).alias("hi"))
    lo, hi = stats.select("lo").scalar(), stats.select("hi").scalar()
    width = (hi - lo) / F.lit(float(n_bins))
    # a constant column has one bin
    bucket = F.least(F.floor(F.coalesce(F.try_divide(c - lo, width), F.lit(0.0))) + 1, F.lit(n_bins)).cast("int")
    keys = [bucket.alias("bucket")] + ([by.alias("class")] if by is not None else [])
    out = (df.where(c.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("count")))
    return out.withColumn("lower", rnd(lo + (F.col("bucket") - 1) * width))


def _pairwise_corr(df: DataFrame, pairs: Sequence[tuple[str, str]], flag: Column) -> DataFrame:
    """(var_a, var_b, c0, c1): correlation of each pair where ``flag`` is 0 and
    1.  One pass with a mergeable co-moment buffer per pair and group; rows are
    not multiplied.  Rows with a null in a pair don't count for that pair, and
    a constant column has no correlation (null)."""
    used = list(dict.fromkeys(c for p in pairs for c in p))
    rows = df.select(flag.alias("g"), *[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(used)])
    x = {c: F.col(f"_c{i}") for i, c in enumerate(used)}

    def corr(a, b):  # ``F.corr`` fails on a constant column
        var = [F.var_pop(F.when(other.isNotNull(), own)) for own, other in ((a, b), (b, a))]
        return F.try_divide(F.covar_pop(a, b), F.sqrt(var[0]) * F.sqrt(var[1]))

    wide = rows.groupBy("g").agg(*[corr(x[a], x[b]).alias(f"_r{k}") for k, (a, b) in enumerate(pairs)])
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("var_a"), F.lit(b).alias("var_b"), F.col(f"_r{k}").alias("c"))
                               for k, (a, b) in enumerate(pairs)])).alias("r")
    long = wide.select("g", each).select("g", "r.*")  # a row a pair and group
    return long.groupBy("var_a", "var_b").agg(F.max(F.when(F.col("g") == 0, F.col("c"))).alias("c0"),
                                              F.max(F.when(F.col("g") == 1, F.col("c"))).alias("c1"))


def corr_with_target(df: DataFrame, features: Sequence[str], target: str, flag: Column) -> DataFrame:
    """Pearson correlation of each feature with ``target`` separately where
    ``flag`` is 0 and 1, and their difference."""
    w = _pairwise_corr(df, [(f, target) for f in features], flag)
    return w.select(F.col("var_a").alias("feature"), rnd(F.col("c0")).alias("corr_without"),
                    rnd(F.col("c1")).alias("corr_with"), rnd(F.col("c1") - F.col("c0")).alias("difference"))


def corr_matrix(df: DataFrame, cols: Sequence[str], flag: Column) -> DataFrame:
    """Full correlation matrix per group (flag 0 / 1) and their difference
    (each unordered pair computed once, mirrored)."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    w = _pairwise_corr(df, pairs, flag)
    # mirror inside each (tiny) result row instead of re-reading the result
    both = F.explode(F.array(F.struct(F.col("var_a").alias("a"), F.col("var_b").alias("b")),
                             F.struct(F.col("var_b").alias("a"), F.col("var_a").alias("b"))))
    mirrored = (w.select(both.alias("p"), "c0", "c1")
                .select(F.col("p.a").alias("var_a"), F.col("p.b").alias("var_b"), "c0", "c1")
                .dropDuplicates(["var_a", "var_b"]))  # the diagonal appears twice
    return mirrored.select("var_a", "var_b", rnd(F.col("c0")).alias("corr_without"),
                           rnd(F.col("c1")).alias("corr_with"), rnd(F.col("c1") - F.col("c0")).alias("difference"))
