"""Evaluation as aggregations: regression metrics, quantile coverage and
pinball loss, confusion matrices, per-class reports, PR curve, average
precision, threshold selection.

Curves are built from the *score histogram* (one row per distinct score
with its positive / negative counts — a partial aggregate), then cumulated
over a global order with the range-partitioned prefix sum of
:mod:`kestrel.operators.ordering`, so no step puts all rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.operators.ordering import running_sums

R = 6


def regression_metrics(df: DataFrame, y: str, p: str, scale: float = 60.0) -> DataFrame:
    """MAE, RMSE, R² (1 - SSE/SST), mean prediction/actual; MAE and RMSE
    also in minutes.  One aggregation pass; R² of a constant target is NULL."""
    e = F.col(p) - F.col(y)
    n = F.count(F.col(y))
    sse = F.sum(e * e)
    sst = F.var_pop(y) * n  # one pass, without the cancellation of a difference of sums
    out = df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).agg(
        n.alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(sse / n).alias("rmse"),
        (F.lit(1.0) - F.try_divide(sse, sst)).alias("r2"), F.avg(p).alias("mean_prediction"), F.avg(y).alias("mean_actual"))
    return out.select("n", *[F.round(c, R).alias(c) for c in ["mae", "rmse", "r2", "mean_prediction", "mean_actual"]],
                      F.round(F.col("mae") / scale, R).alias("mae_minutes"),
                      F.round(F.col("rmse") / scale, R).alias("rmse_minutes"))


def coverage(y: Column, p: Column) -> Column:
    """Share of rows with ``actual <= predicted``."""
    return F.avg((y <= p).cast("int"))


def pinball(y: Column, p: Column, alpha: float) -> Column:
    d = y - p
    return F.avg(F.greatest(F.lit(alpha) * d, F.lit(alpha - 1.0) * d))


def confusion(df: DataFrame, y: str, yhat: Column) -> DataFrame:
    return df.groupBy(F.col(y).cast("int").alias("actual"), yhat.cast("int").alias("predicted")) \
        .agg(F.count(F.lit(1)).alias("count"))


def class_report(df: DataFrame, y: str, yhat: Column) -> DataFrame:
    """precision / recall / F1 / support for classes 0 and 1."""
    yy = F.col(y).cast("int")
    yh = yhat.cast("int")
    rows = []
    for c in (0, 1):
        tp = F.count_if((yy == c) & (yh == c))
        pp = F.count_if(yh == c)
        ap = F.count_if(yy == c)
        rows.append(df.agg(F.lit(c).alias("class"), tp.alias("tp"), pp.alias("pp"), ap.alias("support")))
    u = rows[0].unionByName(rows[1])
    prec = F.when(F.col("pp") > 0, F.col("tp") / F.col("pp")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return u.select("class", F.round(prec, R).alias("precision"), F.round(rec, R).alias("recall"),
                    F.round(f1, R).alias("f1"), "support")


def score_histogram(df: DataFrame, y: str, score: str) -> DataFrame:
    """One row per distinct score: positives and negatives at that score."""
    yy = F.col(y).cast("int")
    return df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(yy).alias("pos"), F.sum(F.lit(1) - yy).alias("neg"))


def pr_curve(df: DataFrame, y: str, score: str) -> DataFrame:
    """``precision_recall_curve`` points, one per distinct score (predict
    positive when ``score >= threshold``), plus the end point (precision 1,
    recall 0, no threshold).  Columns: threshold, tp, fp, precision, recall."""
    h = score_histogram(df, y, score)
    c = running_sums(h, [F.col("threshold").desc()], {"tp": F.col("pos"), "fp": F.col("neg")})
    total_pos = df.select(F.sum(F.col(y).cast("int"))).scalar()
    pts = c.select("threshold", "tp", "fp",
                      F.round(F.col("tp") / (F.col("tp") + F.col("fp")), R).alias("precision"),
                      F.round(F.col("tp") / total_pos, R).alias("recall"))
    end = df.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"),
                                          F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"),
                                          F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def average_precision(df: DataFrame, y: str, score: str) -> DataFrame:
    """AP = sum over distinct thresholds of (R_n - R_{n-1}) * P_n."""
    h = score_histogram(df, y, score)
    c = running_sums(h, [F.col("threshold").desc()], {"tp": F.col("pos"), "fp": F.col("neg")})
    total_pos = df.select(F.sum(F.col(y).cast("int"))).scalar()
    step = F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))
    return c.agg(F.round(F.sum(step) / total_pos, R).alias("average_precision"))


def threshold_min_recall(curve: DataFrame, min_recall: float = 0.75) -> DataFrame:
    """Max precision among points with recall >= min_recall; if none, max
    recall.  Ties go to the lowest threshold (first in sklearn order)."""
    pts = curve.where(F.col("threshold").isNotNull())
    ok = F.col("recall") >= min_recall
    return pts.agg(
        F.coalesce(
            F.max_by(F.col("threshold"), F.when(ok, F.struct(F.col("precision"), -F.col("threshold")))),
            F.max_by(F.col("threshold"), F.struct(F.col("recall"), -F.col("threshold")))).alias("threshold"))


def f1_sweep(df: DataFrame, y: str, score: str, start: float = 0.10, stop: float = 0.89,
             step: float = 0.01, digits: int = 2) -> DataFrame:
    """Best F1 over a fixed threshold grid ``start, start+step, ..., stop``
    (first threshold on ties), predicting positive when ``score >= t``.

    No cross join: each distinct score is assigned to the grid cell of the
    largest threshold it reaches (exact comparison against the rounded grid
    value), the per-cell counts (at most n+1 rows) are cumulated from the top
    threshold down, and every threshold's TP / FP is read from that.
    """
    n = int(round((stop - start) / step)) + 1

    def t_of(i):
        return F.round(F.lit(start) + i * F.lit(step), digits)

    h = score_histogram(df, y, score)
    s = F.col("threshold")
    guess = F.floor((s - F.lit(start)) / F.lit(step))
    guess = F.when(s < t_of(guess), guess - 1).when(s >= t_of(guess + 1), guess + 1).otherwise(guess)
    cell = F.least(F.greatest(guess, F.lit(-1)), F.lit(n - 1)).cast("int")
    per_cell = h.groupBy(cell.alias("cell")).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    grid = df.sparkSession.range(n).select(F.col("id").cast("int").alias("cell"))
    # bounded: at most n + 1 rows on each side
    g = grid.join(F.broadcast(per_cell), "cell", "left").na.fill(0, ["pos", "neg"])
    above = Window.orderBy(F.col("cell").desc()).rowsBetween(Window.unboundedPreceding, 0)
    total_pos = h.select(F.sum("pos")).scalar()
    cum = g.select("cell", F.sum("pos").over(above).alias("tp"), F.sum("neg").over(above).alias("fp"))
    f1 = F.when(F.col("tp") > 0, 2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + (total_pos - F.col("tp")))) \
        .otherwise(F.lit(0.0))
    scored = cum.select(t_of(F.col("cell")).alias("t"), f1.alias("f1"))
    return scored.agg(F.max_by(F.col("t"), F.struct(F.col("f1"), -F.col("t"))).alias("best_threshold"),
                      F.round(F.max("f1"), R).alias("best_f1"))


def fbeta(tp: Column, fp: Column, fn: Column, beta: float) -> Column:
    b2 = beta * beta
    den = (1 + b2) * tp + b2 * fn + fp
    return F.when(den > 0, (1 + b2) * tp / den).otherwise(F.lit(0.0))


def fbeta_guard(df: DataFrame, y: str, score: str, chosen: Column, beta: float = 2.0,
                default: float = 0.5) -> DataFrame:
    """F-beta at the chosen threshold vs at ``default``; keep the chosen one
    unless it is worse."""
    yy = F.col(y).cast("int") == 1
    s = F.col(score)

    def counts(t):
        pred = s >= t
        return (F.count_if(yy & pred), F.count_if(~yy & pred), F.count_if(yy & ~pred))

    tc, fc, nc = counts(chosen)
    td, fd, nd = counts(F.lit(default))
    r = df.agg(fbeta(tc, fc, nc, beta).alias("f_chosen"), fbeta(td, fd, nd, beta).alias("f_default"),
               F.first(chosen).alias("chosen"))
    return r.select(F.round("f_chosen", R).alias("f_chosen"), F.round("f_default", R).alias("f_default"),
                    F.when(F.col("f_chosen") < F.col("f_default"), F.lit(default)).otherwise(F.col("chosen"))
                    .alias("threshold"))


def nearest_point(curve: DataFrame, threshold: Column) -> DataFrame:
    """PR point whose threshold is nearest to ``threshold`` (first on ties)."""
    pts = curve.where(F.col("threshold").isNotNull())
    d = F.abs(F.col("threshold") - threshold)
    return pts.agg(F.min_by(F.struct("threshold", "precision", "recall"), F.struct(d, F.col("threshold"))).alias("p")) \
        .select("p.threshold", "p.precision", "p.recall")
