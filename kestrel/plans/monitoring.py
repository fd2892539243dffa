"""Delay-model monitoring and evaluation queries: ground-truth sync, drift
ratios, dashboard aggregates, regression / quantile / classification
evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.modeling import evaluate as ev
from kestrel.operators import relational as rel
from kestrel.operators.selection import quantiles
from kestrel.plans.registry import query
from kestrel.quality import monitoring as mon

# Weekday labels of the monitoring dashboard, 0 = Monday.
DOW_LABELS = ["Lundi", "Mardi", "Mercredi", "Jeudi", "Vendredi", "Samedi", "Dimanche"]

# One row per slot (line, direction, stop, weekday, hour) of the observations:
# how many there are and the last one; predictions look their slot up.
def _slots_sql(*extra: str) -> str:
    more = "".join(f", {e}(timestamp_rounded) AS s_{e}" for e in extra)
    return f"""
slots AS (
  SELECT bus_nbr AS s_line, CAST(direction_id AS VARCHAR) AS s_way, stop_sequence AS s_stop,
         isodow(timestamp_rounded) - 1 AS s_day, hour(timestamp_rounded) AS s_hour{more},
         count(*) AS n_matches, max({{'t': timestamp_rounded, 'i': id, 'd': departure_delay}}) AS last
  FROM transport_rt WHERE bus_nbr = '541' GROUP BY ALL),
found AS (
  SELECT id, n_matches, last.d AS actual_delay, last.t AS observed_at
  FROM prediction_logs JOIN slots
    ON (bus_nbr, CAST(direction_id AS VARCHAR), stop_sequence, day_of_week, hour{"".join(f", {e}" for e in extra)})
     = (s_line, s_way, s_stop, s_day, s_hour{"".join(f", s_{e}" for e in extra)}))"""


@query("join_ground_truth", oracle=f"WITH {_slots_sql()} SELECT id, n_matches FROM found")
def join_ground_truth(v):
    """Predictions x observations on (bus, direction, stop, weekday, hour):
    number of matching observations per prediction (computed per slot, so
    the pair set is never materialised)."""
    return mon.match_predictions(v.prediction_logs, v.transport_rt).select("id", "n_matches")


@query("win_latest_per_prediction", oracle=f"WITH {_slots_sql()} SELECT id, actual_delay, observed_at FROM found")
def win_latest_per_prediction(v):
    return mon.match_predictions(v.prediction_logs, v.transport_rt).select("id", "actual_delay", "observed_at")


@query("join_ground_truth_month", oracle=f"WITH {_slots_sql('month')} SELECT id, actual_delay FROM found")
def join_ground_truth_month(v):
    return mon.match_predictions(v.prediction_logs, v.transport_rt, match="month_dow_hour").select("id", "actual_delay")


@query("join_anti_synced", oracle="""
SELECT id FROM prediction_logs ANTI JOIN ground_truth ON id = prediction_log_id""")
def join_anti_synced(v):
    return mon.not_yet_synced(v.prediction_logs, v.ground_truth).select("id")


@query("drift_ground_truth_sync", oracle=f"""WITH {_slots_sql()}
SELECT id AS prediction_log_id, actual_delay, newest AS created_at
FROM found CROSS JOIN (SELECT max(timestamp) AS newest FROM prediction_logs)
WHERE id NOT IN (SELECT prediction_log_id FROM ground_truth WHERE prediction_log_id IS NOT NULL)""")
def drift_ground_truth_sync(v):
    as_of = rel.max_of(v.prediction_logs, "timestamp")
    return mon.ground_truth_sync(v.prediction_logs, v.transport_rt, v.ground_truth, as_of)


@query("join_logs_truth", oracle="""
SELECT p.id, p.prediction_P50, g.actual_delay FROM prediction_logs p LEFT JOIN ground_truth g ON p.id = g.prediction_log_id""")
def join_logs_truth(v):
    return mon.logs_with_truth(v.prediction_logs, v.ground_truth).select("id", "prediction_P50", "actual_delay")


@query("join_late_labels", oracle="""
WITH g AS (SELECT prediction_log_id, min(created_at) AS first_at FROM ground_truth GROUP BY 1),
f AS (SELECT t.prediction_log_id, min(t.actual_delay) AS actual_delay, g.first_at FROM ground_truth t JOIN g
      ON t.prediction_log_id = g.prediction_log_id AND t.created_at = g.first_at GROUP BY 1, 3)
SELECT p.id, p.prediction_P50, f.actual_delay, f.first_at AS created_at
FROM prediction_logs p LEFT JOIN f ON p.id = f.prediction_log_id""")
def join_late_labels(v):
    from kestrel.operators.joins import earliest_label
    return earliest_label(v.prediction_logs.select("id", "prediction_P50"), v.ground_truth, "id",
                          "prediction_log_id", "created_at", ["actual_delay"]).select(
        "id", "prediction_P50", "actual_delay", "created_at")


_J = "prediction_logs p JOIN ground_truth g ON p.id = g.prediction_log_id"


def _joined(v):
    return mon.logs_with_truth(v.prediction_logs, v.ground_truth, how="inner")


@query("agg_mae", oracle=f"""
SELECT round(avg(abs(p.prediction_P50 - g.actual_delay)), 6) AS mae FROM {_J} WHERE p.bus_nbr = '541'""")
def agg_mae(v):
    j = _joined(v).where(F.col("bus_nbr") == "541")
    return j.agg(F.round(mon.mae(F.col("prediction_P50"), F.col("actual_delay")), 6).alias("mae"))


@query("agg_mae_by_hour", oracle=f"""
SELECT p.hour, round(avg(abs(p.prediction_P50 - g.actual_delay)), 6) AS mae FROM {_J} GROUP BY p.hour""")
def agg_mae_by_hour(v):
    return _joined(v).groupBy("hour").agg(F.round(mon.mae(F.col("prediction_P50"), F.col("actual_delay")), 6).alias("mae"))


@query("agg_p50_by_hour", oracle="""
SELECT hour, round(avg(prediction_P50), 6) AS mean_p50 FROM prediction_logs GROUP BY hour""")
def agg_p50_by_hour(v):
    return v.prediction_logs.groupBy("hour").agg(F.round(F.avg("prediction_P50"), 6).alias("mean_p50"))


@query("agg_p50_by_dow", oracle=f"""
SELECT day_of_week, round(avg(prediction_P50), 6) AS mean_p50,
       {str(DOW_LABELS).replace('"', "'")}[day_of_week + 1] AS day_label FROM prediction_logs GROUP BY day_of_week""")
def agg_p50_by_dow(v):
    labels = F.array(*[F.lit(x) for x in DOW_LABELS])
    g = v.prediction_logs.groupBy("day_of_week").agg(F.round(F.avg("prediction_P50"), 6).alias("mean_p50"))
    return g.withColumn("day_label", F.element_at(labels, F.col("day_of_week") + 1))


@query("agg_activity_hourly", oracle="""
SELECT date_trunc('hour', timestamp) AS hour_start, count(*) AS n_predictions FROM prediction_logs GROUP BY 1""")
def agg_activity_hourly(v):
    return v.prediction_logs.groupBy(F.date_trunc("hour", "timestamp").cast("timestamp_ntz").alias("hour_start")) \
        .agg(F.count(F.lit(1)).alias("n_predictions"))


@query("agg_prediction_kpis", oracle="""
SELECT count(*) AS total,
       count(*) FILTER (WHERE p.timestamp >= date_trunc('day', (SELECT max(timestamp) FROM prediction_logs))) AS today,
       round(avg(p.prediction_P50), 6) AS mean_p50,
       round(avg(abs(p.prediction_P50 - g.actual_delay)), 6) AS mae
FROM prediction_logs p LEFT JOIN ground_truth g ON p.id = g.prediction_log_id""")
def agg_prediction_kpis(v):
    j = mon.logs_with_truth(v.prediction_logs, v.ground_truth)
    today = F.date_trunc("day", rel.max_of(v.prediction_logs, "timestamp")).cast("timestamp_ntz")
    return j.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("timestamp") >= today).alias("today"),
                 F.round(F.avg("prediction_P50"), 6).alias("mean_p50"),
                 F.round(mon.mae(F.col("prediction_P50"), F.col("actual_delay")), 6).alias("mae"))


@query("drift_ratio_dag", oracle=f"""
WITH a AS (SELECT avg(abs(p.prediction_P50 - g.actual_delay)) AS mae_weekly FROM {_J} WHERE p.bus_nbr = '541'),
b AS (SELECT avg(abs(prediction_P50)) AS mae_avg FROM prediction_logs WHERE bus_nbr = '541')
SELECT round(mae_weekly, 6) AS mae_weekly, round(mae_avg, 6) AS mae_avg, round(mae_weekly / mae_avg, 6) AS drift_ratio,
       mae_weekly / mae_avg > 1.3 AS alert FROM a, b""")
def drift_ratio_dag(v):
    return mon.drift_ratio_dag(v.prediction_logs, v.ground_truth)


@query("drift_ratio_dashboard", oracle=f"""
WITH j AS (SELECT p.prediction_P50, g.actual_delay, g.created_at FROM {_J}),
r AS (SELECT avg(abs(prediction_P50 - actual_delay)) FILTER (WHERE created_at >= (SELECT max(created_at) FROM ground_truth) - INTERVAL 1 HOUR) AS mae_last,
             avg(abs(prediction_P50 - actual_delay)) AS mae_global FROM j)
SELECT round(mae_last, 6) AS mae_last, round(mae_global, 6) AS mae_global, round(mae_last / mae_global, 6) AS drift_ratio,
       coalesce(mae_last / mae_global > 1.3, false) AS alert FROM r""")
def drift_ratio_dashboard(v):
    return mon.drift_ratio_dashboard(v.prediction_logs, v.ground_truth)


@query("topk_recent_logs", oracle="""
SELECT p.id, p.timestamp, p.prediction_P50, g.actual_delay FROM prediction_logs p LEFT JOIN ground_truth g
ON p.id = g.prediction_log_id ORDER BY p.timestamp DESC, p.id DESC LIMIT 500""")
def topk_recent_logs(v):
    top = v.prediction_logs.orderBy(F.desc("timestamp"), F.desc("id")).limit(500)
    return mon.logs_with_truth(top, v.ground_truth).select("id", "timestamp", "prediction_P50", "actual_delay")


# -- evaluation: quantile regression on synced rows ----------------------------
@query("eval_regression", oracle=f"""
WITH j AS (SELECT p.prediction_P50 AS p, g.actual_delay AS y FROM {_J})
SELECT count(y) AS n, round(avg(abs(p - y)), 6) AS mae, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse,
       round(1 - sum((p - y) * (p - y)) / (sum(y * y) - sum(y) * sum(y) / count(y)), 6) AS r2,
       round(avg(p), 6) AS mean_prediction, round(avg(y), 6) AS mean_actual,
       round(avg(abs(p - y)) / 60, 6) AS mae_minutes, round(sqrt(avg((p - y) * (p - y))) / 60, 6) AS rmse_minutes FROM j""")
def eval_regression(v):
    return ev.regression_metrics(_joined(v), "actual_delay", "prediction_P50")


@query("eval_coverage", oracle=f"""
SELECT round(avg(CAST(g.actual_delay <= p.prediction_P50 AS INT)), 6) AS coverage_p50,
       round(avg(CAST(g.actual_delay <= p.prediction_P80 AS INT)), 6) AS coverage_p80,
       round(avg(CAST(g.actual_delay <= p.prediction_P90 AS INT)), 6) AS coverage_p90 FROM {_J}""")
def eval_coverage(v):
    y = F.col("actual_delay")
    return _joined(v).agg(*[F.round(ev.coverage(y, F.col(f"prediction_P{q}")), 6).alias(f"coverage_p{q}")
                            for q in (50, 80, 90)])


@query("eval_pinball", oracle=f"""
SELECT {", ".join(f"round(avg(greatest({a} * (g.actual_delay - p.prediction_P{q}), ({a} - 1) * (g.actual_delay - p.prediction_P{q}))), 6) AS pinball_p{q}" for q, a in ((50, 0.5), (80, 0.8), (90, 0.9)))}
FROM {_J}""")
def eval_pinball(v):
    y = F.col("actual_delay")
    return _joined(v).agg(*[F.round(ev.pinball(y, F.col(f"prediction_P{q}"), a), 6).alias(f"pinball_p{q}")
                            for q, a in ((50, 0.5), (80, 0.8), (90, 0.9))])


@query("dq_regression_report", oracle=f"""
WITH j AS (SELECT p.prediction_P50 - g.actual_delay AS e FROM {_J})
SELECT count(*) AS n, round(avg(e), 6) AS mean_error, round(stddev_samp(e), 6) AS std_error,
       round(quantile_cont(e, 0.05), 6) AS error_p05, round(quantile_cont(e, 0.5), 6) AS error_p50,
       round(quantile_cont(e, 0.95), 6) AS error_p95,
       count(*) FILTER (WHERE e > 0) AS n_over, count(*) FILTER (WHERE e < 0) AS n_under FROM j""")
def dq_regression_report(v):
    j = _joined(v).withColumn("e", F.col("prediction_P50") - F.col("actual_delay"))
    r = j.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("e"), 6).alias("mean_error"),
              F.round(F.stddev_samp("e"), 6).alias("std_error"), F.count_if(F.col("e") > 0).alias("n_over"),
              F.count_if(F.col("e") < 0).alias("n_under"))
    names = ["error_p05", "error_p50", "error_p95"]
    q = quantiles(j, "e", (0.05, 0.5, 0.95), names).drop("n")
    return r.crossJoin(F.broadcast(q)).select(  # one row each
        "n", "mean_error", "std_error", *[F.round(n, 6).alias(n) for n in names], "n_over", "n_under")


# -- evaluation: fraud scores against labels ---------------------------------
_SCORED_LABELS = "(SELECT t.transaction_id, CAST(t.is_fraud AS INT) AS y, p.prediction_score AS s FROM tx t JOIN preds p ON t.transaction_id = p.transaction_id WHERE t.is_fraud IS NOT NULL)"


def _labelled_scores(v):
    t = v.tx.where(F.col("is_fraud").isNotNull()).select("transaction_id", F.col("is_fraud").cast("int").alias("y"))
    return t.join(v.preds.select("transaction_id", F.col("prediction_score").alias("s")), "transaction_id")


@query("eval_confusion", oracle=f"""
SELECT y AS actual, CAST(s >= 0.5 AS INT) AS predicted, count(*) AS count FROM {_SCORED_LABELS} x GROUP BY 1, 2""")
def eval_confusion(v):
    return ev.confusion(_labelled_scores(v), "y", F.col("s") >= 0.5)


@query("eval_class_report", oracle=f"""
WITH x AS {_SCORED_LABELS}, c AS (SELECT 0 AS class UNION ALL SELECT 1),
k AS (SELECT class, count(*) FILTER (WHERE x.y = class AND CAST(x.s >= 0.5 AS INT) = class) AS tp,
             count(*) FILTER (WHERE CAST(x.s >= 0.5 AS INT) = class) AS pp,
             count(*) FILTER (WHERE x.y = class) AS support FROM c CROSS JOIN x GROUP BY class)
SELECT class, round(CASE WHEN pp > 0 THEN tp / pp ELSE 0 END, 6) AS precision,
       round(CASE WHEN support > 0 THEN tp / support ELSE 0 END, 6) AS recall,
       round(CASE WHEN tp > 0 THEN 2 * (tp / pp) * (tp / support) / ((tp / pp) + (tp / support)) ELSE 0 END, 6) AS f1,
       support FROM k""")
def eval_class_report(v):
    return ev.class_report(_labelled_scores(v), "y", F.col("s") >= 0.5)


_PR_SQL = f"""
h AS (SELECT s AS threshold, sum(y) AS pos, sum(1 - y) AS neg FROM {_SCORED_LABELS} x GROUP BY s),
c AS (SELECT threshold, pos, neg, sum(pos) OVER (ORDER BY threshold DESC) AS tp, sum(neg) OVER (ORDER BY threshold DESC) AS fp FROM h),
tot AS (SELECT sum(pos) AS P FROM h),
pr AS (SELECT threshold, tp, fp, round(tp / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall FROM c, tot)"""


@query("win_cumulative_pr", oracle=f"""WITH {_PR_SQL}
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp FROM c""")
def win_cumulative_pr(v):
    from kestrel.operators.ordering import running_sums
    h = ev.score_histogram(_labelled_scores(v), "y", "s")
    return running_sums(h, [F.col("threshold").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}).select(
        "threshold", "tp", "fp")


@query("eval_pr_curve", oracle=f"""WITH {_PR_SQL}
SELECT CAST(threshold AS DOUBLE) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, precision, recall FROM pr
UNION ALL SELECT NULL, 0, 0, 1.0, 0.0""")
def eval_pr_curve(v):
    return ev.pr_curve(_labelled_scores(v), "y", "s")


@query("eval_average_precision", oracle=f"""WITH {_PR_SQL}
SELECT round(sum((pos / P) * (tp / (tp + fp))), 6) AS average_precision FROM c, tot""")
def eval_average_precision(v):
    return ev.average_precision(_labelled_scores(v), "y", "s")


@query("eval_threshold_min_recall", oracle=f"""WITH {_PR_SQL}
SELECT coalesce(
  (SELECT threshold FROM pr WHERE recall >= 0.75 ORDER BY precision DESC, threshold ASC LIMIT 1),
  (SELECT threshold FROM pr ORDER BY recall DESC, threshold ASC LIMIT 1)) AS threshold""")
def eval_threshold_min_recall(v):
    return ev.threshold_min_recall(ev.pr_curve(_labelled_scores(v), "y", "s"))


@query("topk_nearest_threshold", oracle=f"""WITH {_PR_SQL}
SELECT threshold, precision, recall FROM pr ORDER BY abs(threshold - 0.9), threshold LIMIT 1""")
def topk_nearest_threshold(v):
    return ev.nearest_point(ev.pr_curve(_labelled_scores(v), "y", "s"), F.lit(0.9))


@query("eval_f1_sweep", oracle=f"""
WITH g AS (SELECT round(0.10 + i * 0.01, 2) AS t FROM range(80) r(i)),
x AS {_SCORED_LABELS},
k AS (SELECT t, count(*) FILTER (WHERE x.s >= t AND y = 1) AS tp, count(*) FILTER (WHERE x.s >= t AND y = 0) AS fp,
             count(*) FILTER (WHERE y = 1) AS p FROM g CROSS JOIN x GROUP BY t),
f AS (SELECT t, CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + (p - tp)) ELSE 0 END AS f1 FROM k)
SELECT CAST((SELECT t FROM f ORDER BY f1 DESC, t ASC LIMIT 1) AS DOUBLE) AS best_threshold, round(max(f1), 6) AS best_f1 FROM f""")
def eval_f1_sweep(v):
    return ev.f1_sweep(_labelled_scores(v), "y", "s")


@query("eval_fbeta_guard", oracle=f"""
WITH x AS {_SCORED_LABELS},
k AS (SELECT count(*) FILTER (WHERE y = 1 AND s >= 0.8) AS tc, count(*) FILTER (WHERE y = 0 AND s >= 0.8) AS fc,
             count(*) FILTER (WHERE y = 1 AND s < 0.8) AS nc, count(*) FILTER (WHERE y = 1 AND s >= 0.5) AS td,
             count(*) FILTER (WHERE y = 0 AND s >= 0.5) AS fd, count(*) FILTER (WHERE y = 1 AND s < 0.5) AS nd FROM x),
f AS (SELECT CASE WHEN 5 * tc + 4 * nc + fc > 0 THEN 5.0 * tc / (5 * tc + 4 * nc + fc) ELSE 0 END AS fc2,
             CASE WHEN 5 * td + 4 * nd + fd > 0 THEN 5.0 * td / (5 * td + 4 * nd + fd) ELSE 0 END AS fd2 FROM k)
SELECT round(fc2, 6) AS f_chosen, round(fd2, 6) AS f_default, CAST(CASE WHEN fc2 < fd2 THEN 0.5 ELSE 0.8 END AS DOUBLE) AS threshold FROM f""")
def eval_fbeta_guard(v):
    return ev.fbeta_guard(_labelled_scores(v), "y", "s", F.lit(0.8))
