"""End-to-end flows composed from the operators (the three lifecycles of
(writes to the shared folder), parameters instead of wall-clock time.

* :func:`transit_days_to_staging` — feed entities of a day range ->
  selected line -> flattened stop updates -> cap per slot -> hour rounding
  -> staging table; days without data are reported, not fatal.
* :func:`fraud_train_score_report` — labelled history -> features ->
  stratified split -> soft-vote model -> threshold -> scores for new
  records -> daily report.
* :func:`delay_monitoring` — prediction log + observations -> ground-truth
  rows to append -> drift verdict.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions import calendar as cal
from kestrel.operators import windows as win
from kestrel.sources import feed
from kestrel.sources import files as fs


@dataclass
class StagingResult:
    staged: DataFrame
    bad_days: DataFrame


def transit_days_to_staging(spark: SparkSession, entities_path: str, trips: DataFrame, routes: DataFrame,
                            begin: str, end: str, out_path: str, line: str = "541", per_slot: int = 2,
                            cap_keys=("direction_id", "stop_sequence"), seed: str = "42") -> StagingResult:
    """Feed entity JSON (one entity per line, ``start_date`` = yyyyMMdd) for
    ``begin..end`` -> staging rows of one line, appended to ``out_path``."""
    raw = spark.read.text(entities_path).select(feed.parse_entities(F.col("value")).alias("entity"))
    sel = routes.where(F.col("route_short_name").cast("string") == line).join(trips, "route_id").select("trip_id")
    day = F.to_date(F.col("entity.trip_update.trip.start_date"), "yyyyMMdd")
    lo, hi = F.lit(begin).cast("date"), F.lit(end).cast("date")
    ents = raw.where(day.between(lo, hi))
    rows = feed.flatten_stop_updates(ents)
    rows = rows.join(sel, "trip_id", "left_semi")  # selected trips only
    rows = rows.withColumn("_id", F.concat_ws("-", "trip_id", F.col("stop_sequence").cast("string"),
                                             F.col("departure_time").cast("string")))
    capped = win.cap_per_group(rows, list(cap_keys), per_slot, "_id", seed)
    ts = F.timestamp_seconds("timestamp").cast("timestamp_ntz")  # the feed message's own time; NULL stays NULL
    staged = capped.select(
        F.col("direction_id").cast("string").alias("direction_id"), "stop_sequence", "arrival_delay",
        "departure_delay", cal.round_hour(ts).alias("timestamp_rounded"),
        F.hour(cal.round_hour(ts)).alias("hour"), F.lit(line).alias("bus_nbr"))
    fs.append_chunked(staged, out_path)
    days = spark.range(1).select(F.explode(F.sequence(lo, hi)).alias("day"))
    seen = ents.select(day.alias("day")).distinct().withColumn("_seen", F.lit(True))
    bad = days.join(seen, "day", "left").where(F.col("_seen").isNull()) \
        .select("day", F.lit("no data").alias("reason"))
    return StagingResult(spark.read.parquet(out_path), bad)


@dataclass
class FraudResult:
    threshold: float
    average_precision: float
    scores: DataFrame
    report: DataFrame


def fraud_train_score_report(spark: SparkSession, history: DataFrame, new_records: DataFrame,
                             report_base: str, report_day: Column, n_trees: int = 10,
                             min_recall: float = 0.75) -> FraudResult:
    """Train on labelled history, pick the threshold on the validation
    split (max precision at recall >= min_recall, F2 guard against 0.5),
    score new records, write the day's report."""
    from kestrel.modeling import evaluate as ev
    from kestrel.modeling import features as fe
    from kestrel.modeling.models import assemble, fit_soft_vote, soft_vote_score
    from kestrel.operators import payments as pay
    lab = history.where(F.col("is_fraud").isNotNull())
    cats = fe.label_encode(lab.select("category").distinct(), "category", "category_code")
    cs, ms = pay.client_stats(lab), pay.merchant_stats(lab)

    def features(df):
        f = pay.lookup_stats_with_default(df.join(cats, "category"), cs, ms)
        f = f.withColumns({"hour": F.hour("timestamp"), "day_of_week": F.weekday("timestamp"),
                           "amount_d": F.col("amount").cast("double")})
        return assemble(f, ["amount_d", "category_code", "hour", "day_of_week", "client_tx_count",
                            "client_avg_amount", "client_amount_ratio", "merchant_tx_count"])

    data = fe.stratified_split(features(lab).withColumn("label", F.col("is_fraud").cast("int")),
                               "label", "transaction_id")
    w = fe.class_weight(data.where(F.col("split") == "train"), "label").first()["scale_pos_weight"]
    data = fe.with_weight(data, "label", F.lit(float(w)))
    models = fit_soft_vote(data.where(F.col("split") == "train"), n_trees=n_trees)
    val = soft_vote_score(models, data.where(F.col("split") == "val"))
    chosen = ev.threshold_min_recall(ev.pr_curve(val, "label", "score"), min_recall).first()[0]
    test = soft_vote_score(models, data.where(F.col("split") == "test"))
    thr = ev.fbeta_guard(test, "label", "score", F.lit(float(chosen if chosen is not None else 0.5))).first()["threshold"]
    ap = ev.average_precision(test, "label", "score").first()[0]
    scored = soft_vote_score(models, features(new_records)).select(
        "transaction_id", "timestamp", "amount", "category", F.round("score", 6).alias("prediction_score"),
        (F.col("score") >= thr).alias("is_alerted"))
    day_rows = scored.where(F.to_date("timestamp") == report_day)
    fs.write_report(day_rows, report_base, report_day)
    return FraudResult(float(thr), float(ap), scored, day_rows)


def delay_monitoring(prediction_logs: DataFrame, observations: DataFrame, ground_truth: DataFrame,
                     as_of: Column, bus: str = "541", limit: float = 1.3) -> tuple[DataFrame, DataFrame]:
    """Ground-truth rows to append for not-yet-synced predictions, and the
    drift verdict computed on the table as it will be after the append."""
    from kestrel.quality import monitoring as mon
    new_rows = mon.ground_truth_sync(prediction_logs, observations, ground_truth, as_of, bus)
    after = ground_truth.select("prediction_log_id", "actual_delay", "created_at").unionByName(new_rows)
    return new_rows, mon.drift_ratio_dag(prediction_logs, after, bus, limit)
