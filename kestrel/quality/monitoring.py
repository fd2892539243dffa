"""Delay-model monitoring: ground-truth synchronisation and drift ratios.

The reference sync joins every prediction with *all* archive rows of the
same structural slot (bus, direction, stop, weekday, hour) and then keeps the
newest per prediction.  At scale that join emits every pair inside a slot,
so here the archive side is first reduced to one row per slot (newest
observation, via ``max_by`` — a partial aggregate that also absorbs hot
slots) and then equi-joined: output rows = predictions, never pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.calendar import weekday0

SLOT_KEYS = ["bus_nbr", "direction_id", "stop_sequence", "day_of_week", "hour"]


def observation_slots(obs: DataFrame, ts: str = "timestamp_rounded", match: str = "dow_hour") -> DataFrame:
    """Archive rows keyed by structural slot.

    ``match='dow_hour'`` (default, weekly job): weekday 0 = Monday + hour.
    ``match='month_dow_hour'`` adds the month (the second sync variant,
    with its weekday convention fixed to 0 = Monday).
    """
    t = F.col(ts)
    keyed = obs.withColumns({"bus_nbr": F.col("bus_nbr").cast("string"),
                             "direction_id": F.col("direction_id").cast("string"),
                             "stop_sequence": F.col("stop_sequence").cast("int"),
                             "day_of_week": weekday0(t).cast("int"),
                             "hour": F.hour(t).cast("int")})
    if match == "month_dow_hour":
        keyed = keyed.withColumn("month", F.month(t).cast("int"))
    return keyed


def slot_keys(match: str) -> list[str]:
    return SLOT_KEYS + (["month"] if match == "month_dow_hour" else [])


def latest_per_slot(obs: DataFrame, value: str, ts: str, tiebreak: str, match: str = "dow_hour") -> DataFrame:
    """Newest observation per slot (ties broken by ``tiebreak`` desc) and the
    number of observations in the slot."""
    keys = slot_keys(match)
    k = observation_slots(obs, ts, match)
    return k.groupBy(*keys).agg(
        F.max_by(F.struct(F.col(value).alias("actual_delay"), F.col(ts).alias("observed_at")),
                 F.struct(F.col(ts), F.col(tiebreak))).alias("_l"),
        F.count(F.lit(1)).alias("n_matches")) \
        .select(*keys, "_l.actual_delay", "_l.observed_at", "n_matches")


def _pred_keys(preds: DataFrame, match: str) -> DataFrame:
    cols = {"bus_nbr": F.col("bus_nbr").cast("string"), "direction_id": F.col("direction_id").cast("string"),
            "stop_sequence": F.col("stop_sequence").cast("int")}
    return preds.withColumns(cols)


def match_predictions(preds: DataFrame, obs: DataFrame, bus: str = "541", match: str = "dow_hour",
                      value: str = "departure_delay", ts: str = "timestamp_rounded",
                      tiebreak: str = "id") -> DataFrame:
    """Predictions of one line with their newest structurally matching
    observation (inner: predictions without a match are dropped)."""
    p = _pred_keys(preds, match).where(F.col("bus_nbr") == bus)
    if match == "dow_hour":
        p = p.where(F.col("day_of_week").between(0, 6))
    slots = latest_per_slot(obs.where(F.col("bus_nbr").cast("string") == bus), value, ts, tiebreak, match)
    return p.join(slots, slot_keys(match))


def not_yet_synced(preds: DataFrame, truth: DataFrame, id_col: str = "id",
                   truth_key: str = "prediction_log_id") -> DataFrame:
    """``NOT EXISTS`` (ground truth for this prediction) as a left anti join."""
    return preds.join(truth.select(F.col(truth_key).alias(id_col)), id_col, "left_anti")


def ground_truth_sync(preds: DataFrame, obs: DataFrame, truth: DataFrame, as_of: Column,
                      bus: str = "541", match: str = "dow_hour") -> DataFrame:
    """Rows to append to the ground-truth table."""
    todo = not_yet_synced(preds, truth)
    m = match_predictions(todo, obs, bus, match)
    return m.select(F.col("id").alias("prediction_log_id"), "actual_delay",
                    as_of.cast("timestamp_ntz").alias("created_at"))


def mae(pred: Column, actual: Column) -> Column:
    return F.avg(F.abs(pred - actual))


def drift_ratio_dag(logs: DataFrame, truth: DataFrame, bus: str = "541", limit: float = 1.3) -> DataFrame:
    """MAE on synced rows / mean |P50| of the line (the job's definitions)."""
    p = logs.where(F.col("bus_nbr") == bus)
    j = p.join(truth, p.id == truth.prediction_log_id)
    m1 = j.select(mae(F.col("prediction_P50"), F.col("actual_delay")).alias("mae_weekly"))
    m2 = p.select(F.avg(F.abs(F.col("prediction_P50"))).alias("mae_avg"))
    r = m1.crossJoin(m2).withColumn("drift_ratio", F.try_divide(F.col("mae_weekly"), F.col("mae_avg")))
    return r.select(F.round("mae_weekly", 6).alias("mae_weekly"), F.round("mae_avg", 6).alias("mae_avg"),
                    F.round("drift_ratio", 6).alias("drift_ratio"), (F.col("drift_ratio") > limit).alias("alert"))


def drift_ratio_dashboard(logs: DataFrame, truth: DataFrame, limit: float = 1.3,
                          last_run_hours: int = 1) -> DataFrame:
    """MAE of the last sync run (rows created within an hour of the newest)
    over the global MAE."""
    j = logs.join(truth, logs.id == truth.prediction_log_id)
    last = truth.select(F.max("created_at")).scalar()
    recent = F.col("created_at") >= last - F.expr(f"INTERVAL {last_run_hours} HOURS")
    err = F.abs(F.col("prediction_P50") - F.col("actual_delay"))
    r = j.agg(F.avg(F.when(recent, err)).alias("mae_last"), F.avg(err).alias("mae_global"))
    r = r.withColumn("drift_ratio", F.try_divide(F.col("mae_last"), F.col("mae_global")))
    return r.select(F.round("mae_last", 6).alias("mae_last"), F.round("mae_global", 6).alias("mae_global"),
                    F.round("drift_ratio", 6).alias("drift_ratio"),
                    F.coalesce(F.col("drift_ratio") > limit, F.lit(False)).alias("alert"))


def logs_with_truth(logs: DataFrame, truth: DataFrame, how: str = "left",
                    cols: Sequence[str] = ("actual_delay", "created_at")) -> DataFrame:
    t = truth.select(F.col("prediction_log_id").alias("id"), *cols)
    return logs.join(t, "id", how)
