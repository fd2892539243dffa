"""Structured Streaming jobs: live counters, sliding features, sessions,
stream-static enrichment, per-entity velocity state, de-duplication, late
data, failed-login alerts, micro-batch scoring.

Every job reads a file source with a fixed schema, runs with an explicit
trigger, writes to a file sink (or ``foreachBatch`` keyed on ``batch_id``
so a replayed batch replaces its own output) and keeps its checkpoint in
the shared checkpoint folder — a restarted query resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def event_stream(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA,
                 files_per_trigger: int = 4, ts: str = "ts") -> DataFrame:
    """File-source stream; event time cast to TIMESTAMP (watermarks need it)."""
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return s.withColumn(ts, F.col(ts).cast("timestamp"))


def run_to_files(df: DataFrame, out: str, checkpoint: str, mode: str = "append",
                 trigger: dict | None = None) -> None:
    """Run a streaming query to a Parquet sink until the input is drained
    (``availableNow`` by default; pass ``{'processingTime': '10 seconds'}``
    for a continuous run)."""
    trigger = trigger or {"availableNow": True}
    q = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
         .trigger(**trigger).start(out))
    q.awaitTermination()


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                      trigger: dict | None = None) -> None:
    trigger = trigger or {"availableNow": True}
    q = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(**trigger).start()
    q.awaitTermination()


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent micro-batch write: rows go to partition ``batch_id``
    with dynamic overwrite, so a replay of the batch replaces, never adds."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


# -- windowed aggregations ---------------------------------------------------
def tumbling_counters(events: DataFrame, width: str = "1 minute", watermark: str = "10 minutes") -> DataFrame:
    w = F.window("ts", width)
    return (events.withWatermark("ts", watermark).groupBy(w.alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value_sum"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "n",
                    "value_sum"))


def sliding_features(events: DataFrame, length: str = "1 hour", slide: str = "15 minutes",
                     watermark: str = "1 hour") -> DataFrame:
    w = F.window("ts", length, slide)
    return (events.withWatermark("ts", watermark).groupBy(w.alias("w"), "user_id")
            .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("value_sum"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_id",
                    "n_events", "value_sum"))


def sessions(events: DataFrame, gap: str = "30 minutes", watermark: str = "1 hour") -> DataFrame:
    s = F.session_window("ts", gap)
    return (events.withWatermark("ts", watermark).groupBy(s.alias("s"), "user_id")
            .agg(F.count(F.lit(1)).alias("n_events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
            .select("user_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "n_events", "first_ts", "last_ts"))


def failed_login_alerts(events: DataFrame, k: int = 3, width: str = "10 minutes",
                        watermark: str = "10 minutes") -> DataFrame:
    """Users with at least ``k`` failures (error events) in a window."""
    w = F.window("ts", width)
    return (events.withWatermark("ts", watermark).groupBy(w.alias("w"), "user_id")
            .agg(F.count_if(F.col("event_type") == "error").alias("n_failures"))
            .where(F.col("n_failures") >= k)
            .select("user_id", F.col("w.start").alias("window_start"), "n_failures"))


def enrich_static(events: DataFrame, profiles: DataFrame, key: str = "user_id") -> DataFrame:
    """Stream-static left join (the static side is re-read per batch)."""
    return events.join(profiles, key, "left")


def dedupe(stream: DataFrame, key: str, ts: str, watermark: str = "1 hour") -> DataFrame:
    return stream.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


# -- arbitrary state: per-user velocity ------------------------------------------
VELOCITY_BUCKETS = 256
VELOCITY_ROW = "user long, flags long, t long, id long"       # flags: 1 no user_id, 2 no event_id, 4 not yet emitted
VELOCITY_STATE = "users array<long>, flags array<long>, times array<long>, ids array<long>"


def _velocity(window_s: int):
    """Event-time exact trailing count per user, for a bucket of users at once.

    State per bucket: user and epoch second of the events that can still fall
    inside some future window, and those not yet emitted.  An event is
    emitted once the watermark has passed its time (so every earlier event
    has arrived); its count covers the user's kept events with a time in
    ``[t - window_s, t]`` (whole seconds, ties included), matching the batch
    ``rangeBetween(-window_s, 0)`` window.  Times older than the watermark
    minus the window are pruned, so state stays bounded by one window and the
    events behind the watermark.
    """
    import numpy as np

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names = ["user", "flags", "t", "id"]
        parts = [np.array(state.get, dtype=np.int64)] if state.exists else []
        parts += [pdf[names].to_numpy(dtype=np.int64).T for pdf in pdfs if len(pdf)]
        user, flags, t, ids = np.concatenate(parts, axis=1) if parts else np.zeros((4, 0), dtype=np.int64)
        order = np.lexsort((t, user, flags & 1))
        user, flags, t, ids = user[order], flags[order], t[order], ids[order]
        wm = state.getCurrentWatermarkMs() // 1000
        waits = flags & 4 > 0
        out, keep = waits & (t <= wm), (waits & (t > wm)) | (t >= wm - window_s)
        n = np.zeros(0, dtype=np.int64)
        if out.any():
            # users one after the other on one line, further apart than a window
            first = np.r_[True, (user[1:] != user[:-1]) | (flags[1:] & 1 != flags[:-1] & 1)]
            at = (np.cumsum(first) - 1) * (t.max() - t.min() + window_s + 1) + (t - t.min())
            n = np.searchsorted(at, at[out], "right") - np.searchsorted(at, at[out] - window_s, "left")
        if keep.any():
            late = waits & ~out
            state.update(tuple(x.tolist() for x in (user[keep], np.where(late, flags, flags & 3)[keep], t[keep], ids[keep])))
            if late.any():
                state.setTimeoutTimestamp(int(t[late].min()) * 1000 + 1000)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"user": user[out], "flags": flags[out], "t": t[out], "id": ids[out], "n": n})
    return fn


def velocity_state(events: DataFrame, window_s: int = 3600, watermark: str = "1 hour",
                   buckets: int = VELOCITY_BUCKETS) -> DataFrame:
    """Running count of each user's events in the trailing window with state
    (``applyInPandasWithState``, event-time timeout).  The state is kept per
    bucket of users: a call costs some milliseconds, so a call for each user
    and batch would cost far more than the counts.  Events without a time
    are left out."""
    e = events.where(F.col("ts").isNotNull()).withWatermark("ts", watermark).select(
        "ts", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).alias("bucket"),
        F.coalesce("user_id", F.lit(0)).cast("long").alias("user"),
        (F.col("user_id").isNull().cast("long") + 2 * F.col("event_id").isNull().cast("long") + 4).alias("flags"),
        F.unix_seconds("ts").alias("t"), F.coalesce("event_id", F.lit(0)).cast("long").alias("id"))
    counted = e.groupBy("bucket").applyInPandasWithState(
        _velocity(window_s), f"{VELOCITY_ROW}, n long", VELOCITY_STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return counted.select(F.when(F.col("flags").bitwiseAND(2) == 0, F.col("id")).alias("event_id"),
                          F.when(F.col("flags").bitwiseAND(1) == 0, F.col("user")).alias("user_id"),
                          F.timestamp_seconds("t").alias("ts"), F.col("n").alias("last_1h_count"))


# -- late data ---------------------------------------------------------------------
def split_late(spark: SparkSession, on_time: str, late: str, progress: str, ts: str = "ts",
               lateness_s: int = 3600) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body: rows older than (newest event time of earlier
    batches - lateness) go to ``late``, others to ``on_time``.  The newest
    time per batch is kept as one row per batch in ``progress``."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        try:
            prior = (spark.read.parquet(progress).where(F.col("batch_id") < batch_id)
                     .agg(F.max("max_ts")).first()[0])
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            prior = None  # first batch: no progress yet
        if prior is None:
            flagged = batch.withColumn("_late", F.lit(False))
        else:
            bound = F.lit(prior).cast("timestamp") - F.expr(f"INTERVAL {lateness_s} SECONDS")
            flagged = batch.withColumn("_late", F.col(ts) < bound)
        flagged = flagged.persist()
        write_batch(flagged.where(~F.col("_late")).drop("_late"), on_time, batch_id)
        write_batch(flagged.where(F.col("_late")).drop("_late"), late, batch_id)
        write_batch(batch.agg(F.max(ts).alias("max_ts")), progress, batch_id)
        flagged.unpersist()
    return fn


# -- micro-batch scoring ---------------------------------------------------------
def scoring_batch(spark: SparkSession, model, categories: DataFrame, client_stats: DataFrame,
                  merchant_stats: DataFrame, feature_cols: list[str], out: dict[str, str], threshold: float,
                  version: str, required=("transaction_id", "amount", "category", "timestamp")):
    """``foreachBatch`` body of the scoring worker.

    Records missing a mandatory field, or with a category the model does not
    know, are written to ``out['bad']`` with the reason and the batch goes
    on.  Valid records get the behavioural features (stats looked up, median
    default), are scored, and are written to the transactions and
    predictions tables; alerts also go to ``out['alerts']``.  All writes
    are keyed by ``batch_id`` (idempotent on replay)."""
    from kestrel.modeling.models import positive_probability
    from kestrel.operators.payments import lookup_stats_with_default, stats_medians
    from kestrel.quality.profile import required_fields

    # the median defaults are computed once for the whole stream (3 numbers)
    m = stats_medians(client_stats, merchant_stats).first()
    medians = spark.createDataFrame([(m["_m_cnt"], m["_m_avg"], m["_m_mcnt"])],
                                    "_m_cnt double, _m_avg double, _m_mcnt double")

    def fn(batch: DataFrame, batch_id: int) -> None:
        checked = required_fields(batch, list(required)).join(categories, "category", "left")
        reason = (F.when(~F.col("is_valid"), F.concat(F.lit("missing: "), F.array_join("missing_fields", ",")))
                  .when(F.col("category_code").isNull(), F.lit("unknown category")))
        checked = checked.withColumn("reason", reason).persist()
        write_batch(checked.where(F.col("reason").isNotNull()).select("transaction_id", "reason"), out["bad"], batch_id)
        good = checked.where(F.col("reason").isNull()).drop("reason", "missing_fields", "is_valid")
        feats = lookup_stats_with_default(good, client_stats, merchant_stats, medians=medians)
        feats = feats.withColumns({"hour": F.hour("timestamp"), "day_of_week": F.weekday("timestamp"),
                                   "amount_d": F.col("amount").cast("double")})
        from pyspark.ml.feature import VectorAssembler
        vec = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="keep").transform(feats)
        scored = model.transform(vec).withColumn("prediction_score", positive_probability()) \
            .withColumn("is_alerted", F.col("prediction_score") >= threshold).persist()
        write_batch(scored.select("transaction_id", "timestamp", "amount", "category", "client_id", "merchant_id"),
                    out["transactions"], batch_id)
        preds = scored.select("transaction_id", F.lit(version).alias("model_version"),
                              F.round("prediction_score", 6).alias("prediction_score"), "is_alerted")
        write_batch(preds, out["predictions"], batch_id)
        write_batch(preds.where(F.col("is_alerted")), out["alerts"], batch_id)
        scored.unpersist()
        checked.unpersist()
    return fn
