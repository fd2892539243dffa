"""Streaming queries.  Each stages rows derived from the tables as a file
source in the shared folder, runs the streaming job to completion with an
``availableNow`` trigger and returns the sink contents."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.plans.registry import query
from kestrel.session import shared_path
from kestrel.streaming import jobs


END_TYPE = "~end"      # event type and user of the rows that close a finite stream
END_USER = -1


def _time_slices(df, ts: str, n: int):
    """``df`` cut into ``n`` consecutive, equally long stretches of time."""
    lo, hi = df.agg(F.min(ts), F.max(ts)).first()
    if lo is None:
        return [df]
    step = (hi - lo) / n
    at = [lo + step * i for i in range(1, n)]
    cuts = [None, *at, None]
    return [df.where((F.lit(True) if a is None else F.col(ts) >= F.lit(a)) & (F.lit(True) if b is None else F.col(ts) < F.lit(b)))
            for a, b in zip(cuts, cuts[1:])]


def _stage_events(v, n_slices: int = 6, files_per_slice: int = 4):
    """Events as a file source that arrives in event-time order: consecutive
    time slices are written one after the other (each by ``files_per_slice``
    parallel tasks), so file modification times follow event time.  Rows of
    ``END_TYPE`` a day after the last event follow: they move the watermark
    past every window, so a finite stream's last windows close too."""
    path = shared_path(v.spark, "stream-src-events")
    e = v.t.events
    for part in _time_slices(e, "ts", n_slices):
        part.repartition(files_per_slice).write.mode("append").parquet(path)
    end = e.agg((F.max("ts") + F.expr("INTERVAL 1 DAY")).alias("ts")).select(
        F.lit(-1).cast("long").alias("event_id"), "ts", F.lit(END_USER).cast("long").alias("user_id"),
        F.lit(END_TYPE).alias("event_type"), F.lit(0.0).alias("value"), F.lit(None).cast("string").alias("props"))
    for _ in range(2 * files_per_slice):  # two batches: the second sees the watermark of the first
        end.write.mode("append").parquet(path)
    return path


def _run(v, df, name, mode="append"):
    out, ck = shared_path(v.spark, f"{name}-out"), shared_path(v.spark, f"{name}-ckpt")
    jobs.run_to_files(df, out, ck, mode)
    done = v.spark.read.schema(df.schema).parquet(out)
    for c, end in (("event_type", END_TYPE), ("user_id", END_USER)):
        if c in done.columns:
            done = done.where(F.col(c) != end)
    return done.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp"
                         else F.col(f.name) for f in done.schema.fields])


@query("stream_tumbling_counters", oracle="""
SELECT date_trunc('minute', ts) AS window_start, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, event_type,
       count(*) AS n, round(sum(value), 6) AS value_sum FROM events GROUP BY 1, 2, 3""")
def stream_tumbling_counters(v):
    s = jobs.event_stream(v.spark, _stage_events(v))
    return _run(v, jobs.tumbling_counters(s), "tumbling").withColumn("value_sum", F.round("value_sum", 6))


@query("stream_sliding_features", oracle="""
WITH x AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 15 MINUTE * k AS window_start, user_id, value
           FROM events, (SELECT unnest(range(4)) AS k))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, user_id, count(*) AS n_events,
       round(sum(value), 6) AS value_sum FROM x GROUP BY 1, 2, 3""")
def stream_sliding_features(v):
    s = jobs.event_stream(v.spark, _stage_events(v))
    return _run(v, jobs.sliding_features(s), "sliding").withColumn("value_sum", F.round("value_sum", 6))


@query("stream_sessions", oracle="""
WITH g AS (SELECT user_id, ts, coalesce(ts - lag(ts) OVER w > INTERVAL 30 MINUTE, true) AS opens FROM events
           WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, count_if(opens) OVER (PARTITION BY user_id ORDER BY ts) AS nth FROM g)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n_events,
       min(ts) AS first_ts, max(ts) AS last_ts FROM s GROUP BY user_id, nth""")
def stream_sessions(v):
    s = jobs.event_stream(v.spark, _stage_events(v))
    return _run(v, jobs.sessions(s), "sessions")


@query("stream_failed_logins", oracle="""
SELECT user_id, date_trunc('hour', ts) AS window_start, count(*) AS n_failures FROM events WHERE event_type = 'error'
GROUP BY 1, 2 HAVING count(*) >= 2""")
def stream_failed_logins(v):
    s = jobs.event_stream(v.spark, _stage_events(v))
    return _run(v, jobs.failed_login_alerts(s, k=2, width="1 hour"), "failed-logins")


@query("stream_enrich_static", oracle="""
SELECT e.*, c_mktsegment AS segment, c_nationkey AS nation_key FROM events e LEFT JOIN customer ON user_id = c_custkey""")
def stream_enrich_static(v):
    s = jobs.event_stream(v.spark, _stage_events(v))
    prof = v.t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"),
                               F.col("c_nationkey").alias("nation_key"))
    return _run(v, jobs.enrich_static(s, prof), "enrich")


@query("stream_velocity_state", oracle="""
WITH p AS (SELECT event_id, user_id, date_trunc('second', ts) AS ts FROM events WHERE event_type = 'purchase')
SELECT event_id, user_id, ts, count(*) OVER (PARTITION BY user_id ORDER BY ts
       RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS last_1h_count FROM p""")
def stream_velocity_state(v):
    s = jobs.event_stream(v.spark, _stage_events(v)).where(F.col("event_type").isin("purchase", END_TYPE))
    return _run(v, jobs.velocity_state(s), "velocity")


@query("stream_dedupe", oracle="SELECT transaction_id, timestamp, amount, category FROM tx")
def stream_dedupe(v):
    """Payment records delivered twice, the second time with the next stretch
    of time; one row per transaction survives.  The state covers two
    stretches."""
    path = shared_path(v.spark, "stream-src-payments")
    tx = v.tx.select("transaction_id", "timestamp", "amount", "category")
    n = 24
    parts = _time_slices(tx, "timestamp", n)
    for i, part in enumerate(parts):
        (part.unionByName(parts[i - 1]) if i else part).repartition(4).write.mode("append").parquet(path)
    parts[-1].repartition(4).write.mode("append").parquet(path)
    lo, hi = tx.agg(F.min("timestamp"), F.max("timestamp")).first()
    days = 2 * ((hi - lo).days // n + 1) if lo else 1
    schema = "transaction_id long, timestamp timestamp_ntz, amount decimal(15,2), category string"
    s = (v.spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(path)
         .withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    return _run(v, jobs.dedupe(s, "transaction_id", "timestamp", watermark=f"{days} days"), "dedupe")


@query("stream_late_split", oracle="""
SELECT event_id, ts, user_id, dayofmonth(ts) <= 20 AS is_late, CAST(dayofmonth(ts) <= 20 AS INT) AS batch_id FROM events""")
def stream_late_split(v):
    """The month's last days arrive first: rows older than an hour before the
    newest time of earlier batches are set aside."""
    path = shared_path(v.spark, "stream-src-late")
    e = v.t.events
    day = F.dayofmonth("ts")
    e.where(day > 20).repartition(4).write.mode("overwrite").parquet(path)
    e.where(day <= 20).repartition(4).write.mode("append").parquet(path)
    s = jobs.event_stream(v.spark, path, files_per_trigger=4)
    on_time, late, prog = (shared_path(v.spark, n) for n in ("late-on-time", "late-late", "late-progress"))
    jobs.run_foreach_batch(s, jobs.split_late(v.spark, on_time, late, prog), shared_path(v.spark, "late-ckpt"))
    a = v.spark.read.parquet(on_time).withColumn("is_late", F.lit(False))
    b = v.spark.read.parquet(late).withColumn("is_late", F.lit(True))
    return a.unionByName(b).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "is_late", "batch_id")


@query("stream_alerts", oracle="""
SELECT p.*, t.timestamp FROM preds p JOIN tx t USING (transaction_id) WHERE p.is_alerted""")
def stream_alerts(v):
    """Scores arrive as a stream; flagged ones are appended to the alert
    table."""
    path = shared_path(v.spark, "stream-src-scores")
    v.preds.join(v.tx.select("transaction_id", "timestamp"), "transaction_id") \
        .repartition(8).write.mode("overwrite").parquet(path)
    schema = "transaction_id long, model_version string, prediction_score double, is_alerted boolean, timestamp timestamp_ntz"
    s = v.spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(path)
    return _run(v, s.where(F.col("is_alerted")), "alerts")


@query("stream_score")
def stream_score(v):
    """Payment records -> validation -> features -> score -> transactions,
    predictions and alerts tables; bad records logged, stream continues."""
    from pyspark.ml.classification import LogisticRegression
    from kestrel.modeling.features import label_encode
    from kestrel.modeling.models import assemble
    from kestrel.operators.payments import client_stats, merchant_stats, lookup_stats_with_default
    tx = v.tx
    lab = tx.where(F.col("is_fraud").isNotNull())
    cs, ms = client_stats(lab), merchant_stats(lab)
    enc = label_encode(lab.select("category").distinct(), "category", "category_code")
    feature_cols = ["amount_d", "category_code", "hour", "day_of_week", "client_tx_count", "client_avg_amount",
                    "client_amount_ratio", "merchant_tx_count"]
    train = lookup_stats_with_default(lab.join(enc, "category"), cs, ms).withColumns(
        {"hour": F.hour("timestamp"), "day_of_week": F.weekday("timestamp"), "amount_d": F.col("amount").cast("double"),
         "label": F.col("is_fraud").cast("int")})
    model = LogisticRegression(labelCol="label", maxIter=1000).fit(assemble(train, feature_cols))
    # incoming records: unlabelled transactions, some with a missing amount
    src = shared_path(v.spark, "stream-src-records")
    rec = tx.where(F.col("is_fraud").isNull()).select(
        "transaction_id", "timestamp", F.when(F.col("transaction_id") % 97 == 0, F.lit(None)).otherwise(F.col("amount"))
        .cast("decimal(15,2)").alias("amount"), "category", "client_id", "merchant_id")
    rec.repartition(6).write.mode("overwrite").parquet(src)
    schema = ("transaction_id long, timestamp timestamp_ntz, amount decimal(15,2), category string, client_id long, "
              "merchant_id long")
    s = v.spark.readStream.schema(schema).option("maxFilesPerTrigger", 2).parquet(src)
    out = {k: shared_path(v.spark, f"score-{k}") for k in ("transactions", "predictions", "alerts", "bad")}
    fn = jobs.scoring_batch(v.spark, model, enc, cs, ms, feature_cols, out, threshold=0.5, version="logit-v1")
    jobs.run_foreach_batch(s, fn, shared_path(v.spark, "score-ckpt"))
    return v.spark.read.parquet(out["predictions"])
