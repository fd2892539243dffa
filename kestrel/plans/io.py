"""Source / sink queries.  Each writes data derived from the tables to a
fresh folder under the cluster's shared checkpoint folder and reads it back
through the operator under test."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions import calendar as cal
from kestrel.functions import weather as wx
from kestrel.operators import relational as rel
from kestrel.plans.registry import query
from kestrel.plans.transit import _GTFS_SQL
from kestrel.session import shared_path
from kestrel.sources import archives as arc
from kestrel.sources import feed
from kestrel.sources import files as fs
from kestrel.sources import merge

TX_CSV_SCHEMA = T.StructType([
    T.StructField("trans_num", T.LongType()), T.StructField("trans_date_trans_time", T.TimestampNTZType()),
    T.StructField("amt", T.DecimalType(15, 2)), T.StructField("merchant", T.LongType()),
    T.StructField("cc_num", T.LongType()), T.StructField("category", T.StringType()),
])


@query("scan_csv", oracle="""
SELECT transaction_id AS trans_num, timestamp AS trans_date_trans_time, amount AS amt, merchant_id AS merchant,
       client_id AS cc_num, category FROM tx""")
def scan_csv(v):
    path = shared_path(v.spark, "payments-csv")
    src = v.tx.select(F.col("transaction_id").cast("string").alias("idx"), F.col("transaction_id").alias("trans_num"),
                      F.col("timestamp").alias("trans_date_trans_time"), F.col("amount").alias("amt"),
                      F.col("merchant_id").alias("merchant"), F.col("client_id").alias("cc_num"), "category")
    src.withColumnRenamed("idx", "").write.mode("overwrite").option("header", True).csv(path)
    return fs.read_csv_indexed(v.spark, path, TX_CSV_SCHEMA)


@query("scan_table_query", oracle="""
SELECT * FROM tx WHERE is_fraud IS NOT NULL""")
def scan_table_query(v):
    return fs.run_sql(v.spark, "SELECT * FROM kestrel_transactions WHERE is_fraud IS NOT NULL",
                      {"kestrel_transactions": v.tx})


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def _bronze_events(v):
    path = shared_path(v.spark, "bronze-events")
    fs.write_json_by_day(v.t.events, path, "ts")
    return path


@query("sink_json_raw", oracle="SELECT *, CAST(ts AS DATE) AS day FROM events")
def sink_json_raw(v):
    path = _bronze_events(v)
    schema = T.StructType(list(EVENT_SCHEMA.fields) + [T.StructField("day", T.DateType())])
    return fs.read_json_rows(v.spark, path, schema)


@query("scan_json_raw", oracle="SELECT * FROM events")
def scan_json_raw(v):
    path = _bronze_events(v)
    return fs.read_json_rows(v.spark, path, T.StructType(list(EVENT_SCHEMA.fields) + [T.StructField("day", T.DateType())])).drop("day")


@query("replay_from_raw", oracle="""
SELECT event_id AS id, date_trunc('hour', ts + INTERVAL 30 MINUTE) AS timestamp_rounded,
       CAST(hour(ts + INTERVAL 30 MINUTE) AS INT) AS hour, CASE WHEN user_id % 3 = 0 THEN '541' ELSE '542' END AS bus_nbr
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'""")
def replay_from_raw(v):
    """Rebuild a staging table for a period from the stored raw rows."""
    from kestrel.plans.fixtures import bus_of_user
    path = _bronze_events(v)
    raw = fs.read_json_rows(v.spark, path, T.StructType(list(EVENT_SCHEMA.fields) + [T.StructField("day", T.DateType())]))
    period = raw.where(F.col("day").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-09").cast("date")))
    staged = period.select(F.col("event_id").alias("id"), cal.round_hour(F.col("ts")).alias("timestamp_rounded"),
                           F.hour(F.col("ts") + F.expr("INTERVAL 30 MINUTES")).cast("int").alias("hour"),
                           bus_of_user(F.col("user_id")).alias("bus_nbr"))
    out = shared_path(v.spark, "staging-transport")
    fs.append_chunked(staged, out)
    return v.spark.read.parquet(out)


def _weather_features(v):
    r = wx.weather_risks(F.col("temperature_2m"), F.col("weather_code"))
    return v.weather_hourly.withColumns(r)


@query("sink_parquet", oracle="""
SELECT *, CAST(temperature_2m <= 0 AND weather_code IN (61, 63, 65) AS INT) AS risque_gel_pluie,
       CAST(temperature_2m <= 0 AND weather_code IN (71, 73, 75) AS INT) AS risque_gel_neige,
       CAST(temperature_2m > 0 AND weather_code IN (71, 73, 75) AS INT) AS neige_fondue FROM weather_hourly""")
def sink_parquet(v):
    path = shared_path(v.spark, "weather-parquet")
    fs.write_parquet(_weather_features(v), path)
    return fs.read_parquet(v.spark, path)


@query("scan_parquet", oracle="SELECT timestamp_rounded, temperature_2m, weather_code FROM weather_hourly")
def scan_parquet(v):
    path = shared_path(v.spark, "weather-parquet")
    fs.write_parquet(_weather_features(v), path, partition_by=["weather_code"])
    return fs.read_parquet(v.spark, path).select("timestamp_rounded", "temperature_2m", "weather_code")


@query("sink_append", oracle="SELECT id, event_ts, departure_delay FROM transport_rt")
def sink_append(v):
    path = shared_path(v.spark, "append")
    rows = v.transport_rt.select("id", "event_ts", "departure_delay")
    fs.append_chunked(rows.where(F.col("event_ts") < F.lit("2024-01-15").cast("timestamp_ntz")), path)
    fs.append_chunked(rows.where(F.col("event_ts") >= F.lit("2024-01-15").cast("timestamp_ntz")), path)
    return v.spark.read.parquet(path)


@query("sink_truncate_load", oracle="SELECT id, departure_delay FROM transport_rt WHERE event_ts >= TIMESTAMP '2024-01-29 00:00:00'")
def sink_truncate_load(v):
    path = shared_path(v.spark, "realtime")
    rows = v.transport_rt.select("id", "event_ts", "departure_delay")
    fs.truncate_load(rows.where(F.col("event_ts") < F.lit("2024-01-29").cast("timestamp_ntz")), path)
    fs.truncate_load(rows.where(F.col("event_ts") >= F.lit("2024-01-29").cast("timestamp_ntz")), path)
    return v.spark.read.parquet(path).select("id", "departure_delay")


@query("sink_replace_keyed", oracle="""
SELECT timestamp_rounded, temperature_2m, weather_code, 36 AS key_chars, 1 AS rows_of_key FROM weather_hourly""")
def sink_replace_keyed(v):
    path = shared_path(v.spark, "weather-keyed")
    fs.replace_keyed(_weather_features(v), path)
    stored = v.spark.read.parquet(path)
    per_key = stored.groupBy("observation_uuid").agg(F.count(F.lit(1)).alias("rows_of_key"))
    return stored.join(per_key, "observation_uuid").select(
        "timestamp_rounded", "temperature_2m", "weather_code", F.length("observation_uuid").alias("key_chars"), "rows_of_key")


@query("fn_uuid", oracle="""
SELECT timestamp_rounded, true AS is_uuid, md5(strftime(timestamp_rounded, '%Y-%m-%d %H:%M:%S')) AS observation_key
FROM weather_hourly""")
def fn_uuid(v):
    """Random row id per observation (its form is reported, its value differs
    in every run) and the deterministic variant."""
    own = F.expr("uuid()").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")
    return v.weather_hourly.select("timestamp_rounded", own.alias("is_uuid"),
                                   F.md5(F.col("timestamp_rounded").cast("string")).alias("observation_key"))


@query("sink_insert_if_absent", oracle="""
WITH w AS (SELECT timestamp_rounded, temperature_2m FROM weather_hourly)
SELECT * FROM w WHERE day(timestamp_rounded) <= 20
UNION ALL
SELECT * FROM w WHERE day(timestamp_rounded) >= 15 AND day(timestamp_rounded) > 20""")
def sink_insert_if_absent(v):
    """Target holds days 1-20; the batch (days 15-30, every hour twice: the
    original first, a revised copy second) only adds hours not yet stored,
    first row winning inside the batch."""
    path = shared_path(v.spark, "forecast")
    w = v.weather_hourly.select("timestamp_rounded", "temperature_2m")
    d = F.dayofmonth("timestamp_rounded")
    w.where(d <= 20).write.mode("overwrite").parquet(path)
    batch = w.where(d >= 15).withColumn("_src", F.lit(0)).unionByName(
        w.where(d >= 15).withColumn("temperature_2m", F.col("temperature_2m") + 100).withColumn("_src", F.lit(1)))
    fs.insert_if_absent(v.spark, batch, path, ["timestamp_rounded"], [F.col("_src")],
                        columns=["timestamp_rounded", "temperature_2m"])
    return v.spark.read.parquet(path).select("timestamp_rounded", "temperature_2m")


_REPORT_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.LongType()), T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("amount", T.DecimalType(15, 2)), T.StructField("category", T.StringType()),
    T.StructField("prediction_score", T.DoubleType()), T.StructField("is_alerted", T.BooleanType()),
])


def _daily_report_rows(v, day_offset: int):
    """Scored transactions of one day (``day_offset`` days before the
    newest transaction's day)."""
    from kestrel.operators.payments import with_predictions
    day = F.date_sub(F.to_date(rel.max_of(v.tx, "timestamp")), day_offset)
    rows = with_predictions(v.tx, v.preds).where(F.to_date("timestamp") == day)
    return rows.select(*[f.name for f in _REPORT_SCHEMA.fields]), day


@query("sink_csv_report", oracle="""
SELECT t.transaction_id, t.timestamp, t.amount, t.category, p.prediction_score, p.is_alerted,
       CAST(t.timestamp AS DATE) AS report_date
FROM tx t LEFT JOIN preds p ON t.transaction_id = p.transaction_id
WHERE CAST(t.timestamp AS DATE) = (SELECT CAST(max(timestamp) AS DATE) - 1 FROM tx)""")
def sink_csv_report(v):
    """Yesterday's scored transactions as a dated CSV report."""
    base = shared_path(v.spark, "reports")
    rows, day = _daily_report_rows(v, 1)
    fs.write_report(rows, base, day)
    return v.spark.read.schema(T.StructType(list(_REPORT_SCHEMA.fields) + [T.StructField("report_date", T.DateType())])) \
        .option("header", True).csv(base)


@query("scan_latest_report", oracle="""
SELECT t.transaction_id, t.timestamp, t.amount, t.category, p.prediction_score, p.is_alerted,
       CAST(t.timestamp AS DATE) AS report_date
FROM tx t LEFT JOIN preds p ON t.transaction_id = p.transaction_id
WHERE CAST(t.timestamp AS DATE) = (SELECT CAST(max(timestamp) AS DATE) FROM tx)""")
def scan_latest_report(v):
    """Two dated reports are written; the newest one is opened."""
    base = shared_path(v.spark, "reports")
    for off in (1, 0):
        rows, day = _daily_report_rows(v, off)
        fs.write_report(rows, base, day)
    return fs.latest_report(v.spark, base, _REPORT_SCHEMA)


def _file_name():
    return F.element_at(F.split("path", "/"), -1).alias("file")


def _staged_archives(v):
    base = shared_path(v.spark, "gtfs-static")
    from kestrel.plans.transit import gtfs_trips
    trips = gtfs_trips(v)
    # 8 archives per block of 10 000 trip ids: an archive never holds more
    # than 1 250 trips however large the timetable grows
    n = 8
    aid = (F.col("trip_id") % n + F.floor(F.col("trip_id") / 10000) * n).cast("long")
    arc.write_zip_archives(trips, base, "trips.txt", ["trip_id", "route_id", "direction_id"],
                           aid, corrupt_if=(F.col("trip_id") % n) == n - 1).collect()
    return base


_ARCHIVE_SQL = f"""WITH {_GTFS_SQL},
a AS (SELECT *, CAST(trip_id % 8 + floor(trip_id / 10000) * 8 AS BIGINT) AS archive_id, trip_id % 8 = 7 AS corrupt FROM trips),
f AS (SELECT 'archive_' || lpad(CAST(archive_id AS VARCHAR), 5, '0') || '.zip' AS file, archive_id, corrupt,
             length('trip_id,route_id,direction_id') + 1
             + sum(length(CAST(trip_id AS VARCHAR)) + length(route_id) + length(direction_id) + 3) AS bytes
      FROM a GROUP BY archive_id, corrupt)"""


@query("scan_zip_csv", oracle=f"""{_ARCHIVE_SQL}
SELECT trip_id, route_id, direction_id, NULL AS error FROM a WHERE NOT corrupt
UNION ALL SELECT NULL, NULL, NULL, 'BadZipFile: File is not a zip file' FROM f WHERE corrupt""")
def scan_zip_csv(v):
    """``trips.txt`` read out of every static archive; unreadable archives
    are reported, not fatal."""
    base = _staged_archives(v)
    rows, bad = arc.read_zip_csv(v.spark, base, "trips.txt", "trip_id long, route_id string, direction_id string")
    return rows.select("trip_id", "route_id", "direction_id", F.lit(None).cast("string").alias("error")) \
        .unionByName(bad.select(F.lit(None).cast("long").alias("trip_id"), F.lit(None).cast("string").alias("route_id"),
                                F.lit(None).cast("string").alias("direction_id"), "error"))


@query("scan_archive_entries", oracle=f"""{_ARCHIVE_SQL}
SELECT file, 'feed_' || lpad(CAST(archive_id AS VARCHAR), 5, '0') || '.pb' AS entry, CAST(bytes AS BIGINT) AS size, NULL AS error
FROM f WHERE NOT corrupt
UNION ALL SELECT file, NULL, NULL, 'unsupported archive kind: unknown' FROM f WHERE corrupt""")
def scan_archive_entries(v):
    """Archives sniffed by magic bytes; payload entries (.pb/.protobuf/.bin)
    emitted, other entries skipped, bad archives quarantined with a reason."""
    base = _staged_archives(v)
    entries = arc.archive_entries(arc.scan_archives(v.spark, base))
    return entries.select(_file_name(), "entry", F.length("payload").cast("long").alias("size"), "error")


@query("fn_magic_bytes", oracle=f"""{_ARCHIVE_SQL}
SELECT file, CASE WHEN corrupt THEN hex('trip') ELSE '504B0304' END AS magic, CASE WHEN corrupt THEN 'unknown' ELSE 'zip' END AS kind
FROM f""")
def fn_magic_bytes(v):
    base = _staged_archives(v)
    a = arc.scan_archives(v.spark, base)
    return a.select(_file_name(), F.hex(F.substring("content", 1, 4)).alias("magic"), "kind")


_FEED_SQL = """u AS (
  SELECT user_id, strftime(ts, '%Y%m%d') AS start_date, CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS trip_id,
         'R' || CAST(user_id % 4 AS VARCHAR) AS route_id, CAST(user_id % 2 AS INT) AS direction_id,
         CAST(1 + event_id % 30 AS INT) AS stop_sequence, CAST(floor(epoch(ts)) AS BIGINT) AS t,
         CAST(floor(value * 6) - 60 AS INT) AS delay, event_id FROM events)"""


def _feed_entities(v):
    path = shared_path(v.spark, "feed-entities")
    feed.entities_from_events(v.t.events).write.mode("overwrite").text(path)
    return v.spark.read.text(path).select(feed.parse_entities(F.col("value")).alias("entity"))


@query("scan_feed_entities", oracle=f"""WITH {_FEED_SQL}
SELECT trip_id AS entity_id, trip_id, route_id, direction_id, max(t) AS timestamp, CAST(count(*) AS INT) AS n_updates
FROM u GROUP BY user_id, start_date, trip_id, route_id, direction_id""")
def scan_feed_entities(v):
    return feed.entity_rows(_feed_entities(v))


@query("arr_explode_stops", oracle=f"""WITH {_FEED_SQL}
SELECT trip_id, route_id, direction_id, start_date, 'V' || CAST(user_id AS VARCHAR) AS vehicle_id,
       max(t) OVER (PARTITION BY trip_id) AS timestamp, stop_sequence,
       CASE WHEN event_id % 3 <> 0 THEN t END AS arrival_time, t AS departure_time,
       CASE WHEN event_id % 3 <> 0 THEN delay - 10 END AS arrival_delay,
       CASE WHEN event_id % 17 <> 0 THEN delay END AS departure_delay FROM u""")
def arr_explode_stops(v):
    return feed.flatten_stop_updates(_feed_entities(v))


@query("ingest_day_range", oracle="""
WITH d AS (SELECT CAST(x AS DATE) AS day FROM generate_series(DATE '2023-12-30', DATE '2024-02-01', INTERVAL 1 DAY) g(x)),
c AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1)
SELECT d.day, coalesce(c.n, 0) AS n_rows, CASE WHEN c.n IS NULL THEN 'no data' ELSE 'ok' END AS status
FROM d LEFT JOIN c ON d.day = c.day""")
def ingest_day_range(v):
    """Days from begin to end processed as one plan: the day list is a
    generated sequence left-joined to the per-day data; days without data
    become 'no data' rows instead of stopping the run."""
    days = v.spark.range(1).select(F.explode(F.sequence(F.lit("2023-12-30").cast("date"),
                                                         F.lit("2024-02-01").cast("date"))).alias("day"))
    per_day = v.t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    j = days.join(per_day, "day", "left")
    return j.select("day", F.coalesce("n", F.lit(0)).alias("n_rows"),
                    F.when(F.col("n").isNull(), "no data").otherwise("ok").alias("status"))


@query("sink_documents", oracle="""
SELECT user_id, CAST(ts AS DATE) AS day, list(event_id ORDER BY ts, event_id) AS event_ids, count(*) AS n_events
FROM events GROUP BY 1, 2""")
def sink_documents(v):
    """Session documents (user, day) with the embedded ordered event list,
    written as JSON documents and read back."""
    from kestrel.operators.documents import sessions_by_day
    s = sessions_by_day(v.t.events)
    docs = s.select("user_id", "day", F.transform("events", lambda e: e["event_id"]).alias("event_ids"),
                    F.size("events").alias("n_events"))
    path = shared_path(v.spark, "session-docs")
    docs.write.mode("overwrite").json(path)
    return v.spark.read.schema("user_id long, day date, event_ids array<long>, n_events int").json(path) \
        .withColumn("n_events", F.col("n_events").cast("long"))


@query("agg_incremental_preagg", oracle="""
SELECT date_key, merchant_key, sum(gross_amount) AS gross_amount, sum(net_revenue) AS net_revenue, count(*) AS nb_tx
FROM fact_transactions GROUP BY 1, 2""")
def agg_incremental_preagg(v):
    """Daily pre-aggregate kept as partial sums per arrival batch: a run adds
    the batches it hasn't seen and reads no other; late rows come in a later
    batch and are added to their day when read."""
    from kestrel.operators.warehouse import daily_revenue_merchant
    facts, path = shared_path(v.spark, "facts-arrived"), shared_path(v.spark, "agg-daily-revenue")
    f = v.fact_transactions
    late = F.col("is_fraud")  # stand-in: these rows arrive one batch late
    batch = F.floor(F.col("date_key") / 10_000) + F.coalesce(late.cast("int"), F.lit(0))
    f.withColumn("batch_id", batch.cast("int")).write.partitionBy("batch_id").parquet(facts)
    merge.add_partials(facts, path, daily_revenue_merchant)
    return merge.merged_partials(v.spark, path, ["date_key", "merchant_key"],
                                 ["gross_amount", "net_revenue", "nb_tx"])


@query("set_union_days", oracle="""
SELECT event_id, CAST(ts AS DATE) AS day, value, NULL::VARCHAR AS props FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-15'
UNION ALL
SELECT event_id, CAST(ts AS DATE), value, props FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15'""")
def set_union_days(v):
    """Day sets with different columns appended into one (missing columns
    become NULL)."""
    e = v.t.events.withColumn("day", F.to_date("ts"))
    cut = F.lit("2024-01-15").cast("date")
    a = e.where(F.col("day") < cut).select("event_id", "day", "value")
    b = e.where(F.col("day") >= cut).select("event_id", "day", "value", "props")
    return a.unionByName(b, allowMissingColumns=True)


@query("sample_rows")
def sample_rows(v):
    """Bernoulli sample (seeded) of the delay rows."""
    return v.transport_rt.sample(withReplacement=False, fraction=0.1, seed=42)


@query("sample_with_replacement")
def sample_with_replacement(v):
    """Exactly n draws with replacement from the valid (direction, stop,
    weekday, hour) combinations: draw i picks combination
    ``pmod(xxhash64(i, seed), n_combos)``; combinations are numbered with a
    prefix count, the draws are a generated range joined on that number."""
    from kestrel.operators.ordering import global_row_number
    from kestrel.plans.transit import delays
    combos = delays(v).select("direction_id", "stop_sequence", cal.weekday0(F.col("timestamp_rounded")).alias("day_of_week"),
                              F.hour("timestamp_rounded").alias("hour")).distinct()
    numbered = global_row_number(combos, [F.col(c) for c in combos.columns], "combo_no")
    n_combos = numbered.count()
    n_draws = 500
    draws = v.spark.range(n_draws).select(F.col("id").alias("draw"),
                                          (F.pmod(F.xxhash64(F.col("id"), F.lit(42)), F.lit(n_combos)) + 1).alias("combo_no"))
    return draws.join(numbered, "combo_no").select("draw", "direction_id", "stop_sequence", "day_of_week", "hour")


@query("arr_zip_hourly", oracle="SELECT timestamp_rounded, temperature_2m, weather_code FROM weather_hourly")
def arr_zip_hourly(v):
    """Daily documents of parallel hourly arrays (time[], temperature[],
    code[]) turned back into hourly rows with ``inline(arrays_zip(...))``."""
    h = v.weather_hourly
    daily = h.groupBy(F.to_date("timestamp_rounded").alias("date")).agg(
        F.array_sort(F.collect_list(F.struct("timestamp_rounded", "temperature_2m", "weather_code"))).alias("_r"))
    doc = daily.select("date", F.struct(
        F.transform("_r", lambda r: r["timestamp_rounded"]).alias("time"),
        F.transform("_r", lambda r: r["temperature_2m"]).alias("temperature_2m"),
        F.transform("_r", lambda r: r["weather_code"]).alias("weather_code")).alias("hourly"))
    return doc.select(F.inline(F.arrays_zip(F.col("hourly.time").alias("timestamp_rounded"),
                                            F.col("hourly.temperature_2m").alias("temperature_2m"),
                                            F.col("hourly.weather_code").alias("weather_code"))))


@query("arr_index_hour", oracle="""
SELECT r.id, w.temperature_2m FROM transport_rt r LEFT JOIN weather_hourly w ON r.timestamp_rounded = w.timestamp_rounded""")
def arr_index_hour(v):
    """Weather of a request read from the day's 24-slot hourly array by
    hour index."""
    h = v.weather_hourly
    daily = h.groupBy(F.to_date("timestamp_rounded").alias("date")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.hour("timestamp_rounded"), F.col("temperature_2m")))).alias("_m"))
    daily = daily.select("date", F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: F.col("_m")[i]).alias("temps"))
    r = v.transport_rt.select("id", F.to_date("timestamp_rounded").alias("date"), F.hour("timestamp_rounded").alias("h"))
    return r.join(daily, "date", "left").select("id", wx.hourly_value(F.col("temps"), F.col("h")).alias("temperature_2m"))


@query("agg_freshness", oracle="""
SELECT count(*) FILTER (WHERE timestamp_rounded >= (SELECT max(timestamp_rounded) FROM weather_hourly) - INTERVAL 24 HOUR) AS n_recent,
       max(timestamp_rounded) AS last_ts,
       CASE WHEN count(*) FILTER (WHERE timestamp_rounded >= (SELECT max(timestamp_rounded) FROM weather_hourly) - INTERVAL 24 HOUR) = 0
            THEN 'fail' ELSE 'ok' END AS status FROM weather_hourly""")
def agg_freshness(v):
    """Rows in the 24 h before ``as_of`` (here the newest hour) and the
    newest timestamp; 'fail' when nothing is fresh."""
    as_of = rel.max_of(v.weather_hourly, "timestamp_rounded")
    h = v.weather_hourly
    recent = F.col("timestamp_rounded") >= as_of - F.expr("INTERVAL 24 HOURS")
    r = h.agg(F.count_if(recent).alias("n_recent"), F.max("timestamp_rounded").alias("last_ts"))
    return r.withColumn("status", F.when(F.col("n_recent") == 0, "fail").otherwise("ok"))
