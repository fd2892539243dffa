"""Event / document queries: log errors, sessions with embedded arrays,
tags, JSON properties, feature maps and documents, point-in-time features,
velocity windows, feedback."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import documents as doc
from kestrel.operators import joins as jn
from kestrel.operators import windows as win
from kestrel.plans.registry import query

LOG_BOUND = "2024-01-15 00:00:00"
VELOCITY_USER = 12
VELOCITY_BOUND = "2024-01-20 00:00:00"

_LOGS_SQL = """logs AS (SELECT event_id, ts AS timestamp, CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level,
  'svc-' || CAST(user_id % 5 AS VARCHAR) AS service_name, 'event ' || CAST(event_id AS VARCHAR) AS message FROM events)"""


def _bound(s):
    return F.lit(s).cast("timestamp_ntz")


@query("filter_log_errors", oracle=f"""WITH {_LOGS_SQL}
SELECT event_id, service_name FROM logs WHERE timestamp >= TIMESTAMP '{LOG_BOUND}' AND level = 'ERROR'""")
def filter_log_errors(v):
    logs = doc.app_logs(v.t.events)
    return logs.where((F.col("timestamp") >= _bound(LOG_BOUND)) & (F.col("level") == "ERROR")).select(
        "event_id", "service_name")


@query("agg_errors_by_service", oracle=f"""WITH {_LOGS_SQL},
e AS (SELECT * FROM logs WHERE timestamp >= TIMESTAMP '{LOG_BOUND}' AND level = 'ERROR')
SELECT e.service_name, e.message, c.nb_erreurs FROM e JOIN (SELECT service_name, count(*) AS nb_erreurs FROM e GROUP BY 1) c
ON e.service_name = c.service_name""")
def agg_errors_by_service(v):
    return doc.errors_by_service(doc.app_logs(v.t.events), _bound(LOG_BOUND))


@query("agg_purchase_velocity", oracle=f"""
SELECT count(*) AS tx_count FROM events WHERE user_id = {VELOCITY_USER} AND event_type = 'purchase'
AND CAST(ts AS DATE) IN (SELECT CAST(ts AS DATE) FROM events WHERE user_id = {VELOCITY_USER}
                         GROUP BY 1 HAVING min(ts) >= TIMESTAMP '{VELOCITY_BOUND}')""")
def agg_purchase_velocity(v):
    """Purchases of one user in sessions starting after a bound, read from
    the sessions' embedded event arrays (filter HOF + explode + count)."""
    s = doc.sessions_by_day(v.t.events.where(F.col("user_id") == VELOCITY_USER))
    s = s.where(F.col("start_time") >= _bound(VELOCITY_BOUND))
    tx = s.select(F.explode(doc.purchases_in_sessions(s)).alias("tx"))
    return tx.agg(F.count(F.lit(1)).alias("tx_count"))


@query("arr_filter_events", oracle="""
SELECT user_id, CAST(ts AS DATE) AS day, count(*) FILTER (WHERE event_type = 'purchase') AS n_purchases,
       count(*) AS n_events FROM events GROUP BY 1, 2""")
def arr_filter_events(v):
    s = doc.sessions_by_day(v.t.events)
    return s.select("user_id", "day", F.size(doc.purchases_in_sessions(s)).cast("long").alias("n_purchases"),
                    F.size("events").cast("long").alias("n_events"))


@query("arr_tags", oracle="""
SELECT transaction_id, string_split(category, '-') AS tags FROM tx WHERE list_contains(string_split(category, '-'), 'HIGH')""")
def arr_tags(v):
    t = v.tx.select("transaction_id", doc.split_tags(F.col("category")).alias("tags"))
    return t.where(F.array_contains("tags", "HIGH"))


@query("json_props", oracle="""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""")
def json_props(v):
    return v.t.events.select("event_id", doc.json_int(F.col("props"), "$.k").alias("k"))


@query("map_features", oracle="""
WITH g AS (SELECT user_id, CAST(count(value) AS DOUBLE) AS c, round(sum(value), 6) AS s, max(value) AS m FROM events GROUP BY 1)
SELECT user_id, 'count' AS name, c AS value FROM g UNION ALL SELECT user_id, 'sum', s FROM g UNION ALL SELECT user_id, 'max', m FROM g""")
def map_features(v):
    return doc.explode_map(doc.feature_map(v.t.events, "user_id", "value"), "user_id")


@query("reverse_export", oracle="""
SELECT client_id, count(*) AS n_tx, sum(amount) AS total_amount FROM tx GROUP BY client_id""")
def reverse_export(v):
    g = v.tx.groupBy("client_id").agg(F.count(F.lit(1)).alias("n_tx"),
                                      F.sum("amount").cast("decimal(38,2)").alias("total_amount"))
    return g


_FEAT_SQL = """feat AS (SELECT user_id, CAST(ts AS DATE) AS feature_day, count(*) AS f_count, round(sum(value), 6) AS f_sum,
  max(value) AS f_max, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS valid_from FROM events GROUP BY 1, 2)"""


@query("win_latest_features", oracle=f"""WITH {_FEAT_SQL}
SELECT user_id, feature_day, f_count, f_sum, f_max FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY feature_day DESC) AS rn FROM feat) x WHERE rn = 1""")
def win_latest_features(v):
    f = doc.daily_features(v.t.events).select("user_id", "feature_day", "f_count", "f_sum", "f_max")
    return win.latest_per_key(f, ["user_id"], ["feature_day"])


@query("join_asof_features", oracle=f"""WITH {_FEAT_SQL}
SELECT e.event_id, e.user_id, f.feature_day, f.f_count, f.f_sum
FROM events e ASOF LEFT JOIN feat f ON e.user_id = f.user_id AND e.ts >= f.valid_from""")
def join_asof_features(v):
    f = doc.daily_features(v.t.events)
    probe = v.t.events.select("event_id", "user_id", "ts")
    j = jn.asof_join_bucketed(probe, f, "user_id", "ts", "valid_from", ["feature_day", "f_count", "f_sum"],
                              bucket_seconds=7 * 86400)
    return j.select("event_id", "user_id", "feature_day", "f_count", "f_sum")


def _purchases(v):
    return v.t.events.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")


def _range_sql(expr, seconds, alias):
    return f"""{expr} OVER (PARTITION BY user_id ORDER BY date_trunc('second', ts)
           RANGE BETWEEN INTERVAL {seconds} SECOND PRECEDING AND CURRENT ROW) AS {alias}"""


@query("win_velocity_1h", oracle=f"""
SELECT event_id, user_id, {_range_sql('count(*)', 3600, 'last_1h_txn_count')} FROM events WHERE event_type = 'purchase'""")
def win_velocity_1h(v):
    return win.rolling_time_agg(_purchases(v), "user_id", "ts", 3600, {"last_1h_txn_count": ("count", None)}) \
        .select("event_id", "user_id", "last_1h_txn_count")


@query("win_tx_count_7d", oracle=f"""
SELECT event_id, user_id, {_range_sql('count(*)', 604800, 'tx_count_7d')} FROM events WHERE event_type = 'purchase'""")
def win_tx_count_7d(v):
    return win.pane_time_agg(_purchases(v), "user_id", "ts", 604800, {"tx_count_7d": ("count", None)}) \
        .select("event_id", "user_id", "tx_count_7d")


@query("win_avg_spend_30d", oracle=f"""
SELECT event_id, user_id, round(avg_spend_30d, 6) AS avg_spend_30d FROM (
  SELECT event_id, user_id, {_range_sql('avg(value)', 2592000, 'avg_spend_30d')} FROM events WHERE event_type = 'purchase') x""")
def win_avg_spend_30d(v):
    r = win.pane_time_agg(_purchases(v), "user_id", "ts", 2592000, {"avg_spend_30d": ("avg", "value")})
    return r.select("event_id", "user_id", F.round("avg_spend_30d", 6).alias("avg_spend_30d"))


@query("join_feedback_tx", oracle="""
WITH fb AS (SELECT event_id AS transaction_id, 1 + event_id % 5 AS rating FROM events WHERE event_type = 'click')
SELECT t.category, count(*) AS n_feedback, round(avg(fb.rating), 6) AS mean_rating FROM fb JOIN tx t ON fb.transaction_id = t.transaction_id
GROUP BY t.category""")
def join_feedback_tx(v):
    fb = v.t.events.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("transaction_id"), (F.lit(1) + F.col("event_id") % 5).alias("rating"))
    return fb.join(v.tx, "transaction_id").groupBy("category").agg(
        F.count(F.lit(1)).alias("n_feedback"), F.round(F.avg("rating"), 6).alias("mean_rating"))
