"""Transit-delay chain: feed rows, hour rounding, weather join, calendar and
weather features, exploratory delay statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions import calendar as cal
from kestrel.functions import weather as wx
from kestrel.operators import aggregates as agg
from kestrel.operators import relational as rel
from kestrel.operators import windows as win
from kestrel.operators.selection import quantiles
from kestrel.plans.registry import query

WEATHER_COLS = ["temperature_2m", "precipitation", "snowfall", "wind_speed_10m", "weather_code"]
# Delay bins (seconds, right-closed) and their labels.
DELAY_EDGES = [-500, 0, 60, 120, 300, 600, 3000]
DELAY_LABELS = ["Avance", "0-1 min", "1-2 min", "2-5 min", "5-10 min", ">10 min"]
# Weekday names, 0 = Monday.
DAY_NAMES = ["Lun", "Mar", "Mer", "Jeu", "Ven", "Sam", "Dim"]
CORR_FEATURES = ["temperature_2m", "precipitation", "wind_speed_10m", "stop_sequence", "hour", "snowfall"]


def transport_weather(v) -> DataFrame:
    """Transport rows left-joined to hourly weather on the rounded hour.

    The weather side is one row per clock hour of the data span (8 760 rows
    a year per location); AQE broadcasts it when its measured size is small.
    """
    w = v.weather_hourly.select("timestamp_rounded", *WEATHER_COLS)
    return (v.transport_rt.join(w, "timestamp_rounded", "left")
            .withColumn("day_of_week", cal.weekday0(F.col("timestamp_rounded"))))


def delays(v) -> DataFrame:
    return rel.filter_not_null(transport_weather(v), "departure_delay")


DELAY_SQL = """delay AS (
  SELECT r.*, w.temperature_2m, w.precipitation, w.snowfall, w.wind_speed_10m, w.weather_code,
         CAST(isodow(r.timestamp_rounded) - 1 AS INT) AS day_of_week
  FROM transport_rt r LEFT JOIN weather_hourly w ON r.timestamp_rounded = w.timestamp_rounded
  WHERE r.departure_delay IS NOT NULL)"""


def dsql(body: str) -> str:
    return f"WITH {DELAY_SQL}\n{body}"


# -- joins ---------------------------------------------------------------------
@query("join_transport_weather", oracle="""
SELECT r.id, r.timestamp_rounded, r.departure_delay, w.temperature_2m, w.weather_code
FROM transport_rt r LEFT JOIN weather_hourly w ON r.timestamp_rounded = w.timestamp_rounded""")
def join_transport_weather(v):
    return transport_weather(v).select("id", "timestamp_rounded", "departure_delay",
                                       "temperature_2m", "weather_code")


def _daily_sun(hourly: DataFrame) -> DataFrame:
    d = F.to_date("timestamp_rounded")
    day = F.dayofmonth(F.col("date"))
    base = hourly.select(d.alias("date")).distinct()
    midnight = F.col("date").cast("timestamp_ntz")
    return base.select("date",
                       (midnight + F.expr("INTERVAL 1 MINUTE") * (F.lit(360) + day * 3)).alias("sunrise"),
                       (midnight + F.expr("INTERVAL 1 MINUTE") * (F.lit(960) - day * 2)).alias("sunset"))


_SUN_SQL = """
WITH daily AS (SELECT d AS date, CAST(d AS TIMESTAMP) + INTERVAL '1' MINUTE * (360 + day(d) * 3) AS sunrise,
                      CAST(d AS TIMESTAMP) + INTERVAL '1' MINUTE * (960 - day(d) * 2) AS sunset
               FROM (SELECT DISTINCT CAST(timestamp_rounded AS DATE) AS d FROM weather_hourly) x)
SELECT h.timestamp_rounded, {cols}
FROM weather_hourly h LEFT JOIN daily s ON CAST(h.timestamp_rounded AS DATE) = s.date"""


@query("join_daily_sun", oracle=_SUN_SQL.format(cols="s.sunrise, s.sunset"))
def join_daily_sun(v):
    h = v.weather_hourly.withColumn("date", F.to_date("timestamp_rounded"))
    return h.join(_daily_sun(v.weather_hourly), "date", "left").select("timestamp_rounded", "sunrise", "sunset")


@query("fn_daylight", oracle=_SUN_SQL.format(
    cols="coalesce(CAST(h.timestamp_rounded >= s.sunrise AND h.timestamp_rounded <= s.sunset AS INT), 0) AS soleil_leve"))
def fn_daylight(v):
    h = v.weather_hourly.withColumn("date", F.to_date("timestamp_rounded"))
    j = h.join(_daily_sun(v.weather_hourly), "date", "left")
    return j.select("timestamp_rounded",
                    wx.daylight(F.col("timestamp_rounded"), F.col("sunrise"), F.col("sunset")).alias("soleil_leve"))


# -- feed lookups (trip -> route / direction) ----------------------------------
def gtfs_trips(v) -> DataFrame:
    """Static reference: one trip per user, routes R0..R3, direction by parity."""
    return (v.t.events.select(F.col("user_id").alias("trip_id")).distinct()
            .select("trip_id", F.concat(F.lit("R"), (F.col("trip_id") % 4).cast("string")).alias("route_id"),
                    (F.col("trip_id") % 2).cast("string").alias("direction_id")))


def gtfs_routes(v) -> DataFrame:
    return (gtfs_trips(v).select("route_id").distinct()
            .select("route_id", F.when(F.substring("route_id", 2, 1).cast("int") < 2, "541")
                    .otherwise("542").alias("route_short_name")))


_GTFS_SQL = """trips AS (SELECT DISTINCT user_id AS trip_id, 'R' || CAST(user_id % 4 AS VARCHAR) AS route_id,
                      CAST(user_id % 2 AS VARCHAR) AS direction_id FROM events),
routes AS (SELECT DISTINCT route_id, CASE WHEN CAST(substr(route_id, 2, 1) AS INT) < 2 THEN '541' ELSE '542' END AS route_short_name FROM trips)"""


def selected_trips(v, line: str = "541") -> DataFrame:
    routes = rel.filter_eq_cast(gtfs_routes(v), "route_short_name", line)
    return routes.join(gtfs_trips(v), "route_id")


@query("join_route_trips", oracle=f"""WITH {_GTFS_SQL}
SELECT t.trip_id, t.route_id, t.direction_id FROM routes r JOIN trips t ON r.route_id = t.route_id
WHERE CAST(r.route_short_name AS VARCHAR) = '541'""")
def join_route_trips(v):
    return selected_trips(v).select("trip_id", "route_id", "direction_id")


@query("filter_eq_cast", oracle=f"""WITH {_GTFS_SQL}
SELECT route_id FROM routes WHERE CAST(route_short_name AS VARCHAR) = '541'""")
def filter_eq_cast(v):
    return rel.filter_eq_cast(gtfs_routes(v), "route_short_name", "541").select("route_id")


@query("join_semi_trips", oracle=f"""WITH {_GTFS_SQL}
SELECT e.event_id, e.user_id AS trip_id FROM events e
WHERE EXISTS (SELECT 1 FROM routes r JOIN trips t ON r.route_id = t.route_id
              WHERE r.route_short_name = '541' AND t.trip_id = e.user_id)""")
def join_semi_trips(v):
    feed = v.t.events.select("event_id", F.col("user_id").alias("trip_id"))
    return feed.join(selected_trips(v).select("trip_id"), "trip_id", "left_semi").select("event_id", "trip_id")


@query("join_lookup_broadcast", oracle=f"""WITH {_GTFS_SQL}
SELECT e.event_id, t.route_id, t.direction_id FROM events e JOIN trips t ON e.user_id = t.trip_id""")
def join_lookup_broadcast(v):
    """trip -> (route, direction) lookup; AQE broadcasts the timetable when
    its measured size is small."""
    feed = v.t.events.select("event_id", F.col("user_id").alias("trip_id"))
    lookup = gtfs_trips(v)
    return feed.join(lookup, "trip_id").select(
        "event_id", "route_id", "direction_id")


# -- scalar functions ------------------------------------------------------------
@query("fn_round_hour", oracle="""
SELECT id, date_trunc('hour', event_ts + INTERVAL '30' MINUTE) AS timestamp_rounded FROM transport_rt""")
def fn_round_hour(v):
    return v.transport_rt.select("id", cal.round_hour(F.col("event_ts")).alias("timestamp_rounded"))


_EPOCH_SQL = """
WITH e AS (SELECT id, CAST(floor(epoch(event_ts)) AS BIGINT) AS epoch_s FROM transport_rt),
h AS (SELECT id, epoch_s, ((epoch_s + 1800) // 3600) * 3600 AS ts_hour FROM e)
SELECT id, epoch_s, {col} FROM h"""


def _epoch_hours(v):
    e = v.transport_rt.select("id", cal.epoch_seconds(F.col("event_ts")).alias("epoch_s"))
    return e.withColumn("ts_hour", F.floor((F.col("epoch_s") + 1800) / 3600) * 3600)


@query("fn_epoch_to_iso", oracle=_EPOCH_SQL.format(
    col="strftime(make_timestamp(ts_hour * 1000000), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS timestamp_rounded"))
def fn_epoch_to_iso(v):
    return _epoch_hours(v).select("id", "epoch_s", cal.epoch_to_iso(F.col("ts_hour")).alias("timestamp_rounded"))


@query("fn_hour_utc", oracle=_EPOCH_SQL.format(col="CAST((ts_hour // 3600) % 24 AS INT) AS hour"))
def fn_hour_utc(v):
    return _epoch_hours(v).select("id", "epoch_s", cal.hour_of_epoch(F.col("ts_hour")).alias("hour"))


@query("fn_calendar_parts", oracle="""
SELECT timestamp_rounded, CAST(year(timestamp_rounded) AS INT) AS year, CAST(month(timestamp_rounded) AS INT) AS month,
       CAST(isodow(timestamp_rounded) - 1 AS INT) AS day_of_week,
       CAST(isodow(timestamp_rounded) IN (6, 7) AS INT) AS est_weekend FROM weather_hourly""")
def fn_calendar_parts(v):
    parts = cal.calendar_parts(F.col("timestamp_rounded"))
    return v.weather_hourly.select("timestamp_rounded", *[c.cast("int").alias(n) for n, c in parts.items()])


@query("fn_dow_convert", oracle="""
SELECT id, CAST((dayofweek(timestamp) + 6) % 7 AS INT) AS day_of_week FROM prediction_logs""")
def fn_dow_convert(v):
    pg_dow = F.dayofweek("timestamp") - 1  # Spark 1 = Sunday -> Postgres 0 = Sunday
    return v.prediction_logs.select("id", cal.pg_dow_to_monday0(pg_dow).cast("int").alias("day_of_week"))


@query("fn_iso_week", oracle="""
SELECT date_key, CAST(weekofyear(full_date) AS INT) AS iso_week FROM dim_date""")
def fn_iso_week(v):
    return v.dim_date.select("date_key", cal.iso_week(F.col("full_date")).cast("int").alias("iso_week"))


@query("fn_school_holidays", oracle="""
SELECT date_key, CAST(weekofyear(full_date) IN (9, 15, 44) OR weekofyear(full_date) BETWEEN 24 AND 33
       OR (month(full_date) = 12 AND day(full_date) >= 21) OR (month(full_date) = 1 AND day(full_date) <= 8) AS INT)
       AS vacances_scolaires FROM dim_date""")
def fn_school_holidays(v):
    return v.dim_date.select("date_key", cal.school_holiday(F.col("full_date")).alias("vacances_scolaires"))


_HOLIDAY_SQL = """
WITH yrs AS (SELECT range AS y FROM range((SELECT min(year(full_date)) FROM dim_date), (SELECT max(year(full_date)) FROM dim_date) + 1)),
c1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM yrs),
c2 AS (SELECT *, b // 4 AS d, b % 4 AS e, (b + 8) // 25 AS f FROM c1),
c3 AS (SELECT *, (b - f + 1) // 3 AS g, c // 4 AS i, c % 4 AS k FROM c2),
c4 AS (SELECT *, (19 * a + b - d - g + 15) % 30 AS h FROM c3),
c5 AS (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l FROM c4),
c6 AS (SELECT *, (a + 11 * h + 22 * l) // 451 AS m FROM c5),
easter AS (SELECT y, make_date(CAST(y AS INT), CAST((h + l - 7 * m + 114) // 31 AS INT), CAST((h + l - 7 * m + 114) % 31 + 1 AS INT)) AS es FROM c6),
fixed AS (
  SELECT make_date(CAST(y AS INT), 1, 1) AS hd FROM easter UNION ALL SELECT make_date(CAST(y AS INT), 1, 6) FROM easter
  UNION ALL SELECT CAST(es - INTERVAL 2 DAY AS DATE) FROM easter UNION ALL SELECT es FROM easter
  UNION ALL SELECT CAST(es + INTERVAL 1 DAY AS DATE) FROM easter UNION ALL SELECT make_date(CAST(y AS INT), 5, 1) FROM easter
  UNION ALL SELECT CAST(es + INTERVAL 39 DAY AS DATE) FROM easter UNION ALL SELECT CAST(es + INTERVAL 49 DAY AS DATE) FROM easter
  UNION ALL SELECT make_date(CAST(y AS INT), 6, 6) FROM easter
  UNION ALL SELECT CAST(make_date(CAST(y AS INT), 6, 20) + INTERVAL 1 DAY * ((5 - (isodow(make_date(CAST(y AS INT), 6, 20)) - 1) + 7) % 7) AS DATE) FROM easter
  UNION ALL SELECT CAST(make_date(CAST(y AS INT), 10, 31) + INTERVAL 1 DAY * ((5 - (isodow(make_date(CAST(y AS INT), 10, 31)) - 1) + 7) % 7) AS DATE) FROM easter
  UNION ALL SELECT make_date(CAST(y AS INT), 12, 25) FROM easter UNION ALL SELECT make_date(CAST(y AS INT), 12, 26) FROM easter
  UNION ALL SELECT CAST(make_date(CAST(y AS INT), 6, 19) + INTERVAL 1 DAY * ((4 - (isodow(make_date(CAST(y AS INT), 6, 19)) - 1) + 7) % 7) AS DATE) FROM easter
  UNION ALL SELECT make_date(CAST(y AS INT), 12, 24) FROM easter UNION ALL SELECT make_date(CAST(y AS INT), 12, 31) FROM easter),
hol AS (SELECT DISTINCT hd FROM fixed)
SELECT date_key, CAST(dayofweek(full_date) = 0 OR full_date IN (SELECT hd FROM hol) AS INT) AS est_jour_ferie FROM dim_date"""


@query("fn_public_holiday", oracle=_HOLIDAY_SQL)
def fn_public_holiday(v):
    d = v.dim_date.select("date_key", "full_date")
    return cal.with_public_holiday(d, "full_date").select("date_key", "est_jour_ferie")


@query("fn_weather_risks", oracle="""
SELECT timestamp_rounded,
       CAST(temperature_2m <= 0 AND weather_code IN (61, 63, 65) AS INT) AS risque_gel_pluie,
       CAST(temperature_2m <= 0 AND weather_code IN (71, 73, 75) AS INT) AS risque_gel_neige,
       CAST(temperature_2m > 0 AND weather_code IN (71, 73, 75) AS INT) AS neige_fondue FROM weather_hourly""")
def fn_weather_risks(v):
    r = wx.weather_risks(F.col("temperature_2m"), F.col("weather_code"))
    return v.weather_hourly.select("timestamp_rounded", *[c.alias(n) for n, c in r.items()])


@query("fn_weather_risks_amount", oracle="""
SELECT timestamp_rounded,
       CAST(temperature_2m <= 0 AND precipitation > 0 AND snowfall = 0 AS INT) AS risque_gel_pluie,
       CAST(temperature_2m <= 0 AND snowfall > 0 AS INT) AS risque_gel_neige,
       CAST(temperature_2m > 0 AND snowfall > 0 AS INT) AS neige_fondue FROM weather_hourly""")
def fn_weather_risks_amount(v):
    r = wx.weather_risks(F.col("temperature_2m"), F.col("weather_code"), F.col("precipitation"),
                         F.col("snowfall"), rule="amount")
    return v.weather_hourly.select("timestamp_rounded", *[c.alias(n) for n, c in r.items()])


_RECODE_SQL = """CASE WHEN weather_code IN (61, 63, 65) THEN 'Pluie' WHEN weather_code IN (71, 73, 75) THEN 'Neige'
       WHEN weather_code IN (51, 53, 55) THEN 'Bruine' WHEN weather_code IN (1, 2, 3) THEN 'Nuageux'
       WHEN weather_code = 0 THEN 'Ciel clair' ELSE CAST(weather_code AS VARCHAR) END"""


@query("fn_weather_recode", oracle=f"SELECT timestamp_rounded, {_RECODE_SQL} AS weather FROM weather_hourly")
def fn_weather_recode(v):
    return v.weather_hourly.select("timestamp_rounded", wx.recode(F.col("weather_code")).alias("weather"))


@query("fn_weather_severity", oracle="""
SELECT timestamp_rounded, CASE WHEN weather_code BETWEEN 0 AND 3 THEN 'Normal' WHEN weather_code BETWEEN 51 AND 65 THEN 'Precipitation'
       WHEN weather_code BETWEEN 71 AND 75 THEN 'Ice/Snow' ELSE 'Other' END AS severity FROM weather_hourly""")
def fn_weather_severity(v):
    return v.weather_hourly.select("timestamp_rounded", wx.severity(F.col("weather_code")).alias("severity"))


@query("fn_cyclic", oracle="""
SELECT id, round(sin(2 * pi() * hour / 24), 6) AS hour_sin, round(cos(2 * pi() * hour / 24), 6) AS hour_cos,
       round(sin(2 * pi() * day_of_week / 7), 6) AS day_sin, round(cos(2 * pi() * day_of_week / 7), 6) AS day_cos,
       round(sin(2 * pi() * month / 12), 6) AS month_sin, round(cos(2 * pi() * month / 12), 6) AS month_cos
FROM prediction_logs""")
def fn_cyclic(v):
    cols = []
    for name, p in (("hour", 24), ("day", 7), ("month", 12)):
        src = "day_of_week" if name == "day" else name
        s, c = cal.cyclic(F.col(src), p)
        cols += [F.round(s, 6).alias(f"{name}_sin"), F.round(c, 6).alias(f"{name}_cos")]
    return v.prediction_logs.select("id", *cols)


_BINS_SQL = """CASE WHEN departure_delay > -500 AND departure_delay <= 0 THEN 'Avance'
       WHEN departure_delay > 0 AND departure_delay <= 60 THEN '0-1 min'
       WHEN departure_delay > 60 AND departure_delay <= 120 THEN '1-2 min'
       WHEN departure_delay > 120 AND departure_delay <= 300 THEN '2-5 min'
       WHEN departure_delay > 300 AND departure_delay <= 600 THEN '5-10 min'
       WHEN departure_delay > 600 AND departure_delay <= 3000 THEN '>10 min' END"""


@query("fn_delay_bins", oracle=f"SELECT id, {_BINS_SQL} AS delay_category FROM transport_rt")
def fn_delay_bins(v):
    return v.transport_rt.select(
        "id", agg.right_closed_bins(F.col("departure_delay"), DELAY_EDGES, DELAY_LABELS).alias("delay_category"))


@query("fn_units", oracle="""
SELECT id, round(departure_delay / 60, 6) AS delay_minutes, round(departure_delay / 60, 2) AS delay_minutes_2 FROM transport_rt""")
def fn_units(v):
    d = F.col("departure_delay")
    return v.transport_rt.select("id", F.round(d / 60, 6).alias("delay_minutes"), F.round(d / 60, 2).alias("delay_minutes_2"))


@query("fn_recent_date_for_dow", oracle="""
WITH a AS (SELECT CAST(max(timestamp) AS DATE) - 3 AS anchor FROM prediction_logs)
SELECT id, CAST(anchor - CAST((((isodow(anchor) - 1 - day_of_week) % 7 + 7) % 7) AS INTEGER) AS DATE) AS target_date
FROM prediction_logs CROSS JOIN a""")
def fn_recent_date_for_dow(v):
    anchor = F.to_date(rel.max_of(v.prediction_logs, "timestamp"))
    return v.prediction_logs.select("id", cal.recent_date_for_dow(anchor, F.col("day_of_week")).alias("target_date"))


@query("fn_date_window", oracle="""
WITH a AS (SELECT CAST(max(event_ts) AS DATE) AS d FROM transport_rt)
SELECT 'archive' AS mode, CAST(x AS DATE) AS day FROM a, generate_series(DATE '2024-01-01', d - 1, INTERVAL 1 DAY) g(x)
UNION ALL
SELECT 'forecast' AS mode, CAST(x AS DATE) AS day FROM a, generate_series(d, d + 7, INTERVAL 1 DAY) g(x)""")
def fn_date_window(v):
    as_of = rel.max_of(v.transport_rt, "event_ts")
    one = v.spark.range(1)
    out = []
    for mode in ("archive", "forecast"):
        s, e = cal.date_window(as_of, mode)
        out.append(one.select(F.lit(mode).alias("mode"), F.explode(F.sequence(s, e)).alias("day")))
    return out[0].unionByName(out[1])


@query("fn_source_by_age", oracle="""
SELECT id, CASE WHEN timestamp < (SELECT max(timestamp) FROM prediction_logs) - INTERVAL 2 DAY THEN 'archive' ELSE 'forecast' END AS source
FROM prediction_logs""")
def fn_source_by_age(v):
    as_of = rel.max_of(v.prediction_logs, "timestamp")
    return v.prediction_logs.select("id", cal.source_by_age(F.col("timestamp"), as_of).alias("source"))


# -- filters / projections on the delay table -------------------------------
@query("filter_not_null", oracle=dsql("SELECT id, departure_delay FROM delay"))
def filter_not_null(v):
    return delays(v).select("id", "departure_delay")


@query("clip_lower", oracle="""
SELECT id, CASE WHEN departure_delay < 0 THEN 0.0 ELSE departure_delay END AS delay_clipped FROM transport_rt""")
def clip_lower(v):
    return v.transport_rt.select("id", rel.clip_lower(F.col("departure_delay"), 0.0).alias("delay_clipped"))


@query("flag_delayed", oracle="""
SELECT id, CAST(departure_delay > 0 AS INT) AS has_delay, CAST(departure_delay > 0.1 AS INT) AS is_delayed FROM transport_rt""")
def flag_delayed(v):
    d = F.col("departure_delay")
    return v.transport_rt.select("id", rel.flag(d > 0).alias("has_delay"), rel.flag(d > 0.1).alias("is_delayed"))


@query("fill_constant", oracle="""
SELECT r.id, coalesce(r.departure_delay, 0) AS departure_delay, coalesce(w.temperature_2m, 0) AS temperature_2m,
       coalesce(w.weather_code, 0) AS weather_code, coalesce(r.bus_nbr, 'missing') AS bus_nbr,
       coalesce(CAST(w.weather_code AS VARCHAR), 'missing') AS weather_label
FROM transport_rt r LEFT JOIN weather_hourly w ON r.timestamp_rounded = w.timestamp_rounded""")
def fill_constant(v):
    j = transport_weather(v).select("id", "departure_delay", "temperature_2m", "weather_code", "bus_nbr",
                                    F.col("weather_code").cast("string").alias("weather_label"))
    return rel.fill_constant(j)


@query("project_drop_if_present", oracle="""
SELECT id, timestamp_rounded, hour, bus_nbr, direction_id, stop_sequence, departure_delay FROM transport_rt""")
def project_drop_if_present(v):
    return rel.drop_if_present(v.transport_rt, ["event_ts", "trip_id", "route_id", "vehicle_id"])


@query("project_rename_if_present", oracle="""
SELECT timestamp_rounded AS timestamp, temperature_2m FROM weather_hourly""")
def project_rename_if_present(v):
    w = v.weather_hourly.select("timestamp_rounded", "temperature_2m")
    return rel.rename_if_present(w, {"timestamp_rounded": "timestamp", "time": "ignored"})


@query("project_reorder", oracle="""
SELECT weather_code, timestamp_rounded, temperature_2m, precipitation, snowfall, wind_speed_10m FROM weather_hourly""")
def project_reorder(v):
    return rel.reorder(v.weather_hourly, ["weather_code"])


@query("project_numeric_only", oracle="""
SELECT id, hour, direction_id, stop_sequence, departure_delay FROM transport_rt""")
def project_numeric_only(v):
    return rel.numeric_only(v.transport_rt)


@query("set_columns_diff", oracle="\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, {i} AS position, count({c}) AS n_values, count(DISTINCT {c}) AS n_distinct "
    "FROM transport_rt" for i, c in enumerate(["bus_nbr", "direction_id", "event_ts", "hour", "stop_sequence"], 1)))
def set_columns_diff(v):
    """The columns that a contract doesn't list, with what they hold in all
    rows (values and different values)."""
    t = v.transport_rt
    cols = sorted(rel.columns_minus(t, ["id", "timestamp_rounded", "departure_delay"]))
    long = t.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"),
                                                 F.col(c).cast("string").alias("value"))
                                        for i, c in enumerate(cols, 1)])).alias("x")).select("x.*")
    # counts per value first, so that a common value is one row per task
    per_value = long.groupBy("column_name", "position", "value").agg(F.count("value").alias("n"))
    return per_value.groupBy("column_name", "position").agg(
        F.sum("n").alias("n_values"), F.count("value").alias("n_distinct"))


# -- exploratory aggregates -----------------------------------------------------
@query("agg_span", oracle=dsql("""
SELECT count(*) AS n_rows, min(timestamp_rounded) AS first_ts, max(timestamp_rounded) AS last_ts,
       count(DISTINCT CAST(timestamp_rounded AS DATE)) AS n_days FROM delay"""))
def agg_span(v):
    return agg.span(delays(v), "timestamp_rounded")


@query("agg_describe", oracle=dsql("""
SELECT count(departure_delay) AS count, round(avg(departure_delay), 6) AS mean, round(stddev_samp(departure_delay), 6) AS std,
       min(departure_delay) AS min, round(quantile_cont(departure_delay, 0.25), 6) AS p25,
       round(quantile_cont(departure_delay, 0.5), 6) AS p50, round(quantile_cont(departure_delay, 0.75), 6) AS p75,
       max(departure_delay) AS max FROM delay"""))
def agg_describe(v):
    return agg.describe(delays(v), "departure_delay")


@query("agg_median_mode", oracle=dsql("""
SELECT round(median(departure_delay), 6) AS median, CAST((SELECT departure_delay FROM delay GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS DOUBLE) AS mode
FROM delay"""))
def agg_median_mode(v):
    return agg.median_mode(delays(v), "departure_delay")


@query("agg_conditional_stats", oracle=dsql("""
SELECT count(departure_delay) AS n, round(avg(departure_delay) / 60, 6) AS mean_all,
       round(avg(departure_delay) FILTER (WHERE departure_delay > 0) / 60, 6) AS mean_cond,
       round(stddev_samp(departure_delay) / 60, 6) AS std_all,
       round(stddev_samp(departure_delay) FILTER (WHERE departure_delay > 0) / 60, 6) AS std_cond,
       round(count(departure_delay) FILTER (WHERE departure_delay > 0) * 100.0 / count(departure_delay), 6) AS pct_cond FROM delay"""))
def agg_conditional_stats(v):
    return agg.conditional_stats(delays(v), "departure_delay", F.col("departure_delay") > 0)


@query("agg_boxplot", oracle=dsql("""
SELECT CASE WHEN departure_delay / 60 < 2 THEN '< 2 min' ELSE '>= 2 min' END AS class, count(*) AS n,
       round(quantile_cont(departure_delay / 60, 0.0), 6) AS min, round(quantile_cont(departure_delay / 60, 0.25), 6) AS q1,
       round(quantile_cont(departure_delay / 60, 0.5), 6) AS median, round(quantile_cont(departure_delay / 60, 0.75), 6) AS q3,
       round(quantile_cont(departure_delay / 60, 1.0), 6) AS max
FROM delay WHERE departure_delay / 60 <= 20 GROUP BY 1"""))
def agg_boxplot(v):
    d = delays(v).withColumn("delay_minutes", F.col("departure_delay") / 60).where(F.col("delay_minutes") <= 20)
    cls = F.when(F.col("delay_minutes") < 2, "< 2 min").otherwise(">= 2 min")
    return agg.five_numbers(d, "delay_minutes", cls)


@query("agg_boxplot_zoom", oracle=dsql("""
SELECT count(*) AS n, round(quantile_cont(departure_delay / 60, 0.5), 6) AS median FROM delay
WHERE departure_delay / 60 >= 0 AND departure_delay / 60 <= 5"""))
def agg_boxplot_zoom(v):
    m = F.col("departure_delay") / 60
    d = delays(v).withColumn("delay_minutes", m).where((m >= 0) & (m <= 5))
    return quantiles(d, "delay_minutes", (0.5,), ("median",)).select("n", F.round("median", 6).alias("median"))


@query("agg_bin_shares", oracle=dsql(f"""
SELECT delay_category AS bin, count(*) AS count, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct
FROM (SELECT {_BINS_SQL} AS delay_category FROM delay) b WHERE delay_category IS NOT NULL GROUP BY 1"""))
def agg_bin_shares(v):
    return agg.bin_shares(delays(v), F.col("departure_delay"), DELAY_EDGES, DELAY_LABELS)


@query("agg_histogram", oracle=dsql("""
, s AS (SELECT min(departure_delay) AS lo, max(departure_delay) AS hi FROM delay)
SELECT CAST(least(floor((departure_delay - lo) / ((hi - lo) / 50.0)) + 1, 50) AS INT) AS bucket,
       CAST(departure_delay > 0 AS INT) AS class, count(*) AS count,
       round(lo + (CAST(least(floor((departure_delay - lo) / ((hi - lo) / 50.0)) + 1, 50) AS INT) - 1) * ((hi - lo) / 50.0), 6) AS lower
FROM delay CROSS JOIN s GROUP BY 1, 2, lo, hi"""))
def agg_histogram(v):
    d = delays(v)
    return agg.equal_width_histogram(d, "departure_delay", 50, by=(F.col("departure_delay") > 0).cast("int"))


@query("agg_delay_by_hour", oracle=dsql("""
SELECT hour, round(avg(CAST(departure_delay > 0 AS INT)), 6) AS prob_retard, round(avg(departure_delay), 6) AS retard_moyen
FROM delay GROUP BY hour"""))
def agg_delay_by_hour(v):
    d = delays(v)
    return d.groupBy("hour").agg(F.round(F.avg(rel.flag(F.col("departure_delay") > 0)), 6).alias("prob_retard"),
                                 F.round(F.avg("departure_delay"), 6).alias("retard_moyen"))


@query("agg_delay_by_dow", oracle=dsql("""
SELECT day_of_week, round(avg(CAST(departure_delay > 0 AS INT)), 6) AS prob_retard, round(avg(departure_delay), 6) AS retard_moyen,
       ['Lun', 'Mar', 'Mer', 'Jeu', 'Ven', 'Sam', 'Dim'][day_of_week + 1] AS day_name
FROM delay GROUP BY day_of_week"""))
def agg_delay_by_dow(v):
    d = delays(v)
    names = F.array(*[F.lit(n) for n in DAY_NAMES])
    g = d.groupBy("day_of_week").agg(F.round(F.avg(rel.flag(F.col("departure_delay") > 0)), 6).alias("prob_retard"),
                                     F.round(F.avg("departure_delay"), 6).alias("retard_moyen"))
    return g.withColumn("day_name", F.element_at(names, F.col("day_of_week") + 1))


@query("agg_weather_impact", oracle=dsql(f"""
SELECT {_RECODE_SQL} AS weather, count(*) AS n, round(avg(CAST(departure_delay > 0 AS INT)), 2) AS prob_retard,
       round(avg(departure_delay), 2) AS retard_moyen_sec, round(round(avg(departure_delay), 2) / 60, 6) AS retard_moyen_min
FROM delay WHERE weather_code IS NOT NULL GROUP BY 1"""))
def agg_weather_impact(v):
    d = delays(v).where(F.col("weather_code").isNotNull())
    g = d.groupBy(wx.recode(F.col("weather_code")).alias("weather")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(rel.flag(F.col("departure_delay") > 0)), 2).alias("prob_retard"),
        F.round(F.avg("departure_delay"), 2).alias("retard_moyen_sec"))
    return g.withColumn("retard_moyen_min", F.round(F.col("retard_moyen_sec") / 60, 6))


@query("agg_levels", oracle=dsql("""
SELECT count(DISTINCT CAST(weather_code AS VARCHAR)) AS n_levels, list_sort(list(DISTINCT CAST(weather_code AS VARCHAR)) FILTER (WHERE weather_code IS NOT NULL)) AS levels
FROM delay"""))
def agg_levels(v):
    return agg.levels(delays(v), "weather_code")


@query("agg_corr_with_target", oracle=dsql("""
SELECT feature, round(c0, 6) AS corr_without, round(c1, 6) AS corr_with, round(c1 - c0, 6) AS difference FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT '{f}' AS feature, corr({f}, departure_delay) FILTER (WHERE departure_delay <= 0) AS c0, "
    f"corr({f}, departure_delay) FILTER (WHERE departure_delay > 0) AS c1 FROM delay" for f in CORR_FEATURES) + ") x"))
def agg_corr_with_target(v):
    d = delays(v)
    return agg.corr_with_target(d, CORR_FEATURES, "departure_delay", (F.col("departure_delay") > 0).cast("int"))


_MATRIX_COLS = ["temperature_2m", "precipitation", "wind_speed_10m", "stop_sequence", "departure_delay"]


@query("agg_corr_matrix", oracle=dsql("""
SELECT var_a, var_b, round(c0, 6) AS corr_without, round(c1, 6) AS corr_with, round(c1 - c0, 6) AS difference FROM (
""" + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, corr({a}, {b}) FILTER (WHERE departure_delay <= 0) AS c0, "
    f"corr({a}, {b}) FILTER (WHERE departure_delay > 0) AS c1 FROM delay"
    for a in _MATRIX_COLS for b in _MATRIX_COLS) + ") x"))
def agg_corr_matrix(v):
    return agg.corr_matrix(delays(v), _MATRIX_COLS, (F.col("departure_delay") > 0).cast("int"))


@query("agg_distinct_combos", oracle=dsql("""
SELECT DISTINCT direction_id, stop_sequence, CAST((dayofweek(timestamp_rounded) + 6) % 7 AS INT) AS day_of_week,
       CAST(hour(timestamp_rounded) AS INT) AS hour
FROM delay WHERE CAST(bus_nbr AS VARCHAR) = '541'"""))
def agg_distinct_combos(v):
    d = rel.filter_eq_cast(delays(v), "bus_nbr", "541")
    return (d.select("direction_id", "stop_sequence", cal.weekday0(F.col("timestamp_rounded")).cast("int").alias("day_of_week"),
                     F.hour("timestamp_rounded").cast("int").alias("hour"))
            .distinct().orderBy("direction_id", "stop_sequence", "day_of_week", "hour"))


@query("set_distinct_rows", oracle="""
SELECT DISTINCT bus_nbr, direction_id, stop_sequence FROM transport_rt""")
def set_distinct_rows(v):
    return v.transport_rt.select("bus_nbr", "direction_id", "stop_sequence").distinct()


@query("win_share_of_total", oracle=dsql("""
SELECT hour, count(*) AS count, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM delay GROUP BY hour"""))
def win_share_of_total(v):
    g = delays(v).groupBy("hour").agg(F.count(F.lit(1)).alias("count"))
    return win.share_of_total(g)


_CAP_SQL = """
SELECT id, direction_id, stop_sequence{extra} FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY md5(CAST(id AS VARCHAR) || '42'), id) AS rn FROM transport_rt) x
WHERE rn <= 2"""


@query("win_cap_per_group", oracle=_CAP_SQL.format(extra="", keys="direction_id, stop_sequence"))
def win_cap_per_group(v):
    """Observed behaviour: cap of 2 per (direction, stop) per run."""
    return win.cap_per_group(v.transport_rt, ["direction_id", "stop_sequence"], 2, "id").select(
        "id", "direction_id", "stop_sequence")


@query("win_cap_per_group_hourly", oracle=_CAP_SQL.format(extra=", hour", keys="hour, direction_id, stop_sequence"))
def win_cap_per_group_hourly(v):
    """Stated intent: cap of 2 buses per (hour, direction, stop)."""
    return win.cap_per_group(v.transport_rt, ["hour", "direction_id", "stop_sequence"], 2, "id").select(
        "id", "direction_id", "stop_sequence", "hour")


@query("fn_suffix_filter", oracle="""
SELECT page_id, url FROM pages WHERE regexp_matches(lower(regexp_replace(url, '[?#].*$', '')), '\\.(html|htm)$')""")
def fn_suffix_filter(v):
    from kestrel.sources.archives import suffix_matches
    return v.t.pages.where(suffix_matches(F.regexp_replace("url", r"[?#].*$", ""), (".html", ".htm"))).select(
        "page_id", "url")


@query("filter_between", oracle="""
SELECT id, day_of_week FROM prediction_logs WHERE day_of_week BETWEEN 0 AND 6""")
def filter_between(v):
    return v.prediction_logs.where(F.col("day_of_week").between(0, 6)).select("id", "day_of_week")
