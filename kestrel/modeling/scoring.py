"""Batch scoring of delay-prediction requests.

A request carries direction, month, day, hour and weekday (mandatory) and
optionally a line and a stop (defaults '541' and 1).  Requests are enriched
with calendar flags and the weather of their hour (a join against the
hourly weather table, which is one row per hour), scored by the P50 / P80 /
P90 models and returned as prediction-log rows.  Requests missing a
mandatory field are returned separately as a quarantine with the missing
names; requests without weather keep a 'weather_unavailable' status.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions import calendar as cal
from kestrel.functions import weather as wx
from kestrel.quality.profile import required_fields

# Request defaults and mandatory fields of the scoring API.
DEFAULT_BUS = "541"
DEFAULT_STOP = 1
MANDATORY = ["direction_id", "month", "day", "hour", "day_of_week"]


def prepare_requests(requests: DataFrame, year: int | Column) -> tuple[DataFrame, DataFrame]:
    """Apply defaults and split valid requests from the quarantine."""
    r = requests
    if "bus_nbr" not in r.columns:
        r = r.withColumn("bus_nbr", F.lit(None).cast("string"))
    if "stop_sequence" not in r.columns:
        r = r.withColumn("stop_sequence", F.lit(None).cast("int"))
    r = r.withColumns({"bus_nbr": F.coalesce(F.col("bus_nbr"), F.lit(DEFAULT_BUS)),
                       "stop_sequence": F.coalesce(F.col("stop_sequence"), F.lit(DEFAULT_STOP))})
    checked = required_fields(r, MANDATORY)
    bad = checked.where(~F.col("is_valid")).drop("is_valid")
    good = checked.where(F.col("is_valid")).drop("is_valid", "missing_fields")
    year = F.lit(year) if isinstance(year, int) else year
    good = good.withColumn("request_ts", F.try_make_timestamp_ntz(year, F.col("month"), F.col("day"), F.col("hour"),
                                                                  F.lit(0), F.lit(0)))
    # a date that doesn't exist (30 February) is a bad request, not an error
    no_date = good.where(F.col("request_ts").isNull()).drop("request_ts").withColumn(
        "missing_fields", F.array(F.lit("date")))
    bad = bad.unionByName(no_date.select(*[F.col(c).cast(bad.schema[c].dataType) for c in bad.columns]))
    return good.where(F.col("request_ts").isNotNull()), bad


#: Levels in string order, of which the first has no column (fixed values).
DUMMY_LEVELS = {"direction_id": ["0", "1"],
                "weather_code": ["0", "1", "2", "3", "51", "53", "55", "61", "63", "65", "71", "73", "75"]}
DELAY_FEATURES = ["stop_sequence", "hour", "day_of_week", "month", "day",
                  "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos",
                  "temperature_2m", "precipitation", "snowfall", "wind_speed_10m",
                  *[f"{col}_{level}" for col, levels in DUMMY_LEVELS.items() for level in levels[1:]]]


def delay_terms(df: DataFrame) -> DataFrame:
    """The delay models' derived terms: hour, weekday and month on a circle,
    and 0/1 columns of direction and weather code less their first levels (a
    level not named gives zeros)."""
    terms = {}
    for col, short, period in (("hour", "hour", 24), ("day_of_week", "day", 7), ("month", "month", 12)):
        terms[f"{short}_sin"], terms[f"{short}_cos"] = cal.cyclic(F.col(col), period)
    for col, levels in DUMMY_LEVELS.items():
        for level in levels[1:]:
            terms[f"{col}_{level}"] = F.coalesce((F.col(col).cast("string") == level).cast("int"), F.lit(0))
    return df.withColumns(terms)


def enrich(good: DataFrame, weather_hourly: DataFrame) -> DataFrame:
    """Calendar flags and the weather of the request's hour."""
    w = weather_hourly.withColumnRenamed("timestamp_rounded", "request_ts")
    e = good.join(w, "request_ts", "left")
    return delay_terms(e).withColumns({
        "est_weekend": F.col("day_of_week").isin(5, 6).cast("int"),
        "vacances_scolaires": cal.school_holiday(F.col("request_ts")),
        **wx.weather_risks(F.col("temperature_2m"), F.col("weather_code")),
        "weather_status": F.when(F.col("temperature_2m").isNull(), "weather_unavailable").otherwise("ok"),
    })


def score(enriched: DataFrame, models: dict, feature_cols: list[str]) -> DataFrame:
    from kestrel.modeling.models import assemble
    # missing measures are scored as 0 (their status column says so)
    s = assemble(enriched.na.fill(0.0, feature_cols), feature_cols)
    for name, mdl in models.items():
        s = mdl.transform(s, out=f"prediction_{name}")
    return s.drop("features")
