"""Calendar expressions: hour rounding, weekday conventions, ISO weeks,
school holidays, Swedish public holidays, cyclic encodings, date windows.

All are Column expressions (no Python UDF).  The public-holiday set is a
small generated table (about 15 + 52 rows per year) joined by date.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.relational import col_or_lit


def round_hour(ts: Column) -> Column:
    """Nearest hour, half-up: ``((t + 1800) // 3600) * 3600``; keeps NTZ."""
    return F.date_trunc("hour", ts + F.expr("INTERVAL 30 MINUTES")).cast("timestamp_ntz")


def epoch_to_iso(epoch: Column) -> Column:
    """Epoch seconds -> UTC ISO-8601 text ``YYYY-MM-DDTHH:MM:SS+00:00``."""
    return F.concat(F.date_format(F.timestamp_seconds(epoch), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00"))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch of a (NTZ or LTZ) timestamp, UTC."""
    return F.unix_timestamp(ts.cast("timestamp"))


def hour_of_epoch(epoch_hour: Column) -> Column:
    """``(ts_hour // 3600) % 24`` as in the feed transform."""
    return F.pmod(F.floor(epoch_hour / 3600), F.lit(24)).cast("int")


def weekday0(ts: Column) -> Column:
    """0 = Monday ... 6 = Sunday (pandas ``dayofweek``)."""
    return F.weekday(ts)


def pg_dow_to_monday0(pg_dow: Column) -> Column:
    """Postgres ``EXTRACT(DOW)`` (0 = Sunday) -> 0 = Monday."""
    return F.pmod(pg_dow + 6, F.lit(7))


def calendar_parts(ts: Column) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day_of_week": F.weekday(ts),
        "est_weekend": F.weekday(ts).isin(5, 6).cast("int"),
    }


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts)


# Swedish school-holiday rule (ISO weeks and Christmas range).
SCHOOL_HOLIDAY_WEEKS = [9, 15, 44]          # sports, Easter, autumn break
SUMMER_WEEKS = (24, 33)                      # inclusive
CHRISTMAS_FROM = (12, 21)                    # 21 Dec ...
CHRISTMAS_TO = (1, 8)                        # ... 8 Jan


def school_holiday(ts: Column) -> Column:
    w, m, d = F.weekofyear(ts), F.month(ts), F.dayofmonth(ts)
    cond = (w.isin(*SCHOOL_HOLIDAY_WEEKS) | w.between(*SUMMER_WEEKS)
            | ((m == CHRISTMAS_FROM[0]) & (d >= CHRISTMAS_FROM[1]))
            | ((m == CHRISTMAS_TO[0]) & (d <= CHRISTMAS_TO[1])))
    return cond.cast("int")


def cyclic(x: Column, period: float) -> tuple[Column, Column]:
    ang = F.lit(2 * math.pi) * x / F.lit(float(period))
    return F.sin(ang), F.cos(ang)


def recent_date_for_dow(anchor_date: Column, dow: Column, lag_days: int = 3) -> Column:
    """Latest date on or before ``anchor - lag_days`` whose weekday is ``dow``."""
    a = F.date_sub(anchor_date, lag_days)
    return F.date_sub(a, F.pmod(F.weekday(a) - dow, F.lit(7)).cast("int"))


def date_window(as_of: Column, mode: str, archive_start: str = "2024-01-01") -> tuple[Column, Column]:
    """Archive: fixed start -> yesterday.  Forecast: today -> today + 7."""
    d = as_of.cast("date")
    if mode == "archive":
        return F.lit(archive_start).cast("date"), F.date_sub(d, 1)
    return d, F.date_add(d, 7)


def source_by_age(ts: Column, as_of, days: int = 2) -> Column:
    """'archive' when older than ``days`` before ``as_of``, else 'forecast'."""
    return F.when(ts < col_or_lit(as_of) - F.expr(f"INTERVAL {days} DAYS"), F.lit("archive")) \
        .otherwise(F.lit("forecast"))


# ---------------------------------------------------------------------------
# Swedish public holidays, generated per year.
# Fixed values (rules of the Swedish calendar):
#   1 Jan New Year's Day, 6 Jan Epiphany, Good Friday, Easter Sunday,
#   Easter Monday, 1 May, Ascension Day (Easter + 39), Whit Sunday
#   (Easter + 49), 6 Jun National Day, Midsummer Eve (Friday 19-25 Jun),
#   Midsummer Day (Saturday 20-26 Jun), All Saints' Day (Saturday 31 Oct -
#   6 Nov), 24 Dec Christmas Eve, 25 Dec, 26 Dec, 31 Dec New Year's Eve;
#   optionally every Sunday.
# ---------------------------------------------------------------------------
def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous Gregorian computus), as a date."""
    y = year
    a = F.pmod(y, F.lit(19))
    b = F.floor(y / 100)
    c = F.pmod(y, F.lit(100))
    d = F.floor(b / 4)
    e = F.pmod(b, F.lit(4))
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = F.pmod(19 * a + b - d - g + 15, F.lit(30))
    i = F.floor(c / 4)
    k = F.pmod(c, F.lit(4))
    l_ = F.pmod(32 + 2 * e + 2 * i - h - k, F.lit(7))
    m = F.floor((a + 11 * h + 22 * l_) / 451)
    month = F.floor((h + l_ - 7 * m + 114) / 31)
    day = F.pmod(h + l_ - 7 * m + 114, F.lit(31)) + 1
    return F.make_date(y.cast("int"), month.cast("int"), day.cast("int"))


def _first_weekday_on_or_after(d: Column, weekday: int) -> Column:
    """First date >= d with ``weekday(date) == weekday`` (0 = Monday)."""
    return F.date_add(d, F.pmod(F.lit(weekday) - F.weekday(d), F.lit(7)).cast("int"))


def public_holidays(spark: SparkSession, first_year: Column | int, last_year: Column | int,
                    include_sundays: bool = True, include_eves: bool = True,
                    years: DataFrame | None = None) -> DataFrame:
    """One row per (holiday date) between the two years, inclusive.

    ``years`` (one column ``y``) may be given instead, e.g. derived lazily
    from the data's span, so the table covers exactly the span of the data:
    ~15 fixed rows + 52 Sundays per year, a bounded broadcast.
    """
    if years is None:
        years = (spark.range(1).select(F.explode(F.sequence(col_or_lit(first_year).cast("int"),
                                                             col_or_lit(last_year).cast("int"))).alias("y")))
    y = F.col("y")
    md = lambda m, d: F.make_date(y, F.lit(m), F.lit(d))
    easter = easter_sunday(y)
    fixed = [
        md(1, 1), md(1, 6), F.date_sub(easter, 2), easter, F.date_add(easter, 1), md(5, 1),
        F.date_add(easter, 39), F.date_add(easter, 49), md(6, 6),
        _first_weekday_on_or_after(md(6, 20), 5), _first_weekday_on_or_after(md(10, 31), 5),
        md(12, 25), md(12, 26),
    ]
    if include_eves:
        fixed += [_first_weekday_on_or_after(md(6, 19), 4), md(12, 24), md(12, 31)]
    days = years.select(F.explode(F.array(*fixed)).alias("holiday_date"))
    if include_sundays:
        sundays = years.select(F.explode(F.sequence(
            _first_weekday_on_or_after(md(1, 1), 6), md(12, 31), F.expr("INTERVAL 7 DAYS"))).alias("holiday_date"))
        days = days.unionByName(sundays)
    return days.distinct()


def with_public_holiday(df: DataFrame, ts: str, out: str = "est_jour_ferie",
                        include_sundays: bool = True, include_eves: bool = True) -> DataFrame:
    """Flag rows whose date is a public holiday (left join to the generated
    table, which is bounded by the data's year span)."""
    span = df.select(F.min(F.year(ts)).alias("a"), F.max(F.year(ts)).alias("b"))  # one row, lazy
    years = span.select(F.explode(F.sequence(F.col("a").cast("int"), F.col("b").cast("int"))).alias("y"))
    hol = public_holidays(df.sparkSession, 0, 0, include_sundays, include_eves, years=years)
    hol = hol.withColumn("_hol", F.lit(1))
    return (df.join(F.broadcast(hol), F.to_date(F.col(ts)) == F.col("holiday_date"), "left")
            .withColumn(out, F.coalesce(F.col("_hol"), F.lit(0)))
            .drop("_hol", "holiday_date"))
