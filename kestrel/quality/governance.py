"""Privacy and governance operators on tables: tokenisation, masking,
column classification, subject access, retention purge, request SLAs, alert backlog, extraction-volume anomalies and a
composite quality score.  All are column expressions and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokenise(value: Column, salt: str) -> Column:
    """Deterministic token: SHA-256 of ``salt || value`` (hex)."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)


def mask_keep_last(value: Column, keep: int = 4, char: str = "*") -> Column:
    s = value.cast("string")
    return F.concat(F.repeat(F.lit(char), F.greatest(F.length(s) - keep, F.lit(0))), F.right(s, F.lit(keep)))


def mask_digits(text: Column, char: str = "#") -> Column:
    return F.regexp_replace(text, r"[0-9]", char)


# Sensitivity levels and their required controls.
LEVEL_CONTROLS = [("N4", "encrypt and mask"), ("N3", "restricted access"), ("N2", "internal"), ("N1", "public")]
N4_PATTERN = r"(name|email|text|phone|address|html|url)"
N3_PATTERN = r"(price|amount|acctbal|value|props|discount|tax|quantity|embedding)"
N2_PATTERN = r"(key|_id|id)$"
N1_TABLES = ["region", "nation"]


def classify(columns: DataFrame) -> DataFrame:
    """(table_name, column_name) -> sensitivity level and required control."""
    t, c = F.col("table_name"), F.lower(F.col("column_name"))
    level = (F.when(t.isin(*N1_TABLES), "N1").when(c.rlike(N4_PATTERN), "N4")
             .when(c.rlike(N3_PATTERN), "N3").when(c.rlike(N2_PATTERN), "N2").otherwise("N2"))
    control = F.coalesce(*[F.when(level == lv, F.lit(ctl)) for lv, ctl in LEVEL_CONTROLS])
    return columns.select("table_name", "column_name", level.alias("level"), control.alias("control"))


def purge_older_than(df: DataFrame, ts: str, as_of: Column, days: int) -> DataFrame:
    return df.where(F.col(ts) >= as_of - F.expr(f"INTERVAL {int(days)} DAYS"))


def request_sla(requests: DataFrame, opened: str, acknowledged: str, answered: str,
                ack_hours: int = 72, answer_days: int = 30) -> DataFrame:
    """Per month: requests, % acknowledged within ``ack_hours`` and %
    answered within ``answer_days``."""
    ack_ok = F.col(acknowledged) <= F.col(opened) + F.expr(f"INTERVAL {ack_hours} HOURS")
    ans_ok = F.col(answered) <= F.col(opened) + F.expr(f"INTERVAL {answer_days} DAYS")
    return requests.groupBy(F.date_trunc("month", opened).cast("date").alias("month")).agg(
        F.count(F.lit(1)).alias("n_requests"),
        F.round(F.avg(ans_ok.cast("int")) * 100, 6).alias("pct_answered_30d"),
        F.round(F.avg(ack_ok.cast("int")) * 100, 6).alias("pct_ack_72h"))


def alert_backlog(alerts: DataFrame, opened: str, resolved: str) -> DataFrame:
    hours = (F.unix_timestamp(F.col(resolved).cast("timestamp")) - F.unix_timestamp(F.col(opened).cast("timestamp"))) / 3600.0
    return alerts.agg(
        F.count_if(F.col(resolved).isNull()).alias("n_unresolved"),
        F.round(F.avg(hours), 6).alias("mean_hours_to_resolve"),
        F.round(F.avg(F.when(F.col(resolved).isNotNull(), (hours <= 24).cast("int"))) * 100, 6).alias("pct_under_24h"),
        F.round(F.avg(F.when(F.col(resolved).isNotNull(), (hours <= 48).cast("int"))) * 100, 6).alias("pct_under_48h"))


def extraction_anomalies(reads: DataFrame, user: str, ts: str, k: float = 3.0) -> DataFrame:
    """Per user and day read volume, flagged when above the user's mean +
    k * population std over their days (aggregate + join, no per-user window
    over raw rows)."""
    daily = reads.groupBy(user, F.to_date(ts).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    stats = daily.groupBy(user).agg(F.avg("n").alias("_m"), F.stddev_pop("n").alias("_s"))
    j = daily.join(stats, user)
    return j.select(user, "day", "n", (F.col("n") > F.col("_m") + k * F.col("_s")).alias("flagged"))
