"""Document-shaped operators over event tables: embedded arrays, tags,
flexible JSON properties, feature maps, per-entity feature documents.

Arrays are only built per (entity, day) — a bounded document — and are
unnested with ``explode`` / higher-order functions, which run inside
whole-stage codegen without Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def app_logs(events: DataFrame, n_services: int = 5) -> DataFrame:
    """Event rows seen as application log records."""
    return events.select(
        "event_id", F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("INFO").alias("level"),
        F.concat(F.lit("svc-"), (F.col("user_id") % n_services).cast("string")).alias("service_name"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("message"))


def errors_by_service(logs: DataFrame, since) -> DataFrame:
    """Errors since a bound, per service: count, and every message as its
    own row (the pushed message list in long form, so no service's message
    list has to fit in a single row)."""
    err = logs.where((F.col("timestamp") >= since) & (F.col("level") == "ERROR"))
    counts = err.groupBy("service_name").agg(F.count(F.lit(1)).alias("nb_erreurs"))
    return err.select("service_name", "message").join(counts, "service_name") \
        .orderBy(F.desc("nb_erreurs"), "service_name", "message")


def sessions_by_day(events: DataFrame) -> DataFrame:
    """One session document per (user, day) with the ordered event array."""
    ev = F.struct(F.col("ts"), F.col("event_id"), F.col("event_type"), F.col("value"))
    return (events.groupBy("user_id", F.to_date("ts").alias("day"))
            .agg(F.array_sort(F.collect_list(ev)).alias("events"),
                 F.min("ts").alias("start_time")))


def purchases_in_sessions(sessions: DataFrame) -> Column:
    return F.filter(F.col("events"), lambda e: e["event_type"] == "purchase")


def split_tags(text: Column, sep: str = "-") -> Column:
    return F.split(text, sep)


def json_int(text: Column, path: str) -> Column:
    """Integer field of a flexible JSON document (VARIANT access)."""
    return F.try_variant_get(F.try_parse_json(text), path, "int")


def feature_map(df: DataFrame, key: str, value: str) -> DataFrame:
    """Per-entity feature document as a map {count, sum, max}."""
    g = df.groupBy(key).agg(F.count(value).cast("double").alias("count"),
                            F.round(F.sum(value), 6).alias("sum"), F.max(value).alias("max"))
    return g.select(key, F.create_map(F.lit("count"), F.col("count"), F.lit("sum"), F.col("sum"),
                                      F.lit("max"), F.col("max")).alias("features"))


def explode_map(df: DataFrame, key: str, col: str = "features") -> DataFrame:
    return df.select(key, F.explode(col).alias("name", "value"))


def daily_features(events: DataFrame, key: str = "user_id", ts: str = "ts", value: str = "value") -> DataFrame:
    """Feature versions: per entity and day, valid from that day's midnight."""
    d = F.to_date(ts)
    return events.groupBy(key, d.alias("feature_day")).agg(
        F.count(F.lit(1)).alias("f_count"), F.round(F.sum(value), 6).alias("f_sum"),
        F.max(value).alias("f_max")).withColumn("valid_from", F.col("feature_day").cast("timestamp_ntz"))


def to_document(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Key-value export: ``(key, json text of the other columns)``."""
    return df.select(key, F.to_json(F.struct(*[F.col(c) for c in cols])).alias("doc"))
