"""Plan properties that matter at scale: filters reach the Parquet scan,
scans read only the needed columns, global orders never funnel raw rows
through one partition, top-k plans as TakeOrdered, hot keys are split."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL

Q = entry.queries()


def plan(df):
    jvm = df.sparkSession._jvm
    return df._jdf.queryExecution().explainString(
        jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def scans(p):
    return re.findall(r"Scan parquet.*?PushedFilters: (\[.*?\]).*?ReadSchema: (struct<.*?>)\n", p, re.S)


def test_filters_and_pruning_reach_the_scan(spark):
    p = plan(Q["filter_log_errors"](spark, SF_SMALL))
    (pushed, schema), = scans(p)
    assert "GreaterThanOrEqual(ts" in pushed
    assert "props" not in schema and "value" not in schema


def test_velocity_window_has_no_single_partition(spark):
    p = plan(Q["win_velocity_1h"](spark, SF_SMALL))
    assert "SinglePartition" not in p
    assert re.search(r"hashpartitioning\(user_id#\d+L?, _b#\d+L?", p)


def test_pr_curve_runs_without_single_partition_window_on_rows(spark):
    # the only unpartitioned window is over per-range totals (checkpointed,
    # at most n_ranges rows), never over the score histogram itself
    p = plan(Q["eval_pr_curve"](spark, SF_SMALL))
    windows = re.findall(r"\(\d+\) Window\n.*?Arguments: \[(.*?)\]", p, re.S)
    assert any("_range_id" in w for w in windows)


def test_topk_is_take_ordered(spark):
    p = plan(Q["topk_recent_alerts"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_latest_per_key_is_partial_aggregate(spark):
    p = plan(Q["win_latest_features"](spark, SF_SMALL))
    assert "partial_max_by" in p and "Window" not in p


def test_cap_per_group_limits_before_shuffle(spark):
    p = plan(Q["win_cap_per_group"](spark, SF_SMALL))
    assert "WindowGroupLimit" in p


def test_ground_truth_sync_reduces_slots_before_join(spark):
    p = plan(Q["drift_ground_truth_sync"](spark, SF_SMALL))
    assert "partial_max_by" in p


def test_hot_key_results_equal_naive(spark):
    """One user holds a third of the rows: the bucketed rolling window and
    as-of join give the same answer as the naive formulation."""
    from pyspark.sql import Window
    from kestrel.operators import joins as jn
    from kestrel.operators import windows as win
    n = 3000
    df = spark.range(n).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("u"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.expr("INTERVAL 1 SECOND") * (F.col("id") * 613 % 86400 * 7))
        .alias("t"))
    fast = win.rolling_time_agg(df, "u", "t", 3600, {"n": ("count", None)})
    w = Window.partitionBy("u").orderBy(F.unix_timestamp(F.col("t").cast("timestamp"))).rangeBetween(-3600, 0)
    naive = df.withColumn("n", F.count(F.lit(1)).over(w))
    assert fast.select("event_id", "n").exceptAll(naive.select("event_id", "n")).count() == 0
    versions = df.where(F.col("event_id") % 5 == 0).select("u", F.col("t").alias("vt"), F.col("event_id").alias("ver"))
    a = jn.asof_join(df, versions, "u", "t", "vt", ["ver"])
    b = jn.asof_join_bucketed(df, versions, "u", "t", "vt", ["ver"], bucket_seconds=86400)
    assert a.select("event_id", "ver").exceptAll(b.select("event_id", "ver")).count() == 0
    assert b.count() == n


def test_scd2_versions_bucketed_equal_plain_with_hot_entity(spark):
    from kestrel.operators import windows as win
    n = 2000
    ch = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40 + 1).alias("k"),
        (F.col("id") * 7 % 5).cast("string").alias("name"),
        (F.lit("2020-01-01 00:00:00").cast("timestamp_ntz") + F.expr("INTERVAL 1 HOUR") * F.col("id")).alias("at"))
    a = win.scd2_versions(ch, "k", "at", ["name"], bucket_seconds=None)
    b = win.scd2_versions(ch, "k", "at", ["name"], bucket_seconds=7 * 86400)
    cols = ["k", "name", "valid_from", "valid_to", "is_current"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert b.select(cols).exceptAll(a.select(cols)).count() == 0
