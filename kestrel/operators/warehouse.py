"""Star-schema operators: star joins, pre-aggregates, grouping-set rollups,
cubes, change-data-capture merge.

Dimension joins carry no broadcast hints: date / geography dimensions are
small by construction and AQE converts them to broadcast joins from runtime
sizes, while customer / merchant dimensions grow with the business and stay
shuffle joins unless they are measured small.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def money_sum(col: str) -> Column:
    """Sum of a DECIMAL(p,2) money column at the widest precision (38, 2),
    so totals never overflow whatever the number of rows."""
    return F.sum(col).cast("decimal(38,2)")


def in_month(dim_date: DataFrame, year: int, month: int, date: str = "full_date") -> DataFrame:
    """Rows of a month, by a range of the date itself (a predicate on derived
    year and month columns can't be pushed to the scan)."""
    first = datetime.date(year, month, 1)
    following = datetime.date(year + month // 12, month % 12 + 1, 1)
    return dim_date.where((F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(following)))


def revenue_by_day_region(fact: DataFrame, dim_date: DataFrame, dim_geo: DataFrame,
                          year: int, month: int) -> DataFrame:
    d = in_month(dim_date, year, month).select("date_key", "full_date")
    g = dim_geo.select("geography_key", "region")
    # the same period as a range on the fact's own date key: on a fact table
    # partitioned by date_key this prunes partitions statically, and on a
    # derived fact it filters the order side before the line-item join
    lo, hi = year * 10000 + month * 100 + 1, year * 10000 + month * 100 + 31
    j = fact.where(F.col("date_key").between(lo, hi)).join(d, "date_key").join(g, "geography_key")
    return (j.groupBy("full_date", "region")
            .agg(money_sum("gross_amount").alias("gross_total"), money_sum("net_revenue").alias("net_total"),
                 F.count(F.lit(1)).alias("n_transactions"))
            .orderBy(F.desc("full_date"), F.desc("gross_total")))


def cohort_spend(fact: DataFrame, dim_customer: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Spend per (signup cohort, activity month) for activity on or after
    signup: equi-joins plus a residual filter (no theta join)."""
    c = dim_customer.select("customer_key", "signup_cohort_month")
    d = dim_date.select("date_key", "full_date", "month")
    j = fact.join(c, "customer_key").join(d, "date_key").where(F.col("full_date") >= F.col("signup_cohort_month"))
    return (j.groupBy("signup_cohort_month", F.col("month").alias("activity_month"))
            .agg(money_sum("gross_amount").alias("cohort_spend"))
            .orderBy("signup_cohort_month", "activity_month"))


def daily_revenue_merchant(fact: DataFrame, extra_keys: Sequence[str] = ()) -> DataFrame:
    return fact.groupBy(*extra_keys, "date_key", "merchant_key").agg(
        money_sum("gross_amount").alias("gross_amount"), money_sum("net_revenue").alias("net_revenue"),
        F.count(F.lit(1)).alias("nb_tx"))


def monthly_global(fact: DataFrame, dim_merchant: DataFrame) -> DataFrame:
    m = dim_merchant.select("merchant_key", "industry_category")
    j = fact.join(m, "merchant_key", "left")
    return j.groupBy((F.floor(F.col("date_key") / 100)).cast("int").alias("month_key"), "geography_key",
                     "industry_category").agg(money_sum("gross_amount").alias("gross_amount"),
                                              F.round(F.avg(F.col("fee_amount").cast("double")), 6).alias("avg_fee"))


def level_name(gid: Column, levels: Sequence[tuple[int, str]], default: str = "total") -> Column:
    out = F.lit(default)
    for g, name in reversed(levels):
        out = F.when(gid == g, F.lit(name)).otherwise(out)
    return out


def revenue_rollup(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Revenue per day, per ISO week, per month and in total in one
    ``GROUPING SETS`` aggregation (one scan, one shuffle)."""
    d = dim_date.select("date_key", F.col("full_date").alias("day"),
                        (F.col("year") * 100 + F.col("week")).cast("int").alias("week_key"),
                        (F.col("year") * 100 + F.col("month")).cast("int").alias("month_key"))
    j = fact.join(d, "date_key")
    keys = ["day", "week_key", "month_key"]
    out = j.groupingSets([[F.col("day")], [F.col("week_key")], [F.col("month_key")], []], *keys).agg(
        F.grouping_id(*keys).alias("gid"), money_sum("gross_amount").alias("gross_amount"),
        F.count(F.lit(1)).alias("nb_tx"))
    # grouping_id bits: day=4, week=2, month=1 (1 = rolled up)
    lvl = level_name(F.col("gid"), [(3, "day"), (5, "week"), (6, "month")])
    return out.select(lvl.alias("level"), "day", "week_key", "month_key", "gross_amount", "nb_tx")


def payment_mix(fact: DataFrame) -> DataFrame:
    return fact.cube("payment_method_key", "is_successful").agg(
        money_sum("gross_amount").alias("gross_amount"), F.count(F.lit(1)).alias("nb_tx"))


def latest_change(rows: DataFrame, keys: Sequence[str], version: str = "version", op: str = "op") -> DataFrame:
    """Per key the row with the highest (version, op).  ``max_by`` is a partial
    aggregate, so a key with many changes is reduced map-side."""
    vals = [c for c in rows.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in vals]),
                                              F.struct(F.col(version), F.col(op))).alias("_r"))
    return latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in vals])


def cdc_apply(base: DataFrame, changes: DataFrame, key: str, version: str = "version",
              op: str = "op", delete_op: str = "D") -> DataFrame:
    """Apply insert/update/delete events to rows that aren't stored: the latest
    change per key without the deletes (``sources.merge`` for stored tables)."""
    return latest_change(base.unionByName(changes), [key], version, op).where(F.col(op) != delete_op)
