"""Warehouse queries: star-schema reports, cohorts, pre-aggregates,
rollups, SCD2 versions and validity joins, CDC merge."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import joins as jn
from kestrel.operators import warehouse as wh
from kestrel.operators import windows as win
from kestrel.plans.registry import query
from kestrel.session import shared_path
from kestrel.sources import merge

PERIOD = (1997, 1)  # the report month (order dates span 1995-2001)


@query("join_star_region", oracle=f"""
WITH days AS (SELECT date_key, full_date FROM dim_date WHERE (year, month) = {PERIOD}),
per_place AS (SELECT date_key, geography_key, sum(gross_amount) AS gross, sum(net_revenue) AS net, count(*) AS n
              FROM fact_transactions SEMI JOIN days USING (date_key) GROUP BY ALL)
SELECT full_date, region, sum(gross) AS gross_total, sum(net) AS net_total, CAST(sum(n) AS BIGINT) AS n_transactions
FROM per_place JOIN days USING (date_key) JOIN dim_geography USING (geography_key) GROUP BY full_date, region""")
def join_star_region(v):
    return wh.revenue_by_day_region(v.fact_transactions, v.dim_date, v.dim_geography, *PERIOD)


@query("filter_period", oracle=f"""
SELECT date_key, full_date FROM dim_date WHERE year = {PERIOD[0]} AND month = {PERIOD[1]}""")
def filter_period(v):
    """The month as a range of dates, which reaches the scan."""
    return wh.in_month(v.dim_date, *PERIOD).select("date_key", "full_date")


@query("join_star_cohort", oracle="""
WITH spent AS (SELECT customer_key, full_date, month AS activity_month, sum(gross_amount) AS spend
               FROM fact_transactions JOIN dim_date USING (date_key) GROUP BY ALL)
SELECT signup_cohort_month, activity_month, sum(spend) AS cohort_spend
FROM spent JOIN dim_customer USING (customer_key)
WHERE signup_cohort_month <= full_date GROUP BY signup_cohort_month, activity_month""")
def join_star_cohort(v):
    return wh.cohort_spend(v.fact_transactions, v.dim_customer, v.dim_date)


@query("agg_daily_revenue_merchant", oracle="""
SELECT date_key, merchant_key, sum(gross_amount) AS gross_amount, sum(net_revenue) AS net_revenue, count(*) AS nb_tx
FROM fact_transactions GROUP BY 1, 2""")
def agg_daily_revenue_merchant(v):
    return wh.daily_revenue_merchant(v.fact_transactions)


@query("agg_monthly_global", oracle="""
SELECT CAST(floor(f.date_key / 100) AS INT) AS month_key, f.geography_key, m.industry_category,
       sum(f.gross_amount) AS gross_amount, round(avg(CAST(f.fee_amount AS DOUBLE)), 6) AS avg_fee
FROM fact_transactions f LEFT JOIN dim_merchant m ON f.merchant_key = m.merchant_key GROUP BY 1, 2, 3""")
def agg_monthly_global(v):
    return wh.monthly_global(v.fact_transactions, v.dim_merchant)


@query("agg_revenue_rollup", oracle="""
WITH j AS (SELECT f.gross_amount, d.full_date AS day, CAST(d.year * 100 + d.week AS INT) AS week_key,
                  CAST(d.year * 100 + d.month AS INT) AS month_key FROM fact_transactions f JOIN dim_date d ON f.date_key = d.date_key)
SELECT CASE grouping(day, week_key, month_key) WHEN 3 THEN 'day' WHEN 5 THEN 'week' WHEN 6 THEN 'month' ELSE 'total' END AS level,
       day, week_key, month_key, sum(gross_amount) AS gross_amount, count(*) AS nb_tx
FROM j GROUP BY GROUPING SETS ((day), (week_key), (month_key), ())""")
def agg_revenue_rollup(v):
    return wh.revenue_rollup(v.fact_transactions, v.dim_date)


@query("agg_payment_mix", oracle="""
SELECT payment_method_key, is_successful, sum(gross_amount) AS gross_amount, count(*) AS nb_tx
FROM fact_transactions GROUP BY CUBE (payment_method_key, is_successful)""")
def agg_payment_mix(v):
    return wh.payment_mix(v.fact_transactions)


_VERSIONS_SQL = """versions AS (
  SELECT merchant_key, merchant_name, changed_at AS valid_from,
         lead(changed_at) OVER (PARTITION BY merchant_key ORDER BY changed_at) AS valid_to
  FROM (SELECT *, lag(merchant_name) OVER (PARTITION BY merchant_key ORDER BY changed_at) AS prev FROM merchant_changes) c
  WHERE prev IS NULL OR prev <> merchant_name)"""


def _versions(v):
    return win.scd2_versions(v.merchant_changes, "merchant_key", "changed_at", ["merchant_name"])


@query("win_scd2_build", oracle=f"""WITH {_VERSIONS_SQL}
SELECT merchant_key, merchant_name, valid_from, valid_to, valid_to IS NULL AS is_current FROM versions""")
def win_scd2_build(v):
    return _versions(v).select("merchant_key", "merchant_name", "valid_from", "valid_to", "is_current")


@query("join_scd2", oracle=f"""WITH {_VERSIONS_SQL}
SELECT o.o_orderkey, o.o_orderkey % 100 AS merchant_key, v.merchant_name
FROM orders o LEFT JOIN versions v ON o.o_orderkey % 100 = v.merchant_key
  AND v.valid_from <= o.o_orderdate AND (v.valid_to IS NULL OR o.o_orderdate < v.valid_to)""")
def join_scd2(v):
    facts = v.t.orders.select("o_orderkey", (F.col("o_orderkey") % 100).alias("merchant_key"), "o_orderdate")
    vers = _versions(v).select("merchant_key", "merchant_name", "valid_from", "valid_to")
    j = jn.scd2_join(facts, vers, "merchant_key", "o_orderdate", "valid_from", "valid_to", ["merchant_name"])
    return j.select("o_orderkey", "merchant_key", "merchant_name")


@query("cdc_apply", oracle="""
WITH base AS (SELECT transaction_id, amount, 0 AS version, 'I' AS op FROM tx),
ch AS (SELECT transaction_id, CASE WHEN transaction_id % 11 = 0 THEN amount ELSE amount + 1 END AS amount,
              transaction_id % 3 AS version, CASE WHEN transaction_id % 11 = 0 THEN 'D' ELSE 'U' END AS op
       FROM tx WHERE transaction_id % 11 = 0 OR transaction_id % 7 = 0),
u AS (SELECT * FROM base UNION ALL SELECT * FROM ch),
r AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY version DESC, op DESC) AS rn FROM u)
SELECT transaction_id, CAST(amount AS DECIMAL(16,2)) AS amount, CAST(version AS BIGINT) AS version, op FROM r WHERE rn = 1 AND op <> 'D'""")
def cdc_apply(v):
    """Change events merged into a stored table: only the partitions (ranges of
    ids) with changed keys are rewritten."""
    tx = v.tx
    k = F.col("transaction_id")
    base = tx.select("transaction_id", F.col("amount").cast("decimal(16,2)").alias("amount"),
                     F.lit(0).cast("long").alias("version"), F.lit("I").alias("op"))
    is_del = k % 11 == 0
    ch = tx.where(is_del | (k % 7 == 0)).select(
        "transaction_id",
        F.when(is_del, F.col("amount")).otherwise(F.col("amount") + 1).cast("decimal(16,2)").alias("amount"),
        (k % 3).cast("long").alias("version"), F.when(is_del, "D").otherwise("U").alias("op"))
    path, part = shared_path(v.spark, "cdc-tx"), merge.key_range("transaction_id", 1_000_000)
    merge.create_keyed(base, path, part)
    merge.merge_changes(ch, path, "transaction_id", part)
    return merge.live_rows(v.spark, path)


@query("join_orphans", oracle="""
SELECT 'tx.merchant_id' AS relation, CAST(t.transaction_id AS BIGINT) AS child_id FROM tx t
WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = t.merchant_id)
UNION ALL
SELECT 'ground_truth.prediction_log_id', g.prediction_log_id FROM ground_truth g
WHERE NOT EXISTS (SELECT 1 FROM prediction_logs p WHERE p.id = g.prediction_log_id)""")
def join_orphans(v):
    s = v.t.supplier.select(F.col("s_suppkey").alias("merchant_id"))
    a = v.tx.join(s, "merchant_id", "left_anti").select(F.lit("tx.merchant_id").alias("relation"),
                                                       F.col("transaction_id").alias("child_id"))
    p = v.prediction_logs.select(F.col("id").alias("prediction_log_id"))
    b = v.ground_truth.join(p, "prediction_log_id", "left_anti").select(
        F.lit("ground_truth.prediction_log_id").alias("relation"), F.col("prediction_log_id").alias("child_id"))
    return a.unionByName(b)
