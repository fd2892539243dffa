"""Card-payment fraud queries: scored transactions, KPIs, category risk,
behavioural statistics, OLTP-style lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import payments as pay
from kestrel.operators import relational as rel
from kestrel.plans.registry import query

DASHBOARD_DAYS = 30  # the dashboard slider's widest window
REPORT_DAYS = 1      # the daily report's window
HISTORY_CUSTOMER = 12


def _as_of(v):
    return rel.max_of(v.tx, "timestamp")


def _scored(v):
    return pay.with_predictions(v.tx, v.preds)


def _recent_scored(v, days):
    return rel.filter_last_interval(_scored(v), "timestamp", _as_of(v), days=days)


_SCORED_SQL = """
SELECT t.*, p.prediction_score, p.is_alerted, p.model_version
FROM tx t LEFT JOIN preds p ON t.transaction_id = p.transaction_id"""


def _recent_sql(days):
    return f"""(SELECT * FROM ({_SCORED_SQL}) s
    WHERE s.timestamp >= (SELECT max(timestamp) FROM tx) - INTERVAL '{days}' DAY)"""


@query("join_tx_predictions", oracle=f"""
SELECT transaction_id, timestamp, amount, category, merchant_id, client_id,
       prediction_score, is_alerted, model_version FROM ({_SCORED_SQL}) s""")
def join_tx_predictions(v):
    return _scored(v).select("transaction_id", "timestamp", "amount", "category", "merchant_id",
                             "client_id", "prediction_score", "is_alerted", "model_version")


@query("filter_last_interval", oracle="""
SELECT transaction_id, timestamp, amount FROM tx
WHERE timestamp >= (SELECT max(timestamp) FROM tx) - INTERVAL '7' DAY""")
def filter_last_interval(v):
    return rel.filter_last_interval(v.tx, "timestamp", _as_of(v), days=7).select(
        "transaction_id", "timestamp", "amount")


@query("agg_fraud_kpis", oracle=f"""
SELECT count(*) AS total, count(*) FILTER (WHERE is_alerted) AS alerts,
       round(count(*) FILTER (WHERE is_alerted) * 100.0 / count(*), 6) AS alert_rate_pct,
       sum(amount) AS volume, coalesce(sum(amount) FILTER (WHERE is_alerted), 0) AS alerted_volume
FROM {_recent_sql(DASHBOARD_DAYS)} r""")
def agg_fraud_kpis(v):
    return pay.fraud_kpis(_recent_scored(v, DASHBOARD_DAYS))


@query("agg_tx_per_day", oracle=f"""
SELECT CAST(timestamp AS DATE) AS date, count(*) AS count FROM {_recent_sql(DASHBOARD_DAYS)} r GROUP BY 1""")
def agg_tx_per_day(v):
    return pay.per_day_counts(_recent_scored(v, DASHBOARD_DAYS))


CATEGORY_RISK_SQL = """
SELECT category, count(is_alerted) AS total, CAST(sum(CAST(is_alerted AS INT)) AS BIGINT) AS alerts,
       round(sum(CAST(is_alerted AS INT)) * 100.0 / count(is_alerted), 6) AS alert_rate_pct
FROM {src} r WHERE is_alerted IS NOT NULL GROUP BY category"""


@query("agg_category_risk",
       oracle=CATEGORY_RISK_SQL.format(src=_recent_sql(DASHBOARD_DAYS)))
def agg_category_risk(v):
    return pay.category_risk(_recent_scored(v, DASHBOARD_DAYS))


@query("agg_category_frauds", oracle=f"""
SELECT category, count(*) FILTER (WHERE is_alerted) AS alerts FROM ({_SCORED_SQL}) s
GROUP BY category HAVING count(*) FILTER (WHERE is_alerted) > 0""")
def agg_category_frauds(v):
    return pay.category_frauds(_scored(v))


@query("agg_client_stats", oracle="""
SELECT client_id, count(amount) AS client_tx_count, round(avg(CAST(amount AS DOUBLE)), 6) AS client_avg_amount
FROM tx WHERE is_fraud IS NOT NULL GROUP BY client_id""")
def agg_client_stats(v):
    return pay.client_stats(rel.filter_not_null(v.tx, "is_fraud"))


@query("agg_merchant_stats", oracle="""
SELECT merchant_id, count(amount) AS merchant_tx_count FROM tx WHERE is_fraud IS NOT NULL GROUP BY merchant_id""")
def agg_merchant_stats(v):
    return pay.merchant_stats(rel.filter_not_null(v.tx, "is_fraud"))


_GROUP_STATS_SQL = """
WITH l AS (SELECT * FROM tx WHERE is_fraud IS NOT NULL),
cs AS (SELECT client_id, count(amount) AS client_tx_count, round(avg(CAST(amount AS DOUBLE)), 6) AS client_avg_amount FROM l GROUP BY 1),
ms AS (SELECT merchant_id, count(amount) AS merchant_tx_count FROM l GROUP BY 1)
SELECT l.transaction_id, cs.client_tx_count, cs.client_avg_amount,
       round(CAST(l.amount AS DOUBLE) / (cs.client_avg_amount + 1e-6), 6) AS client_amount_ratio,
       ms.merchant_tx_count
FROM l LEFT JOIN cs ON l.client_id = cs.client_id LEFT JOIN ms ON l.merchant_id = ms.merchant_id"""


@query("join_group_stats", oracle=_GROUP_STATS_SQL)
def join_group_stats(v):
    return (pay.with_group_stats(rel.filter_not_null(v.tx, "is_fraud"))
            .select("transaction_id", "client_tx_count", "client_avg_amount",
                    "client_amount_ratio", "merchant_tx_count"))


@query("win_amount_ratio", oracle="""
SELECT transaction_id,
       round(CAST(amount AS DOUBLE) / (round(avg(CAST(amount AS DOUBLE)) OVER (PARTITION BY client_id), 6) + 1e-6), 6) AS client_amount_ratio
FROM tx""")
def win_amount_ratio(v):
    # per-client mean joined back (aggregate + join: skew-safe, see payments)
    return pay.with_group_stats(v.tx).select("transaction_id", "client_amount_ratio")


@query("join_stats_default", oracle="""
WITH l AS (SELECT * FROM tx WHERE is_fraud IS NOT NULL),
cs AS (SELECT client_id, count(amount) AS client_tx_count, round(avg(CAST(amount AS DOUBLE)), 6) AS client_avg_amount FROM l GROUP BY 1),
ms AS (SELECT merchant_id, count(amount) AS merchant_tx_count FROM l GROUP BY 1),
med AS (SELECT (SELECT median(client_tx_count) FROM cs) AS m_cnt, (SELECT median(client_avg_amount) FROM cs) AS m_avg,
               (SELECT median(merchant_tx_count) FROM ms) AS m_mcnt),
n AS (SELECT * FROM tx WHERE is_fraud IS NULL)
SELECT n.transaction_id,
       coalesce(CAST(cs.client_tx_count AS DOUBLE), med.m_cnt) AS client_tx_count,
       coalesce(cs.client_avg_amount, med.m_avg) AS client_avg_amount,
       round(CAST(n.amount AS DOUBLE) / (coalesce(cs.client_avg_amount, med.m_avg) + 1e-6), 6) AS client_amount_ratio,
       coalesce(CAST(ms.merchant_tx_count AS DOUBLE), med.m_mcnt) AS merchant_tx_count
FROM n LEFT JOIN cs ON n.client_id = cs.client_id LEFT JOIN ms ON n.merchant_id = ms.merchant_id CROSS JOIN med""")
def join_stats_default(v):
    labelled = rel.filter_not_null(v.tx, "is_fraud")
    new = v.tx.where(F.col("is_fraud").isNull())
    out = pay.lookup_stats_with_default(new, pay.client_stats(labelled), pay.merchant_stats(labelled))
    return out.select("transaction_id", "client_tx_count", "client_avg_amount",
                      "client_amount_ratio", "merchant_tx_count")


@query("filter_flag_true", oracle="""
SELECT transaction_id, prediction_score FROM preds WHERE is_alerted""")
def filter_flag_true(v):
    return rel.filter_flag_true(v.preds, "is_alerted").select("transaction_id", "prediction_score")


@query("filter_in_list", oracle="""
SELECT transaction_id, category, status FROM tx WHERE category IN ('1-URGENT', '2-HIGH') AND status = 'Pending'""")
def filter_in_list(v):
    return (v.tx.where(F.col("category").isin("1-URGENT", "2-HIGH") & (F.col("status") == "Pending"))
            .select("transaction_id", "category", "status"))


@query("filter_partial_queue", oracle="""
SELECT transaction_id, timestamp, amount FROM tx WHERE status = 'Pending'""")
def filter_partial_queue(v):
    return v.tx.where(F.col("status") == "Pending").select("transaction_id", "timestamp", "amount")


@query("sort_ts_desc", oracle=f"""
SELECT transaction_id, timestamp, amount, prediction_score FROM {_recent_sql(REPORT_DAYS)} r
ORDER BY timestamp DESC, transaction_id DESC""")
def sort_ts_desc(v):
    return (_recent_scored(v, REPORT_DAYS)
            .select("transaction_id", "timestamp", "amount", "prediction_score")
            .orderBy(F.desc("timestamp"), F.desc("transaction_id")))


@query("topk_recent_alerts", oracle=f"""
SELECT timestamp, amount, category, prediction_score FROM ({_SCORED_SQL}) s WHERE is_alerted
ORDER BY timestamp DESC, transaction_id DESC LIMIT 10""")
def topk_recent_alerts(v):
    # orderBy + limit plans to TakeOrderedAndProject: a per-partition top-10
    # and a 10 x n_partitions merge, never a full sort.
    return (rel.filter_flag_true(_scored(v), "is_alerted")
            .orderBy(F.desc("timestamp"), F.desc("transaction_id")).limit(10)
            .select("timestamp", "amount", "category", "prediction_score"))


@query("topk_recent_transactions", oracle=f"""
SELECT transaction_id, timestamp, amount, category FROM ({_SCORED_SQL}) s
ORDER BY timestamp DESC, transaction_id DESC LIMIT 100""")
def topk_recent_transactions(v):
    return (_scored(v).orderBy(F.desc("timestamp"), F.desc("transaction_id")).limit(100)
            .select("transaction_id", "timestamp", "amount", "category"))


@query("join_customer_history", oracle=f"""
SELECT t.transaction_id, t.timestamp, t.amount, s.s_name AS merchant_name
FROM tx t JOIN supplier s ON t.merchant_id = s.s_suppkey
WHERE t.client_id = {HISTORY_CUSTOMER}
ORDER BY t.timestamp DESC, t.transaction_id DESC LIMIT 20""")
def join_customer_history(v):
    t = v.tx.where(F.col("client_id") == HISTORY_CUSTOMER)
    s = v.t.supplier.select(F.col("s_suppkey").alias("merchant_id"), F.col("s_name").alias("merchant_name"))
    return (t.join(s, "merchant_id")
            .orderBy(F.desc("timestamp"), F.desc("transaction_id")).limit(20)
            .select("transaction_id", "timestamp", "amount", "merchant_name"))


@query("join_high_risk", oracle="""
WITH fa AS (SELECT transaction_id, prediction_score,
                   CASE WHEN prediction_score < 0.5 THEN 'Low' WHEN prediction_score < 0.7 THEN 'Medium'
                        WHEN prediction_score < 0.9 THEN 'High' ELSE 'Critical' END AS risk_level FROM preds)
SELECT t.transaction_id, t.amount, fa.risk_level, c.c_name AS customer_name
FROM tx t JOIN fa ON t.transaction_id = fa.transaction_id JOIN customer c ON t.client_id = c.c_custkey
WHERE fa.risk_level IN ('High', 'Critical') AND t.status = 'Pending'""")
def join_high_risk(v):
    fa = v.preds.select("transaction_id", pay.risk_level(F.col("prediction_score")).alias("risk_level"))
    c = v.t.customer.select(F.col("c_custkey").alias("client_id"), F.col("c_name").alias("customer_name"))
    return (v.tx.where(F.col("status") == "Pending")
            .join(fa.where(F.col("risk_level").isin("High", "Critical")), "transaction_id")
            .join(c, "client_id")
            .select("transaction_id", "amount", "risk_level", "customer_name"))


@query("fn_score_band", oracle="""
SELECT transaction_id, CASE WHEN prediction_score > 0.9 THEN 'block' WHEN prediction_score > 0.7 THEN 'challenge'
       ELSE 'approve' END AS decision FROM preds""")
def fn_score_band(v):
    return v.preds.select("transaction_id", pay.score_band(F.col("prediction_score")).alias("decision"))


@query("fn_concat_location", oracle="""
SELECT c_custkey AS client_id, n_name || ', ' || r_name AS location
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def fn_concat_location(v):
    c, n, r = v.t.customer, v.t.nation, v.t.region
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(F.col("c_custkey").alias("client_id"),
                    pay.concat_location(F.col("n_name"), F.col("r_name")).alias("location"))


@query("fn_compound_id", oracle="""
SELECT transaction_id, CAST(transaction_id AS VARCHAR) || '_' || CAST(epoch(timestamp) AS BIGINT) AS trans_key FROM tx""")
def fn_compound_id(v):
    return v.tx.select("transaction_id", pay.compound_id(
        F.col("transaction_id"), F.unix_timestamp(F.col("timestamp").cast("timestamp"))).alias("trans_key"))


# -- ingest projections (source record -> transactions schema) ---------------
_INGEST_MAP = {"o_orderkey": "transaction_id", "o_orderdate": "timestamp", "o_totalprice": "amount",
               "o_custkey": "client_id", "o_orderpriority": "category"}


@query("project_rename_map", oracle="""
SELECT o_orderkey AS transaction_id, o_orderdate AS timestamp, o_totalprice AS amount,
       o_custkey AS client_id, o_orderpriority AS category FROM orders""")
def project_rename_map(v):
    return rel.rename_map(v.t.orders, _INGEST_MAP)


@query("project_defaults", oracle="""
SELECT o_orderkey AS transaction_id, 'EUR' AS currency, CAST(NULL AS VARCHAR) AS ip_address,
       CAST(NULL AS BOOLEAN) AS is_fraud FROM orders""")
def project_defaults(v):
    base = rel.rename_map(v.t.orders, {"o_orderkey": "transaction_id"})
    return rel.with_defaults(base, {"currency": ("EUR", "string"), "ip_address": (None, "string"),
                                    "is_fraud": (None, "boolean")})


@query("project_cast", oracle="""
SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, CAST(o_totalprice AS DECIMAL(15,2)) AS amount,
       CAST(o_custkey AS INTEGER) AS client_id, o_orderstatus = 'F' AS is_settled,
       CAST(CAST(o_orderdate AS VARCHAR) AS TIMESTAMP) AS timestamp FROM orders""")
def project_cast(v):
    o = v.t.orders
    return o.select(F.col("o_orderkey").cast("string").alias("transaction_id"),
                    F.col("o_totalprice").cast("decimal(15,2)").alias("amount"),
                    F.col("o_custkey").cast("int").alias("client_id"),
                    (F.col("o_orderstatus") == "F").alias("is_settled"),
                    F.to_timestamp_ntz(F.col("o_orderdate").cast("string")).alias("timestamp"))
