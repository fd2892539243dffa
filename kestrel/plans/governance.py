"""Privacy and governance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import relational as rel
from kestrel.plans.registry import query
from kestrel.quality import erasure as er
from kestrel.quality import governance as gov
from kestrel.session import shared_path
from kestrel.sources import merge

SALT = "salt-"
ACCESS_SUBJECTS = [1, 2, 3]
CLASSIFIED_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
                     "embeddings", "pages", "benchmark", "labels", "conversations"]


@query("gov_tokenise", oracle=f"""
SELECT c_custkey, sha256('{SALT}' || c_name) AS token FROM customer""")
def gov_tokenise(v):
    return v.t.customer.select("c_custkey", gov.tokenise(F.col("c_name"), SALT).alias("token"))


@query("gov_mask", oracle="""
SELECT c_custkey, repeat('*', greatest(length(c_name) - 4, 0)) || right(c_name, 4) AS masked_name FROM customer""")
def gov_mask(v):
    return v.t.customer.select("c_custkey", gov.mask_keep_last(F.col("c_name")).alias("masked_name"))


@query("gov_mask_text", oracle="""
SELECT doc_id, regexp_replace(text, '[0-9]', '#', 'g') AS masked_text FROM documents""")
def gov_mask_text(v):
    return v.t.documents.select("doc_id", gov.mask_digits(F.col("text")).alias("masked_text"))


_RULES_SQL = """CASE WHEN table_name IN ('region', 'nation') THEN 'N1'
       WHEN regexp_matches(lower(column_name), '(name|email|text|phone|address|html|url)') THEN 'N4'
       WHEN regexp_matches(lower(column_name), '(price|amount|acctbal|value|props|discount|tax|quantity|embedding)') THEN 'N3'
       ELSE 'N2' END"""


@query("gov_classify", oracle=f"""
WITH held AS ({" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, column_name, n_values FROM "
    f"(UNPIVOT (SELECT COUNT(COLUMNS(*)) AS '\\0' FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE n_values)"
    for t in CLASSIFIED_TABLES)}),
c AS (SELECT *, {_RULES_SQL} AS level FROM held)
SELECT table_name, column_name, n_values, level, CASE level WHEN 'N4' THEN 'encrypt and mask' WHEN 'N3' THEN 'restricted access'
       WHEN 'N2' THEN 'internal' ELSE 'public' END AS control FROM c""")
def gov_classify(v):
    """Level and control of every column of every table, with the values that
    its rows hold (an empty column needs no control yet)."""
    held = None
    for t in CLASSIFIED_TABLES:
        df = v.t.table(t)
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        long = counts.select(F.explode(F.map_from_arrays(F.array(*[F.lit(c) for c in df.columns]), F.array(*df.columns)))
                             .alias("column_name", "n_values")).withColumn("table_name", F.lit(t))
        held = long if held is None else held.unionByName(long)
    return gov.classify(held).join(held, ["table_name", "column_name"])


@query("gov_access_request", oracle=f"""
SELECT 'transactions' AS source, client_id, transaction_id AS record_id, timestamp AS event_time FROM tx
WHERE client_id IN ({", ".join(map(str, ACCESS_SUBJECTS))})
UNION ALL
SELECT 'predictions', t.client_id, p.transaction_id, t.timestamp FROM preds p JOIN tx t ON p.transaction_id = t.transaction_id
WHERE t.client_id IN ({", ".join(map(str, ACCESS_SUBJECTS))})""")
def gov_access_request(v):
    t = v.tx.where(F.col("client_id").isin(*ACCESS_SUBJECTS))
    a = t.select(F.lit("transactions").alias("source"), "client_id", F.col("transaction_id").alias("record_id"),
                 F.col("timestamp").alias("event_time"))
    b = v.preds.select("transaction_id").join(t.select("transaction_id", "client_id", "timestamp"), "transaction_id") \
        .select(F.lit("predictions").alias("source"), "client_id", F.col("transaction_id").alias("record_id"),
                F.col("timestamp").alias("event_time"))
    return a.unionByName(b)


@query("gov_erase", oracle="""
WITH er AS (SELECT c_custkey FROM customer WHERE c_custkey % 50 = 0),
c2 AS (SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM er)),
t2 AS (SELECT * FROM tx WHERE client_id NOT IN (SELECT c_custkey FROM er)),
p2 AS (SELECT * FROM preds WHERE transaction_id IN (SELECT transaction_id FROM t2))
SELECT 'customer' AS table_name, (SELECT count(*) FROM customer) AS n_before, (SELECT count(*) FROM c2) AS n_after,
       (SELECT count(*) FROM c2 WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)) AS n_orphans
UNION ALL SELECT 'transactions', (SELECT count(*) FROM tx), (SELECT count(*) FROM t2),
       (SELECT count(*) FROM t2 WHERE client_id NOT IN (SELECT c_custkey FROM c2))
UNION ALL SELECT 'predictions', (SELECT count(*) FROM preds), (SELECT count(*) FROM p2),
       (SELECT count(*) FROM p2 WHERE transaction_id NOT IN (SELECT transaction_id FROM t2))""")
def gov_erase(v):
    """Erase customers from stored tables, with the rows that refer to them at
    any depth; the counts are those of the files read back."""
    def keyed(name, df, key):
        path = shared_path(v.spark, f"erase-{name}")
        merge.create_keyed(df, path, merge.key_range(key, 1_000_000))
        return er.Table(path, key)

    tables = {"nation": keyed("nation", v.t.nation, "n_nationkey"),
              "customer": keyed("customer", v.t.customer, "c_custkey"),
              "transactions": keyed("transactions", v.tx, "transaction_id"),
              "predictions": keyed("predictions", v.preds, "transaction_id")}
    links = [er.Link("customer", "c_nationkey", "nation"), er.Link("transactions", "client_id", "customer"),
             er.Link("predictions", "transaction_id", "transactions")]
    subjects = v.t.customer.where(F.col("c_custkey") % 50 == 0).select("c_custkey")
    return er.erase(v.spark, tables, links, "customer", subjects).select(
        "table_name", "n_before", "n_after", "n_orphans")


@query("gov_ttl_purge", oracle="""
SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY""")
def gov_ttl_purge(v):
    as_of = rel.max_of(v.t.events, "ts")
    return gov.purge_older_than(v.t.events, "ts", as_of, 7).select("event_id", "ts")


_REQ_SQL = """r AS (SELECT o_orderkey, o_orderdate AS opened, o_orderdate + INTERVAL 1 DAY * (o_orderkey % 45) AS answered,
              o_orderdate + INTERVAL 1 HOUR * (o_orderkey % 96) AS acknowledged, o_orderstatus FROM orders)"""


def _requests(v):
    o = v.t.orders
    k = F.col("o_orderkey")
    return o.select("o_orderkey", F.col("o_orderdate").alias("opened"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY") * (k % 45)).alias("answered"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR") * (k % 96)).alias("acknowledged"),
                    "o_orderstatus")


@query("gov_dsar_sla", oracle=f"""WITH {_REQ_SQL}
SELECT CAST(date_trunc('month', opened) AS DATE) AS month, count(*) AS n_requests,
       round(avg(CAST(answered <= opened + INTERVAL 30 DAY AS INT)) * 100, 6) AS pct_answered_30d,
       round(avg(CAST(acknowledged <= opened + INTERVAL 72 HOUR AS INT)) * 100, 6) AS pct_ack_72h FROM r GROUP BY 1""")
def gov_dsar_sla(v):
    return gov.request_sla(_requests(v), "opened", "acknowledged", "answered")


@query("gov_alert_backlog", oracle=f"""WITH {_REQ_SQL},
a AS (SELECT opened, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE acknowledged END AS resolved FROM r),
h AS (SELECT resolved, (epoch(resolved) - epoch(opened)) / 3600.0 AS hours FROM a)
SELECT count(*) FILTER (WHERE resolved IS NULL) AS n_unresolved, round(avg(hours), 6) AS mean_hours_to_resolve,
       round(avg(CASE WHEN resolved IS NOT NULL THEN CAST(hours <= 24 AS INT) END) * 100, 6) AS pct_under_24h,
       round(avg(CASE WHEN resolved IS NOT NULL THEN CAST(hours <= 48 AS INT) END) * 100, 6) AS pct_under_48h FROM h""")
def gov_alert_backlog(v):
    r = _requests(v)
    a = r.select("opened", F.when(F.col("o_orderstatus") == "O", F.lit(None)).otherwise(F.col("acknowledged"))
                 .alias("resolved"))
    return gov.alert_backlog(a, "opened", "resolved")


@query("gov_extraction_volume", oracle="""
WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2),
s AS (SELECT user_id, avg(n) AS m, stddev_pop(n) AS sd FROM d GROUP BY 1)
SELECT d.user_id, d.day, d.n, d.n > s.m + 3 * s.sd AS flagged FROM d JOIN s ON d.user_id = s.user_id""")
def gov_extraction_volume(v):
    return gov.extraction_anomalies(v.t.events, "user_id", "ts")


@query("gov_quality_score", oracle="""
WITH s AS (SELECT avg(CAST(is_fraud IS NOT NULL AS INT)) AS completeness,
                  count(DISTINCT transaction_id) / count(*) AS uniqueness,
                  avg(CAST(amount > 0 AND category IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW') AS INT)) AS validity
           FROM tx)
SELECT round(completeness, 6) AS completeness, round(uniqueness, 6) AS uniqueness, round(validity, 6) AS validity,
       round((completeness + uniqueness + validity) / 3, 6) AS quality_score FROM s""")
def gov_quality_score(v):
    cats = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    t = v.tx
    s = t.agg(F.avg(F.col("is_fraud").isNotNull().cast("int")).alias("completeness"),
              (F.count_distinct("transaction_id") / F.count(F.lit(1))).alias("uniqueness"),
              F.avg(((F.col("amount") > 0) & F.col("category").isin(*cats)).cast("int")).alias("validity"))
    return s.select(*[F.round(c, 6).alias(c) for c in ("completeness", "uniqueness", "validity")],
                    F.round((F.col("completeness") + F.col("uniqueness") + F.col("validity")) / 3, 6).alias("quality_score"))
