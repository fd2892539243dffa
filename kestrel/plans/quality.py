"""Drift and data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.quality import drift as dr
from kestrel.quality import profile as pf
from kestrel.plans.registry import query

SPLIT = "2024-01-16 00:00:00"  # reference = before, current = from
NUMERIC = ["prediction_P50", "prediction_P80", "hour", "stop_sequence", "day_of_week"]
CATEGORICAL = ["bus_nbr", "direction_id"]


def _split(v):
    p = v.prediction_logs
    t = F.lit(SPLIT).cast("timestamp_ntz")
    return p.where(F.col("timestamp") < t), p.where(F.col("timestamp") >= t)


def _drift(v):
    ref, cur = _split(v)
    return dr.drift_columns(ref, cur, NUMERIC, CATEGORICAL)


def _pvalue_sql(lam: str) -> str:
    terms = " + ".join(f"({(-1) ** (j - 1)}) * exp(-2.0 * {j * j} * ({lam}) * ({lam}))" for j in range(1, dr.KS_TERMS + 1))
    return f"CASE WHEN ({lam}) <= 0 THEN 1.0 ELSE least(greatest(2.0 * ({terms}), 0.0), 1.0) END"


def _long_sql(cols, cast):
    parts = []
    for side, src in ((0, "ref"), (1, "cur")):
        for c in cols:
            parts.append(f"SELECT '{c}' AS column_name, CAST({c} AS {cast}) AS value, {side} AS side FROM {src} WHERE {c} IS NOT NULL")
    return "\nUNION ALL ".join(parts)


_SPLIT_SQL = f"""ref AS (SELECT * FROM prediction_logs WHERE timestamp < TIMESTAMP '{SPLIT}'),
cur AS (SELECT * FROM prediction_logs WHERE timestamp >= TIMESTAMP '{SPLIT}')"""

_LAM = "sqrt(n_ref * n_cur / (n_ref + n_cur)) * statistic"
DRIFT_SQL = f"""WITH {_SPLIT_SQL},
ln AS ({_long_sql(NUMERIC, 'DOUBLE')}),
cn AS (SELECT column_name, value, count(*) FILTER (WHERE side = 0) AS n_ref, count(*) FILTER (WHERE side = 1) AS n_cur FROM ln GROUP BY 1, 2),
cm AS (SELECT column_name, sum(n_ref) OVER (PARTITION BY column_name ORDER BY value) AS c_ref,
              sum(n_cur) OVER (PARTITION BY column_name ORDER BY value) AS c_cur,
              sum(n_ref) OVER (PARTITION BY column_name) AS t_ref, sum(n_cur) OVER (PARTITION BY column_name) AS t_cur FROM cn),
d AS (SELECT column_name, max(abs(c_ref / t_ref - c_cur / t_cur)) AS statistic, CAST(max(t_ref) AS DOUBLE) AS n_ref,
             CAST(max(t_cur) AS DOUBLE) AS n_cur FROM cm GROUP BY 1),
d2 AS (SELECT column_name, statistic AS raw_stat, {_pvalue_sql(_LAM)} AS p FROM d),
ks AS (SELECT column_name, 'ks' AS test, round(raw_stat, 6) AS statistic, round(p, 6) AS p_value, p < 0.05 AS drifted FROM d2),
lc AS ({_long_sql(CATEGORICAL, 'VARCHAR')}),
cc AS (SELECT column_name, value, count(*) FILTER (WHERE side = 0) AS n_ref, count(*) FILTER (WHERE side = 1) AS n_cur FROM lc GROUP BY 1, 2),
sh AS (SELECT column_name, n_ref / sum(n_ref) OVER (PARTITION BY column_name) AS p, n_cur / sum(n_cur) OVER (PARTITION BY column_name) AS q FROM cc),
js AS (SELECT column_name, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2)) ELSE 0 END)
                         + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2)) ELSE 0 END) AS div FROM sh GROUP BY 1),
jsd AS (SELECT column_name, 'jensenshannon' AS test, round(sqrt(greatest(div, 0)), 6) AS statistic, CAST(NULL AS DOUBLE) AS p_value,
               sqrt(greatest(div, 0)) >= 0.1 AS drifted FROM js),
cols AS (SELECT * FROM ks UNION ALL SELECT * FROM jsd)"""


@query("drift_columns", oracle=DRIFT_SQL + "\nSELECT * FROM cols")
def drift_columns(v):
    return _drift(v)


@query("drift_dataset", oracle=DRIFT_SQL + """
SELECT count(*) AS n_columns, count(*) FILTER (WHERE drifted) AS n_drifted,
       round(count(*) FILTER (WHERE drifted) / count(*), 6) AS share_drifted,
       round(count(*) FILTER (WHERE drifted) / count(*), 6) >= 0.5 AS dataset_drift FROM cols""")
def drift_dataset(v):
    return dr.dataset_drift(_drift(v))


@query("drift_tests", oracle=DRIFT_SQL + """,
s AS (SELECT count(*) FILTER (WHERE drifted) AS n_drifted, round(count(*) FILTER (WHERE drifted) / count(*), 6) AS share FROM cols)
SELECT 'number_of_drifted_columns' AS test, CAST(n_drifted AS DOUBLE) AS value, 'lt 3' AS condition,
       CASE WHEN n_drifted < 3 THEN 'SUCCESS' ELSE 'FAIL' END AS status FROM s
UNION ALL SELECT 'share_of_drifted_columns', share, 'lt 0.1', CASE WHEN share < 0.1 THEN 'SUCCESS' ELSE 'FAIL' END FROM s""")
def drift_tests(v):
    return dr.drift_tests(_drift(v))


@query("drift_score_vs_truth", oracle="""
SELECT CAST(least(floor(p.prediction_score * 10), 9) AS INT) AS bin, count(*) AS n,
       count(*) FILTER (WHERE t.is_fraud) AS n_pos, round(avg(CAST(t.is_fraud AS INT)), 6) AS positive_rate
FROM tx t JOIN preds p ON t.transaction_id = p.transaction_id WHERE t.is_fraud IS NOT NULL GROUP BY 1""")
def drift_score_vs_truth(v):
    j = v.tx.where(F.col("is_fraud").isNotNull()).join(v.preds, "transaction_id")
    b = F.least(F.floor(F.col("prediction_score") * 10), F.lit(9)).cast("int")
    return j.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.count_if("is_fraud").alias("n_pos"),
                                         F.round(F.avg(F.col("is_fraud").cast("int")), 6).alias("positive_rate"))


_PROFILE_COLS = ["departure_delay", "stop_sequence", "hour", "direction_id"]


@query("dq_profile", oracle="WITH ln AS (" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM transport_rt" for c in _PROFILE_COLS) + """),
st AS (SELECT column_name, count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS n_missing, count(DISTINCT value) AS n_distinct,
              min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean,
              quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM ln GROUP BY 1),
o AS (SELECT ln.column_name, count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers
      FROM ln JOIN st ON ln.column_name = st.column_name GROUP BY 1)
SELECT st.column_name, n, n_missing, round(n_missing * 100.0 / n, 6) AS pct_missing, n_distinct, min, max, mean,
       round(q1, 6) AS q1, round(q3, 6) AS q3, n_outliers FROM st JOIN o ON st.column_name = o.column_name""")
def dq_profile(v):
    return pf.profile(v.transport_rt, _PROFILE_COLS)


@query("dq_duplicates", oracle="""
SELECT CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS n_duplicate_rows FROM (SELECT count(*) AS c FROM transport_rt GROUP BY bus_nbr, direction_id, stop_sequence, hour, departure_delay) g""")
def dq_duplicates(v):
    return pf.duplicate_rows(v.transport_rt.select("bus_nbr", "direction_id", "stop_sequence", "hour", "departure_delay"))


@query("dq_reference_status", oracle=f"""
SELECT count(*) AS n_rows, 12 AS n_columns FROM prediction_logs WHERE timestamp < TIMESTAMP '{SPLIT}'""")
def dq_reference_status(v):
    ref, _ = _split(v)
    return ref.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(ref.columns)))


@query("dq_required_fields", oracle="""
SELECT s.transaction_id,
       list_filter([CASE WHEN s.transaction_id IS NULL THEN 'transaction_id' END, CASE WHEN s.amount IS NULL THEN 'amount' END,
                    CASE WHEN s.category IS NULL THEN 'category' END, CASE WHEN s.timestamp IS NULL THEN 'timestamp' END,
                    CASE WHEN s.prediction_score IS NULL THEN 'prediction_score' END], lambda x: x IS NOT NULL) AS missing_fields,
       s.prediction_score IS NOT NULL AS is_valid
FROM (SELECT t.*, p.prediction_score FROM tx t LEFT JOIN preds p ON t.transaction_id = p.transaction_id) s""")
def dq_required_fields(v):
    """Scored-transaction records: the four mandatory fields plus the score
    (records not yet scored go to quarantine)."""
    s = v.tx.join(v.preds.select("transaction_id", "prediction_score"), "transaction_id", "left")
    r = pf.required_fields(s, ["transaction_id", "amount", "category", "timestamp", "prediction_score"])
    return r.select("transaction_id", "missing_fields", "is_valid")


@query("dq_unique", oracle="""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def dq_unique(v):
    return pf.non_unique_keys(v.t.lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_completeness_kpi", oracle="""
WITH d AS (SELECT d.*, l.doc_id IS NOT NULL AS has_label FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id),
f AS (SELECT CAST(text IS NOT NULL AND length(text) > 0 AS INT) + CAST(coalesce(lang IN ('en', 'fr', 'de', 'es'), false) AS INT)
           + CAST(coalesce(source LIKE 'src%', false) AS INT) + CAST(coalesce(n_chars > 0, false) AS INT) + CAST(has_label AS INT) AS n_valid FROM d)
SELECT count(*) AS n_records, round(avg(CAST(n_valid >= 4 AS INT)) * 100, 6) AS pct_complete,
       avg(CAST(n_valid >= 4 AS INT)) >= 0.92 AS meets_92, avg(CAST(n_valid >= 4 AS INT)) >= 0.97 AS meets_97,
       avg(CAST(n_valid >= 4 AS INT)) >= 0.99 AS meets_99 FROM f""")
def dq_completeness_kpi(v):
    labelled = v.t.labels.select("doc_id").distinct().withColumn("has_label", F.lit(True))
    d = v.t.documents.join(labelled, "doc_id", "left").na.fill(False, ["has_label"])
    flags = [F.col("text").isNotNull() & (F.length("text") > 0),
             F.coalesce(F.col("lang").isin("en", "fr", "de", "es"), F.lit(False)),
             F.coalesce(F.col("source").startswith("src"), F.lit(False)),
             F.coalesce(F.col("n_chars") > 0, F.lit(False)), F.col("has_label")]
    return d.agg(*pf.completeness_kpi(flags, min_valid=4))


@query("dq_volume_anomaly", oracle="""
WITH d AS (SELECT CAST(timestamp AS DATE) AS day, count(*) AS n FROM tx GROUP BY 1),
w AS (SELECT day, n, avg(n) OVER r AS tm, count(n) OVER r AS k FROM d
      WINDOW r AS (ORDER BY day - DATE '1970-01-01' RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT day, n, round(tm, 6) AS trailing_mean, round(CASE WHEN k >= 3 THEN n / tm END, 6) AS ratio,
       coalesce(CASE WHEN k >= 3 THEN n / tm END < 0.5 OR CASE WHEN k >= 3 THEN n / tm END > 2, false) AS anomaly FROM w""")
def dq_volume_anomaly(v):
    daily = v.tx.groupBy(F.to_date("timestamp").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return pf.volume_anomaly(daily, "day", "n")


@query("dq_schema_drift", oracle="""
SELECT 'status' AS column_name, 'string' AS old_type, NULL AS new_type, 'removed' AS change,
       count(status) AS old_values, NULL AS new_values FROM tx
UNION ALL SELECT 'amount', 'decimal(15,2)', 'double', 'retyped', count(amount), count(TRY_CAST(amount AS DOUBLE)) FROM tx
UNION ALL SELECT 'ingested_at', NULL, 'date', 'added', NULL, count(CAST(timestamp AS DATE)) FROM tx""")
def dq_schema_drift(v):
    """Columns that came, went or changed type, with the values that each
    side's rows hold in them (a retyping that loses values shows)."""
    new = v.tx.drop("status").withColumn("amount", F.col("amount").cast("double")) \
        .withColumn("ingested_at", F.to_date("timestamp"))
    drift = pf.schema_drift(v.spark, v.tx, new)

    def values(df, name):
        wide = df.agg(*[F.count(c).alias(c) for c in df.columns])
        return wide.select(F.explode(F.map_from_arrays(
            F.array(*[F.lit(c) for c in df.columns]), F.array(*df.columns))).alias("column_name", name))

    return drift.join(values(v.tx, "old_values"), "column_name", "left").join(
        values(new, "new_values"), "column_name", "left")


@query("dq_feature_jump", oracle="""
WITH wk AS (SELECT CAST(date_trunc('week', ts) AS DATE) AS week, avg(value) AS m FROM events GROUP BY 1)
SELECT week, round(m, 6) AS mean_value, round(m / lag(m) OVER (ORDER BY week), 6) AS ratio,
       coalesce(m / lag(m) OVER (ORDER BY week) >= 2, false) AS jump FROM wk""")
def dq_feature_jump(v):
    return pf.feature_jump(v.t.events, "ts", "value")
