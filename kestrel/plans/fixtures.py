"""Stand-in views over the driver tables.

The operational tables of the workloads (payments, scores, transit feed,
hourly weather, prediction log, ground truth, warehouse star schema, SCD2
change log) are derived here from the TPC-H-like test tables, once as Spark
DataFrames (what the queries use) and once as DuckDB SQL text (what the
oracles use).  The two definitions must stay row-for-row identical.

All views are lazy projections / aggregations of Parquet scans, so their
cost grows with the tables and Catalyst prunes unused columns through them.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import use_utc
from kestrel.sources.tables import Tables


def _ntz(c: Column) -> Column:
    return c.cast("timestamp_ntz")


def minutes(n) -> Column:
    """A day-time interval of ``n`` minutes (``n`` may be a column)."""
    return F.expr("INTERVAL 1 MINUTE") * (n if isinstance(n, Column) else F.lit(n))


def bus_of_user(user: Column) -> Column:
    return F.when(user % 3 == 0, F.lit("541")).otherwise(F.lit("542"))


class Views:
    """Lazy stand-in views for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        use_utc(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)
        self._memo: dict[str, DataFrame] = {}

    def _get(self, name, build):
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]

    # -- payments -------------------------------------------------------
    @property
    def tx(self) -> DataFrame:
        def build():
            o = self.t.orders
            k = F.col("o_orderkey")
            return o.select(
                k.alias("transaction_id"),
                (F.col("o_orderdate") + minutes(k % 1440)).alias("timestamp"),
                F.col("o_totalprice").cast("decimal(15,2)").alias("amount"),
                F.lit("EUR").alias("currency"),
                (k % 100).alias("merchant_id"),
                F.col("o_custkey").alias("client_id"),
                F.col("o_orderpriority").alias("category"),
                F.when(F.col("o_orderstatus") == "O", "Pending")
                 .when(F.col("o_orderstatus") == "F", "Success")
                 .otherwise("Failed").alias("status"),
                F.when(k % 5 == 0, F.lit(None).cast("boolean"))
                 .otherwise(k % 37 == 0).alias("is_fraud"),
            )
        return self._get("tx", build)

    @property
    def preds(self) -> DataFrame:
        def build():
            o = self.t.orders
            k = F.col("o_orderkey")
            r = (k * 7919) % 10007
            return (o.where(k % 10 != 3)
                    .select(k.alias("transaction_id"),
                            F.lit("ensemble-v1").alias("model_version"),
                            (r / F.lit(10007.0)).alias("prediction_score"),
                            (r >= 9006).alias("is_alerted")))
        return self._get("preds", build)

    # -- transit ----------------------------------------------------------
    @property
    def transport_rt(self) -> DataFrame:
        def build():
            e = self.t.events
            shifted = F.col("ts") + minutes(30)
            return e.select(
                F.col("event_id").alias("id"),
                F.col("ts").alias("event_ts"),
                _ntz(F.date_trunc("hour", shifted)).alias("timestamp_rounded"),
                F.hour(shifted).cast("int").alias("hour"),
                bus_of_user(F.col("user_id")).alias("bus_nbr"),
                (F.col("event_id") % 2).cast("int").alias("direction_id"),
                (F.lit(1) + F.col("user_id") % 30).cast("int").alias("stop_sequence"),
                F.when(F.col("event_id") % 17 == 0, F.lit(None).cast("double"))
                 .otherwise((F.floor(F.col("value") * 6) - 60).cast("double"))
                 .alias("departure_delay"),
            )
        return self._get("transport_rt", build)

    @property
    def weather_hourly(self) -> DataFrame:
        def build():
            h = (self.t.events
                 .groupBy(_ntz(F.date_trunc("hour", F.col("ts"))).alias("timestamp_rounded"))
                 .agg(F.min("event_id").alias("k")))
            k = F.col("k")
            code = F.coalesce(*[F.when(k % 13 == i, F.lit(c)) for i, c in enumerate(
                [0, 1, 2, 3, 51, 53, 55, 61, 63, 65, 71, 73])], F.lit(75))
            return h.select(
                "timestamp_rounded",
                (((k * 37) % 300 - 150).cast("double") / 10).alias("temperature_2m"),
                (((k * 13) % 50).cast("double") / 10).alias("precipitation"),
                F.when(k % 4 == 0, ((k * 7) % 30).cast("double") / 10)
                 .otherwise(F.lit(0.0)).alias("snowfall"),
                (((k * 11) % 400).cast("double") / 10).alias("wind_speed_10m"),
                code.cast("int").alias("weather_code"),
            )
        return self._get("weather_hourly", build)

    # -- delay-model monitoring --------------------------------------------
    @property
    def prediction_logs(self) -> DataFrame:
        def build():
            e = self.t.events
            p50 = F.floor(F.col("value") * 5)
            return (e.where(F.col("event_type").isin("purchase", "view"))
                    .select(F.col("event_id").alias("id"),
                            bus_of_user(F.col("user_id")).alias("bus_nbr"),
                            (F.col("event_id") % 2).cast("int").alias("direction_id"),
                            (F.lit(1) + F.col("user_id") % 30).cast("int").alias("stop_sequence"),
                            F.month("ts").cast("int").alias("month"),
                            F.dayofmonth("ts").cast("int").alias("day"),
                            F.hour("ts").cast("int").alias("hour"),
                            F.weekday("ts").cast("int").alias("day_of_week"),
                            p50.cast("double").alias("prediction_P50"),
                            (p50 + 40).cast("double").alias("prediction_P80"),
                            (p50 + 90).cast("double").alias("prediction_P90"),
                            F.col("ts").alias("timestamp")))
        return self._get("prediction_logs", build)

    @property
    def ground_truth(self) -> DataFrame:
        def build():
            p = self.prediction_logs
            return (p.where(F.col("id") % 3 == 0)
                    .select(F.col("id").alias("prediction_log_id"),
                            (F.col("prediction_P50") + (F.col("id") % 41) - 20).alias("actual_delay"),
                            F.when(F.col("id") % 6 == 0,
                                   F.lit("2024-03-04 00:00:00").cast("timestamp_ntz"))
                             .otherwise(F.lit("2024-02-26 00:00:00").cast("timestamp_ntz"))
                             .alias("created_at")))
        return self._get("ground_truth", build)

    # -- warehouse ----------------------------------------------------------
    @staticmethod
    def date_key(c: Column) -> Column:
        return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("long")

    @property
    def fact_transactions(self) -> DataFrame:
        def build():
            li, o, c = self.t.lineitem, self.t.orders, self.t.customer
            j = (li.join(o, li.l_orderkey == o.o_orderkey)
                 .join(c, o.o_custkey == c.c_custkey))
            gross = F.col("l_extendedprice").cast("decimal(15,2)")
            fee = F.col("l_quantity").cast("int").cast("decimal(15,2)")
            return j.select(
                self.date_key(F.col("o_orderdate")).alias("date_key"),
                F.col("l_suppkey").alias("merchant_key"),
                F.col("o_custkey").alias("customer_key"),
                F.col("l_partkey").alias("product_key"),
                F.col("l_linenumber").alias("payment_method_key"),
                F.col("c_nationkey").alias("geography_key"),
                gross.alias("gross_amount"),
                fee.alias("fee_amount"),
                (gross - fee).cast("decimal(16,2)").alias("net_revenue"),
                (F.col("l_linestatus") == "F").alias("is_successful"),
                (F.col("l_returnflag") == "R").alias("is_fraud"),
            )
        return self._get("fact_transactions", build)

    @property
    def dim_date(self) -> DataFrame:
        def build():
            d = F.col("o_orderdate")
            return (self.t.orders.select(
                self.date_key(d).alias("date_key"), d.cast("date").alias("full_date"),
                F.year(d).cast("long").alias("year"), F.quarter(d).cast("long").alias("quarter"),
                F.month(d).cast("long").alias("month"), F.weekofyear(d).cast("long").alias("week")).distinct())
        return self._get("dim_date", build)

    @property
    def dim_customer(self) -> DataFrame:
        def build():
            k = F.col("c_custkey")
            return self.t.customer.select(
                k.alias("customer_key"), F.col("c_mktsegment").alias("segment_name"),
                F.make_date((F.lit(1995) + k % 6).cast("int"), (F.lit(1) + k % 12).cast("int"),
                            F.lit(1)).alias("signup_cohort_month"))
        return self._get("dim_customer", build)

    @property
    def dim_geography(self) -> DataFrame:
        def build():
            n, r = self.t.nation, self.t.region
            return (n.join(r, n.n_regionkey == r.r_regionkey)
                    .select(F.col("n_nationkey").alias("geography_key"),
                            F.col("n_name").alias("country"), F.col("r_name").alias("region")))
        return self._get("dim_geography", build)

    @property
    def dim_merchant(self) -> DataFrame:
        def build():
            s, n = self.t.supplier, self.t.nation
            return (s.join(n, s.s_nationkey == n.n_nationkey)
                    .select(F.col("s_suppkey").alias("merchant_key"),
                            F.col("s_name").alias("merchant_name"),
                            F.col("n_name").alias("industry_category")))
        return self._get("dim_merchant", build)

    @property
    def merchant_changes(self) -> DataFrame:
        def build():
            s = self.t.supplier
            day = F.expr("INTERVAL 1 DAY")
            return (s.withColumn("v", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))  # 3 versions each
                    .select(F.col("s_suppkey").alias("merchant_key"),
                            F.concat(F.col("s_name"), F.lit("-"), F.col("v").cast("string"))
                             .alias("merchant_name"),
                            (F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
                             + day * (F.col("v") * 400 + F.col("s_suppkey") % 90))
                            .alias("changed_at")))
        return self._get("merchant_changes", build)


_VIEWS: dict[tuple[int, str], Views] = {}


def views(spark: SparkSession, sf_dir: str) -> Views:
    """Views of one data folder for this session (re-created when the
    caller hands in another session, e.g. after a stop / getOrCreate)."""
    key = (id(spark), sf_dir)
    cached = _VIEWS.get(key)
    if cached is None or cached.spark is not spark:
        cached = _VIEWS[key] = Views(spark, sf_dir)
    return cached


# ---------------------------------------------------------------------------
# DuckDB text of the same views (used by oracle_sql()).  {DOW} is
# ``isodow(ts) - 1`` there (Spark: ``weekday(ts)``).
# ---------------------------------------------------------------------------
ORACLE_VIEWS: dict[str, str] = {
    "tx": """
SELECT o_orderkey AS transaction_id,
       o_orderdate + INTERVAL '1' MINUTE * (o_orderkey % 1440) AS timestamp,
       CAST(o_totalprice AS DECIMAL(15,2)) AS amount, 'EUR' AS currency,
       o_orderkey % 100 AS merchant_id, o_custkey AS client_id, o_orderpriority AS category,
       CASE o_orderstatus WHEN 'O' THEN 'Pending' WHEN 'F' THEN 'Success' ELSE 'Failed' END AS status,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 37 = 0 END AS is_fraud
FROM orders""",
    "preds": """
SELECT o_orderkey AS transaction_id, 'ensemble-v1' AS model_version,
       ((o_orderkey * 7919) % 10007) / CAST(10007 AS DOUBLE) AS prediction_score,
       ((o_orderkey * 7919) % 10007) >= 9006 AS is_alerted
FROM orders WHERE o_orderkey % 10 <> 3""",
    "transport_rt": """
SELECT event_id AS id, ts AS event_ts,
       date_trunc('hour', ts + INTERVAL '30' MINUTE) AS timestamp_rounded,
       CAST(hour(ts + INTERVAL '30' MINUTE) AS INT) AS hour,
       CASE WHEN user_id % 3 = 0 THEN '541' ELSE '542' END AS bus_nbr,
       CAST(event_id % 2 AS INT) AS direction_id, CAST(1 + user_id % 30 AS INT) AS stop_sequence,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(floor(value * 6) - 60 AS DOUBLE) END AS departure_delay
FROM events""",
    "weather_hourly": """
SELECT timestamp_rounded,
       CAST((k * 37) % 300 - 150 AS DOUBLE) / 10 AS temperature_2m,
       CAST((k * 13) % 50 AS DOUBLE) / 10 AS precipitation,
       CASE WHEN k % 4 = 0 THEN CAST((k * 7) % 30 AS DOUBLE) / 10 ELSE 0.0 END AS snowfall,
       CAST((k * 11) % 400 AS DOUBLE) / 10 AS wind_speed_10m,
       CAST(CASE k % 13 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 51 WHEN 5 THEN 53 WHEN 6 THEN 55
            WHEN 7 THEN 61 WHEN 8 THEN 63 WHEN 9 THEN 65 WHEN 10 THEN 71 WHEN 11 THEN 73 ELSE 75 END AS INT) AS weather_code
FROM (SELECT date_trunc('hour', ts) AS timestamp_rounded, min(event_id) AS k FROM events GROUP BY 1) h""",
    "prediction_logs": """
SELECT event_id AS id, CASE WHEN user_id % 3 = 0 THEN '541' ELSE '542' END AS bus_nbr,
       CAST(event_id % 2 AS INT) AS direction_id, CAST(1 + user_id % 30 AS INT) AS stop_sequence,
       CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day, CAST(hour(ts) AS INT) AS hour,
       CAST(isodow(ts) - 1 AS INT) AS day_of_week,
       CAST(floor(value * 5) AS DOUBLE) AS prediction_P50, CAST(floor(value * 5) + 40 AS DOUBLE) AS prediction_P80,
       CAST(floor(value * 5) + 90 AS DOUBLE) AS prediction_P90, ts AS timestamp
FROM events WHERE event_type IN ('purchase', 'view')""",
    "ground_truth": """
SELECT id AS prediction_log_id, prediction_P50 + (id % 41) - 20 AS actual_delay,
       CASE WHEN id % 6 = 0 THEN TIMESTAMP '2024-03-04 00:00:00' ELSE TIMESTAMP '2024-02-26 00:00:00' END AS created_at
FROM prediction_logs WHERE id % 3 = 0""",
    "fact_transactions": """
SELECT year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS date_key,
       l_suppkey AS merchant_key, o_custkey AS customer_key, l_partkey AS product_key,
       l_linenumber AS payment_method_key, c_nationkey AS geography_key,
       CAST(l_extendedprice AS DECIMAL(15,2)) AS gross_amount,
       CAST(CAST(l_quantity AS INT) AS DECIMAL(15,2)) AS fee_amount,
       CAST(l_extendedprice AS DECIMAL(15,2)) - CAST(CAST(l_quantity AS INT) AS DECIMAL(15,2)) AS net_revenue,
       l_linestatus = 'F' AS is_successful, l_returnflag = 'R' AS is_fraud
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey""",
    "dim_date": """
SELECT DISTINCT year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS date_key,
       CAST(o_orderdate AS DATE) AS full_date, year(o_orderdate) AS year, quarter(o_orderdate) AS quarter,
       month(o_orderdate) AS month, weekofyear(o_orderdate) AS week
FROM orders""",
    "dim_customer": """
SELECT c_custkey AS customer_key, c_mktsegment AS segment_name,
       make_date(CAST(1995 + c_custkey % 6 AS INT), CAST(1 + c_custkey % 12 AS INT), 1) AS signup_cohort_month FROM customer""",
    "dim_geography": """
SELECT n_nationkey AS geography_key, n_name AS country, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_merchant": """
SELECT s_suppkey AS merchant_key, s_name AS merchant_name, n_name AS industry_category FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "merchant_changes": """
SELECT s_suppkey AS merchant_key, s_name || '-' || CAST(v AS VARCHAR(10)) AS merchant_name,
       TIMESTAMP '1995-01-01 00:00:00' + INTERVAL '1' DAY * (v * 400 + s_suppkey % 90) AS changed_at
FROM supplier CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1 UNION ALL SELECT 2) x""",
}

# dependency order for CTE emission
_VIEW_ORDER = list(ORACLE_VIEWS)
_VIEW_DEPS = {"ground_truth": ["prediction_logs"]}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the stand-in views it mentions, as CTEs.

    If ``sql`` itself starts with ``WITH``, its CTEs are appended after ours.
    """
    needed: set[str] = set()

    def add(name):
        if name in needed:
            return
        for d in _VIEW_DEPS.get(name, []):
            add(d)
        needed.add(name)

    for name in _VIEW_ORDER:
        if re.search(rf"\b{name}\b", sql):
            add(name)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({ORACLE_VIEWS[n].strip()})" for n in _VIEW_ORDER if n in needed)
    body = sql.strip()
    m = re.match(r"(?is)^with\s+(recursive\s+)?", body)
    if m:
        return f"WITH {m.group(1) or ''}{ctes},\n{body[m.end():]}"
    return f"WITH {ctes}\n{body}"
