"""Card-payment reporting operators: joins of transactions with scores,
daily KPIs, category risk, behavioural statistics.

Aggregates are expressed with ``groupBy().agg()`` so Spark runs a partial
(map-side) aggregate before the shuffle; a hot client or category therefore
costs one pre-aggregated row per task, not a third of the table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-6  # fixed value: denominator guard of the amount ratio


def with_predictions(tx: DataFrame, preds: DataFrame, cols=("prediction_score", "is_alerted",
                                                             "model_version")) -> DataFrame:
    """Transactions left-joined with their scores.  ``preds`` has no unique
    key, so a transaction scored twice appears twice (kept on purpose)."""
    p = preds.select("transaction_id", *cols)
    return tx.join(p, "transaction_id", "left")


def fraud_kpis(df: DataFrame, amount: str = "amount", alert: str = "is_alerted") -> DataFrame:
    """total, alerts, alert rate %, total volume, alerted volume (0 if none)."""
    a = F.col(alert)
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(a).alias("alerts"),
        F.round(F.try_divide(F.count_if(a) * 100.0, F.count(F.lit(1))), 6).alias("alert_rate_pct"),
        F.sum(amount).cast("decimal(38,2)").alias("volume"),
        F.coalesce(F.sum(F.when(a, F.col(amount))), F.lit(0)).cast("decimal(38,2)").alias("alerted_volume"),
    )


def per_day_counts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("date")).agg(F.count(F.lit(1)).alias("count"))


def category_risk(df: DataFrame, category: str = "category", alert: str = "is_alerted") -> DataFrame:
    """Per category over rows with a known flag: count, alerts, alert rate %."""
    a = F.col(alert)
    return (df.where(a.isNotNull())
            .groupBy(category)
            .agg(F.count(a).alias("total"),
                 F.sum(a.cast("int")).alias("alerts"))
            .withColumn("alert_rate_pct", F.round(F.col("alerts") * 100.0 / F.col("total"), 6))
            .orderBy(F.desc("alert_rate_pct"), category))


def category_frauds(df: DataFrame, category: str = "category", alert: str = "is_alerted") -> DataFrame:
    """Categories with at least one alert (HAVING), most alerts first."""
    return (df.groupBy(category).agg(F.count_if(F.col(alert)).alias("alerts"))
            .where(F.col("alerts") > 0)
            .orderBy(F.desc("alerts"), category))


def client_stats(df: DataFrame, client: str = "client_id", amount: str = "amount") -> DataFrame:
    return df.groupBy(client).agg(
        F.count(amount).alias("client_tx_count"),
        F.round(F.avg(F.col(amount).cast("double")), 6).alias("client_avg_amount"))


def merchant_stats(df: DataFrame, merchant: str = "merchant_id", amount: str = "amount") -> DataFrame:
    return df.groupBy(merchant).agg(F.count(amount).alias("merchant_tx_count"))


def amount_ratio(amount: Column, mean: Column) -> Column:
    return amount.cast("double") / (mean + F.lit(EPS))


def with_group_stats(df: DataFrame, client: str = "client_id", merchant: str = "merchant_id",
                     amount: str = "amount", stats_from: DataFrame | None = None) -> DataFrame:
    """Join per-client and per-merchant statistics back onto every row.

    Aggregate-then-join instead of a window: the aggregate is partial and the
    join of a hot key against its single stats row is split by AQE's skew
    handling, while a ``Window.partitionBy(client)`` would put a hot client
    in one task.  ``stats_from`` fits the stats on another frame (train only).
    """
    src = stats_from if stats_from is not None else df
    cs = client_stats(src, client, amount)
    ms = merchant_stats(src, merchant, amount)
    out = df.join(cs, client, "left").join(ms, merchant, "left")
    return out.withColumn("client_amount_ratio",
                          F.round(amount_ratio(F.col(amount), F.col("client_avg_amount")), 6))


def stats_medians(cstats: DataFrame, mstats: DataFrame) -> DataFrame:
    """One row: exact medians of the client count, client mean amount and
    merchant count columns (the defaults for unknown keys)."""
    from kestrel.operators.ordering import exact_quantiles
    stacked = (cstats.select(F.lit("_m_cnt").alias("stat"), F.col("client_tx_count").cast("double").alias("v"))
               .unionByName(cstats.select(F.lit("_m_avg").alias("stat"), F.col("client_avg_amount").cast("double").alias("v")))
               .unionByName(mstats.select(F.lit("_m_mcnt").alias("stat"), F.col("merchant_tx_count").cast("double").alias("v"))))
    med = exact_quantiles(stacked, "v", [0.5], ["m"], group=["stat"])
    return med.groupBy().pivot("stat", ["_m_cnt", "_m_avg", "_m_mcnt"]).agg(F.first("m"))


def lookup_stats_with_default(df: DataFrame, cstats: DataFrame, mstats: DataFrame,
                              client: str = "client_id", merchant: str = "merchant_id",
                              amount: str = "amount", medians: DataFrame | None = None) -> DataFrame:
    """Score-time lookup: unknown client/merchant -> median of the stats table.

    The medians are one row (broadcast; pass ``medians`` to reuse them across
    micro-batches); the stats tables are joined normally so they may be as
    large as the client base.
    """
    meds = medians if medians is not None else stats_medians(cstats, mstats)
    out = (df.join(cstats, client, "left").join(mstats, merchant, "left")
           .crossJoin(F.broadcast(meds)))
    out = out.withColumns({
        "client_tx_count": F.coalesce(F.col("client_tx_count").cast("double"), F.col("_m_cnt")),
        "client_avg_amount": F.coalesce(F.col("client_avg_amount"), F.col("_m_avg")),
        "merchant_tx_count": F.coalesce(F.col("merchant_tx_count").cast("double"), F.col("_m_mcnt")),
    })
    out = out.withColumn("client_amount_ratio",
                         F.round(amount_ratio(F.col(amount), F.col("client_avg_amount")), 6))
    return out.drop("_m_cnt", "_m_avg", "_m_mcnt")


def score_band(score: Column) -> Column:
    """> 0.9 block, > 0.7 challenge, else approve (0.7 / 0.9 fall lower)."""
    return (F.when(score > 0.9, "block").when(score > 0.7, "challenge").otherwise("approve"))


def risk_level(score: Column) -> Column:
    return (F.when(score < 0.5, "Low").when(score < 0.7, "Medium")
            .when(score < 0.9, "High").otherwise("Critical"))


def concat_location(city: Column, state: Column) -> Column:
    """``city + ', ' + state``; NULL when either part is NULL."""
    return F.concat(city, F.lit(", "), state)


def compound_id(*parts: Column) -> Column:
    return F.concat_ws("_", *[p.cast("string") for p in parts])
