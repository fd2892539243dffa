"""Feature preparation, splits and model-adjacent queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions import calendar as cal
from kestrel.modeling import features as fe
from kestrel.modeling.scoring import DELAY_FEATURES, delay_terms
from kestrel.operators import payments as pay
from kestrel.plans.registry import query
from kestrel.plans.transit import delays

FRAUD_NUMERIC = ["amount", "hour", "day_of_week", "client_tx_count", "client_avg_amount",
                 "client_amount_ratio", "merchant_tx_count"]
MODEL_VERSION = "gbt-rf-ensemble-v1"
ALERT_THRESHOLD = 0.9
WEATHER_LEVELS = ["0", "1", "2", "3", "51", "53", "55", "61", "63", "65", "71", "73", "75"]


def fraud_features(v, df=None):
    """The 8 model features on labelled transactions (stats fitted on the
    same rows, as the reference does before splitting)."""
    lab = df if df is not None else v.tx.where(F.col("is_fraud").isNotNull())
    f = pay.with_group_stats(lab)
    f = f.withColumns({"hour": F.hour("timestamp"), "day_of_week": F.weekday("timestamp"),
                       "amount": F.col("amount").cast("double")})
    f = fe.label_encode(f, "category", "category_code")
    return f.select("transaction_id", "amount", F.col("category_code").alias("category"), "hour", "day_of_week",
                    "client_tx_count", "client_avg_amount", "client_amount_ratio", "merchant_tx_count",
                    F.col("is_fraud").cast("int").alias("label"))


_FEAT_SQL = """l AS (SELECT * FROM tx WHERE is_fraud IS NOT NULL),
cs AS (SELECT client_id, count(amount) AS client_tx_count, round(avg(CAST(amount AS DOUBLE)), 6) AS client_avg_amount FROM l GROUP BY 1),
ms AS (SELECT merchant_id, count(amount) AS merchant_tx_count FROM l GROUP BY 1),
cat AS (SELECT category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INT) AS code FROM (SELECT DISTINCT category FROM l) x),
ff AS (SELECT l.transaction_id, CAST(l.amount AS DOUBLE) AS amount, cat.code AS category, CAST(hour(l.timestamp) AS INT) AS hour,
              CAST(isodow(l.timestamp) - 1 AS INT) AS day_of_week, cs.client_tx_count, cs.client_avg_amount,
              round(CAST(l.amount AS DOUBLE) / (cs.client_avg_amount + 1e-6), 6) AS client_amount_ratio, ms.merchant_tx_count,
              CAST(l.is_fraud AS INT) AS label
       FROM l JOIN cs ON l.client_id = cs.client_id JOIN ms ON l.merchant_id = ms.merchant_id JOIN cat ON l.category = cat.category)"""


@query("ml_fraud_features", oracle=f"WITH {_FEAT_SQL}\nSELECT * FROM ff")
def ml_fraud_features(v):
    return fraud_features(v)


@query("ml_label_encode", oracle="""
SELECT transaction_id, category, CAST(dense_rank() OVER (ORDER BY category) - 1 AS INT) AS category_code FROM tx""")
def ml_label_encode(v):
    return fe.label_encode(v.tx.select("transaction_id", "category"), "category", "category_code")


@query("ml_standardise", oracle=f"""WITH {_FEAT_SQL},
st AS (SELECT {", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, stddev_pop(CAST({c} AS DOUBLE)) AS s_{c}" for c in FRAUD_NUMERIC)} FROM ff)
SELECT transaction_id, {", ".join(f"round((CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} = 0 THEN 1.0 ELSE s_{c} END, 6) AS {c}" for c in FRAUD_NUMERIC)}
FROM ff CROSS JOIN st""")
def ml_standardise(v):
    f = fraud_features(v).select("transaction_id", *FRAUD_NUMERIC)
    return fe.standardise(f, FRAUD_NUMERIC)


_ONEHOT_SQL_COLS = ", ".join(["CAST(coalesce(CAST(direction_id AS VARCHAR) = '1', false) AS INT) AS direction_id_1"] + [
    f"CAST(coalesce(CAST(weather_code AS VARCHAR) = '{lv}', false) AS INT) AS weather_code_{lv}" for lv in WEATHER_LEVELS[1:]])


@query("ml_one_hot", oracle=f"""
WITH d AS (SELECT r.id, r.direction_id, w.weather_code FROM transport_rt r LEFT JOIN weather_hourly w
           ON r.timestamp_rounded = w.timestamp_rounded WHERE r.departure_delay IS NOT NULL)
SELECT id, {_ONEHOT_SQL_COLS} FROM d""")
def ml_one_hot(v):
    d = delays(v).select("id", "direction_id", "weather_code")
    d = fe.one_hot_drop_first(d, "direction_id")
    return fe.one_hot_drop_first(d, "weather_code")


MODEL_COLUMNS = (["stop_sequence", "hour_sin", "hour_cos", "temperature_2m", "vacances_scolaires", "direction_id_1"]
                 + [f"weather_code_{lv}" for lv in WEATHER_LEVELS[1:]])


@query("ml_align_features", oracle=f"""
WITH r AS (SELECT p.id, p.stop_sequence, p.hour, p.direction_id, w.temperature_2m, w.weather_code
           FROM prediction_logs p LEFT JOIN weather_hourly w ON date_trunc('hour', p.timestamp) = w.timestamp_rounded)
SELECT id, CAST(stop_sequence AS DOUBLE) AS stop_sequence, round(sin(2 * pi() * hour / 24), 6) AS hour_sin,
       round(cos(2 * pi() * hour / 24), 6) AS hour_cos, coalesce(temperature_2m, 0.0) AS temperature_2m, 0 AS vacances_scolaires,
       CAST(CAST(direction_id = 1 AS INT) AS DOUBLE) AS direction_id_1,
       {", ".join(f"CAST(coalesce(CAST(weather_code AS VARCHAR) = '{lv}', false) AS INT) AS weather_code_{lv}" for lv in WEATHER_LEVELS[1:])}
FROM r""")
def ml_align_features(v):
    w = v.weather_hourly.select("timestamp_rounded", "temperature_2m", "weather_code")
    p = v.prediction_logs.withColumn("timestamp_rounded", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    r = p.join(w, "timestamp_rounded", "left")
    s, c = cal.cyclic(F.col("hour"), 24)
    r = r.withColumns({"hour_sin": F.round(s, 6), "hour_cos": F.round(c, 6),
                       "direction_id_1": (F.col("direction_id") == 1).cast("int")})
    return fe.align_features(r, MODEL_COLUMNS, level_col="weather_code", level_prefix="weather_code", keep=["id"])


@query("ml_split_chrono", oracle="""
WITH d AS (SELECT id, timestamp_rounded FROM transport_rt WHERE departure_delay IS NOT NULL),
r AS (SELECT id, row_number() OVER (ORDER BY timestamp_rounded, id) AS pos, count(*) OVER () AS n FROM d)
SELECT id, CASE WHEN pos > n - ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM r""")
def ml_split_chrono(v):
    d = delays(v).select("id", "timestamp_rounded")
    return fe.chrono_split(d, ["timestamp_rounded", "id"]).select("id", "split")


_STRAT_SQL = """s AS (
  SELECT transaction_id, CAST(is_fraud AS INT) AS label,
         row_number() OVER (PARTITION BY is_fraud ORDER BY md5(CAST(transaction_id AS VARCHAR) || '42'), transaction_id) AS r,
         count(*) OVER (PARTITION BY is_fraud) AS n FROM tx WHERE is_fraud IS NOT NULL),
sp AS (SELECT transaction_id, label, CASE WHEN r <= n - ceil(n * 0.2) THEN 'train'
                                    WHEN r <= n - ceil(ceil(n * 0.2) / 2) THEN 'val' ELSE 'test' END AS split FROM s)"""


def _stratified(v):
    lab = v.tx.where(F.col("is_fraud").isNotNull()).select("transaction_id", F.col("is_fraud").cast("int").alias("label"))
    return fe.stratified_split(lab, "label", "transaction_id")


@query("ml_split_stratified", oracle=f"WITH {_STRAT_SQL}\nSELECT transaction_id, label, split FROM sp")
def ml_split_stratified(v):
    return _stratified(v).select("transaction_id", "label", "split")


@query("ml_class_weight", oracle=f"""WITH {_STRAT_SQL}
SELECT count(*) FILTER (WHERE label = 0) AS n_neg, count(*) FILTER (WHERE label = 1) AS n_pos,
       round(count(*) FILTER (WHERE label = 0) / count(*) FILTER (WHERE label = 1), 6) AS scale_pos_weight
FROM sp WHERE split = 'train'""")
def ml_class_weight(v):
    return fe.class_weight(_stratified(v).where(F.col("split") == "train"), "label")


@query("ml_quantile_baseline", oracle="""
WITH d AS (SELECT hour, stop_sequence, direction_id, departure_delay AS y FROM transport_rt WHERE departure_delay IS NOT NULL),
seg AS (SELECT hour, stop_sequence, direction_id, count(*) AS n, quantile_cont(y, 0.5) AS p50, quantile_cont(y, 0.8) AS p80,
               quantile_cont(y, 0.9) AS p90 FROM d GROUP BY 1, 2, 3),
par AS (SELECT hour, quantile_cont(y, 0.5) AS p50, quantile_cont(y, 0.8) AS p80, quantile_cont(y, 0.9) AS p90 FROM d GROUP BY 1)
SELECT s.hour, s.stop_sequence, s.direction_id, s.n,
       round(CASE WHEN s.n >= 5 THEN s.p50 ELSE p.p50 END, 6) AS p50, round(CASE WHEN s.n >= 5 THEN s.p80 ELSE p.p80 END, 6) AS p80,
       round(CASE WHEN s.n >= 5 THEN s.p90 ELSE p.p90 END, 6) AS p90, CASE WHEN s.n >= 5 THEN 'segment' ELSE 'hour' END AS level
FROM seg s JOIN par p ON s.hour = p.hour""")
def ml_quantile_baseline(v):
    from kestrel.modeling.models import quantile_baseline
    d = delays(v).select("hour", "stop_sequence", "direction_id", F.col("departure_delay").alias("y"))
    return quantile_baseline(d, "y", ["hour", "stop_sequence", "direction_id"], ["hour"], min_rows=5)


@query("ml_versioned_predictions", oracle=f"""
SELECT transaction_id, prediction_score, '{MODEL_VERSION}' AS model_version, prediction_score >= {ALERT_THRESHOLD} AS is_alert FROM preds""")
def ml_versioned_predictions(v):
    return v.preds.select("transaction_id", "prediction_score", F.lit(MODEL_VERSION).alias("model_version"),
                          (F.col("prediction_score") >= ALERT_THRESHOLD).alias("is_alert"))


@query("ml_shadow_compare", oracle="""
WITH s AS (SELECT transaction_id, prediction_score AS old_s, ((transaction_id * 6007) % 10007) / CAST(10007 AS DOUBLE) AS new_s FROM preds)
SELECT count(*) AS n, round(avg(CAST((old_s >= 0.9) = (new_s >= 0.9) AS INT)), 6) AS agreement,
       round(avg(abs(old_s - new_s)), 6) AS mean_abs_gap,
       count(*) FILTER (WHERE old_s >= 0.9 AND new_s >= 0.9) AS n_both,
       count(*) FILTER (WHERE old_s >= 0.9 AND new_s < 0.9) AS n_only_old,
       count(*) FILTER (WHERE old_s < 0.9 AND new_s >= 0.9) AS n_only_new FROM s""")
def ml_shadow_compare(v):
    from kestrel.modeling.models import shadow_compare
    shadow = v.preds.select("transaction_id", (((F.col("transaction_id") * 6007) % 10007) / F.lit(10007.0))
                            .alias("prediction_score"))
    return shadow_compare(v.preds.select("transaction_id", "prediction_score"), shadow, "transaction_id",
                          "prediction_score", ALERT_THRESHOLD)


# -- model jobs (rows-only checks: fitted models have no SQL oracle) ----------
QUANTILES = {"P50": 0.5, "P80": 0.8, "P90": 0.9}
BOOST_ROUNDS = 300
BOOST_DEPTH = 5
BOOST_RATE = 0.05
FOREST_TREES = 100
BOOSTED_TREES = 20


def delay_training_frame(v):
    """Delay rows with model features, label and chronological split."""
    from kestrel.modeling.models import assemble
    d = delays(v).withColumns({"month": F.month("timestamp_rounded"), "day": F.dayofmonth("timestamp_rounded"),
                               "label": rel_clip(F.col("departure_delay"))})
    d = delay_terms(d).select("id", "timestamp_rounded", "label", *DELAY_FEATURES).na.fill(0.0, DELAY_FEATURES)  # NaN -> 0
    d = fe.chrono_split(d, ["timestamp_rounded", "id"])
    return assemble(d, DELAY_FEATURES)


def rel_clip(c):
    from kestrel.operators.relational import clip_lower
    return clip_lower(c, 0.0)


def fit_delay_quantiles(v, rounds=BOOST_ROUNDS):
    """(frame, models): the three quantile models of the training split."""
    from kestrel.modeling import quantile_boost as qb
    d = delay_training_frame(v)
    return d, qb.fit(d.where(F.col("split") == "train"), QUANTILES, rounds=rounds, depth=BOOST_DEPTH,
                     learning_rate=BOOST_RATE)


_BUNDLES: dict[tuple, str] = {}


def delay_models(v):
    """The trained bundle, read from where the session's first use saved it:
    scoring and reports don't train again."""
    from kestrel.modeling import quantile_boost as qb
    from kestrel.session import shared_path
    key = (v.spark.sparkContext.applicationId, v.sf_dir)
    if key not in _BUNDLES:
        _, models = fit_delay_quantiles(v)
        path = shared_path(v.spark, "quantile-bundle")
        qb.save_bundle(v.spark, models, path)
        _BUNDLES[key] = path
    return qb.load_bundle(v.spark, _BUNDLES[key])


@query("ml_quantile_boost")
def ml_quantile_boost(v):
    """P50 / P80 / P90 pinball-loss boosted trees (300 rounds of depth 5 at
    rate 0.05); test-split predictions."""
    test = delay_training_frame(v).where(F.col("split") == "test")
    for name, mdl in delay_models(v).items():
        test = mdl.transform(test, out=f"prediction_{name}")
    return test.select("id", F.col("label").alias("actual_delay"),
                       *[F.round(f"prediction_{n}", 6).alias(f"prediction_{n}") for n in QUANTILES])


def _fraud_training(v):
    from kestrel.modeling.models import assemble, stored
    f = fraud_features(v)
    split = _stratified(v).select("transaction_id", "split")
    f = stored(f.join(split, "transaction_id"), "fraud-training")
    w = fe.class_weight(f.where(F.col("split") == "train"), "label").select("scale_pos_weight")
    f = f.crossJoin(F.broadcast(w))  # one row
    f = fe.with_weight(f, "label", F.col("scale_pos_weight"))
    cols = ["amount", "category", "hour", "day_of_week", "client_tx_count", "client_avg_amount",
            "client_amount_ratio", "merchant_tx_count"]
    return assemble(f, cols), cols


@query("ml_soft_vote")
def ml_soft_vote(v):
    """Boosted trees + random forest, class-weighted, mean probability on
    the test split."""
    from kestrel.modeling.models import fit_soft_vote, soft_vote_score
    f, _ = _fraud_training(v)
    models = fit_soft_vote(f.where(F.col("split") == "train"), n_trees=BOOSTED_TREES, forest=FOREST_TREES)
    s = soft_vote_score(models, f.where(F.col("split") == "test"))
    return s.select("transaction_id", "label", F.round("p_gbt", 6).alias("p_gbt"), F.round("p_rf", 6).alias("p_rf"),
                    F.round("score", 6).alias("score"))


def _stored_delays(v):
    """The training frame, written once: each of the compared models reads it several times."""
    from kestrel.modeling.models import stored
    return stored(delay_training_frame(v), "delay-training")


def _delay_classification(v):
    d = _stored_delays(v)
    d = d.withColumn("is_delayed", (F.col("label") > 0.1).cast("int"))
    # classes weigh the same: rows / (2 * rows of the class)
    n = d.where(F.col("split") == "train").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("is_delayed") == 1).alias("p"))
    own = F.when(F.col("is_delayed") == 1, F.col("p")).otherwise(F.col("n") - F.col("p"))
    return d.crossJoin(F.broadcast(n)).withColumn(  # one row
        "weight", F.coalesce(F.try_divide(F.col("n"), 2 * own), F.lit(1.0))).drop("n", "p")


@query("ml_clf_compare")
def ml_clf_compare(v):
    """Logistic regression, random forest and boosted trees on 'is delayed';
    best-F1 threshold of each on the test split."""
    from kestrel.modeling import evaluate as ev
    from kestrel.modeling.models import classifiers, positive_probability
    d = _delay_classification(v)
    train, test = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    out = None
    for name, est in classifiers("is_delayed", n_trees=BOOSTED_TREES, forest=FOREST_TREES, weight="weight").items():
        s = est.fit(train).transform(test).withColumn("s", positive_probability())
        r = ev.f1_sweep(s, "is_delayed", "s").select(F.lit(name).alias("model"), "best_threshold", "best_f1")
        out = r if out is None else out.unionByName(r)
    return out


@query("ml_reg_compare")
def ml_reg_compare(v):
    """Ridge, random forest and boosted-tree regressors: MAE / RMSE / R² on
    the chronological test split."""
    from kestrel.modeling import evaluate as ev
    from kestrel.modeling.models import regressors
    d = _stored_delays(v)
    train, test = d.where(F.col("split") == "train"), d.where(F.col("split") == "test")
    out = None
    for name, est in regressors("label", n_trees=BOOSTED_TREES, forest=FOREST_TREES).items():
        p = est.fit(train).transform(test)
        r = ev.regression_metrics(p, "label", "prediction").select(F.lit(name).alias("model"), "n", "mae", "rmse", "r2")
        out = r if out is None else out.unionByName(r)
    return out


@query("ml_feature_importance")
def ml_feature_importance(v):
    """The ten features that the P90 model's splits gain most by."""
    rows = delay_models(v)["P90"].importances(DELAY_FEATURES)[:10]
    return v.spark.createDataFrame([(n, round(x, 6), i + 1) for i, (n, x) in enumerate(rows)],
                                   "feature string, importance double, rank int")


@query("win_rank_top_features", oracle="""
WITH d AS (SELECT r.departure_delay, r.stop_sequence, r.hour, r.direction_id, w.temperature_2m, w.precipitation,
                  w.snowfall, w.wind_speed_10m
           FROM transport_rt r LEFT JOIN weather_hourly w ON r.timestamp_rounded = w.timestamp_rounded WHERE r.departure_delay IS NOT NULL),
c AS (""" + "\nUNION ALL ".join(
    f"SELECT '{f}' AS feature, corr({f}, departure_delay) AS c FROM d"
    for f in ["stop_sequence", "hour", "direction_id", "temperature_2m", "precipitation", "snowfall", "wind_speed_10m"]) + """)
SELECT feature, round(abs(c), 6) AS importance, CAST(row_number() OVER (ORDER BY abs(c) DESC, feature) AS INT) AS rank
FROM c QUALIFY rank <= 5""")
def win_rank_top_features(v):
    """Top features by absolute importance (here |Pearson r| with the
    delay), ranked with ``row_number`` over the small per-feature table."""
    from pyspark.sql import Window
    feats = ["stop_sequence", "hour", "direction_id", "temperature_2m", "precipitation", "snowfall", "wind_speed_10m"]
    d = delays(v)
    wide = d.agg(*[F.corr(F.col(f).cast("double"), "departure_delay").alias(f) for f in feats])
    long = wide.selectExpr("stack({}, {}) AS (feature, c)".format(len(feats), ", ".join(f"'{f}', `{f}`" for f in feats)))
    w = Window.orderBy(F.abs("c").desc(), "feature")  # one row per feature
    return long.select("feature", F.round(F.abs("c"), 6).alias("importance"),
                       F.row_number().over(w).cast("int").alias("rank")).where(F.col("rank") <= 5)


@query("ml_save_load")
def ml_save_load(v):
    """Fit a feature+classifier pipeline, save it with its side tables
    (threshold, client statistics), load everything back and score."""
    from kestrel.modeling.models import fit_pipeline
    from kestrel.session import shared_path
    f, cols = _fraud_training(v)
    base = f.drop("features")
    model = fit_pipeline(base.where(F.col("split") == "train"), cols, "label", n_trees=BOOSTED_TREES)
    path = shared_path(v.spark, "fraud-model")
    model.write().overwrite().save(f"{path}/pipeline")
    lab = v.tx.where(F.col("is_fraud").isNotNull())
    pay.client_stats(lab).write.mode("overwrite").parquet(f"{path}/client_stats")
    v.spark.createDataFrame([(0.5, MODEL_VERSION)], "threshold double, model_version string") \
        .write.mode("overwrite").parquet(f"{path}/meta")
    from pyspark.ml import PipelineModel
    loaded = PipelineModel.load(f"{path}/pipeline")
    meta = v.spark.read.parquet(f"{path}/meta")
    scored = loaded.transform(base.where(F.col("split") == "test")).crossJoin(F.broadcast(meta))
    from kestrel.modeling.models import positive_probability
    return scored.select("transaction_id", F.round(positive_probability(), 6).alias("score"),
                         (positive_probability() >= F.col("threshold")).alias("is_alerted"), "model_version")


@query("ml_batch_score")
def ml_batch_score(v):
    """Prediction requests (the logged requests) enriched with calendar and
    weather features in the year of their log entry, scored by the three
    quantile models of the saved bundle, appended to a prediction log and read back."""
    from kestrel.modeling import scoring
    from kestrel.session import shared_path
    models = delay_models(v)
    req = v.prediction_logs.select("id", "bus_nbr", "direction_id", "stop_sequence", "month", "day", "hour",
                                   "day_of_week", F.year("timestamp").alias("log_year"))
    good, bad = scoring.prepare_requests(req, F.col("log_year"))
    scored = scoring.score(scoring.enrich(good, v.weather_hourly), models, DELAY_FEATURES)
    log = scored.select("id", "bus_nbr", "direction_id", "stop_sequence", "hour", "day_of_week", "est_weekend",
                        "vacances_scolaires", "weather_status",
                        *[F.round(f"prediction_{n}", 6).alias(f"prediction_{n}") for n in QUANTILES])
    out = shared_path(v.spark, "prediction-log")
    log.write.mode("append").parquet(out)
    return v.spark.read.parquet(out)
