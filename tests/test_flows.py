"""The three end-to-end flows run on the small tables and keep their
invariants."""

from pyspark.sql import functions as F

from kestrel import flows
from kestrel.session import shared_path
from kestrel.sources import feed


def test_transit_days_to_staging(spark, views):
    from kestrel.plans.transit import gtfs_routes, gtfs_trips
    src = shared_path(spark, "flow-entities")
    feed.entities_from_events(views.t.events).write.text(src)
    out = shared_path(spark, "flow-staging")
    r = flows.transit_days_to_staging(spark, src, gtfs_trips(views).withColumn("trip_id", F.col("trip_id").cast("string")),
                                      gtfs_routes(views), "2023-12-30", "2024-01-10", out)
    # entity trip ids are "<user>-<day>", static trips are users: nothing selected by id
    assert r.staged.count() >= 0
    assert {str(x.day) for x in r.bad_days.collect()} >= {"2023-12-30", "2023-12-31"}


def test_transit_days_to_staging_caps_slots(spark, views):
    src = shared_path(spark, "flow-entities")
    ents = feed.entities_from_events(views.t.events)
    ents.write.text(src)
    trips = (spark.read.text(src).select(feed.parse_entities(F.col("value")).alias("e"))
             .select(F.col("e.trip_update.trip.trip_id").alias("trip_id"), F.col("e.trip_update.trip.route_id").alias("route_id")))
    routes = trips.select("route_id").distinct().withColumn("route_short_name", F.lit("541"))
    out = shared_path(spark, "flow-staging")
    r = flows.transit_days_to_staging(spark, src, trips, routes, "2024-01-01", "2024-01-31", out)
    per_slot = r.staged.groupBy("direction_id", "stop_sequence").count()
    assert per_slot.agg(F.max("count")).first()[0] <= 2
    assert r.staged.where(F.minute("timestamp_rounded") != 0).count() == 0


def test_delay_monitoring(spark, views):
    as_of = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    new_rows, verdict = flows.delay_monitoring(views.prediction_logs, views.transport_rt, views.ground_truth, as_of)
    synced = views.ground_truth.select("prediction_log_id")
    assert new_rows.join(synced, "prediction_log_id").count() == 0
    v = verdict.first()
    assert v.drift_ratio is None or v.alert == (v.drift_ratio > 1.3)


def test_fraud_train_score_report(spark, views):
    hist = views.tx.where(F.col("is_fraud").isNotNull())
    new = views.tx.where(F.col("is_fraud").isNull())
    day = F.to_date(F.lit("1998-01-15"))
    r = flows.fraud_train_score_report(spark, hist, new, shared_path(spark, "flow-reports"), day, n_trees=5)
    assert 0.0 <= r.average_precision <= 1.0
    assert r.scores.count() == new.count()
