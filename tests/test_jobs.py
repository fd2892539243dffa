"""Invariants for rows-only operators: streams agree with their batch
twins, file round trips keep rows, models behave (coverage, monotonicity),
archive quarantine, idempotent sinks, request scoring behaviours."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL

Q = entry.queries()


def run(spark, key):
    return Q[key](spark, SF_SMALL)


def test_streams_close_their_last_windows(spark, views):
    """The other streams are held against DuckDB in test_oracle.py."""
    out = run(spark, "stream_sessions")
    assert out.agg(F.sum("n_events")).first()[0] == views.t.events.count()
    assert run(spark, "stream_late_split").where("is_late").count() > 0


def test_stream_score_conserves_records(spark, views):
    preds = run(spark, "stream_score")
    n_records = views.tx.where(F.col("is_fraud").isNull()).count()
    n_bad = views.tx.where(F.col("is_fraud").isNull() & (F.col("transaction_id") % 97 == 0)).count()
    assert preds.count() == n_records - n_bad
    assert preds.select("transaction_id").distinct().count() == preds.count()


def test_zip_reader_quarantines_bad_archive(spark):
    out = run(spark, "scan_zip_csv")
    assert out.where(F.col("error").isNotNull()).count() == 1
    assert out.where(F.col("error").isNull()).count() > 0


def test_archive_entries_keep_payloads_only(spark):
    out = run(spark, "scan_archive_entries").collect()
    good = [r for r in out if r.error is None]
    assert good and all(r.entry.endswith(".pb") for r in good)
    assert sum(1 for r in out if r.error) == 1


def test_replace_keyed_rejects_duplicate_keys(spark, tmp_path):
    from kestrel.sources.files import replace_keyed
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        replace_keyed(df, str(tmp_path / "t"), key="k")
    replace_keyed(df.select("v"), str(tmp_path / "u"))
    assert spark.read.parquet(str(tmp_path / "u")).select("observation_uuid").distinct().count() == 2


def test_insert_if_absent_is_idempotent(spark, tmp_path):
    from kestrel.sources.files import insert_if_absent
    path = str(tmp_path / "f")
    spark.createDataFrame([(1, 1.0)], "k int, v double").write.parquet(path)
    batch = spark.createDataFrame([(1, 9.0, 0), (2, 2.0, 0), (2, 7.0, 1)], "k int, v double, o int")
    for _ in range(2):
        insert_if_absent(spark, batch, path, ["k"], [F.col("o")], columns=["k", "v"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, 1.0), (2, 2.0)]


def test_quantile_boost_coverage_and_order(spark, views):
    from kestrel.plans import modeling as m
    from kestrel.modeling import evaluate as ev
    d, models = m.fit_delay_quantiles(views)
    train = d.where(F.col("split") == "train")
    for name, mdl in models.items():
        train = mdl.transform(train, out=f"p_{name}")
    r = train.agg(*[ev.coverage(F.col("label"), F.col(f"p_{n}")).alias(n) for n in m.QUANTILES],
                  *[F.avg(f"p_{n}").alias(f"m_{n}") for n in m.QUANTILES]).first()
    for n, a in m.QUANTILES.items():
        assert abs(r[n] - a) < 0.03, (n, r[n])
    assert r["m_P50"] <= r["m_P80"] <= r["m_P90"]


def test_request_scoring_behaviours(spark, views):
    from kestrel.modeling import scoring
    t = views.weather_hourly.orderBy("timestamp_rounded").first().timestamp_rounded  # an hour with weather
    req = spark.createDataFrame([(1, 0, t.month, t.day, t.hour, t.weekday()), (2, 1, 1, 20, 14, 5),
                                 (3, 0, None, None, None, None)],
                                "id int, direction_id int, month int, day int, hour int, day_of_week int")
    good, bad = scoring.prepare_requests(req, 2024)
    assert [r.id for r in bad.collect()] == [3]
    assert bad.first().missing_fields == ["month", "day", "hour", "day_of_week"]
    g = good.orderBy("id").collect()
    assert [(r.bus_nbr, r.stop_sequence) for r in g] == [("541", 1), ("541", 1)]
    e = scoring.enrich(good, views.weather_hourly).orderBy("id").collect()
    assert e[0].weather_status == "ok" and e[0].temperature_2m is not None
    assert e[1].est_weekend == 1


def test_request_for_a_date_that_does_not_exist_is_quarantined(spark, views):
    from kestrel.modeling import scoring
    req = spark.createDataFrame([(1, 0, 2, 30, 8, 3), (2, 1, 2, 28, 8, 3)],
                                "id int, direction_id int, month int, day int, hour int, day_of_week int")
    good, bad = scoring.prepare_requests(req, 2024)
    assert [r.id for r in good.collect()] == [2]
    assert [(r.id, r.missing_fields) for r in bad.collect()] == [(1, ["date"])]


def test_zip_columns_are_taken_by_header_name(spark, tmp_path):
    import zipfile
    from kestrel.sources.archives import read_zip_csv
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("trips.txt", 'route_id,service_id,trip_id,note\nR1,S9,77,"two\nlines"\n')
    rows, bad = read_zip_csv(spark, str(tmp_path), "trips.txt", "trip_id long, route_id string, direction_id string")
    assert [tuple(r) for r in rows.collect()] == [(77, "R1", None)] and bad.count() == 0


def test_report_of_a_date_is_replaced(spark, tmp_path):
    from kestrel.sources.files import write_report
    base = str(tmp_path / "r")
    for day, n in (("2024-01-01", 2), ("2024-01-02", 1), ("2024-01-01", 3)):
        write_report(spark.range(n).withColumnRenamed("id", "k"), base, day)
    got = spark.read.option("header", True).csv(base).groupBy("report_date").count().orderBy("report_date").collect()
    assert [r["count"] for r in got] == [3, 1]


def test_divisions_by_zero_are_null(spark):
    from kestrel.modeling import evaluate as ev
    from kestrel.modeling import features as fe
    from kestrel.operators.aggregates import equal_width_histogram
    flat = spark.createDataFrame([(5.0, 4.0, 0), (5.0, 6.0, 0)], "y double, p double, label int")
    assert ev.regression_metrics(flat, "y", "p").first().r2 is None
    assert fe.class_weight(flat, "label").first().scale_pos_weight is None
    assert [(r.bucket, r["count"]) for r in equal_width_histogram(flat, "y", 5).collect()] == [(1, 2)]


def test_round_trips_keep_rows(spark, views):
    assert run(spark, "sink_replace_keyed").count() == views.weather_hourly.count()
    assert run(spark, "sink_csv_report").count() > 0
    assert run(spark, "fn_uuid").where(~F.col("is_uuid")).count() == 0


def test_sampling(spark, views):
    s = run(spark, "sample_with_replacement")
    assert s.count() == 500
    assert 0 < run(spark, "sample_rows").count() < views.transport_rt.count()


def test_reference_api_requests(spark, views):
    """The scoring API's test requests: two complete ones (no weather for
    May/June in the January data -> status), one with only a direction."""
    from kestrel.modeling import scoring
    from kestrel.plans import modeling as m
    req = spark.createDataFrame([(1, 0, 5, 15, 8, 3), (2, 1, 6, 20, 14, 4), (3, 0, None, None, None, None)],
                                "id int, direction_id int, month int, day int, hour int, day_of_week int")
    good, bad = scoring.prepare_requests(req, 2024)
    assert [(r.id, r.missing_fields) for r in bad.collect()] == [(3, ["month", "day", "hour", "day_of_week"])]
    _, models = m.fit_delay_quantiles(views, rounds=1)
    out = scoring.score(scoring.enrich(good, views.weather_hourly), models, m.DELAY_FEATURES).orderBy("id").collect()
    assert [(r.bus_nbr, r.stop_sequence, r.weather_status) for r in out] == [("541", 1, "weather_unavailable")] * 2
    assert all(r.prediction_P50 <= r.prediction_P90 for r in out)


def test_velocity_state_equals_the_window(spark, tmp_path):
    """Users of a bucket don't mix, null users and ids are kept, and there is
    one state per bucket, not per user."""
    from pyspark.sql import Window
    from kestrel.streaming import jobs
    src, out, ck = (str(tmp_path / n) for n in ("src", "out", "ck"))
    e = spark.range(4000).select(
        F.when(F.col("id") % 50 != 7, F.col("id")).alias("event_id"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 7 + F.pmod(F.xxhash64("id"), F.lit(900))).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 11 == 0, F.lit(0)).when(F.col("id") % 13 != 0, F.pmod(F.hash("id"), F.lit(600))).cast("long").alias("user_id"),
        F.lit("purchase").alias("event_type"), F.lit(1.0).alias("value"), F.lit(None).cast("string").alias("props"))
    end = e.limit(1).withColumns({"ts": F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"), "user_id": F.lit(-1).cast("long")})
    for part in (e.where("id < 1500"), e.where("id >= 1500 AND id < 3000"), e.where("id >= 3000"), end, end):
        part.coalesce(1).write.mode("append").parquet(src)
    s = jobs.event_stream(spark, src, files_per_trigger=1)
    jobs.run_to_files(jobs.velocity_state(s), out, ck)
    t = F.unix_seconds(F.col("ts").cast("timestamp"))
    w = Window.partitionBy("user_id").orderBy(t).rangeBetween(-3600, 0)
    want = e.select("event_id", "user_id", t.alias("t"), F.count(F.lit(1)).over(w).alias("n"))
    got = spark.read.parquet(out).where("user_id IS NULL OR user_id <> -1").select(
        "event_id", "user_id", F.unix_seconds("ts").alias("t"), F.col("last_1h_count").alias("n"))
    assert got.count() == 4000 and not got.exceptAll(want).count() and not want.exceptAll(got).count()
    assert 0 < spark.read.format("statestore").load(ck).count() <= jobs.VELOCITY_BUCKETS
