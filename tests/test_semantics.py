"""Unit tests on tiny hand-written frames for the semantic traps of the
source system and the custom operators (as-of, SCD2, rolling windows,
distributed prefix sums, quantiles, curves)."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from kestrel.functions import calendar as cal
from kestrel.functions import weather as wx
from kestrel.modeling import evaluate as ev
from kestrel.modeling import features as fe
from kestrel.operators import aggregates as agg
from kestrel.operators import joins as jn
from kestrel.operators import ordering as od
from kestrel.operators import payments as pay
from kestrel.operators import relational as rel
from kestrel.operators import windows as win


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_round_hour_half_up(spark):  # T24
    df = spark.createDataFrame([(ts("2024-01-01 10:29:59"),), (ts("2024-01-01 10:30:00"),),
                                (ts("2024-01-01 23:45:00"),)], "t timestamp_ntz")
    got = [r[0] for r in df.select(cal.round_hour(F.col("t"))).collect()]
    assert got == [ts("2024-01-01 10:00:00"), ts("2024-01-01 11:00:00"), ts("2024-01-02 00:00:00")]


def test_weekday_conventions(spark):  # T6
    df = spark.createDataFrame([(ts("2024-01-07 12:00:00"),)], "t timestamp_ntz")  # a Sunday
    r = df.select(cal.weekday0(F.col("t")).alias("w"),
                  cal.pg_dow_to_monday0(F.dayofweek("t") - 1).alias("c")).first()
    assert r.w == 6 and r.c == 6


def test_right_closed_bins(spark):  # T18
    df = spark.createDataFrame([(0.0,), (0.5,), (60.0,), (-500.0,), (3001.0,)], "d double")
    bins = [r[0] for r in df.select(agg.right_closed_bins(F.col("d"), [-500, 0, 60, 3000], ["a", "b", "c"])).collect()]
    assert bins == ["a", "b", "b", None, None]


def test_one_hot_drops_first_in_string_order(spark):  # T11
    df = spark.createDataFrame([(1, "10"), (2, "9"), (3, None)], "id int, c string")
    out = fe.one_hot_drop_first(df, "c")
    assert out.columns == ["id", "c_9"]  # "10" < "9" as text: "10" is dropped
    assert [r.c_9 for r in out.orderBy("id").collect()] == [0, 1, 0]


def test_label_encode_alphabetical_and_unseen_fails(spark):  # T12
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "x string")
    out = fe.label_encode(df, "x", "code")
    assert sorted({(r.x, r.code) for r in out.collect()}) == [("a", 0), ("b", 1), ("c", 2)]


def test_mode_smallest_on_ties(spark):  # T23
    df = spark.createDataFrame([(3.0,), (1.0,), (3.0,), (1.0,), (2.0,)], "v double")
    assert agg.median_mode(df, "v").first()["mode"] == 1.0


def test_population_std_scaler(spark):  # T10
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    got = sorted(r.x for r in fe.standardise(df, ["x"]).collect())
    assert got == [-1.0, 1.0]


def test_flag_true_drops_null(spark):  # T17
    df = spark.createDataFrame([(True,), (None,), (False,)], "a boolean")
    assert rel.filter_flag_true(df, "a").count() == 1


def test_clip_lower_keeps_null(spark):
    df = spark.createDataFrame([(-5.0,), (None,), (7.0,)], "d double")
    assert [r[0] for r in df.select(rel.clip_lower(F.col("d"), 0.0)).collect()] == [0.0, None, 7.0]


def test_cap_per_group_deterministic(spark):  # T1, T2
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("k"))
    a = {r.id for r in win.cap_per_group(df, ["k"], 2, "id").collect()}
    b = {r.id for r in win.cap_per_group(df, ["k"], 2, "id").collect()}
    assert a == b and len(a) == 6


def test_public_holidays_known_dates(spark):
    hol = {r[0] for r in cal.public_holidays(spark, 2024, 2024, include_sundays=False).collect()}
    for d in ["2024-01-01", "2024-01-06", "2024-03-29", "2024-03-31", "2024-04-01", "2024-05-01", "2024-05-09",
              "2024-05-19", "2024-06-06", "2024-06-21", "2024-06-22", "2024-11-02", "2024-12-24", "2024-12-25",
              "2024-12-26", "2024-12-31"]:
        assert dt.date.fromisoformat(d) in hol, d
    assert len(hol) == 16
    with_sundays = cal.public_holidays(spark, 2024, 2024).count()
    assert with_sundays > 60


def test_easter_computus(spark):
    years = {2000: "2000-04-23", 2019: "2019-04-21", 2024: "2024-03-31", 2025: "2025-04-20", 2038: "2038-04-25"}
    df = spark.createDataFrame([(y,) for y in years], "y int")
    got = {r.y: str(r.e) for r in df.select("y", cal.easter_sunday(F.col("y")).alias("e")).collect()}
    assert got == years


def test_school_holiday_rule(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 28),), (dt.date(2024, 12, 22),), (dt.date(2024, 3, 20),)], "d date")
    assert [r[0] for r in df.select(cal.school_holiday(F.col("d"))).collect()] == [1, 1, 0]


def test_weather_recode_and_risks(spark):
    df = spark.createDataFrame([(61, -1.0), (73, 2.0), (45, 0.0), (0, 5.0)], "c int, t double")
    rows = df.select(wx.recode(F.col("c")).alias("r"),
                     *[v.alias(k) for k, v in wx.weather_risks(F.col("t"), F.col("c")).items()]).collect()
    assert [r.r for r in rows] == ["Pluie", "Neige", "45", "Ciel clair"]
    assert (rows[0].risque_gel_pluie, rows[1].neige_fondue, rows[2].risque_gel_neige) == (1, 1, 0)


def test_daylight_null_sun_is_zero(spark):
    df = spark.createDataFrame([(ts("2024-01-01 12:00:00"), None, None)], "t timestamp_ntz, a timestamp_ntz, b timestamp_ntz")
    assert df.select(wx.daylight(F.col("t"), F.col("a"), F.col("b"))).first()[0] == 0


def test_running_sums_match_naive(spark):
    random.seed(7)
    rows = [(i, random.randint(0, 50), random.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g long, x double")
    out = od.running_sums(df, [F.col("g"), F.col("id")], {"cx": F.col("x"), "n": F.lit(1)}, n_ranges=7)
    got = {r.id: (r.n, r.cx) for r in out.collect()}
    acc, n = 0.0, 0
    for i, g, x in sorted(rows, key=lambda t: (t[1], t[0])):
        acc += x
        n += 1
        assert got[i][0] == n and math.isclose(got[i][1], acc, rel_tol=1e-9)


def test_exact_quantiles_match_linear_interpolation(spark):
    vals = [5.0, 1.0, 9.0, 3.0, 3.0, 7.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = od.exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], ["a", "b", "c", "d", "e"]).first()
    s = sorted(vals)

    def q(p):
        pos = (len(s) - 1) * p
        lo, hi = math.floor(pos), math.ceil(pos)
        return s[lo] + (s[hi] - s[lo]) * (pos - lo)
    assert [r.a, r.b, r.c, r.d, r.e] == pytest.approx([q(p) for p in (0.0, 0.25, 0.5, 0.9, 1.0)])


def test_asof_join_equality_visible_and_no_blowup(spark):
    probe = spark.createDataFrame([(1, ts("2024-01-01 00:00:00")), (1, ts("2024-01-01 05:00:00")),
                                   (2, ts("2024-01-01 01:00:00"))], "k int, t timestamp_ntz")
    vers = spark.createDataFrame([(1, ts("2024-01-01 00:00:00"), "v0"), (1, ts("2024-01-01 04:00:00"), "v1"),
                                  (2, ts("2024-01-01 02:00:00"), "w0")], "k int, vt timestamp_ntz, val string")
    out = jn.asof_join(probe, vers, "k", "t", "vt", ["val"])
    got = sorted((r.k, str(r.t), r.val) for r in out.collect())
    assert got == [(1, "2024-01-01 00:00:00", "v0"), (1, "2024-01-01 05:00:00", "v1"), (2, "2024-01-01 01:00:00", None)]
    b = jn.asof_join_bucketed(probe, vers, "k", "t", "vt", ["val"], bucket_seconds=3600)
    assert sorted((r.k, str(r.t), r.val) for r in b.collect()) == got


def test_scd2_join_respects_gaps(spark):
    facts = spark.createDataFrame([(1, ts("2024-01-05 00:00:00")), (1, ts("2024-02-05 00:00:00"))], "k int, t timestamp_ntz")
    vers = spark.createDataFrame([(1, "a", ts("2024-01-01 00:00:00"), ts("2024-02-01 00:00:00"))],
                                 "k int, name string, f timestamp_ntz, e timestamp_ntz")
    out = sorted((str(r.t), r.name) for r in jn.scd2_join(facts, vers, "k", "t", "f", "e", ["name"]).collect())
    assert out == [("2024-01-05 00:00:00", "a"), ("2024-02-05 00:00:00", None)]


def test_scd2_versions_collapse_repeats(spark):
    ch = spark.createDataFrame([(1, "a", ts("2024-01-01 00:00:00")), (1, "a", ts("2024-01-02 00:00:00")),
                                (1, "b", ts("2024-01-03 00:00:00"))], "k int, name string, at timestamp_ntz")
    v = win.scd2_versions(ch, "k", "at", ["name"]).orderBy("valid_from").collect()
    assert [(r.name, r.is_current) for r in v] == [("a", False), ("b", True)]
    assert str(v[0].valid_to) == "2024-01-03 00:00:00"


def test_rolling_time_agg_equals_naive_window(spark):
    random.seed(3)
    base = dt.datetime(2024, 1, 1)
    rows = [(i, random.choice([1, 2, 2, 2]), base + dt.timedelta(seconds=random.randint(0, 4 * 3600)),
             float(random.randint(1, 9))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, u long, t timestamp_ntz, v double")
    out = win.rolling_time_agg(df, "u", "t", 3600, {"n": ("count", None), "s": ("sum", "v")})
    got = {r.id: (r.n, r.s) for r in out.collect()}
    for i, u, t, _ in rows:
        sec = int(t.timestamp())
        inside = [x for x in rows if x[1] == u and sec - 3600 <= int(x[2].timestamp()) <= sec]
        assert got[i] == (len(inside), sum(x[3] for x in inside))


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 3, "y"), (2, 2, "z")], "k int, o int, v string")
    assert sorted((r.k, r.v) for r in win.latest_per_key(df, ["k"], ["o"]).collect()) == [(1, "y"), (2, "z")]


def test_average_precision_step_sum(spark):  # T19
    y = [1, 0, 1, 1, 0, 0, 1, 0]
    s = [0.9, 0.8, 0.8, 0.6, 0.5, 0.4, 0.3, 0.1]
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    ap = ev.average_precision(df, "y", "s").first()[0]
    # manual: thresholds 0.9, 0.8 (tie), 0.6, 0.5, 0.4, 0.3, 0.1
    pts, tp, fp, prev_r, total = [], 0, 0, 0.0, sum(y)
    acc = 0.0
    for thr in sorted(set(s), reverse=True):
        tp += sum(1 for a, b in zip(y, s) if b == thr and a == 1)
        fp += sum(1 for a, b in zip(y, s) if b == thr and a == 0)
        r = tp / total
        acc += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    assert ap == pytest.approx(round(acc, 6))


def test_threshold_min_recall_falls_back_to_max_recall(spark):
    curve = spark.createDataFrame([(0.9, 0.9, 0.2), (0.5, 0.6, 0.5), (0.2, 0.5, 0.7)],
                                  "threshold double, precision double, recall double")
    assert ev.threshold_min_recall(curve, 0.75).first()[0] == 0.2
    assert ev.threshold_min_recall(curve, 0.5).first()[0] == 0.5


def test_f1_sweep_matches_bruteforce(spark):
    random.seed(5)
    rows = [(int(random.random() < 0.3), round(random.random(), 3)) for _ in range(400)]
    df = spark.createDataFrame(rows, "y int, s double")
    r = ev.f1_sweep(df, "y", "s").first()
    best = None
    for i in range(80):
        t = round(0.10 + i * 0.01, 2)
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        fn = sum(1 for y, s in rows if s < t and y == 1)
        f1 = 2 * tp / (2 * tp + fp + fn) if tp else 0.0
        if best is None or f1 > best[1] + 1e-15:
            best = (t, f1)
    assert r.best_threshold == pytest.approx(best[0]) and r.best_f1 == pytest.approx(round(best[1], 6))


def test_stats_default_is_median_of_stats_table(spark):
    known = spark.createDataFrame([(1, 10, 5.0), (2, 20, 1.0), (3, 30, 3.0)],
                                  "client_id long, client_tx_count long, client_avg_amount double")
    merch = spark.createDataFrame([(7, 4), (8, 6)], "merchant_id long, merchant_tx_count long")
    new = spark.createDataFrame([(99, 9, 6.0)], "client_id long, merchant_id long, amount double")
    r = pay.lookup_stats_with_default(new, known, merch).first()
    assert (r.client_tx_count, r.client_avg_amount, r.merchant_tx_count) == (20.0, 3.0, 5.0)


def test_chrono_split_sizes(spark):
    df = spark.range(10).withColumn("t", F.col("id"))
    out = {r.id: r.split for r in fe.chrono_split(df, ["t", "id"]).collect()}
    assert [out[i] for i in range(10)] == ["train"] * 8 + ["test"] * 2


def test_stratified_split_keeps_class_ratio(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    out = fe.stratified_split(df, "y", "id").groupBy("y", "split").count().collect()
    got = {(r.y, r.split): r["count"] for r in out}
    assert got[(1, "train")] == 80 and got[(1, "val")] == 10 and got[(1, "test")] == 10
    assert got[(0, "train")] == 720 and got[(0, "val")] == 90 and got[(0, "test")] == 90


def test_sql_functions_match_column_builders(spark):
    from kestrel.functions.sql import register_functions
    from kestrel.plans.transit import DELAY_EDGES, DELAY_LABELS
    register_functions(spark)
    df = spark.createDataFrame([(dt.date(2024, 2, 28), 61, -3.0, ts("2024-01-01 10:30:00"), 0.7),
                                (dt.date(2024, 3, 20), 2, 75.0, ts("2024-01-01 10:29:00"), 0.95)],
                               "d date, c int, s double, t timestamp_ntz, p double")
    df.createOrReplaceTempView("fn_probe")
    a = spark.sql("SELECT school_holiday(d) a, weather_recode(c) b, delay_bin(s) c, round_hour(t) e, "
                  "score_band(p) f, weather_severity(c) g FROM fn_probe").collect()
    b = df.select(cal.school_holiday(F.col("d")).alias("a"), wx.recode(F.col("c")).alias("b"),
                  agg.right_closed_bins(F.col("s"), DELAY_EDGES, DELAY_LABELS).alias("c"),
                  cal.round_hour(F.col("t")).alias("e"), pay.score_band(F.col("p")).alias("f"),
                  wx.severity(F.col("c")).alias("g")).collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]
