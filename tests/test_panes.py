"""Rolling aggregates over panes: equal to the plain window, and a hot entity
is spread over tasks."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import windows as win

AGGS = {"n": ("count", None), "n_v": ("count", "v"), "s": ("sum", "v"), "a": ("avg", "v"), "hi": ("max", "v"),
        "lo": ("min", "v")}


@pytest.fixture(scope="module")
def events(spark):
    """User 1 has a third of all rows; ties, days without rows, null values, a
    null user, times before 1970, and clashing columns."""
    r = random.Random(6)
    rows = [(i, r.choice([1, 2, 3, None, 4, 5]) if i % 3 else 1, r.randrange(-3 * 86400, 60 * 86400) // 50 * 50,
             r.choice([None, 1.0, 2.5, -4.0])) for i in range(4000)]
    rows += [(10_000 + i, 9, 40 * 86400 * i, 1.0) for i in range(4)]
    return spark.createDataFrame(rows, "id long, u long, t long, v double").select(
        "id", "u", F.timestamp_seconds("t").alias("ts"), "v", F.lit("c").alias("_n_count2")).repartition(6)


@pytest.mark.parametrize("days, pane", [(7, 86400), (30, 86400), (1, 86400), (2, 43200)])
def test_panes_equal_the_plain_window(events, days, pane):
    w = Window.partitionBy("u").orderBy(F.col("ts").cast("long")).rangeBetween(-days * 86400, 0)
    c = {"count": F.count, "sum": F.sum, "avg": F.avg, "max": F.max, "min": F.min}
    want = events.select("id", *[c[f](F.col(x) if x else F.lit(1)).over(w).alias(n) for n, (f, x) in AGGS.items()])
    got = win.pane_time_agg(events, "u", "ts", days * 86400, AGGS, pane)
    assert got.columns == events.columns + list(AGGS)
    got, want = ({r["id"]: r for r in d.select("id", *AGGS).collect()} for d in (got, want))
    assert set(got) == set(want) and len(got) == 4004
    for i, r in got.items():
        for n in AGGS:
            assert r[n] == (pytest.approx(want[i][n], abs=1e-9) if want[i][n] is not None else None), (i, n)


def test_a_hot_entity_is_spread(events):
    """What a task must hold together is two panes, not the whole window."""
    hot = events.where("u = 1").count()
    groups = win.pane_rows(events, "u", "ts", 30 * 86400, 86400).groupBy("u", "_pane").count()
    assert hot > events.count() / 3 and groups.agg(F.max("count")).first()[0] < hot / 10
    plan = win.pane_time_agg(events, "u", "ts", 30 * 86400, AGGS)._jdf.queryExecution().executedPlan().toString()
    by_row = [line for line in plan.splitlines() if "Window [" in line and "_pane" not in line.split("],")[1]]
    assert len(by_row) <= 1     # the one over pane totals


def test_windows_must_be_whole_panes(events):
    with pytest.raises(ValueError):
        win.pane_time_agg(events, "u", "ts", 1000, AGGS, 86400)
