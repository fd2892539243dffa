"""Order statistics by narrowing, against sorting."""

import inspect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import aggregates, selection

PROBS = (0.0, 0.1, 0.25, 0.5, 0.8, 0.999, 1.0)
NAMES = [f"q{i}" for i in range(len(PROBS))]


def groups():
    r = random.Random(3)
    return {
        "one": [4.5],
        "ties": [1.0] * 500 + [2.0] * 3,
        "plain": [r.gauss(0, 1) for _ in range(1500)],
        "scales": [r.choice([-1, 1]) * 10.0 ** r.randrange(-300, 300) for _ in range(700)],
        "hot": [float(r.randrange(10_000)) for _ in range(6000)],
        "far": [1.7e308, -1.7e308, 0.0, 5e-324] * 20,
        None: [r.random() for _ in range(99)],
    }


@pytest.mark.parametrize("cells, keep", [(1024, 4096), (16, 3), (64, 100)])
def test_quantiles_equal_sorting(spark, cells, keep):
    data = groups()
    if cells < 64:      # many passes: a few small groups do
        data = {k: v[:60] for k, v in data.items() if k in ("ties", "plain", None)}
    rows = [(k, v) for k, vs in data.items() for v in vs]
    rows += [("plain", None), ("plain", float("nan")), ("hollow", None), ("plain", float("inf"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r.g: r for r in selection.quantiles(df, "v", PROBS, NAMES, ["g"], cells, keep).collect()}
    assert set(got) == set(data)
    for k, vs in data.items():
        s = np.sort(np.array(vs))
        assert got[k].n == len(vs)
        for p, nm in zip(PROBS, NAMES):
            at = (len(s) - 1) * p
            lo, hi = s[int(np.floor(at))], s[int(np.ceil(at))]
            with np.errstate(over="ignore", invalid="ignore"):
                want = lo + (hi - lo) * (at - np.floor(at)) if hi != lo else lo
            assert got[k][nm] == pytest.approx(want, rel=1e-12) or not np.isfinite(want), (k, p)


def test_without_group_and_empty(spark):
    df = spark.range(10_001).select((F.col("id") * 7 % 10_001).alias("v"))
    r = selection.quantiles(df, "v", (0.5, 0.9), ("a", "b"), keep=10, cells=16).first()
    assert tuple(r) == (10_001, 5000.0, 9000.0)
    assert tuple(selection.quantiles(df.limit(0), "v", (0.5,), ("a",)).first()) == (0, None)
    d = aggregates.describe(df, "v").first()
    assert (d["count"], d["min"], d.p25, d.p50, d.p75, d["max"]) == (10_001, 0.0, 2500.0, 5000.0, 7500.0, 10_000.0)


def test_many_groups_are_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(selection, "FEW", 5)
    df = spark.range(4000).select((F.col("id") % 50).alias("g"), F.col("id").alias("v"))
    got = selection.quantiles(df, "v", (0.5,), ("m",), ["g"], 8, 20).collect()
    assert {r.g: r.m for r in got} == {g: g + 50 * 39.5 for g in range(50)}


def test_mode_takes_the_smallest_of_the_most_frequent(spark):
    df = spark.createDataFrame([(3,), (3,), (1,), (1,), (2,), (None,), (None,), (None,)], "v int")
    assert selection.mode(df, "v").first().mode == 1.0


def test_rows_are_never_sorted_nor_kept_in_value_maps(spark):
    from kestrel.modeling import models
    from kestrel.plans import monitoring, transit
    for module in (aggregates, models, transit, monitoring):
        code = "\n".join(line for line in inspect.getsource(module).splitlines() if "F." in line)
        assert not any(f"F.{f}(" in code for f in ("percentile", "median", "mode")), module.__name__
