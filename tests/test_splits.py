"""Splits by cut keys, against sorting."""

import datetime as dt
import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from kestrel.modeling import features as fe
from kestrel.operators import selection as sel


def test_cut_keys_equal_sorting(spark):
    r = random.Random(11)
    rows = [("hot", r.choice([1.0, 1.0, 2.0, None]), r.randrange(-40, 40), i) for i in range(900)]
    rows += [("few", 5.0, r.randrange(3), i) for i in range(20)] + [(None, 1.0, 1, 7)]
    df = spark.createDataFrame(rows, "g string, a double, b long, c long").repartition(5)
    wanted = [("hot", x) for x in (0, 1, 224, 225, 450, 899, 900)] + [("few", 0), ("few", 19), (None, 0), ("none", 0), ("few", -1)]
    ranks = spark.createDataFrame([(g, f"{x}", x) for g, x in wanted], "_group string, name string, rank long")
    got = {(x._group, int(x.name_)): tuple(x.key) for x in sel.cut_keys(
        df, [F.col("a"), F.col("b"), F.col("c")], ranks, F.col("g")).withColumnRenamed("name", "name_").collect()}
    want = {}
    for g, x in wanted:
        keys = sorted((-1.7e308 if a is None else a, float(b), float(c)) for h, a, b, c in rows if h == g)
        if 0 <= x < len(keys):
            want[g, x] = keys[x]
    assert got == want


@pytest.mark.parametrize("n, share", [(0, 0.2), (1, 0.2), (7, 0.2), (500, 0.2), (20, 0.0), (20, 1.0)])
def test_chrono_split_equals_sorting(spark, n, share):
    r = random.Random(n)
    at = dt.datetime(2024, 3, 31, 1, 30)  # an hour that some zones skip
    rows = [(i, r.choice([None] + [at + dt.timedelta(minutes=30 * k, microseconds=k) for k in range(6)])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, t timestamp_ntz")
    got = {x.id: x.split for x in fe.chrono_split(df, ["t", "id"], share).collect()}
    order = sorted(rows, key=lambda x: (x[1] is not None, x[1] or at, x[0]))
    first = n - math.ceil(n * share)
    assert got == {x[0]: "test" if k >= first else "train" for k, x in enumerate(order)}


def test_stratified_split_equals_sorting(spark):
    rows = [(i, 0 if i % 17 else 1, "x") for i in range(700)] + [(1000 + i, None, "x") for i in range(9)] + [(5000, 2, "x")]
    df = spark.createDataFrame(rows, "id long, y int, _group string").repartition(3)
    out = fe.stratified_split(df.drop("_group").withColumn("key", F.lit(1)), "y", "id")
    got = {x.id: x.split for x in out.collect()}
    want = {}
    for y in (0, 1, 2, None):
        ids = sorted((i for i, c, _ in rows if c == y), key=lambda i: hashlib.md5(f"{i}42".encode()).hexdigest())
        temp = math.ceil(len(ids) * 0.2)
        test = math.ceil(temp / 2)
        for k, i in enumerate(ids):
            want[i] = "train" if k < len(ids) - temp else "val" if k < len(ids) - test else "test"
    assert got == want


def test_rows_are_neither_sorted_nor_moved(spark, capsys):
    df = spark.range(1000).withColumn("y", F.col("id") % 2)
    for out in (fe.chrono_split(df, ["id"]), fe.stratified_split(df, "y", "id")):
        out.explain()
        plan = capsys.readouterr().out
        above = plan[:plan.index("Range (0, 1000")]  # what is done to the rows; the cuts' side comes below
        assert "Exchange" not in above and "Sort" not in above and "Broadcast" in above
