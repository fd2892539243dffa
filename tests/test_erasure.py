"""Erasure along foreign keys in stored tables, against sets in Python."""

import glob
import os
import random

import pytest

from kestrel.quality.erasure import Link, Table, erase
from kestrel.sources import merge


def store(spark, base, name, rows, schema, width=10):
    path, key = f"{base}/{name}", schema.split()[0]
    df = spark.createDataFrame(rows, schema)
    merge.create_keyed(df, path, merge.key_range(key, width))
    return Table(path, key)


def files(table):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{table.path}/*/part-*")}


def keys(spark, table):
    return sorted(r[0] for r in spark.read.parquet(table.path).select(table.key).collect() if r[0] is not None)


LINKS = [Link("orders", "buyer", "people"), Link("orders", "seller", "people"), Link("lines", "order_id", "orders"),
         Link("people", "boss", "people"), Link("notes", "about", "lines")]


def test_walk_equals_closure(spark, tmp_path):
    r = random.Random(4)
    people = [(i, r.choice([None, None, None, i // 2])) for i in range(1, 60)] + [(100, 101), (101, 100)]  # a cycle
    orders = [(i, r.choice([3, r.randrange(1, 60)]), r.choice([None, r.randrange(1, 60)])) for i in range(200)]
    lines = [(i, r.randrange(220)) for i in range(400)]  # some orders don't exist
    notes = [(None, i) for i in range(0, 400, 7)] + [(5000, None)]  # rows without a key
    t = {"people": store(spark, tmp_path, "people", people, "id long, boss long"),
         "orders": store(spark, tmp_path, "orders", orders, "id long, buyer long, seller long"),
         "lines": store(spark, tmp_path, "lines", lines, "id long, order_id long"),
         "notes": store(spark, tmp_path, "notes", notes, "id long, about long")}
    subjects = {3, 20, 100, 999}
    gone = set(subjects)
    while more := {p for p, boss in people if boss in gone} - gone:
        gone |= more
    orders_gone = {o for o, b, s in orders if b in gone or s in gone}
    lines_gone = {x for x, o in lines if o in orders_gone}
    report = {x.table_name: x for x in erase(spark, t, LINKS, "people", spark.createDataFrame(
        [(s,) for s in subjects] + [(None,), (3,)], "subject long")).collect()}
    assert keys(spark, t["people"]) == sorted({p for p, _ in people} - gone)
    assert keys(spark, t["orders"]) == sorted({o for o, _, _ in orders} - orders_gone)
    assert keys(spark, t["lines"]) == sorted({x for x, _ in lines} - lines_gone)
    left = [about for _, about in notes if about not in lines_gone]
    got = [x.about for x in spark.read.parquet(t["notes"].path).collect()]
    assert sorted(got, key=str) == sorted(left, key=str)
    assert report["notes"].n_before == len(notes) and report["notes"].n_after == len(left)
    assert report["people"].n_orphans == report["orders"].n_orphans == report["notes"].n_orphans == 0
    assert report["lines"].n_orphans == sum(o >= 200 for _, o in lines)  # those had no order before


@pytest.mark.parametrize("subjects", [[], [25], list(range(20, 30))])
def test_only_touched_files_change(spark, tmp_path, subjects):
    t = {"people": store(spark, tmp_path, "people", [(i, None) for i in range(50)], "id long, boss long"),
         "orders": store(spark, tmp_path, "orders", [(i, i, None) for i in range(50)], "id long, buyer long, seller long"),
         "lines": store(spark, tmp_path, "lines", [(i, i) for i in range(50)], "id long, order_id long"),
         "notes": store(spark, tmp_path, "notes", [(i, 0) for i in range(50)], "id long, about long")}
    before = {n: files(x) for n, x in t.items()}
    for _ in range(2):  # a repeated run finds nothing more
        erase(spark, t, LINKS, "people", spark.createDataFrame([(s,) for s in subjects], "subject long")).collect()
    for n in ("people", "orders", "lines"):
        after = files(t[n])
        changed = {p.split(f"{merge.PART}=")[1].split("/")[0] for p, at in before[n].items() if after.get(p) != at}
        assert changed == ({"2"} if subjects else set())
        assert keys(spark, t[n]) == [i for i in range(50) if i not in subjects]
    assert files(t["notes"]) == before["notes"]
