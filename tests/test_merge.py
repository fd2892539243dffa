"""Stored tables under changes, against merging in Python."""

import glob
import os
import random

from pyspark.sql import functions as F

from kestrel.operators.warehouse import daily_revenue_merchant
from kestrel.sources import files as fs
from kestrel.sources import merge

SCHEMA = "k long, v string, version long, op string"


def stored_files(path):
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{path}/*/part-*")}


def test_untouched_files_keep_their_names(spark, tmp_path):
    path, part = str(tmp_path / "t"), merge.key_range("k", 100)
    merge.create_keyed(spark.createDataFrame([(i, "a", 0, "I") for i in range(1000)], SCHEMA), path, part)
    before = stored_files(path)
    ch = spark.createDataFrame([(150, "b", 1, "U"), (151, None, 1, "D"), (2000, "n", 1, "I")], SCHEMA)
    assert merge.merge_changes(ch, path, "k", part) == [1, 20]
    after = stored_files(path)
    assert len(before) == 10 and len(after) == 11
    same = {p for p in before if after.get(p) == before[p]}
    assert {p.split("_part=")[1].split("/")[0] for p in set(before) - same} == {"1"} and len(same) == 9
    rows = {r.k: r.v for r in merge.live_rows(spark, path).collect()}
    assert rows[150] == "b" and 151 not in rows and rows[2000] == "n" and len(rows) == 1000


def test_random_batches_equal_a_dict(spark, tmp_path):
    r = random.Random(5)
    path, part = str(tmp_path / "t"), merge.key_range("k", 10)
    want = {}
    hot = 7  # a third of all changes

    def batch(n, versions):
        out = []
        for _ in range(n):
            k = r.choice([hot, r.randrange(60), r.randrange(60), None])
            out.append((k, r.choice("abc"), r.choice(versions), r.choice("IUD")))
        return out

    def apply(rows):
        for k, v, n, op in rows:
            if k not in want or (n, op) > want[k][1:]:
                want[k] = (v, n, op)

    seen = set()  # one value per (key, version, op): ties would be any of their values
    batches = []
    for versions in (range(5), range(3, 9), range(2)):  # the last comes late
        b = [x for x in batch(150, versions) if not ((x[0], *x[2:]) in seen or seen.add((x[0], *x[2:])))]
        batches.append(b)
    merge.create_keyed(spark.createDataFrame([], SCHEMA), path, part)
    merge.create_keyed(spark.createDataFrame([(0, "z", -1, "I")], SCHEMA), path, part)
    apply([(0, "z", -1, "I")])
    for b in [*batches, batches[1], []]:  # a repeated batch and an empty one change nothing
        merge.merge_changes(spark.createDataFrame(b, SCHEMA).repartition(3), path, "k", part)
        apply(b)
    got = {x.k: (x.v, x.version, x.op) for x in merge.live_rows(spark, path).collect()}
    assert got == {k: x for k, x in want.items() if x[2] != "D"}


def test_a_partition_may_lose_all_its_rows(spark, tmp_path):
    path, part = str(tmp_path / "t"), merge.key_range("k", 10)
    merge.create_keyed(spark.createDataFrame([(1, "a", 0, "I"), (11, "a", 0, "I")], SCHEMA), path, part)
    merge.merge_changes(spark.createDataFrame([(1, None, 1, "D")], SCHEMA), path, "k", part)
    merge.merge_changes(spark.createDataFrame([(1, "old", 0, "U")], SCHEMA), path, "k", part)
    assert [x.k for x in merge.live_rows(spark, path).collect()] == [11]


FACTS = "date_key int, merchant_key long, gross_amount decimal(15,2), net_revenue decimal(15,2), batch_id int"


def test_second_run_reads_new_batches_only(spark, tmp_path):
    facts, path = str(tmp_path / "facts"), str(tmp_path / "agg")

    def arrive(batch, days, n):
        rows = spark.range(n).select(
            F.element_at(F.array(*[F.lit(d) for d in days]), (F.col("id") % len(days) + 1).cast("int")).alias("date_key"),
            (F.col("id") % 5).alias("merchant_key"), (F.col("id") / 7).cast("decimal(15,2)").alias("gross_amount"),
            (F.col("id") / 9).cast("decimal(15,2)").alias("net_revenue"), F.lit(batch).alias("batch_id"))
        rows.write.mode("append").partitionBy("batch_id").parquet(facts)

    def add():
        return merge.add_partials(facts, path, daily_revenue_merchant)

    def result(df):
        return sorted(map(tuple, df.select("date_key", "merchant_key", "gross_amount", "net_revenue", "nb_tx").collect()))

    arrive(1, [20240101, 20240102], 1000)
    assert add() == ([1], 1000)
    arrive(2, [20240103], 30)
    arrive(3, [20240101], 4)  # late rows of an old day
    assert add() == ([2, 3], 34)
    assert add() == ([], 0)
    got = merge.merged_partials(spark, path, ["date_key", "merchant_key"], ["gross_amount", "net_revenue", "nb_tx"])
    assert result(got) == result(daily_revenue_merchant(spark.read.parquet(facts)))


def test_newest_report_from_the_listing(spark, tmp_path):
    base = str(tmp_path / "r")
    df = spark.createDataFrame([(1, "x")], "id long, name string")
    for day in ("2024-01-02", "2024-11-30", "2024-03-09"):
        fs.write_report(df.withColumn("name", F.lit(day)), base, day)
    assert str(max(fs.listed_partitions(spark, base, "report_date"))) == "2024-11-30"
    assert [r.name for r in fs.latest_report(spark, base, df.schema).collect()] == ["2024-11-30"]
    assert fs.listed_partitions(spark, base + "-none", "report_date") == []
