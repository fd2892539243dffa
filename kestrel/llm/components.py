"""Connected components over links between long ids, and link search inside
buckets without listing the pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); the component is the
    smallest id that links reach.

    Each round every node joins its first neighbour in a hashed order and the
    graph is contracted along these choices, so chains and stars alike shrink
    by a constant factor; all of it is joins and aggregates on shrinking
    tables, and each round's tables are written."""
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .where("a <> b").distinct(), "links")
    label = stored(edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
                   .withColumn("label", F.col("id")), "labels")
    while not edges.isEmpty():
        order = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        both = edges.union(edges.select("b", "a"))
        to = stored(both.groupBy("a").agg(F.min(order("b")).alias("m"))
                    .select(F.col("a").alias("v"), F.least(F.col("m"), order("a"))["v"].alias("to")), "contract")
        label = stored(label.join(to, label.label == to.v, "left")
                       .select("id", F.coalesce("to", "label").alias("label")), "labels")
        ends = edges.join(to, edges.a == to.v).select(F.col("to").alias("x"), "b")
        ends = ends.join(to, ends.b == to.v).select(F.least("x", "to").alias("a"), F.greatest("x", "to").alias("b"))
        edges = stored(ends.where("a <> b").distinct(), "links")
    least = label.groupBy("label").agg(F.min("id").alias("component"))
    return label.join(least, "label").select("id", "component")


def bucket_links(rows: DataFrame, key: list[str], near: Callable[[Column, Column], Column],
                 payload: str) -> DataFrame:
    """Links (a, b) whose components equal those of *all* pairs of ``rows``
    (key columns, id, payload) that share a key and are ``near``.

    First every row is tested against its bucket's first row only.  What is
    joined by these links needs no further test; rows not linked to the first
    are then tested against those rows of their bucket that lie in other
    components.  A group of near copies costs a linear number of tests."""
    spec = F.min(F.struct("id", payload)).alias("first")
    heads = rows.groupBy(*key).agg(spec, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    shared = stored(rows.join(heads, key).withColumn("linked", near(F.col(payload), F.col(f"first.{payload}"))),
                    "buckets")
    star = stored(shared.where("linked AND id <> first.id").select(F.col("id").alias("a"), F.col("first.id").alias("b")
                                                                   ).distinct(), "star")
    label = stored(components(star), "star-labels")
    labelled = shared.join(label, "id", "left").select(
        *key, "id", payload, "linked", F.coalesce("component", "id").alias("component"))
    # only buckets that still hold rows of several components
    several = labelled.groupBy(*key).agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_rows = stored(labelled.join(several.select(*key), key, "left_semi"), "open-buckets")
    a, b = open_rows.where("NOT linked").alias("a"), open_rows.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in key]
    apart = (F.col("a.component") != F.col("b.component")) & near(F.col(f"a.{payload}"), F.col(f"b.{payload}"))
    rest = a.join(b, [*same, apart]).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    return star.union(rest)
