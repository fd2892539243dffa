"""Stored tables that take changes without being rewritten: keyed tables whose
touched partitions alone are merged, and pre-aggregates kept as partial sums
per batch.

Both read the partitions they need by name, so a small batch costs what it
touches and not what the table holds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.warehouse import latest_change
from kestrel.session import shared_path
from kestrel.sources.files import listed_partitions

PART = "_part"


def key_range(key: str, width: int) -> Column:
    """Partition number of an integer key: ranges of ``width`` neighbours."""
    return F.floor(F.col(key) / width)


def _with_part(df: DataFrame, part: Column) -> DataFrame:
    return df.withColumn(PART, F.coalesce(part.cast("long"), F.lit(-1)))  # null keys: a partition of their own


def overwrite_parts(df: DataFrame, path: str) -> None:
    (df.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PART).parquet(path))


def create_keyed(df: DataFrame, path: str, part: Column) -> None:
    """Write a keyed table in partitions of ``part``, a function of the key.
    A partition is one file; choose ``part`` so that it fits a task."""
    overwrite_parts(_with_part(df, part), path)


def merge_changes(changes: DataFrame, path: str, key: str, part: Column, version: str = "version",
                  op: str = "op") -> list[int]:
    """Merge insert, update and delete events into a keyed table and return the
    partitions that were rewritten; the files of all others stay as they are.

    Per key the row with the highest (version, op) stays, whether it was stored
    or comes now, so a batch may be repeated or come late.  Deleted keys stay as
    rows with their delete op: an older change that comes later can't bring
    them back.  A null key is a key like others.  An empty batch changes
    nothing.  The merged partitions are written to the shared folder before
    they replace the stored ones."""
    spark = changes.sparkSession
    columns = changes.columns
    new = latest_change(_with_part(changes, part), [PART, key], version, op)
    staged_new = shared_path(spark, "merge-changes")
    new.write.parquet(staged_new)  # read twice: for the list and for the merge
    new = spark.read.parquet(staged_new)
    touched = sorted(r[0] for r in new.select(PART).distinct().collect())  # numbers of partitions
    if not touched:
        return []
    old = spark.read.parquet(path).where(F.col(PART).isin(touched)).withColumn(PART, F.col(PART).cast("long"))
    # one exchange, by partition: it serves the merge by key and the write
    both = old.unionByName(new.select(*old.columns)).repartition(PART)
    staged = shared_path(spark, "merge-parts")
    latest_change(both, [PART, key], version, op).select(*columns, PART).write.parquet(staged)
    overwrite_parts(spark.read.parquet(staged), path)
    return touched


def live_rows(spark: SparkSession, path: str, op: str = "op", delete_op: str = "D") -> DataFrame:
    """The rows of a keyed table that aren't deleted."""
    return spark.read.parquet(path).where(F.col(op) != delete_op).drop(PART)


def add_partials(arrivals: str, path: str, aggregate: Callable[[DataFrame, list[str]], DataFrame],
                 batch: str = "batch_id") -> tuple[list[int], int]:
    """Add the batches of ``arrivals`` (Parquet, partitioned by ``batch``) that
    ``path`` doesn't hold yet, as partial aggregates per batch; return these
    batches and the number of rows read for them.

    ``aggregate(rows, extra_keys)`` must give sums that may be added up over
    batches.  A batch is the mark of its own partials: a repeated run finds it
    done, and a run that died in it replaces it.  Late rows are rows of a later
    batch with an older date.  Batches are numbers; an empty one has no mark."""
    spark = SparkSession.getActiveSession()
    have = listed_partitions(spark, path, batch)
    new = sorted(set(listed_partitions(spark, arrivals, batch)) - set(have))  # a name per batch
    if not new:
        return [], 0
    seen = Observation("arrivals")
    rows = spark.read.parquet(arrivals).where(F.col(batch).isin(new)).observe(seen, F.count(F.lit(1)).alias("n"))
    (aggregate(rows, [batch]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(batch).parquet(path))
    return new, seen.get["n"]


def merged_partials(spark: SparkSession, path: str, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """The pre-aggregate: partials of all batches added up per key."""
    rows = spark.read.parquet(path)
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in sums])
