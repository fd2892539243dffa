"""Erasure of subjects from stored tables along a graph of foreign keys.

Tables are keyed Parquet tables (``sources.merge.create_keyed``).  The walk
finds the keys that go, level by level; then only the partitions that hold
such rows are written anew, and the result is told from the files read back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import shared_path
from kestrel.sources.merge import PART, overwrite_parts

_K = "_erased_key"


@dataclass(frozen=True)
class Table:
    path: str
    key: str


@dataclass(frozen=True)
class Link:
    """``child.column`` holds keys of ``parent``."""
    child: str
    column: str
    parent: str


def _stored(df: DataFrame) -> DataFrame:
    path = shared_path(df.sparkSession, "erase")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _hit(rows: DataFrame, column: str, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    return rows.join(keys, rows[column] == keys[_K], how)


def keys_to_erase(spark: SparkSession, tables: Mapping[str, Table], links: Sequence[Link], root: str,
                  subjects: DataFrame) -> tuple[dict[str, DataFrame], list[str]]:
    """Per table the keys of the rows that go, and the tables in the order in
    which they can be rewritten (those that others are found through last).

    A row goes if its key is a subject's or if it refers to a row that goes, at
    any depth; tables may refer to themselves or to each other.  A null
    reference refers to nothing."""
    start = _stored(subjects.select(F.col(subjects.columns[0]).alias(_K)).where(F.col(_K).isNotNull()).distinct())
    found: dict[str, list[DataFrame]] = {root: [start]}
    turn = {root: 0}
    frontier, n = {root: start}, 0
    while frontier:  # ends: every turn finds keys that were not known
        n += 1
        fresh: dict[str, list[DataFrame]] = {}
        for link in (x for x in links if x.parent in frontier):
            rows = spark.read.parquet(tables[link.child].path)
            new = _hit(rows, link.column, frontier[link.parent]).select(F.col(tables[link.child].key).alias(_K))
            new = new.where(F.col(_K).isNotNull()).distinct()
            for known in found.get(link.child, []):
                new = new.join(known, _K, "left_anti")
            new = _stored(new)
            if not new.isEmpty():
                found.setdefault(link.child, []).append(new)
                fresh.setdefault(link.child, []).append(new)
                turn[link.child] = n
        frontier = {t: reduce(DataFrame.union, parts) for t, parts in fresh.items()}
    # rows without a key are found through nothing else: their tables come first
    others = [x.child for x in links if x.parent in found and x.child not in found]
    order = list(dict.fromkeys(others)) + sorted(found, key=lambda t: -turn[t])
    return {t: reduce(DataFrame.union, parts) for t, parts in found.items()}, order


def _rewrite(spark: SparkSession, table: Table, hits: Sequence[tuple[str, DataFrame]]) -> list[int]:
    """Leave out the rows that ``hits`` (column, keys) name; the partitions
    written anew."""
    rows = spark.read.parquet(table.path)
    touched = reduce(DataFrame.union, [_hit(rows, c, k).select(PART) for c, k in hits]).distinct()
    parts = sorted(r[0] for r in touched.collect())  # numbers of partitions
    if not parts:
        return []
    kept = rows.where(F.col(PART).isin(parts))
    for c, k in hits:
        kept = _hit(kept, c, k, "left_anti")
    kept = _stored(kept)
    full = {r[0] for r in kept.select(PART).distinct().collect()}
    if full:
        overwrite_parts(kept, table.path)
    empty = spark.createDataFrame([], rows.drop(PART).schema)
    for p in (p for p in parts if p not in full):  # overwriting by partition leaves these as they were
        empty.write.mode("overwrite").parquet(f"{table.path}/{PART}={p}")
    return parts


def erase(spark: SparkSession, tables: Mapping[str, Table], links: Sequence[Link], root: str,
          subjects: DataFrame) -> DataFrame:
    """Erase ``subjects`` (first column: keys of ``root``) and all rows that
    refer to them, and report per reached table ``table_name``, ``n_before``,
    ``n_after`` and ``n_orphans``: references without a row, in the files read
    back (also those that had none before).

    Files of partitions without erased rows stay as they are.  Tables are
    rewritten children first, so a run that died may be repeated with the same
    subjects: what is left is still found.  No subjects: nothing is written."""
    gone, order = keys_to_erase(spark, tables, links, root, subjects)
    before = {t: spark.read.parquet(tables[t].path).count() for t in order}
    for t in order:
        hits = [(tables[t].key, gone[t])] if t in gone else []
        hits += [(x.column, gone[x.parent]) for x in links if x.child == t and x.parent in gone]
        _rewrite(spark, tables[t], hits)
    report = []
    for t in order:
        rows = spark.read.parquet(tables[t].path)
        counted = rows.agg(F.lit(t).alias("table_name"), F.lit(before[t]).cast("long").alias("n_before"),
                           F.count(F.lit(1)).alias("n_after"))
        broken = [_hit(rows.where(F.col(x.column).isNotNull()), x.column, spark.read.parquet(
            tables[x.parent].path).select(F.col(tables[x.parent].key).alias(_K)), "left_anti").select(
            F.lit(1).alias("one")) for x in links if x.child == t]
        orphans = reduce(DataFrame.union, broken, rows.select(F.lit(1).alias("one")).limit(0))
        report.append(counted.crossJoin(orphans.agg(F.count("one").alias("n_orphans"))))  # one row each
    return reduce(DataFrame.union, report)
