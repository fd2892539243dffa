"""Exact order statistics by narrowing histograms.

A wanted rank lies in a *bracket*, at first the whole range of its group.  One
pass counts the rows of every bracket in ``CELLS`` cells of equal width, with
each cell's least and greatest value; the cell that holds the rank is the next
bracket.  Every other pass takes the width on a logarithmic scale, so values of
many orders of magnitude need few passes too.  A bracket is done when its values are equal, or when it holds at
most ``KEEP`` rows, which a last pass sorts.  So no row is sorted, shuffled or
written as a whole, and no map of values is kept: what moves is a cell's count,
and what is stored between passes is a row per bracket.

Ranks that share a bracket share its passes.  Brackets are broadcast while
there are at most ``FEW`` of them; more are joined by a shuffle.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import ensure_checkpoint_dir

CELLS = 1024
KEEP = 4096
FEW = 10_000
TINY = 1e-300
_G = "_group"


def _in_brackets(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    """Each row with the bracket that it lies in (brackets of a group don't
    overlap)."""
    b = F.broadcast(brackets) if brackets.count() <= FEW else brackets
    b = b.withColumnRenamed(_G, "_bg")
    here = F.col(_G).eqNullSafe(F.col("_bg")) & (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi"))
    return rows.join(b, here).drop("_bg")


def _half(c: Column) -> Column:
    """Halves keep the differences of very large values finite."""
    return c / 2


def _log(c: Column) -> Column:
    """Ascending in the value, with a step for each order of magnitude."""
    return F.signum(c) * (F.log(F.abs(c) + TINY) - F.lit(math.log(TINY)))


def _place(scale) -> Column:
    """Where a row's value lies between its bracket's ends, from 0 to 1; null
    if the scale doesn't tell the ends apart."""
    v, lo, hi = (scale(F.col(c)) for c in ("_v", "lo", "hi"))
    return F.try_divide(v - lo, hi - lo)


def values_at(rows: DataFrame, ranks: DataFrame, cells: int = CELLS, keep: int = KEEP) -> DataFrame:
    """(_group, rank, value): the values at 0-based ranks.

    ``rows`` are (_group, _v), ``ranks`` the first brackets (_group, lo, hi,
    below = 0, n, ranks)."""
    ensure_checkpoint_dir(rows.sparkSession)
    brackets = ranks.checkpoint()
    done = None
    for turn in itertools.count():
        wide = (F.col("lo") < F.col("hi")) & (F.col("n") > keep)
        closed, wider = brackets.where(~wide), brackets.where(wide)
        done = closed if done is None else done.unionByName(closed)
        if wider.isEmpty():
            break
        place = F.coalesce(_place(_log if turn % 2 else _half), (F.col("_v") > F.col("lo")).cast("double"))
        cell = F.least(F.floor(place * cells), F.lit(cells - 1))
        bracket = [_G, "lo", "hi", "below", "ranks"]
        counted = _in_brackets(rows, wider).groupBy(*bracket, cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most"))
        before = Window.partitionBy(*bracket).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        placed = counted.withColumn("below", F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0)))
        inside = F.filter("ranks", lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("n")))
        brackets = placed.select(_G, F.col("least").alias("lo"), F.col("most").alias("hi"), "below", "n",
                                 inside.alias("ranks")).where(F.size("ranks") > 0).checkpoint()
    equal = done.where("lo = hi").select(_G, F.explode("ranks").alias("rank"), F.col("lo").alias("value"))
    few = _in_brackets(rows, done.where("lo < hi")).groupBy(_G, "below", "ranks").agg(
        F.sort_array(F.collect_list("_v")).alias("_vs"))  # at most ``keep`` values
    sorted_few = few.select(_G, F.explode("ranks").alias("rank"), "below", "_vs").select(
        _G, "rank", F.get("_vs", (F.col("rank") - F.col("below")).cast("int")).alias("value"))
    return equal.unionByName(sorted_few)


def quantiles(df: DataFrame, value: str, probs: Sequence[float], names: Sequence[str],
              group: Sequence[str] = (), cells: int = CELLS, keep: int = KEEP) -> DataFrame:
    """Group columns, ``n`` (finite values) and one column per probability:
    exact quantiles with linear interpolation, as ``percentile`` gives.

    Null and non-finite values are left out; a group of only such values has no
    row; without ``group`` the result is one row (null quantiles if empty)."""
    g = F.struct(*[F.col(c) for c in group]) if group else F.lit(0)
    v = F.col(value).cast("double")
    rows = df.select(g.alias(_G), v.alias("_v")).where(F.col("_v").isNotNull() & (F.abs("_v") < float("inf")))
    at = {nm: (F.col("n") - 1) * F.lit(float(p)) for nm, p in zip(names, probs)}
    wanted = F.array_distinct(F.array(*[f(x).cast("long") for x in at.values() for f in (F.floor, F.ceil)]))
    stats = rows.groupBy(_G).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    ranks = stats.select(_G, "lo", "hi", F.lit(0).cast("long").alias("below"), "n", wanted.alias("ranks")).checkpoint()
    found = values_at(rows, ranks, cells, keep).groupBy(_G).agg(  # two entries a probability
        F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_at"))
    n = ranks.select(F.col(_G).alias("_ng"), "n")
    joined = found.join(n, F.col(_G).eqNullSafe(F.col("_ng")))

    def between(x):
        low, high = (F.element_at("_at", f(x).cast("long")) for f in (F.floor, F.ceil))
        return low + (high - low) * (x - F.floor(x))

    keys = [F.col(f"{_G}.{c}").alias(c) for c in group]
    out = joined.select(*keys, "n", *[between(x).alias(nm) for nm, x in at.items()])
    if group:
        return out
    return out.agg(F.coalesce(F.max("n"), F.lit(0)).alias("n"), *[F.max(nm).alias(nm) for nm in names])  # one row


def mode(df: DataFrame, value: str) -> DataFrame:
    """One row ``mode``: the smallest of the most frequent values."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.min_by("_v", F.struct(-F.col("_n"), F.col("_v"))).cast("double").alias("mode"))


def cut_keys(df: DataFrame, order: Sequence[Column], ranks: DataFrame, group: Column | None = None) -> DataFrame:
    """(_group, name, key): the order keys at 0-based ranks of each group.

    ``ranks`` are (_group, name, rank), few per group; a rank outside its group
    has no row.  ``order`` are numbers that doubles hold exactly, first those
    that decide; a null comes before every number.  ``key`` is a struct of them,
    to be compared with ``order_key``.  Part by part, the value at the rank is
    found by narrowing and the rank is taken on among the rows that tie, so no
    row is sorted or written."""
    g = F.lit(0) if group is None else group
    parts = [f"_p{i}" for i in range(len(order))]
    rows = df.select(g.alias("_g0"), *[p.alias(n) for p, n in zip(_parts(order), parts)])
    at = ranks.select(F.col(_G).alias("_g0"), "name", F.col("rank").cast("long").alias("rank"))
    at = at.where(F.col("rank") >= 0)
    for i, part in enumerate(parts):
        prefix = ["_g0", *parts[:i]]
        here = [F.col(f"r.{c}").eqNullSafe(F.col(f"a.{c}")) for c in prefix]
        at = at.checkpoint()
        tied = F.broadcast(at.select(*prefix).distinct())  # as few as there are ranks
        left = rows.alias("r").join(tied.alias("a"), here, "left_semi")
        later = parts[i + 1:]
        left = left.select(F.struct(*prefix).alias(_G), F.col(part).alias("_v"),
                           F.struct(F.lit(0), *later).alias("_later"))
        size = left.groupBy(_G).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
        wanted = at.groupBy(F.struct(*prefix).alias("_w")).agg(F.collect_set("rank").alias("ranks"))  # few
        first = size.join(wanted, F.col(_G).eqNullSafe(F.col("_w"))).select(
            _G, "lo", "hi", F.lit(0).cast("long").alias("below"), "n",
            F.filter("ranks", lambda r: r < F.col("n")).alias("ranks"))
        found = values_at(left.drop("_later"), first).select(F.col(_G).alias("_fg"), F.col("rank").alias("_fr"), "value")
        at = at.join(found, F.struct(*prefix).eqNullSafe(F.col("_fg")) & (F.col("rank") == F.col("_fr")))
        at = at.select(*prefix, "name", "rank", F.col("value").alias(part)).checkpoint()
        ends = F.broadcast(at.select(F.struct(*prefix).alias("_eg"), F.col(part).alias("_end")).distinct())
        below = left.join(ends, F.col(_G).eqNullSafe(F.col("_eg")) & (F.col("_v") <= F.col("_end"))).groupBy(
            "_eg", "_end").agg(F.count_if(F.col("_v") < F.col("_end")).alias("_below"),
                               F.count_if(F.col("_v") == F.col("_end")).alias("_ties"),
                               F.max(F.when(F.col("_v") == F.col("_end"), F.col("_later"))).alias("_later"))
        at = at.join(below, F.struct(*prefix).eqNullSafe(F.col("_eg")) & (F.col(part) == F.col("_end"))).checkpoint()
        if at.where("_ties > 1").isEmpty():  # the cuts are single rows, with their later parts
            at = at.select(*prefix, part, "name", *[F.col(f"_later.{c}").alias(c) for c in later])
            break
        at = at.select(*prefix, part, "name", (F.col("rank") - F.col("_below")).alias("rank"))
    return at.select(F.col("_g0").alias(_G), "name", F.struct(*parts).alias("key")).checkpoint()


def _parts(order: Sequence[Column]) -> list[Column]:
    return [F.coalesce(p.cast("double"), F.lit(-1.7e308)) for p in order]


def order_key(order: Sequence[Column]) -> Column:
    """A row's own key, comparable with those of ``cut_keys``."""
    return F.struct(*[p.alias(f"_p{i}") for i, p in enumerate(_parts(order))])
