"""Total-order operations without a single-partition window.

A window with no ``partitionBy`` moves every row into one task.  For
running sums / row numbers over a global order (PR curves, exact quantiles) we
instead

1. range-partition the rows on the order key (Spark samples the key to cut
   balanced ranges),
2. total each range (one small row per range; the prefix over those totals
   is a window over at most ``n_ranges`` rows),
3. broadcast the per-range offsets back (bounded by ``n_ranges``) and finish
   with a window partitioned by range.

The range-tagged rows are checkpointed once (see ``_with_range_id``), which
also cuts the lineage of the (usually pre-aggregated) input.

So no task ever holds more than one range of rows.  Callers pre-aggregate to
unique order keys first when ties must be grouped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_B = "_range_id"


def _with_range_id(df: DataFrame, order: Sequence[Column], n: int | None) -> DataFrame:
    """Range-partition and tag each row with its range number.

    The range bounds come from a sample taken when the exchange is planned,
    so two evaluations of the same plan may cut the ranges differently.  The
    tagged rows are therefore materialised once with a reliable
    ``checkpoint()`` (to the cluster's shared checkpoint folder) before they
    are read twice (range totals, and rows).
    """
    from kestrel.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    # without an explicit count AQE may merge adjacent ranges to its target
    # partition size; merged ranges stay contiguous, so the order holds
    ranged = df.repartitionByRange(n, *order) if n else df.repartitionByRange(*order)
    return ranged.withColumn(_B, F.spark_partition_id()).checkpoint(eager=True)


def running_sums(df: DataFrame, order: Sequence[Column], sums: dict[str, Column],
                 n_ranges: int | None = None) -> DataFrame:
    """Add ``name = sum(expr)`` over all rows up to and including this one in
    ``order`` (a total order; make it unique for deterministic results)."""
    b = _with_range_id(df, order, n_ranges)
    tmp = {name: f"_v_{name}" for name in sums}
    b = b.withColumns({tmp[k]: v for k, v in sums.items()})
    totals = b.groupBy(_B).agg(*[F.sum(tmp[k]).alias(tmp[k]) for k in sums])
    before = Window.orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(_B, *[F.coalesce(F.sum(tmp[k]).over(before), F.lit(0)).alias(f"_off_{k}")
                                  for k in sums])
    within = Window.partitionBy(_B).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = b.join(F.broadcast(offsets), _B)  # at most n_ranges rows
    out = out.withColumns({k: F.sum(tmp[k]).over(within) + F.col(f"_off_{k}") for k in sums})
    return out.drop(_B, *tmp.values(), *[f"_off_{k}" for k in sums])


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number",
                      n_ranges: int | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (total order assumed)."""
    return running_sums(df, order, {name: F.lit(1)}, n_ranges)


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    names: Sequence[str] | None = None, group: Sequence[str] = ()) -> DataFrame:
    """Exact linear-interpolated quantiles (``percentile`` / ``quantile_cont``)
    of ``value`` per ``group``, from per-(group, value) counts.

    The counts are cumulated with one range-partitioned prefix sum over
    (group, value); each group's offset (rows of the groups before it) is
    subtracted, so a group holding most rows is still split over ranges.
    NULL values are ignored.
    """
    names = list(names or [f"q{int(p * 100)}" for p in probs])
    g = list(group)
    counts = df.where(F.col(value).isNotNull()).groupBy(*g, value).agg(F.count(F.lit(1)).alias("_c"))
    cum = running_sums(counts, [*[F.col(c) for c in g], F.col(value)], {"_cum": F.col("_c")})
    if g:
        # a group's offset is the global count before its first value, i.e.
        # the smallest (cum - c) inside the group: one more aggregate, no
        # second ordering pass
        tot = cum.groupBy(*g).agg(F.sum("_c").alias("_n"), F.min(F.col("_cum") - F.col("_c")).alias("_off"))
        cum = cum.join(tot, g)
    else:
        cum = cum.crossJoin(F.broadcast(counts.agg(F.sum("_c").alias("_n"), F.lit(0).alias("_off"))))  # 1 row
    cum = cum.withColumn("_cum", F.col("_cum") - F.col("_off"))
    cum = cum.withColumn("_lo", F.col("_cum") - F.col("_c"))  # rows of the group strictly before
    outs = []
    for p, nm in zip(probs, names):
        pos = (F.col("_n") - 1) * F.lit(float(p))
        lo_i, hi_i = F.floor(pos), F.ceil(pos)
        frac = pos - lo_i
        # value at 0-based position i is the row with _lo <= i < _cum
        lo_v = F.min(F.when((F.col("_lo") <= lo_i) & (lo_i < F.col("_cum")), F.col(value)))
        hi_v = F.min(F.when((F.col("_lo") <= hi_i) & (hi_i < F.col("_cum")), F.col(value)))
        fr = F.first(frac)
        outs.append((lo_v.cast("double") + (hi_v.cast("double") - lo_v.cast("double")) * fr).alias(nm))
    if g:
        return cum.groupBy(*g).agg(*outs)
    return cum.agg(*outs)
