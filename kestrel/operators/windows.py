"""Window-style operators written to survive skewed keys.

* top-n per key uses ``row_number() <= n``, which Spark plans as a
  ``WindowGroupLimit`` *before* the shuffle, so a hot key ships at most n
  rows per map task;
* latest-per-key uses ``max_by`` aggregation (partial aggregation);
* short time-range windows (velocity) and SCD2 version building split every
  entity's history into time buckets, long ones (7 / 30 day rollups) into
  panes with partial aggregates, so one hot entity is spread over many tasks
  instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.functions.calendar import epoch_seconds


def top_n_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                  rank_col: str | None = None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order`` tuple.

    ``max_by(struct(all), struct(order))`` is a partial aggregate, so even a
    key holding a third of the rows is reduced map-side.
    """
    others = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(*[F.col(o) for o in order])).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])


def cap_per_group(df: DataFrame, keys: Sequence[str], n: int, id_col: str, seed: str = "42") -> DataFrame:
    """At most ``n`` pseudo-random rows per key; the draw is
    ``md5(id || seed)`` order so every engine keeps the same rows."""
    order = [F.md5(F.concat(F.col(id_col).cast("string"), F.lit(seed))), F.col(id_col)]
    return top_n_per_key(df, keys, order, n)


def rolling_time_agg(df: DataFrame, key: str, ts: str, seconds: int,
                     aggs: dict[str, tuple[str, str | None]]) -> DataFrame:
    """Per-entity aggregates over the trailing ``seconds`` (inclusive, on whole
    epoch seconds, current row included) for every row.

    ``aggs``: output -> (function in {count, sum, avg, max, min}, column).

    Skew-safe plan: rows are assigned to bucket ``floor(t / seconds)`` and
    replicated once into the next bucket as context, then the range window
    runs partitioned by (entity, bucket).  Any trailing window of length
    ``seconds`` ending in bucket b lies inside buckets b-1 and b, so results
    are exact; each task holds at most two buckets of one entity.
    """
    t = epoch_seconds(F.col(ts))
    base = df.withColumns({"_t": t, "_own": F.floor(t / seconds)})
    ctx = F.explode(F.array(F.struct(F.col("_own").alias("b"), F.lit(True).alias("own")),
                            F.struct((F.col("_own") + 1).alias("b"), F.lit(False).alias("own"))))
    rep = base.select("*", ctx.alias("_c")).select("*", F.col("_c.b").alias("_b"), F.col("_c.own").alias("_is_own")) \
        .drop("_c")
    w = Window.partitionBy(key, "_b").orderBy("_t").rangeBetween(-seconds, 0)
    exprs = {}
    for name, (fn, col) in aggs.items():
        c = F.col(col) if col else F.lit(1)
        exprs[name] = {"count": F.count(c), "sum": F.sum(c), "avg": F.avg(c),
                       "max": F.max(c), "min": F.min(c)}[fn].over(w)
    out = rep.withColumns(exprs).where(F.col("_is_own"))
    return out.drop("_t", "_own", "_b", "_is_own")


def pane_rows(df: DataFrame, key: str, ts: str, seconds: int, pane_seconds: int) -> DataFrame:
    """Every row twice: in its own pane (``_own``), and as context ``seconds``
    later, where windows may begin in the middle of its pane."""
    t = epoch_seconds(F.col(ts))
    twice = F.explode(F.array(F.struct(t.alias("at"), F.lit(True).alias("own")),
                              F.struct((t + seconds).alias("at"), F.lit(False).alias("own"))))
    rows = df.select("*", twice.alias("_c")).select("*", F.col("_c.at").alias("_at"), F.col("_c.own").alias("_own"))
    return rows.drop("_c").withColumn("_pane", F.floor(F.col("_at") / pane_seconds))


def pane_time_agg(df: DataFrame, key: str, ts: str, seconds: int, aggs: dict[str, tuple[str, str | None]],
                  pane_seconds: int = 86400) -> DataFrame:
    """As ``rolling_time_agg``, for windows of many panes (``seconds`` is a
    multiple of ``pane_seconds``).

    A window has three parts: its own pane up to the row, the end of the pane
    that it begins in, and the whole panes between.  These are partial
    aggregates per (entity, pane) and a window over them; only the first two
    need rows, so a task holds rows of two panes of an entity, however long the
    window is."""
    if seconds % pane_seconds:
        raise ValueError("the window must be a whole number of panes")
    n_panes = seconds // pane_seconds
    # what each function adds up: partial name -> (combine, column)
    parts = {}
    for name, (fn, col) in aggs.items():
        c = F.col(col) if col else F.lit(1)
        wanted = {"count": ("count",), "sum": ("sum", "count"), "avg": ("sum", "count"), "max": ("max",), "min": ("min",)}[fn]
        parts |= {f"_{name}_{w}": (w, c) for w in wanted}
    first = {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}
    again = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}

    panes = df.groupBy(key, F.floor(epoch_seconds(F.col(ts)) / pane_seconds).alias("_pane")).agg(
        *[first[w](c).alias(p) for p, (w, c) in parts.items()])
    between = Window.partitionBy(key).orderBy("_pane").rangeBetween(-(n_panes - 1), -1)  # one row a pane
    between = panes.select(key, "_pane", *[again[w](p).over(between).alias(f"{p}_mid") for p, (w, _) in parts.items()])

    rows = pane_rows(df, key, ts, seconds, pane_seconds).unionByName(between, allowMissingColumns=True)
    whole = Window.partitionBy(key, "_pane")
    upto = whole.orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    since = whole.orderBy(F.col("_at").desc()).rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({p: first[w](F.when(F.col("_own"), c)).over(upto) for p, (w, c) in parts.items()})
    rows = rows.withColumns({f"{p}_old": first[w](F.when(~F.col("_own"), c)).over(since) for p, (w, c) in parts.items()})
    rows = rows.withColumns({f"{p}_mid": F.max(f"{p}_mid").over(whole) for p in parts}).where("_own")

    def joined(p):
        three = [F.col(p), F.col(f"{p}_old"), F.col(f"{p}_mid")]
        if parts[p][0] in ("max", "min"):
            return {"max": F.greatest, "min": F.least}[parts[p][0]](*three)
        return sum(F.coalesce(x, F.lit(0)) for x in three)

    def result(name, fn):
        if fn in ("count", "max", "min"):
            return joined(f"_{name}_{fn}")
        n = joined(f"_{name}_count")
        total = F.when(n > 0, joined(f"_{name}_sum"))
        return total if fn == "sum" else F.try_divide(total, n)

    return rows.select(*df.columns, *[result(name, fn).alias(name) for name, (fn, _) in aggs.items()])


def share_of_total(df: DataFrame, count_col: str = "count", out: str = "share") -> DataFrame:
    """``count / sum(count)`` over an already-aggregated (bounded) frame."""
    return df.withColumn(out, F.round(F.col(count_col) / F.sum(count_col).over(Window.partitionBy()), 6))


def scd2_versions(changes: DataFrame, key: str, ts: str, attrs: Sequence[str],
                  bucket_seconds: int | None = 30 * 86400) -> DataFrame:
    """Change log -> SCD2 versions: consecutive identical attribute values
    collapse; ``valid_from`` = change time, ``valid_to`` = next version's
    start, ``is_current`` when there is none.

    With ``bucket_seconds`` (default 30 days) the lag / lead windows run per
    (entity, time bucket); the row before a bucket's first row (and the row
    after its last) comes from a per-bucket ``max_by`` / ``min`` aggregate
    carried over the entity's short list of buckets.  An entity with a huge
    change log is thus spread over its buckets.  ``None`` uses plain
    per-entity windows.
    """
    cur = F.struct(*[F.col(a) for a in attrs])
    if bucket_seconds is None:
        w = Window.partitionBy(key).orderBy(ts)
        prev = F.struct(*[F.lag(a).over(w) for a in attrs])
        changed = changes.withColumn("_chg", F.lag(F.col(ts)).over(w).isNull() | (prev != cur)) \
            .where(F.col("_chg")).drop("_chg")
        return (changed.withColumn("valid_from", F.col(ts))
                .withColumn("valid_to", F.lead(ts).over(w))
                .withColumn("is_current", F.col("valid_to").isNull()))

    bk = F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / bucket_seconds)
    c = changes.withColumn("_bk", bk).withColumn("_cur", cur)
    wb = Window.partitionBy(key).orderBy("_bk")  # over buckets of one entity (few rows)
    last_of = c.groupBy(key, "_bk").agg(F.max_by("_cur", F.col(ts)).alias("_last"))
    seed = last_of.select(key, "_bk", F.lag("_last").over(wb).alias("_seed"))
    w = Window.partitionBy(key, "_bk").orderBy(ts)
    with_prev = c.join(seed, [key, "_bk"]).withColumn("_prev", F.coalesce(F.lag("_cur").over(w), F.col("_seed")))
    changed = with_prev.where(F.col("_prev").isNull() | (F.col("_prev") != F.col("_cur"))) \
        .drop("_prev", "_seed")
    first_of = changed.groupBy(key, "_bk").agg(F.min(ts).alias("_first"))
    nxt = first_of.select(key, "_bk", F.lead("_first").over(wb).alias("_next_bucket_start"))
    out = changed.join(nxt, [key, "_bk"]).withColumn(
        "valid_to", F.coalesce(F.lead(ts).over(w), F.col("_next_bucket_start")))
    return (out.withColumn("valid_from", F.col(ts)).withColumn("is_current", F.col("valid_to").isNull())
            .drop("_bk", "_cur", "_next_bucket_start"))
