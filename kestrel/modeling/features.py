"""Feature preparation shared by training and scoring: label encoding,
first-level-dropped dummies, feature alignment, population standardisation,
chronological and stratified splits, class weights.

Level lists (categories, weather codes) are the only thing brought to the
driver: they are bounded by the number of distinct levels, never by rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.operators.selection import cut_keys, order_key


def label_encode(df: DataFrame, col: str, out: str) -> DataFrame:
    """Alphabetical 0-based codes; unseen levels fail (``handleInvalid='error'``)."""
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType="alphabetAsc",
                          handleInvalid="error").fit(df)
    return model.transform(df).withColumn(out, F.col(out).cast("int"))


def sorted_levels(df: DataFrame, col: str) -> list[str]:
    """Distinct non-NULL levels as text, in string order (bounded list)."""
    rows = df.select(F.col(col).cast("string").alias("l")).where(F.col("l").isNotNull()).distinct().collect()
    return sorted(r.l for r in rows)


def one_hot_drop_first(df: DataFrame, col: str, levels: Sequence[str] | None = None) -> DataFrame:
    """``get_dummies(drop_first=True)``: one 0/1 column per level except the
    first in string order; NULL gives all zeros."""
    levels = list(levels) if levels is not None else sorted_levels(df, col)
    s = F.col(col).cast("string")
    dummies = {f"{col}_{lv}": F.coalesce((s == F.lit(lv)).cast("int"), F.lit(0)) for lv in levels[1:]}
    return df.withColumns(dummies).drop(col)


def align_features(df: DataFrame, model_columns: Sequence[str], level_col: str | None = None,
                   level_prefix: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Select ``model_columns`` in order; absent columns are padded with 0.
    When ``level_col`` is given, the dummy ``{prefix}_{value}`` of the row's
    level is set to 1 (unknown levels stay all-zero = base level)."""
    cols = []
    for c in model_columns:
        if level_col is not None and level_prefix and c.startswith(level_prefix + "_"):
            lv = c[len(level_prefix) + 1:]
            cols.append(F.coalesce((F.col(level_col).cast("string") == F.lit(lv)).cast("int"), F.lit(0)).alias(c))
        elif c in df.columns:
            cols.append(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c))
        else:
            cols.append(F.lit(0).alias(c))
    return df.select(*keep, *cols)


def standardise(df: DataFrame, cols: Sequence[str], stats_from: DataFrame | None = None,
                digits: int = 6) -> DataFrame:
    """(x - mean) / population std, statistics from one aggregate row
    (broadcast, one row regardless of data size)."""
    src = stats_from if stats_from is not None else df
    stats = src.agg(*[F.avg(F.col(c).cast("double")).alias(f"_m_{c}") for c in cols],
                    *[F.stddev_pop(F.col(c).cast("double")).alias(f"_s_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(stats))
    scaled = {c: F.round((F.col(c).cast("double") - F.col(f"_m_{c}")) /
                         F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}")), digits) for c in cols}
    return j.withColumns(scaled).drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def _number(df: DataFrame, col: str) -> Column:
    """A column as a number in the same order: times in microseconds."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.TimestampNTZType):  # its own clock, whatever the session's zone
        minutes = (F.unix_date(F.col(col).cast("date")).cast("long") * 24 + F.hour(col)) * 60 + F.minute(col)
        return minutes * 60_000_000 + (F.date_part(F.lit("SECOND"), F.col(col)) * 1_000_000).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    return F.unix_date(col) if isinstance(kind, T.DateType) else F.col(col)


def chrono_split(df: DataFrame, order: Sequence[str], test_share: float = 0.2) -> DataFrame:
    """Last ``ceil(test_share * n)`` rows in ``order`` (numbers, dates, times)
    are 'test'.  Only the key of the first test row is looked for; a row's
    label is a comparison with it.  Rows that tie with it in all of ``order``
    are 'test' too."""
    keys = [_number(df, c) for c in order]
    n = F.count(F.lit(1))
    ranks = df.agg(F.lit(0).alias("_group"), F.lit("test").alias("name"), (n - F.ceil(n * test_share)).alias("rank"))
    cut = F.broadcast(cut_keys(df, keys, ranks).select(F.col("key").alias("_cut")))  # at most one row
    # without a row to be tested (no rows, a share of 0) there is no cut
    return df.join(cut, how="left").withColumn(
        "split", F.when(order_key(keys) >= F.col("_cut"), "test").otherwise("train")).drop("_cut")


def stratified_split(df: DataFrame, label: str, id_col: str, seed: str = "42",
                     temp_share: float = 0.2) -> DataFrame:
    """80 / 10 / 10 per class in ``md5(id || seed)`` order: the last
    ``ceil(0.2 n_c)`` rows of each class are held out, the last half of
    those (rounded up) is 'test', the rest 'val'.

    Per class only the two keys are looked for at which 'val' and 'test' begin;
    a row's label is a comparison with them.  Rows of one id are together.  A
    null label is a class like others."""
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(seed)))
    # the hash in numbers that a double holds exactly: 12 + 12 + 8 digits
    keys = [F.conv(F.substring(h, at, size), 16, 10).cast("long") for at, size in ((1, 12), (13, 12), (25, 8))]
    group = F.struct(F.col(label).alias("label"))
    n = F.count(F.lit(1))
    n_temp = F.ceil(n * temp_share)
    ranks = df.groupBy(group.alias("_group")).agg(F.explode(F.array(
        F.struct(F.lit("val").alias("name"), (n - n_temp).alias("rank")),
        F.struct(F.lit("test").alias("name"), (n - F.ceil(n_temp / 2)).alias("rank")))).alias("_r")).select("_group", "_r.*")
    cuts = cut_keys(df, keys, ranks, group).groupBy("_group").agg(
        F.max(F.when(F.col("name") == "val", F.col("key"))).alias("_val"),
        F.max(F.when(F.col("name") == "test", F.col("key"))).alias("_test"))
    j = df.join(F.broadcast(cuts), group.eqNullSafe(F.col("_group")), "left")  # a row per class
    key = order_key(keys)
    split = F.when(key >= F.col("_test"), "test").when(key >= F.col("_val"), "val").otherwise("train")
    return j.withColumn("split", split).drop("_group", "_val", "_test")


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """negatives / positives (the positive-class weight; NULL without positives)."""
    y = F.col(label).cast("int")
    return df.agg(F.count_if(y == 0).alias("n_neg"), F.count_if(y == 1).alias("n_pos")) \
        .withColumn("scale_pos_weight", F.round(F.try_divide(F.col("n_neg"), F.col("n_pos")), 6))


def with_weight(df: DataFrame, label: str, pos_weight: Column, out: str = "weight") -> DataFrame:
    return df.withColumn(out, F.when(F.col(label).cast("int") == 1, pos_weight).otherwise(F.lit(1.0)))
