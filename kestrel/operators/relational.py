"""Projection, filter and predicate helpers (lazy, expression-only).

Every function takes and returns a DataFrame and only adds expressions to
the logical plan, so Catalyst keeps them inside whole-stage codegen and
pushes filters on base columns into the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_or_lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# -- projections -------------------------------------------------------------
def rename_map(df: DataFrame, mapping: Mapping[str, str], keep_rest: bool = False) -> DataFrame:
    """Select ``source -> target`` columns (target schema order)."""
    cols = [F.col(src).alias(dst) for src, dst in mapping.items()]
    if keep_rest:
        cols += [F.col(c) for c in df.columns if c not in mapping]
    return df.select(*cols)


def with_defaults(df: DataFrame, defaults: Mapping[str, tuple[object, str]]) -> DataFrame:
    """Add constant columns ``name -> (value, type)``; NULL when value is None."""
    return df.withColumns({n: F.lit(v).cast(t) for n, (v, t) in defaults.items()})


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Force column types; ``strict=False`` turns bad values into NULL (try_cast)."""
    def conv(c, t):
        return F.col(c).cast(t) if strict else F.col(c).try_cast(t)
    return df.withColumns({c: conv(c, t) for c, t in types.items()})


def drop_if_present(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*[c for c in cols if c in df.columns])


def rename_if_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({o: n for o, n in mapping.items() if o in df.columns})


def reorder(df: DataFrame, first: Iterable[str]) -> DataFrame:
    first = [c for c in first if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)
            and not isinstance(f.dataType, T.BooleanType)]


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def columns_minus(df: DataFrame, excluded: Iterable[str]) -> list[str]:
    ex = set(excluded)
    return [c for c in df.columns if c not in ex]


# -- filters -----------------------------------------------------------------
def filter_eq_cast(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.where(F.col(col).cast("string") == F.lit(str(value)))


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def filter_flag_true(df: DataFrame, col: str) -> DataFrame:
    """``col == True``: NULL flags are dropped (three-valued logic)."""
    return df.where(F.col(col))


def filter_last_interval(df: DataFrame, ts: str, as_of, days: int | None = None,
                         hours: int | None = None) -> DataFrame:
    """Rows with ``ts >= as_of - interval``; ``as_of`` is a literal or column
    (e.g. a scalar subquery).  Future rows are kept, as in the source."""
    if days is not None:
        span = F.expr(f"INTERVAL {int(days)} DAYS")
    else:
        span = F.expr(f"INTERVAL {int(hours)} HOURS")
    return df.where(F.col(ts) >= col_or_lit(as_of) - span)


def clip_lower(c: Column, lower=0) -> Column:
    """Values below ``lower`` become ``lower``; NULL stays NULL."""
    return F.when(c < lower, F.lit(lower)).otherwise(c)


def fill_constant(df: DataFrame, numeric=0, category="missing") -> DataFrame:
    num = numeric_columns(df)
    cat = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill(numeric, subset=num).na.fill(category, subset=cat)


def flag(cond: Column) -> Column:
    """Boolean condition -> 0/1 integer (NULL stays NULL)."""
    return cond.cast("int")


def max_of(df: DataFrame, col: str) -> Column:
    """Uncorrelated scalar subquery ``(SELECT max(col) FROM df)``."""
    return df.select(F.max(col)).scalar()
