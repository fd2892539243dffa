"""File sources and sinks: CSV with an index column, raw JSON (bronze),
Parquet, append / truncate-load / keyed replace, insert-if-absent, dated
CSV reports, partitions by listing.

Sinks write with Spark's parallel writers (one file set per partition and
task); nothing is funnelled through a single task or the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import shared_path


# -- sources -----------------------------------------------------------------
def read_csv_indexed(spark: SparkSession, path: str, schema: T.StructType, index_col: str = "_c0") -> DataFrame:
    """Header CSV whose first column is an unnamed row index (dropped)."""
    full = T.StructType([T.StructField(index_col, T.StringType())] + list(schema.fields))
    return spark.read.schema(full).option("header", True).csv(path).drop(index_col)


# microsecond timestamps survive the JSON round trip
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_json_rows(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = False) -> DataFrame:
    """Raw JSON rows with a fixed schema (no inference pass)."""
    return (spark.read.schema(schema).option("multiLine", multiline).option("timestampNTZFormat", TS_FORMAT)
            .option("timestampFormat", TS_FORMAT).json(path))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def run_sql(spark: SparkSession, text: str, views: dict[str, DataFrame]) -> DataFrame:
    """Run SQL text over named DataFrames (temporary views)."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


# -- sinks -------------------------------------------------------------------
def write_json_by_day(df: DataFrame, path: str, ts: str, mode: str = "overwrite") -> None:
    """Bronze layer: raw rows as JSON lines, one folder per day."""
    (df.withColumn("day", F.to_date(ts)).write.mode(mode).partitionBy("day")
     .option("timestampNTZFormat", TS_FORMAT).option("timestampFormat", TS_FORMAT).json(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def append_chunked(df: DataFrame, path: str, chunk_rows: int = 0) -> None:
    """Append; ``chunk_rows`` bounds the rows per written file (0: no bound)."""
    df.write.mode("append").option("maxRecordsPerFile", chunk_rows).parquet(path)


def truncate_load(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_keyed(df: DataFrame, path: str, key: str = "observation_uuid") -> None:
    """Replace a table; add a random UUID key when absent; refuse to replace
    it when the key is not unique.  The rows are written to the shared folder
    first: the check and the table then see the same drawn keys."""
    if key not in df.columns:
        df = df.withColumn(key, F.expr("uuid()"))
    staged = shared_path(df.sparkSession, "replace-keyed")
    df.select(key, *[c for c in df.columns if c != key]).write.parquet(staged)
    rows = df.sparkSession.read.parquet(staged)
    if not rows.groupBy(key).count().where(F.col("count") > 1).isEmpty():
        raise ValueError(f"primary key {key} is not unique")
    rows.write.mode("overwrite").parquet(path)


def first_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Within-batch duplicates: keep the first row per key in ``order``
    (``row_number() = 1``, planned as a pre-shuffle group limit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return batch.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def insert_if_absent(spark: SparkSession, batch: DataFrame, target_path: str, keys: Sequence[str],
                     order: Sequence[Column], columns: Sequence[str] | None = None) -> None:
    """Append rows whose key is not yet in the target (first wins inside
    the batch).  The target's file listing is taken before the append, so
    the anti join never sees the files being written."""
    new = first_per_key(batch, keys, order)
    if columns is not None:
        new = new.select(*columns)
    try:
        existing = spark.read.parquet(target_path).select(*keys)
        new = new.join(existing, list(keys), "left_anti")
    except AnalysisException as e:  # no target yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    new.write.mode("append").parquet(target_path)


def write_report(df: DataFrame, base: str, report_date, fmt: str = "csv") -> None:
    """Dated report under ``report_date=YYYY-MM-DD`` (parallel part files); a
    report of the same date is replaced, other dates stay."""
    out = df.withColumn("report_date", F.lit(report_date).cast("date") if not isinstance(report_date, Column)
                        else report_date.cast("date"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("report_date") \
        .option("header", True).format(fmt).save(base)


def listed_partitions(spark: SparkSession, base: str, column: str) -> list:
    """The values of a partition column, from the names of the files; no file
    is opened.  One value per partition comes to the driver; no folder: none."""
    try:
        files = spark.read.format("binaryFile").load(base)  # lists; contents are read only if selected
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [r[0] for r in files.select(column).distinct().collect()]


def latest_report(spark: SparkSession, base: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Open the newest report: its date is found in the listing, then only that
    partition is read."""
    full = T.StructType(list(schema.fields) + [T.StructField("report_date", T.DateType())])
    all_reports = spark.read.schema(full).option("header", True).format(fmt).load(base)
    dates = [d for d in listed_partitions(spark, base, "report_date") if d is not None]
    return all_reports.where(F.col("report_date") == F.lit(max(dates, default=None)).cast("date"))
