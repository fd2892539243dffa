"""Shared folder and intermediate tables of the training-data operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from kestrel.session import shared_path

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of the jobs run inside go when each job ends (their result
    is a written table, so nothing reads them again)."""
    old = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, old)


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back:
    lineage ends there and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    with freed_shuffles(spark):
        df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
