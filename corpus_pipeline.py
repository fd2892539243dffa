"""A corpus through five stages, each over all that the stage before it kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``; all stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm import lines, packing, quality, secrets, simhash
from kestrel.llm.queries import fertility_vocabularies, table, vocabulary
from kestrel.llm.tables import stored


def by_row(docs: DataFrame, name: str) -> DataFrame:
    """(row, doc): every row of ``docs`` as a struct with a stored number."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), whole), name, "snappy")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the fertility rules reject go."""
    rows = by_row(docs, "quality-rows")
    rated = quality.rate(rows.select("row", "doc.text", "doc.lang"), fertility_vocabularies(), doc_id="row")
    gone = rated.where(~F.col("kept")).select(F.col("doc_id").alias("row"))
    return rows.join(gone, "row", "left_anti").select("doc.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, but for the first of each class; so does a document
    that loses lines and has none of its own left (a copy of others).  What
    is left of lines that count is unique or the first of its class."""
    kept = lines.drop_repeated(docs, one_edit_chars=lines.ONE_EDIT_CHARS)
    own = (F.size("removed") == 0) | F.exists(F.split("doc.text", "\n"), lambda line: lines.counts(line))
    return kept.where(own).select("doc.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: one with the smallest
    doc_id (rows without one come last).  Groups are of rows, so different
    texts under one doc_id are apart, and so are rows without a doc_id."""
    rows = by_row(docs, "near-rows")
    groups = simhash.near_duplicates(rows.select("row", "doc.text"), doc_id="row").select(
        F.col("doc_id").alias("row"), "component_id")
    place = F.struct(F.col("doc.doc_id").isNull(), F.col("doc.doc_id"), F.col("row").alias("row"))
    first = rows.select("row", place.alias("place")).join(groups, "row").groupBy("component_id").agg(
        F.min("place").alias("first")).select("first.row")
    return rows.join(first, "row", "left_semi").select("doc.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked; all documents stay."""
    return secrets.mask(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scan),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"), "snappy")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL expresses neither the tokenisers nor the components; tests hold the
#: stages against brute force.
ORACLE_SQL = None
