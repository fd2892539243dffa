"""Whitening of embeddings on MLlib block matrices.

Method: every number c becomes the whole number x = floor(1024 c) + 100000.
The rows, less their mean, are indexed 0, 1, ... and cut into distributed
blocks; the transposed matrix times the matrix is the scatter.  Its small
eigenproblem (as wide as a vector) is solved on the driver, and the row
blocks times the whitening matrix are the projected rows.

The product of the scatter is cut along the rows into parts of ``PART_BYTES``,
which are added up as they come, so no task holds more than one part.

Defined cases: vectors that are null, empty or hold null or non-finite numbers
(or numbers beyond +-2^42, which x can't hold exactly) take no part; vectors of
different lengths are spaces of their own, each whitened by itself; components without variance (and those beyond a vector's length) have null
``whitened`` or are absent, and don't count in ``identity_error``; repeated
rows and null vec_ids are rows like any other; no vectors, no rows;
``deviation`` is null where it is beyond a long.  Columns besides the named
ones are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.tables import stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
LARGEST = float(1 << 42)
BLOCK_ROWS = 1024        # least rows of a block
MOST_BLOCKS = 20_000     # a taller matrix has taller blocks
PART_BYTES = 2 << 20     # blocks that one task multiplies for the scatter
RANK_TOLERANCE = 1e-12   # share of the largest eigenvalue below which there is no variance

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def usable(vector: Column) -> Column:
    fine = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST)
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, fine), F.lit(False))


def indexed(rows: DataFrame, name: str = "index") -> DataFrame:
    """``rows`` with ``name`` = 0, 1, ...; ``rows`` must be a stored table.
    A partition's offset comes from the row counts of those before it."""
    at = rows.withColumn("_at", F.monotonically_increasing_id())
    at = stored(at.withColumn("_part", F.shiftright("_at", 33)), "whitening-places")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    offsets = at.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return at.join(F.broadcast(offsets), "_part").withColumn(
        name, F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_before")


def sums(rows: DataFrame, array: str) -> list[int]:
    """Exact sums of the entries of an array of longs."""
    each = rows.select(F.posexplode(array).alias("place", "x")).groupBy("place").agg(
        F.sum(F.col("x").cast("decimal(20,0)")).alias("s"))
    return [int(r.s) for r in each.orderBy("place").collect()]  # as many as a vector is long


def block_matrix(rows: DataFrame, index: str, vector: str, n: int, dims: int) -> BlockMatrix:
    tall = max(BLOCK_ROWS, -(-n // MOST_BLOCKS))
    two = rows.select(F.col(index).alias("index"), array_to_vector(F.col(vector)).alias("vector"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(two, "vector"), n, dims).toBlockMatrix(tall, dims)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """matrix' x matrix.  Cutting the long middle dimension is a parameter of
    MLlib's multiply that its Python wrapper doesn't pass on."""
    block_bytes = 8 * matrix.rowsPerBlock * matrix.colsPerBlock
    parts = max(1, matrix.numRowBlocks * block_bytes // PART_BYTES)
    own, other = matrix._java_matrix_wrapper._java_model, matrix.transpose()._java_matrix_wrapper._java_model
    product = BlockMatrix(other.multiply(own, int(parts)), matrix.colsPerBlock, matrix.colsPerBlock)
    return product.toLocalMatrix().toArray()


def principal(covariance: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1][:most]
    vectors = vectors[:, order]
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]
    return values[order], vectors * np.where(largest < 0, -1.0, 1.0)


def _identity_error(rows: DataFrame, array: str, k: int) -> float:
    """Largest entry of the covariance of the first k numbers less identity."""
    if not k:
        return 0.0
    means = rows.agg(*[F.avg(F.col(array)[i]) for i in range(k)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i + 1)]
    cov = rows.agg(*[F.avg((F.col(array)[i] - F.lit(means[i])) * (F.col(array)[j] - F.lit(means[j])))
                     for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))


def _whiten_space(rows: DataFrame, dims: int, n: int, most: int) -> DataFrame:
    """Rows (index, vec_id, x) of one length."""
    spark = rows.sparkSession
    total = sums(rows, "x")
    # x - S/n = (x - q) - r/n with whole numbers S = q n + r, so nothing is lost
    whole, rest = (F.lit(np.array(v, dtype=np.int64)) for v in zip(*(divmod(t, n) for t in total)))
    above = F.zip_with("x", whole, lambda x, q: x - q)
    scaled = F.zip_with("above", rest, lambda a, r: F.try_subtract(F.try_multiply(a, F.lit(n).cast("long")), r))
    centred = stored(rows.withColumn("above", above).select(
        "index", "vec_id",
        F.zip_with("above", rest, lambda a, r: a.cast("double") - r.cast("double") / F.lit(float(n))).alias("centred"),
        F.aggregate(scaled, F.lit(0).cast("long"), lambda acc, a: F.try_add(acc, F.try_multiply(a, a))
                    ).alias("deviation")), "whitening-centred")
    matrix = block_matrix(centred, "index", "centred", n, dims).persist(StorageLevel.DISK_ONLY)
    covariance = scatter(matrix) / n
    values, vectors = principal(covariance, most)
    trace = float(np.trace(covariance))
    rank = int(np.count_nonzero(values > RANK_TOLERANCE * max(values[0], 0.0))) if trace > 0 else 0
    columns = vectors[:, :rank] / np.sqrt(values[:rank])
    out = centred.select("index", "vec_id", "deviation")
    if rank:
        whitener = BlockMatrix(spark.sparkContext.parallelize(
            [((0, 0), DenseMatrix(dims, rank, columns.ravel(order="F").tolist()))], 1), matrix.colsPerBlock, rank)
        projected = matrix.multiply(whitener).toIndexedRowMatrix().rows.toDF(["index", "vector"])
        projected = stored(projected.select("index", vector_to_array(F.col("vector")).alias("whitened")),
                           "whitening-projected")
        out = out.join(projected, "index")
        error = _identity_error(projected, "whitened", rank)
        matrix._java_matrix_wrapper._java_model.blocks().unpersist(False)
    else:
        out, error = out.withColumn("whitened", F.array().cast("array<double>")), 0.0
    each = F.array(*[F.struct(F.lit(i + 1).alias("component"), F.get("whitened", F.lit(i)).alias("whitened"),
                              F.lit(float(e / trace) if trace > 0 and i < rank else 0.0).alias("explained"))
                     for i, e in enumerate(values)])
    return out.withColumn("c", F.explode(each)).select(
        "vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained",
        F.lit(float(error)).alias("identity_error"))


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row (``SCHEMA``) a vector and component."""
    numbers = F.transform(F.col(vector), lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("long") + SHIFT)
    rows = stored(embeddings.where(usable(F.col(vector))).select(
        F.col(vec_id).cast("long").alias("vec_id"), numbers.alias("x")), "whitening-rows")
    spaces = rows.groupBy(F.size("x").alias("dims")).agg(F.count(F.lit(1)).alias("n")).orderBy("dims").collect()
    out = None
    for dims, n in spaces:  # almost always one
        part = _whiten_space(indexed(rows.where(F.size("x") == dims)), dims, n, components)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else embeddings.sparkSession.createDataFrame([], SCHEMA)
