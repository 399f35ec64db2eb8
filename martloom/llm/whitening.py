"""Whitening of embeddings: rows on the principal components of their covariance, each with variance one.

The vectors become exact integers, their sums are exact, and the centred rows are an MLlib BlockMatrix of indexed rows.
Its transpose times itself is the scatter matrix, which is as large as the square of the dimension and comes to
the driver for the eigenvectors; the product with the matrix of these projects all rows.
"""

from __future__ import annotations

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martloom.llm.runtime import Scratch

#: Entries of this size and more have no exact integer and count as not finite.
LARGEST = float(1 << 43)
#: Rows of a block: at least and at most (64 MB at 128 dimensions).
ROWS = (1024, 65536)
#: Blocks whose names a driver can well keep; with more rows blocks are larger.
BLOCKS = 16_384
#: Row blocks of one task of the scatter product.
BLOCKS_A_TASK = 8
#: Eigenvalues up to this share of the largest count as zero.
RANK = 1e-12

SCHEMA = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def integers(embeddings: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """Columns vec_id and x: floor(1024 c) + 100000 of each entry, for the vectors with finite entries only."""
    rows = embeddings.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False)))
    return rows.filter((F.size("v") > 0) & fine).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * 1024).cast("bigint") + 100000).alias("x")
    )


def _numbered(kept: DataFrame) -> DataFrame:
    """The rows with an index from 0 without gaps; one count for each partition passes through the driver."""
    part, place = F.shiftright("id", 33), F.col("id").bitwiseAND((1 << 33) - 1)
    counts = sorted(kept.groupBy(part.alias("part")).count().collect())
    offsets, total = [], 0
    for number, count in counts:
        offsets.append((number, total))
        total += count
    table = kept.sparkSession.createDataFrame(offsets, "part bigint, before bigint")
    return kept.join(F.broadcast(table), part == F.col("part")).withColumn("index", F.col("before") + place).drop("part", "before", "id")


def _scatter(rows: BlockMatrix, blocks: int) -> np.ndarray:
    """Transpose times matrix. The rows' dimension is split, so that a task multiplies few blocks at a time."""
    splits = max(1, -(-blocks // BLOCKS_A_TASK))
    left, right = rows.transpose()._java_matrix_wrapper, rows._java_matrix_wrapper._java_model
    product = left.call("multiply", right, splits)
    return BlockMatrix(product, rows.colsPerBlock, rows.colsPerBlock).toLocalMatrix().toArray()


def _small(spark: SparkSession, matrix: np.ndarray, rows_per_block: int) -> BlockMatrix:
    """A matrix of the driver in blocks of rows."""
    blocks = []
    for b, first in enumerate(range(0, len(matrix), rows_per_block)):
        part = matrix[first : first + rows_per_block]
        blocks.append(((b, 0), DenseMatrix(*part.shape, part.ravel(order="F").tolist())))
    return BlockMatrix(spark.sparkContext.parallelize(blocks, len(blocks)), rows_per_block, matrix.shape[1], *matrix.shape)


def _deviation(x: Column, n: int, whole: Column, rest: Column) -> Column:
    """Sum of (n x - S) squared in longs; null beyond them."""
    each = F.transform(x, lambda v, i: F.try_subtract(F.try_multiply(F.lit(n), F.try_subtract(v, whole[i])), rest[i]))
    return F.aggregate(each, F.lit(0).cast("bigint"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))


def whiten(
    embeddings: DataFrame, scratch: Scratch, components: int = 8, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Rows of vec_id, component, n, deviation, whitened, explained and identity_error for each vector and component.

    Vectors that are null, empty, or hold a null, a NaN, an infinite entry or one of 2**43 and more are left out. Vectors
    must have one length; of several lengths the most frequent counts (of equally frequent the largest) and the others
    are left out. Repeated rows count as often as they occur and are returned each; other columns do not matter. The
    components are those of the covariance of the integers x, numbered from 1 by falling eigenvalue. For a
    component without variance (fewer rows than dimensions, equal rows) whitened is null and identity_error leaves it out; if
    there is no variance at all, explained and identity_error are null. deviation is null where it does
    not fit a long. No vectors give no rows.
    """
    spark = embeddings.sparkSession
    kept = scratch.keep(integers(embeddings, id_column, vector_column).withColumn("id", F.monotonically_increasing_id()), "integers")
    sizes = kept.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).head(2)
    if not sizes:
        return spark.createDataFrame([], SCHEMA)
    d = sizes[0]["d"]
    if len(sizes) > 1:
        kept = scratch.keep(kept.filter(F.size("x") == d).drop("id").withColumn("id", F.monotonically_increasing_id()), "integers")
    n = sizes[0]["count"]
    numbered = _numbered(kept)
    each = kept.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("s"))
    sums = [int(r["s"]) for r in sorted(each.collect())]
    whole = F.array(*[F.lit(s // n).cast("bigint") for s in sums])
    rest = F.array(*[F.lit(s % n).cast("bigint") for s in sums])
    part = F.array(*[F.lit(s % n / n) for s in sums])
    centred = F.transform("x", lambda v, i: (v - whole[i]).cast("double") - part[i])
    rows = numbered.select("index", array_to_vector(centred).alias("vector"))
    rows_per_block = min(max(ROWS[0], -(-n // BLOCKS)), ROWS[1])
    matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(rows, "vector"), n, d).toBlockMatrix(rows_per_block, min(d, ROWS[0]))
    # read three times; blocks that are lost with an executor are made again
    matrix.persist(StorageLevel.MEMORY_AND_DISK)
    covariance = _scatter(matrix, -(-n // rows_per_block)) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    k = min(components, d)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    trace = float(np.trace(covariance))
    real = (values > RANK * max(values[0], 0)) & (values > 0)
    scaled = np.where(real, vectors / np.sqrt(np.where(real, values, 1)), 0)
    projected = matrix.multiply(_small(spark, scaled, matrix.colsPerBlock)).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
    found = scratch.keep(found.select(F.col("index").alias("at"), vector_to_array("vector").alias("w")), "projected")
    matrix._java_matrix_wrapper.call("blocks").unpersist(False)

    told = [i for i in range(k) if real[i]]
    explained = F.array(*[F.lit(float(v) / trace if trace > 0 else None).cast("double") for v in values])
    known = F.array(*[F.lit(bool(r)) for r in real])
    joined = numbered.join(found, F.col("index") == F.col("at"))
    error = _identity_error(found, told)
    out = joined.select("vec_id", _deviation(F.col("x"), n, whole, rest).alias("deviation"), F.posexplode("w").alias("i", "w"))
    return out.select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        F.when(known[F.col("i")], F.col("w")).alias("whitened"), explained[F.col("i")].alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _identity_error(projected: DataFrame, told: list[int]) -> float | None:
    """Largest absolute entry of the covariance of the told components minus the identity."""
    if not told:
        return None
    means = projected.agg(*[F.avg(F.col("w")[i]) for i in told]).first()
    centred = dict(zip(told, [F.col("w")[i] - F.lit(m) for i, m in zip(told, means)]))
    pairs = [(i, j) for i in told for j in told if i <= j]
    found = projected.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Scratch(spark))
