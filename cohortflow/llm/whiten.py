"""Embedding whitening on MLlib block matrices.

Entries c become integers x = floor(64 c) + 1000000.  The fit list is each
different x vector once: n vectors with sums S per dimension.  Its rows, centred
as (n x - S) / n from exact integers, are indexed and laid out as a BlockMatrix A
of ``BLOCK`` rows a block.

1. Scatter: transpose of A times A, block products spread over the row blocks and
   summed per result block; V = scatter / n comes to the driver (d x d numbers).
2. A local eigh gives unit eigenvectors, by falling eigenvalue.
3. The whitening matrix (first ``components`` eigenvectors over the roots of their
   eigenvalues) is a BlockMatrix too; all rows of the table, laid out in the same
   way, times it are the projections.
4. The projected fit list times itself checks the covariance against the identity.

Nothing but d x d and d x components numbers reaches the driver.  A task holds
``SPLIT`` blocks; copies are one row of the fit list, reduced before its shuffle.

Rows whose vector is null or holds null, non-finite or too large entries (beyond
2^40, where x is no longer exact) are dropped, and so are vectors whose length
is not the table's most frequent one (ties: the longer), and empty vectors.  A
null id keeps its row; repeated rows each get theirs.  A component without
variance (as all, if n is 1) gives 0 and is left out of identity_error.  Empty
table, or no usable vector: no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortflow.llm.common import col, materialize

COMPONENTS = 16
BLOCK = 1024
#: Row blocks of a scatter task.
SPLIT = 4
LARGEST = float(1 << 40)


def usable_rows(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): the integer vectors of the rows that take part."""
    rows = df.select(col(id_col).alias("vec_id"), col(vector_col).cast("array<double>").alias("c"))
    fits = F.forall("c", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) <= LARGEST))
    rows = rows.where(F.col("c").isNotNull() & (F.size("c") > 0) & F.coalesce(fits, F.lit(False)))
    lengths = rows.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size("c") == (lengths["d"] if lengths else 0))
    return rows.select("vec_id", F.transform("c", lambda e: F.floor(e * 64).cast("long") + 1_000_000).alias("x"))


def indexed(df: DataFrame) -> DataFrame:
    """``df`` written with an index 0, 1, 2... (``i``)."""
    df = materialize(df.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("at", 33)
    sizes = sorted(df.groupBy(part.alias("p")).count().collect())  # one number a task
    before = np.cumsum([0, *(r["count"] for r in sizes)])
    starts = df.sparkSession.createDataFrame([(r["p"], int(b)) for r, b in zip(sizes, before)], "p long, b long")
    # a row a partition: bounded by the number of tasks that wrote df
    out = df.withColumn("p", part).join(F.broadcast(starts), "p")
    return out.withColumn("i", F.col("b") + F.col("at") - F.shiftleft("p", 33)).drop("p", "b", "at")


def _centred(x: str, sums: list[int], n: int) -> Column:
    """n x - S, exact."""
    return F.zip_with(x, F.array(*(F.lit(s).cast("long") for s in sums)), lambda a, s: a * n - s)


def _blocks(rows: DataFrame, vector: Column, n: int, d: int) -> BlockMatrix:
    got = rows.select("i", array_to_vector(vector).alias("v"))
    return IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(got, "v"), n, d).toBlockMatrix(BLOCK, BLOCK)


def _gram(a: BlockMatrix) -> np.ndarray:
    """Transpose times itself: products of ``SPLIT`` row blocks a task (the
    public call would multiply all row blocks of a result block in one)."""
    wrapped = a._java_matrix_wrapper
    splits = -(-a.numRowBlocks // SPLIT)
    product = BlockMatrix(wrapped._java_model.transpose().multiply(wrapped._java_model, splits), a.colsPerBlock, a.colsPerBlock)
    return product.toLocalMatrix().toArray()


def _rows_of(product: BlockMatrix) -> DataFrame:
    """(i, v array<double>) of a product, without a pass through Python."""
    got = callMLlibFunc("getIndexedRows", product.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    got = MLUtils.convertVectorColumnsToML(got, "vector")
    return got.select(F.col("index").alias("i"), vector_to_array("vector").alias("v"))


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component (1 ... at most ``components``): vec_id,
    component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    rows = indexed(usable_rows(df, id_col, vector_col))
    fit = indexed(rows.select("x").distinct())
    n = fit.count()
    kind = rows.schema["vec_id"].dataType.simpleString()
    if not n:
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    sums = [r["s"] for r in fit.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").collect()]
    d, total = len(sums), rows.count()
    centred = _centred("x", sums, n)
    unit = F.transform(centred, lambda e: e.cast("double") / float(n))
    a = _blocks(fit, unit, n, d)
    e, vectors = np.linalg.eigh(_gram(a) / n)
    k = min(components, d)
    e, vectors, trace = e[::-1][:k], vectors[:, ::-1][:, :k], max(float(e.sum()), 0.0)
    real = e > 1e-12 * trace if trace else np.zeros(k, bool)
    matrix = np.where(real, vectors / np.sqrt(np.where(real, e, 1.0)), 0.0)
    small = spark.createDataFrame([(j, r) for j, r in enumerate(matrix.tolist())], "i long, r array<double>")
    w = _blocks(small, F.col("r"), d, k)
    covariance = _gram(a.multiply(w)) / n
    error = float(np.abs(covariance - np.eye(k))[np.ix_(real, real)].max(initial=0.0))
    projected = _rows_of(_blocks(rows, unit, total, d).multiply(w))
    deviation = F.aggregate(centred, F.lit(0).cast("long"), lambda s, v: s + v * v)
    kept = rows.select("i", "vec_id", deviation.alias("deviation"))
    shares = F.array(*(F.lit(float(max(v, 0.0) / trace) if trace else 0.0) for v in e))
    out = kept.join(projected, "i").select("vec_id", "deviation", F.posexplode("v").alias("j", "whitened"))
    return out.select(
        "vec_id", (F.col("j") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("j")).alias("explained"), F.lit(error).alias("identity_error"),
    )
