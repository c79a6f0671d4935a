"""Whitening of embeddings by distributed block matrices.

Vectors become whole numbers, floor(256 c). The covariance is that of the fit list, each
distinct vector once: its centred rows are indexed into an MLlib BlockMatrix, whose
transpose times itself is the scatter matrix. That is of the vectors' dimension and is taken
apart on the driver; the leading unit eigenvectors over the roots of their eigenvalues
are the whitening matrix, and the block matrix of all centred rows times it projects them.

Row indices are dense and come of tables that are written first, so that a lost
executor's rows are made again under the same numbers. The scatter's products are dealt out
over several tasks by row blocks (``multiply`` with splits of the inner dimension), and
only sums of the dimension squared meet. Copies of a vector fall together before the
shuffle of the fit list and are rows of their own in the projection, so none is a hot key.

Vectors that are null, empty or hold null or non-finite entries are dropped, and so are
those of another length than most have (of ties, the longer). Rows with a null id stay.
Repeated rows are projected each. Components whose eigenvalue is rounding (under RANK of
the greatest) are left out: a table without two different vectors gives no rows, nor does an
empty one. A vector's signs are such that an eigenvector's entry of greatest size is
positive. Whole-number arithmetic that leaves 64 bits is an error, not a wrong figure. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from skyweft.llm.common import table, written

#: Production parameters.
SCALE, COMPONENTS = 256, 4
#: Rows and columns of a block.
BLOCK_ROWS, BLOCK_COLS = 1024, 1024
#: Row blocks that one product of the scatter takes, about.
BLOCKS_A_SPLIT = 8
#: Share of the greatest eigenvalue that counts as none.
RANK = 1e-12


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id and x, the vectors as whole numbers, of the rows that take part."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where(F.coalesce(fine & (F.size("v") > 0), F.lit(False)))
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long"))
    return rows.select("id", x.alias("x"), F.size("v").alias("dim"))


def numbered(rows: DataFrame) -> DataFrame:
    """``rows``, written, with a dense index ``i`` from 0.

    Tasks number their rows as they write them; how many each wrote, one number a task, comes
    to the driver and goes out again as where each begins.
    """
    kept = written(rows.withColumn("__k", F.monotonically_increasing_id()))
    task = F.shiftright("__k", 33)
    counts = sorted((r["task"], r["n"]) for r in kept.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect())
    begins, at = [], 0
    for k, n in counts:
        begins.append((k, at))
        at += n
    begin = F.broadcast(rows.sparkSession.createDataFrame(begins, "__task long, __begin long"))
    return kept.join(begin, task == F.col("__task")).select(*rows.columns, (F.col("__begin") + F.col("__k").bitwiseAND(F.lit((1 << 33) - 1))).alias("i"))


def block_matrix(rows: DataFrame, mean: np.ndarray, n: int) -> BlockMatrix:
    """The centred rows x - mean at their indices, in distributed blocks."""
    centred = F.transform("x", lambda c, k: c.cast("double") - F.get(F.lit(mean.tolist()), k))
    vectors = rows.select(F.col("i").alias("index"), array_to_vector(centred).alias("vector"))
    m = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, len(mean))
    return m.toBlockMatrix(BLOCK_ROWS, min(BLOCK_COLS, len(mean)))


def scatter(m: BlockMatrix, n: int) -> np.ndarray:
    """The transpose of ``m`` times ``m``. The inner dimension's blocks are dealt out."""
    splits = max(1, -(-n // (BLOCK_ROWS * BLOCKS_A_SPLIT)))
    t = m.transpose()
    java = t._java_matrix_wrapper.call("multiply", m._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, t.rowsPerBlock, m.colsPerBlock).toLocalMatrix().toArray()


def local_blocks(spark: SparkSession, a: np.ndarray) -> BlockMatrix:
    """A small matrix as a block matrix of row blocks of BLOCK_COLS."""
    from pyspark.mllib.linalg import Matrices

    step = min(BLOCK_COLS, len(a))
    parts = [((k, 0), Matrices.dense(*a[b : b + step].shape, a[b : b + step].ravel("F").tolist())) for k, b in enumerate(range(0, len(a), step))]
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), step, a.shape[1], *a.shape)


@dataclass
class Whitening:
    """What a fit list gives: counts, sums, eigenvalues and the whitening matrix."""

    n: int
    sums: list[int]
    values: np.ndarray
    matrix: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of ``x`` (all of one length); None if there is none."""
    spark = x.sparkSession
    listed = numbered(x.select("x").distinct())
    sums = {r["k"]: (r["s"], r["n"]) for r in listed.select(F.posexplode("x").alias("k", "c")).groupBy("k").agg(F.sum("c").alias("s"), F.count("*").alias("n")).collect()}
    if not sums:
        return None
    n = sums[0][1]
    out = Whitening(n, [sums[k][0] for k in range(len(sums))], *[np.zeros(0)] * 3, 0.0)
    m = block_matrix(listed, out.mean, n).persist(StorageLevel.MEMORY_AND_DISK)  # read by two products; lost blocks are made again
    values, vectors = np.linalg.eigh(scatter(m, n) / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = min(components, int((values > RANK * max(values[0], 0.0)).sum()) if values[0] > 0 else 0)
    if not keep:
        return None
    top = np.abs(vectors).argmax(0)
    vectors = vectors * np.where(vectors[top, np.arange(len(top))] < 0, -1.0, 1.0)
    out.values, out.matrix = values[:keep], vectors[:, :keep] / np.sqrt(values[:keep])
    out.explained = values[:keep] / values.sum()
    white = m.multiply(local_blocks(spark, out.matrix))
    out.identity_error = float(np.abs(scatter(white, n) / n - np.eye(keep)).max())
    m._java_matrix_wrapper._java_model.blocks().unpersist(False)
    return out


def project(rows: DataFrame, w: Whitening) -> DataFrame:
    """``i`` and ``whitened``, an array of the components, of each numbered row."""
    n = rows.count()
    m = block_matrix(rows, w.mean, n).multiply(local_blocks(rows.sparkSession, w.matrix))
    back = callMLlibFunc("getIndexedRows", m.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return back.toDF("i", "v").select("i", vector_to_array("v").alias("whitened"))


COLUMNS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each vector that takes part and each component, numbered from 1."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, id_col, vec_col)
    dims = [r["dim"] for r in rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()]
    kind = vectors.schema[id_col].dataType.simpleString()
    empty = spark.createDataFrame([], f"`{id_col}` {kind}, {COLUMNS}")
    if not dims:
        return empty
    rows = numbered(rows.where(F.col("dim") == dims[0]).drop("dim"))
    w = fit(rows, components)
    if w is None:
        return empty
    sums = F.lit(w.sums)
    off = lambda c, k: c * F.lit(w.n).cast("long") - F.get(sums, k)
    deviation = F.aggregate(F.transform("x", off), F.lit(0).cast("long"), lambda a, d: a + d * d)
    told = rows.select("i", "id", deviation.alias("deviation")).join(project(rows, w), "i")
    out = told.select(F.col("id").alias(id_col), "deviation", F.posexplode("whitened").alias("k", "whitened"))
    n, error = F.lit(w.n).cast("long"), F.lit(w.identity_error)
    return out.select(
        f"`{id_col}`", (F.col("k") + 1).alias("component"), n.alias("n"), "deviation", "whitened", F.get(F.lit(w.explained.tolist()), F.col("k")).alias("explained"), error.alias("identity_error")
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op12_whitening": op12_whitening}
ORACLES: dict[str, str] = {}
