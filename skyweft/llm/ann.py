"""Approximate nearest neighbours by additive quantisation.

A vector is coded as the sum of one word from each of BOOKS codebooks of full
dimension, found by beam search; codebooks are k-means of the residuals left by those
before, fitted on a bounded sample (TRAIN_ROWS vectors, the smallest ids by hash).
With the sum's norm stored, the squared distance to a query is
|q|^2 + |sum|^2 - 2 (q . sum), and q . sum is a few look-ups in the query's table of
products with all words. The SHORTLIST best of a task's index rows (of each SEGMENT_BYTES
of vectors, if it has more), ties to the smaller id, are reranked by exact
double-precision distance.

All valid vectors are coded once and written to the shared folder. Queries come in
blocks of QUERY_BLOCK (a stated set against all rows), one after another: a block is
broadcast, each task scans its codes and keeps its ten best for each query, and the
results are added to a table before the next block comes. What the driver holds is one
block. The tasks' bests meet in one small shuffle.

Vectors that are null, zero, of another length than the sample's most common one, or
that hold null or non-finite components take no part, nor do rows with a null id. A
query's own id is no candidate; other rows with equal vectors are. A query id that
repeats is asked once, with its smallest vector. Fewer candidates than k give fewer
rows; an empty table, or one without a valid vector, gives none.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyweft.llm.common import discard, exists, scratch, table, written

#: Production parameters.
BOOKS, WORDS, BEAM, ROUNDS = 32, 128, 2, 8
TRAIN_ROWS = 8192
NEAREST, SHORTLIST = 10, 256
QUERY_BLOCK = 4096
QUERY_EVERY = 100
#: Rows of the index scored at a time against a block.
RUN_ROWS = 2048
#: Bytes of vectors that a task holds at a time, as a run with one shortlist a query.
SEGMENT_BYTES = 64 << 20
SEED = 11


def valid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    v = F.col(vec_col)
    inf = float("inf")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists(v, lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("id"), v.cast("array<double>").alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(fine, F.lit(False)))


class Quantiser:
    """Codebooks [BOOKS, WORDS, dimension]."""

    def __init__(self, books: np.ndarray):
        self.books = books
        self.squares = (books**2).sum(2)

    def encode(self, x: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the rows of x by beam search, and the squared norms of their sums."""
        n = len(x)
        codes = np.zeros((n, 1, len(self.books)), np.uint8)
        rest = x[:, None, :].astype(np.float32)
        rows = np.arange(n)[:, None]
        for m, words in enumerate(self.books):
            # |r - c|^2 of every beam entry and word
            d = (rest**2).sum(2)[:, :, None] - 2 * rest @ words.T + self.squares[m]
            flat = d.reshape(n, -1)
            keep = min(beam, flat.shape[1])
            best = np.argpartition(flat, keep - 1, axis=1)[:, :keep]
            entry, word = best // len(words), best % len(words)
            codes = codes[rows, entry]
            codes[:, :, m] = word
            rest = rest[rows, entry] - words[word]
        best = (rest**2).sum(2).argmin(1)
        codes = codes[np.arange(n), best]
        return codes, (self.decode(codes) ** 2).sum(1)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return sum(self.books[m][codes[:, m]] for m in range(len(self.books)))

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Products of queries with all words: [BOOKS, WORDS, queries]."""
        return np.einsum("mwd,qd->mwq", self.books, q.astype(np.float32), optimize=True)


def fit(x: np.ndarray, books: int = BOOKS, words: int = WORDS) -> Quantiser:
    """Residual k-means: each codebook on what the earlier ones leave."""
    rng = np.random.default_rng(SEED)
    rest, out = x.astype(np.float32), []
    for _ in range(books):
        centres = rest[rng.permutation(len(rest))[:words]]
        if len(centres) < words:
            centres = np.concatenate([centres, np.zeros((words - len(centres), rest.shape[1]), np.float32)])
        for _ in range(ROUNDS):
            near = ((centres**2).sum(1) - 2 * rest @ centres.T).argmin(1)
            count = np.bincount(near, minlength=words)
            total = np.zeros_like(centres)
            np.add.at(total, near, rest)
            centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres).astype(np.float32)
        near = ((centres**2).sum(1) - 2 * rest @ centres.T).argmin(1)
        rest = rest - centres[near]
        out.append(centres)
    return Quantiser(np.stack(out))


def sample(good: DataFrame) -> np.ndarray:
    rows = [r["v"] for r in good.orderBy(F.xxhash64("id", F.lit(SEED)), "id", "v").limit(TRAIN_ROWS).collect()]
    if not rows:
        return np.zeros((0, 0))
    size = Counter(map(len, rows)).most_common()
    dim = min(d for d, n in size if n == size[0][1])
    return np.array([r for r in rows if len(r) == dim])


def index(good: DataFrame, quantiser, dim: int) -> DataFrame:
    """id, v, code and norm of every valid vector; no shuffle."""

    def run(batches):
        for b in batches:
            x = _matrix(b.column("v"), dim)
            for i in range(0, len(x), 4096):
                codes, norms = quantiser.value.encode(x[i : i + 4096])
                part = b.slice(i, 4096)
                code = pa.FixedSizeListArray.from_arrays(pa.array(codes.reshape(-1)), codes.shape[1]).cast(pa.list_(pa.int16()))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), code, pa.array(norms.astype(np.float32))], names=["id", "v", "code", "norm"])

    return good.where(F.size("v") == dim).mapInArrow(run, "id long, v array<double>, code array<short>, norm float")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def search(indexed: DataFrame, quantiser, shared, k: int = NEAREST, shortlist: int = SHORTLIST) -> DataFrame:
    """query_id, vec_id, score: each task's best k for each query of one broadcast block."""

    def run(batches):
        qid, q = shared.value
        tables = quantiser.value.tables(q)
        found = (np.full((len(q), k), np.inf), np.full((len(q), k), np.iinfo(np.int64).max))
        for ids, v, codes, norms in segments(batches, q.shape[1], tables.shape[0]):
            found = best(found, qid, q, tables, ids, v, codes, norms, k, shortlist)
        dist, who = found
        row, col = np.nonzero(np.isfinite(dist))
        yield pa.RecordBatch.from_arrays([pa.array(qid[row]), pa.array(who[row, col]), pa.array(dist[row, col])], names=["query_id", "vec_id", "score"])

    return indexed.mapInArrow(run, "query_id long, vec_id long, score double")


def segments(batches, dim: int, books: int):
    """Index rows of a task in runs of SEGMENT_BYTES of vectors, each by id."""
    most = max(RUN_ROWS, SEGMENT_BYTES // (8 * dim))
    held: list = []
    size = 0

    def whole():
        ids, v, codes, norms = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(ids, kind="stable")
        return ids[order], v[order], codes[order], norms[order]

    for b in batches:
        held.append((b.column("id").to_numpy(), _matrix(b.column("v"), dim), _matrix(b.column("code"), books), b.column("norm").to_numpy()))
        size += b.num_rows
        if size >= most:
            yield whole()
            held, size = [], 0
    if size:
        yield whole()


def best(found: tuple, qid: np.ndarray, q: np.ndarray, tables: np.ndarray, ids: np.ndarray, v: np.ndarray, codes: np.ndarray, norms: np.ndarray, k: int, shortlist: int) -> tuple:
    """The k best so far and of one segment (by id) for each query: the ``shortlist``
    best by code score, ties to the smaller id, by exact distance."""
    score = np.zeros((len(q), 0), np.float32)
    place = np.zeros((len(q), 0), np.int64)
    for i in range(0, len(ids), RUN_ROWS):
        run = slice(i, i + RUN_ROWS)
        products = np.zeros((len(ids[run]), len(q)), np.float32)
        for m in range(tables.shape[0]):
            products += tables[m][codes[run, m]]
        now = (norms[run, None] - 2 * products).T
        now[ids[None, run] == qid[:, None]] = np.inf
        score = np.concatenate([score, now], axis=1)
        place = np.concatenate([place, np.broadcast_to(np.arange(i, i + now.shape[1]), now.shape)], axis=1)
        if score.shape[1] > shortlist:
            # all below the last score that fits; of those that equal it the first, by id
            cut = np.partition(score, shortlist - 1, axis=1)[:, shortlist - 1 : shortlist]
            under, equal = score < cut, score == cut
            chosen = under | (equal & (np.cumsum(equal, axis=1) <= shortlist - under.sum(1, keepdims=True)))
            score, place = (a[chosen].reshape(len(q), shortlist) for a in (score, place))
    exact = np.empty(place.shape)
    step = max(1, (1 << 22) // max(1, place.shape[1] * q.shape[1]))
    for i in range(0, len(q), step):
        exact[i : i + step] = np.sqrt(((v[place[i : i + step]] - q[i : i + step, None, :]) ** 2).sum(2))
    dist = np.concatenate([found[0], np.where(ids[place] == qid[:, None], np.inf, exact)], axis=1)
    who = np.concatenate([found[1], ids[place]], axis=1)
    order = np.lexsort((who, dist), axis=1)[:, :k]
    return np.take_along_axis(dist, order, 1), np.take_along_axis(who, order, 1)


def query_blocks(good: DataFrame, dim: int, every: int = QUERY_EVERY):
    """Blocks of (ids, vectors) of the query set, in no order."""
    rows = good.where((F.col("id") % every == 0) & (F.size("v") == dim)).groupBy("id").agg(F.min("v").alias("v"))
    ids, vectors = [], []
    for r in rows.toLocalIterator():
        ids.append(r["id"])
        vectors.append(r["v"])
        if len(ids) == QUERY_BLOCK:
            yield np.array(ids), np.array(vectors)
            ids, vectors = [], []
    if ids:
        yield np.array(ids), np.array(vectors)


RESULT = "query_id long, rank int, vec_id long, score double"


def nearest(vectors: DataFrame, every: int = QUERY_EVERY, k: int = NEAREST, shortlist: int = SHORTLIST, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found, nearest first."""
    spark = vectors.sparkSession
    good = valid(vectors, id_col, vec_col)
    train = sample(good)
    if not len(train):
        return spark.createDataFrame([], RESULT)
    quantiser = spark.sparkContext.broadcast(fit(train))
    dim = train.shape[1]
    indexed, path = written(index(good, quantiser, dim)), scratch(spark)
    for block in query_blocks(good, dim, every):
        shared = spark.sparkContext.broadcast(block)
        search(indexed, quantiser, shared, k, shortlist).write.mode("append").parquet(path)
        shared.destroy()
        del block
    discard(indexed)
    if not exists(spark, path):
        return spark.createDataFrame([], RESULT)
    every_part = spark.read.schema("query_id long, vec_id long, score double").parquet(path)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return every_part.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


QUERIES = {"op8_ann": op8_ann}
ORACLES: dict[str, str] = {}
