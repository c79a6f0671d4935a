"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows per Arrow batch for operators that read whole texts. Spark's default of
#: 10,000 rows would hold over 1 GB of very long texts in one Python worker.
TEXT_BATCH_ROWS = 1000
#: Bytes of text that a worker processes at a time inside a batch.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lower (never raise) the session's Arrow batch size to TEXT_BATCH_ROWS."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > TEXT_BATCH_ROWS or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(TEXT_BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Where that is unset a temporary folder will do if the executors are this machine's
    (a local master, as in tests); on a cluster it is an error.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = tempfile.mkdtemp(prefix="skyweft-")
    return where.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` once to the shared folder and read it back.

    Unlike ``checkpoint()`` this runs the plan once, prunes columns on reread and
    survives the loss of any executor. The files stay until :func:`discard`, or until
    whoever owns the folder clears it: lazy results may read them at any later time.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/skyweft-{uuid.uuid4().hex}"


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames made by :func:`written` that no plan needs now."""
    for df in frames:
        spark = df.sparkSession
        jvm = spark._jvm
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/skyweft-" in path:
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def held_out(doc_id: str = "doc_id"):
    """crc32 of doc_id as text, mod 5, is 0. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def chunks(texts: list, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of whole texts of about ``most`` characters, one text at least."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        n = len(t) if t else 0
        if j > i and size + n > most:
            yield i, j
            i, size = j, 0
        size += n
    if i < len(texts):
        yield i, len(texts)


def map_text(
    df: DataFrame, text_col: str, keep: list[str], score: Callable[[list], dict], fields: list[tuple[str, T.DataType]]
) -> DataFrame:
    """``keep`` columns of ``df`` plus what ``score`` makes of its texts.

    ``score`` gets a list of texts (None for null) and returns one sequence per
    field. Rows never leave their partition; there is no shuffle.
    """
    small_batches(df.sparkSession)
    src = df.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text_col])])
    schema = T.StructType([*[src.schema[c] for c in keep], *[T.StructField(n, t) for n, t in fields]])
    names = [n for n, _ in fields]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for b in batches:
            texts = b.column(text_col).to_pylist()
            parts: dict[str, list] = {n: [] for n in names}
            for i, j in chunks(texts):
                for n, v in score(texts[i:j]).items():
                    parts[n].append(v)
            cols = [b.column(c).cast(arrow.field(c).type) for c in keep]
            for n in names:
                cols.append(_column(parts[n], arrow.field(n).type))
            yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return src.mapInArrow(run, schema)


def _column(parts: list, kind: pa.DataType) -> pa.Array:
    if parts and all(isinstance(p, pa.Array) for p in parts):
        return pa.concat_arrays(parts).cast(kind)
    if parts and all(isinstance(p, np.ndarray) for p in parts):
        return pa.array(np.concatenate(parts)).cast(kind)
    return pa.array([x for p in parts for x in p], type=kind)


def filter_text(df: DataFrame, text_col: str, keep: Callable[[list], np.ndarray]) -> DataFrame:
    """The rows of ``df``, all columns, whose text ``keep`` accepts. No shuffle."""
    small_batches(df.sparkSession)

    def run(batches):
        for b in batches:
            texts = b.column(text_col).to_pylist()
            mask = np.concatenate([np.zeros(0, bool), *[np.asarray(keep(texts[i:j]), bool) for i, j in chunks(texts)]])
            yield b.filter(pa.array(mask))

    return df.mapInArrow(run, df.schema)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, most_bytes: int, id_col: str = "doc_id", text_col: str = "text"
) -> list[tuple]:
    """(text, label) of a bounded sample of labelled, not held-out documents.

    The bound: ``per_class`` ids of each label value, the smallest by hash, and of
    those texts, in the same order, ``most_bytes`` of UTF-8 in all (a text over a
    twentieth of that is passed over). An id whose labels differ counts with the
    smallest. The label is one of two values or a few: of over 50 the smallest count.
    """
    lab = (
        labels.select(F.col(id_col).alias("id"), F.col(label).alias("y"))
        .where(F.col("id").isNotNull() & F.col("y").isNotNull() & ~held_out("id"))
        .groupBy("id")
        .agg(F.min("y").alias("y"))
        .withColumn("h", F.xxhash64(F.col("id"), F.lit(17)))
    )
    ys = [r[0] for r in lab.select("y").distinct().orderBy("y").limit(50).collect()]
    ids: dict = {}
    for y in ys:
        ids.update({r["id"]: (r["h"], y) for r in lab.where(F.col("y") == F.lit(y)).orderBy("h", "id").limit(per_class).collect()})
    return fetch_texts(docs, ids, most_bytes, id_col, text_col)


def fetch_texts(docs: DataFrame, ids: dict, most_bytes: int, id_col: str, text_col: str, each: dict | None = None) -> list[tuple]:
    """(text, label) of the documents in ``ids`` (id: (order, label)), within the bound.

    Lengths come to the driver first; texts only of the ids that the running sum of
    lengths, in order, lets in. With ``each`` (label: bytes) every label has a bound of
    its own, and its first text whatever that is.
    """
    spark = docs.sparkSession
    if not ids:
        return []
    kind = T.StructType([T.StructField("id", docs.schema[id_col].dataType)])
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).where(F.octet_length("t") <= most_bytes // 20)

    def of(wanted) -> DataFrame:
        # the wanted ids were bounded by the caller, so their broadcast is
        return d.join(F.broadcast(spark.createDataFrame([(i,) for i in wanted], kind)), "id", "left_semi").groupBy("id").agg(F.min("t").alias("t"))

    found = written(of(ids))
    sizes = {r["id"]: r["n"] for r in found.select("id", F.octet_length("t").alias("n")).collect()}
    spent: dict = {}
    chosen = []
    for i in sorted(sizes, key=lambda i: (ids[i][0], i)):
        y = ids[i][1] if each else None
        first = y not in spent
        spent[y] = spent.get(y, 0) + sizes[i]
        if spent[y] <= (each[y] if each else most_bytes) or (each and first):
            chosen.append(i)
    texts = {r["id"]: r["t"] for r in found.join(F.broadcast(spark.createDataFrame([(i,) for i in chosen], kind)), "id", "left_semi").collect()} if chosen else {}
    discard(found)
    return [(texts[i], ids[i][1]) for i in chosen]


def groups_by_length(lengths: np.ndarray, most_cells: int, most_rows: int = 512) -> Iterator[np.ndarray]:
    """Indices of non-empty sequences in groups of like length, longest first.

    A group's padded size stays under ``most_cells`` unless one sequence alone
    is longer.
    """
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    i = 0
    while i < len(order):
        n = max(1, min(most_rows, most_cells // int(lengths[order[i]])))
        yield order[i : i + n]
        i += n
