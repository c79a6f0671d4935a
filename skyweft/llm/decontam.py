"""Benchmark decontamination: broadcast n-gram set, scan, verify, remove.

Texts are lower-cased (A-Z only) and cut into words: runs of digits, ASCII letters
and all other characters from U+0080. A benchmark item's windows are its runs of
``n`` consecutive words; an item of fewer words, but not none, is one window. The
windows' rolling hashes are broadcast; each document's windows are hashed the same
way, looked up and verified word by word. Every word inside an occurrence is hit.

The broadcast's bound is checked: items are cut into blocks of ``block_bytes`` of
text, one of which is on the driver at a time. A benchmark within the bound is one pass
without a shuffle. Each further block is a pass that reads the texts and gives only what it
hits: a text's hash of 128 bits, spans and items. These meet the documents once, by hash;
no text is written or moved for a block, and equal texts are one row there.

A null or empty text has no words and is clean. Items without words (null too)
have no windows. Equal rows give equal results; an item_id in several rows is one
item; the windows of items with a null id count, the id does not. With an empty
benchmark every document is clean; an empty table of documents gives no rows. Texts are
read whole, a very long one alone (about ten bytes of memory a byte). Other columns are
ignored or, in :func:`remove`, passed on, whatever their names.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.llm.common import chunks, map_text, small_batches, table, written

#: Production parameters.
WINDOW = 10
BLOCK_BYTES = 4 << 20
#: In :func:`remove`, the share of hit words above which a document goes whole.
WHOLE_SHARE = 0.5

#: A-Z to a-z, other ASCII outside 0-9 and a-z to a space; the rest stays.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


class Index:
    """Distinct windows of one block of items, by length, and whose they are."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], n: int):
        self.items = items
        found: dict[int, list[tuple[int, int]]] = {}
        for i, (_, w) in enumerate(items):
            size = min(n, len(w))
            if size:
                found.setdefault(size, []).extend((i, k) for k in range(len(w) - size + 1))
        self.by_length = []
        for size, at in sorted(found.items()):
            flat = [w for i, k in at for w in items[i][1][k : k + size]]
            h = rolling(hashes(flat), size)[::size]
            maybe = np.zeros(1 << 22, bool)
            maybe[h >> np.uint64(42)] = True
            self.by_length.append((size, *self._distinct(size, h, at), maybe))

    def _distinct(self, size: int, h: np.ndarray, at: list[tuple[int, int]]) -> tuple[np.ndarray, list, list]:
        """Hashes of the distinct windows in order, a place of each and its items."""
        order = np.argsort(h, kind="stable")
        known = h[order]
        cuts = np.flatnonzero(np.concatenate([[True], known[1:] != known[:-1], [True]])).tolist()
        hash_of, place, owners = [], [], []
        for a, b in zip(cuts, cuts[1:]):
            if b - a == 1:
                i, k = at[order[a]]
                hash_of.append(a)
                place.append((i, k))
                owners.append((i,))
                continue
            same: dict[tuple, tuple[tuple[int, int], set]] = {}
            for x in order[a:b].tolist():
                i, k = at[x]
                same.setdefault(tuple(self.items[i][1][k : k + size]), (at[x], set()))[1].add(i)
            for first, mine in same.values():
                hash_of.append(a)
                place.append(first)
                owners.append(tuple(mine))
        return known[hash_of], place, owners

    def scan(self, docs: list[list[bytes]]) -> dict[int, tuple[list[tuple[int, int]], set]]:
        """Of the documents with hits: (start, end) words of each hit and item numbers."""
        flat = [w for d in docs for w in d]
        lengths = np.fromiter(map(len, docs), np.int64, len(docs))
        ends = np.cumsum(lengths)
        h = hashes(flat)
        out: dict[int, tuple[list, set]] = {}
        for size, known, place, owners, maybe in self.by_length:
            if len(flat) < size:
                continue
            r = rolling(h, size)
            start = np.flatnonzero(maybe[r >> np.uint64(42)])
            lo = np.searchsorted(known, r[start], "left")
            hi = np.searchsorted(known, r[start], "right")
            doc = np.searchsorted(ends, start, "right")
            ok = (hi > lo) & (start + size <= ends[np.minimum(doc, len(ends) - 1)])
            met: dict[int, set] = {}
            for s, d, a, b in zip(start[ok].tolist(), doc[ok].tolist(), lo[ok].tolist(), hi[ok].tolist()):
                for x in range(a, b):
                    i, k = place[x]
                    if self.items[i][1][k : k + size] == flat[s : s + size]:
                        first = s - int(ends[d] - lengths[d])
                        out.setdefault(d, ([], set()))[0].append((first, first + size))
                        met.setdefault(d, set()).add(x)
                        break
            for d, windows in met.items():
                out[d][1].update(i for x in windows for i in owners[x])
        return out


def hashes(words: list[bytes]) -> np.ndarray:
    """Of this process only: Python's hash differs between processes."""
    return np.fromiter(map(hash, words), np.int64, len(words)).astype(np.uint64) * _MULT


def rolling(h: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(max(0, len(h) - size + 1), np.uint64)
    for k in range(size):
        out *= np.uint64(0x100000001B3)
        out += h[k : k + len(out)]
    return out * _MULT


def union(spans: list[tuple[int, int]]) -> list[int]:
    """Start and end of each maximal hit run, flat."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


#: The index of one block, by a key that is never used again (an address may recur).
_WORKER: dict = {}


def _index(key, items, n: int) -> Index:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Index(items.value, n)
    return _WORKER[key]


def blocks(bench: DataFrame, block_bytes: int, id_col: str = "item_id", text_col: str = "text"):
    """Lists of (item id, words), each of ``block_bytes`` of text or one item."""
    rows = bench.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("t is not null")
    block, size = [], 0
    for r in rows.toLocalIterator():
        n = len(r["t"].encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((r["i"], words_of(r["t"])))
        size += n
    if block:
        yield block


_KINDS = [("n_words", T.LongType()), ("hits", T.ArrayType(T.IntegerType())), ("items", T.ArrayType(T.StringType()))]
#: A text's hash and what is hit of it: names that no table is likely to have.
_A, _B, _HITS, _ITEMS = "__skyweft_a", "__skyweft_b", "__skyweft_hits", "__skyweft_items"


def _hashed(df: DataFrame, text_col: str) -> DataFrame:
    """Adds 128 bits of the text. One that is null has some too, but is never hit."""
    text = F.col(f"`{text_col}`")
    return df.withColumns({_A: F.xxhash64(text), _B: F.xxhash64(F.lit(29), text, F.octet_length(text))})


def scan(docs: DataFrame, bench: DataFrame, n: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, n_words, n_hit, hits (start, end, start, end ... in words) and item ids of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema

    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rest = blocks(bench, block_bytes)
    score = _scores(docs.sparkSession, next(rest, []), n)
    more = _found(src, "text", rest, n)
    if more is None:
        df = map_text(src, "text", ["id"], score, _KINDS)
    else:
        df = map_text(_hashed(src, "text"), "text", ["id", _A, _B], score, _KINDS).join(more, [_A, _B], "left").drop(_A, _B)
        schema = T.StructType([f for f in df.schema if f.name not in (_HITS, _ITEMS)])
        df = df.mapInArrow(_added(to_arrow_schema(schema)), schema)
    pairs = F.sequence(F.lit(0), F.size("hits") - 2, F.lit(2))
    n_hit = F.when(F.size("hits") > 0, F.aggregate(pairs, F.lit(0).cast("long"), lambda a, i: a + F.get("hits", i + 1) - F.get("hits", i)))
    return df.select(F.col("id").alias(id_col), "n_words", F.coalesce(n_hit, F.lit(0).cast("long")).alias("n_hit"), "hits", "items")


def _scores(spark: SparkSession, block: list, n: int):
    """For ``map_text``: the number of words, hit spans and item ids of each text."""
    key, items = uuid.uuid4().hex, spark.sparkContext.broadcast(block)

    def score(texts: list) -> dict:
        index = _index(key, items, n)
        docs = [words_of(t) for t in texts]
        hits, names = [[] for _ in docs], [[] for _ in docs]
        for d, (spans, hit) in index.scan(docs).items():
            hits[d] = union(spans)
            names[d] = sorted({index.items[k][0] for k in hit if index.items[k][0] is not None})
        return {"n_words": np.fromiter(map(len, docs), np.int64, len(docs)), "hits": hits, "items": names}

    return score


def _found(docs: DataFrame, text_col: str, rest, n: int) -> DataFrame | None:
    """Hash, hits and item ids of the texts that any block of ``rest`` hits, a row a text;
    spans and items of different blocks follow each other. None without a block.

    What a block hits is written before the next block is read.
    """
    texts = _hashed(docs.select(F.col(f"`{text_col}`").alias("text")).where("text is not null"), "text")
    parts = None
    for block in rest:
        hit = map_text(texts, "text", [_A, _B], _scores(docs.sparkSession, block, n), _KINDS).where(F.size("hits") > 0)
        part = written(hit.groupBy(_A, _B).agg(F.first("hits").alias(_HITS), F.first("items").alias(_ITEMS)))
        parts = part if parts is None else parts.union(part)
    return None if parts is None else parts.groupBy(_A, _B).agg(*[F.flatten(F.collect_list(c)).alias(c) for c in (_HITS, _ITEMS)])


def _pairs(flat: list[int]) -> list[tuple[int, int]]:
    return list(zip(flat[::2], flat[1::2]))


def _added(arrow: pa.Schema):
    """Hits and items of the first block with those of the others."""

    def run(batches):
        for b in batches:
            hits, names = b.column("hits").to_pylist(), b.column("items").to_pylist()
            for i, (more, others) in enumerate(zip(b.column(_HITS).to_pylist(), b.column(_ITEMS).to_pylist())):
                if more:
                    hits[i] = union(_pairs(hits[i]) + _pairs(more))
                    names[i] = sorted({*names[i], *others})
            data = {f.name: b.column(f.name) for f in b.schema} | {"hits": pa.array(hits, arrow.field("hits").type), "items": pa.array(names, arrow.field("items").type)}
            yield pa.RecordBatch.from_arrays([data[f.name].cast(f.type) for f in arrow], schema=arrow)

    return run


def without(text: str, hits: list[int]) -> str | None:
    """The text without hit words (start, end, ...); None if it goes whole."""
    at = [m.span() for m in _WORD.finditer(text)]
    if sum(hits[1::2]) - sum(hits[::2]) > WHOLE_SHARE * len(at):
        return None
    kept, last = [], 0
    for a, b in zip(hits[::2], hits[1::2]):
        kept.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join([*kept, text[last:]])


def cut(text: str, index: Index) -> str | None:
    """The text without hit spans; None if it goes whole. Cuts until nothing is hit."""
    while found := index.scan([words_of(text)]):
        text = without(text, union(found[0][0]))
        if text is None:
            break
    return text


def remove(docs: DataFrame, bench: DataFrame, n: int = WINDOW, text_col: str = "text", chars_col: str | None = "n_chars", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without hit spans, and without documents hit for over WHOLE_SHARE.

    All columns stay; clean rows are untouched. ``chars_col`` follows a cut text. With
    several blocks, all are scanned for before a document is judged and cut, again for
    the documents that were cut until none is hit: block sizes do not show. Only cut
    documents are written; the others are ``docs`` less those with a hit text.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    small_batches(spark)
    arrow = to_arrow_schema(docs.schema)
    some = blocks(bench, block_bytes)
    first = next(some, None)
    if first is None:
        return docs
    if next(some, None) is None:
        return docs.mapInArrow(_removal(arrow, uuid.uuid4().hex, spark.sparkContext.broadcast(first), n, text_col, chars_col), docs.schema)
    own = [F.col(f"`{c}`") for c in docs.columns]
    left, clean = docs, []
    while True:
        found = written(_found(left, text_col, blocks(bench, block_bytes), n))
        if found.isEmpty():
            break
        hashed = _hashed(left, text_col)
        clean.append(hashed.join(found, [_A, _B], "left_anti").select(*own))
        hit = hashed.join(found, [_A, _B]).select(*own, _HITS)
        left = written(hit.mapInArrow(_cutting(arrow, text_col, chars_col), docs.schema))
    for c in clean:
        left = left.union(c)
    return left


def _cutting(arrow: pa.Schema, text_col: str, chars_col: str | None):
    def run(batches):
        for b in batches:
            new = {i: without(t, union(_pairs(h))) for i, (t, h) in enumerate(zip(b.column(text_col).to_pylist(), b.column(_HITS).to_pylist()))}
            yield _replaced(b.drop_columns([_HITS]), new, arrow, text_col, chars_col)

    return run


def _replaced(b: pa.RecordBatch, new: dict[int, str | None], arrow: pa.Schema, text_col: str, chars_col: str | None) -> pa.RecordBatch:
    """``b`` with new texts by row; rows whose new text is None go."""
    data = {f.name: b.column(f.name) for f in b.schema}
    data[text_col] = pa.array([new.get(i, t) for i, t in enumerate(data[text_col].to_pylist())], arrow.field(text_col).type)
    if chars_col in data:
        old = data[chars_col].to_pylist()
        data[chars_col] = pa.array([len(new[i]) if new.get(i) is not None else c for i, c in enumerate(old)], arrow.field(chars_col).type)
    gone = {i for i, t in new.items() if t is None}
    b = pa.RecordBatch.from_arrays(list(data.values()), names=list(data))
    return b.filter(pa.array([i not in gone for i in range(b.num_rows)], pa.bool_()))


def _removal(arrow: pa.Schema, key, items, n: int, text_col: str, chars_col: str | None):
    def run(batches):
        for b in batches:
            texts = b.column(text_col).to_pylist()
            index = _index(key, items, n)
            new: dict[int, str | None] = {}
            for i, j in chunks(texts):
                for d in index.scan([words_of(t) for t in texts[i:j]]):
                    new[i + d] = cut(texts[i + d], index)
            if new:
                b = _replaced(b, new, arrow, text_col, chars_col)
            yield b

    return run


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS_SQL = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

QUERIES = {"op4_decontaminate": op4_decontaminate}
ORACLES = {
    "op4_decontaminate": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS_SQL} AS ws FROM documents),
i AS (SELECT item_id, {_WORDS_SQL} AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[k:k + n - 1], ' ') AS g
  FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS k FROM i WHERE len(ws) > 0)),
dw AS (
  SELECT rid, k, n, array_to_string(ws[k:k + n - 1], ' ') AS g
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM iw) WHERE len(ws) >= n)),
hits AS (SELECT rid, k, n, item_id FROM dw JOIN iw USING (n, g)),
hw AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(k, k + n)) AS p FROM hits) GROUP BY rid),
hi AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT rid, item_id::VARCHAR AS s FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN hi USING (rid)"""
}
