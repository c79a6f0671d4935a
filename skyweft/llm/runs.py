"""Periodic runs of words: multi-scale minimizers find them, exact checks confirm them.

A run is a stretch of words with smallest period q, at least REPEATS times as long as q and
LEAST words long, that no neighbouring word extends. All runs of a text are found:

* Periods under SHORT are direct lag scans: stretches where words q apart are equal.
* A scale covers periods from W to 2W - 1, W a power of two. Hashes of 2W words, made by
  doubling, are all different within a period. Their minima over windows of W
  positions (the minimizers) repeat at the distance of the period, nothing equal between
  them, so neighbours of equal hash that are W to 2W - 1 apart seed all runs of the scale.
  Seeds of one distance within W of each other are one stretch; of a run it spans all
  but W - 1 words at either end, so it is extended by so many at most and its words are
  then compared one by one.
* Of stretches that begin and end alike, the one of the smallest period is the run: over
  four periods, a stretch whose smallest period is shorter has that one's ends.

Texts are joined into one array of word numbers for each 4 MB or so, longest first, a
number of its own between them; a scale reads only those texts long enough for it. Work is
n log^2 n for n words, whatever they are.

Null texts have no words. A text of white space only has none either; its collapsed
text is empty. Long texts are whole; about 20 bytes of memory a byte. Repeated rows count
each; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.llm.common import map_text, small_batches, table

#: A run's length is at least so many periods, and so many words.
REPEATS, LEAST = 4, 6
#: Periods below are scanned directly; a power of two.
SHORT = 8

_ODD = np.uint64(0x9E3779B97F4A7C15)
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def words_of(text: str | None) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+``, as UTF-8."""
    return text.encode().split() if text else []


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD
    return x ^ (x >> np.uint64(29))


def find_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Of each word list, its runs by start, then period: rows of start, length, period."""
    out = [np.zeros((0, 3), np.int64) for _ in texts]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    order = [i for i in np.argsort(-size, kind="stable").tolist() if size[i] >= LEAST]
    if not order:
        return out
    numbers = _Numbers()
    x = np.full(int(size[order].sum()) + len(order), -1, np.int64)
    begin = np.cumsum(np.append(0, size[order] + 1))[:-1]
    for i, b in zip(order, begin.tolist()):
        x[b : b + size[i]] = np.fromiter(map(numbers.__getitem__, texts[i]), np.int64, size[i])
    gap = begin + size[order]
    x[gap] = len(numbers) + np.arange(len(gap))
    found = [_direct(x, q) for q in range(1, SHORT)]
    h, width = _mix(x.astype(np.uint64) + _ODD), 1
    w = SHORT
    while True:
        n = int((size[order] >= REPEATS * w).sum())
        if not n:
            break
        h = h[: int(gap[n - 1]) + 1]
        while width < 2 * w:
            h = _mix(h[: max(0, len(h) - width)] * np.uint64(3) + h[width:] * _ODD)
            width *= 2
        found.append(_scale(x[: int(gap[n - 1]) + 1], h, w))
        w *= 2
    runs = np.concatenate(found)
    if not len(runs):
        return out
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    runs = runs[np.append(True, (np.diff(runs[:, :2], axis=0) != 0).any(1))]  # the smallest period of each stretch
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    of = np.searchsorted(begin, runs[:, 0], "right") - 1
    runs[:, 0] -= begin[of]
    cuts = np.flatnonzero(np.diff(of)) + 1
    for k, part in zip(of[np.append(0, cuts)].tolist(), np.split(runs, cuts)):
        out[order[k]] = part
    return out


def _long(start: np.ndarray, equal: np.ndarray, q) -> np.ndarray:
    """Runs of stretches of ``equal`` words that are as the word q further on."""
    length = equal + q
    ok = length >= np.maximum(LEAST, REPEATS * q)
    return np.stack([start, length, np.broadcast_to(q, start.shape)], axis=1)[ok]


def _direct(x: np.ndarray, q: int) -> np.ndarray:
    same = np.concatenate([[False], x[:-q] == x[q:], [False]]) if len(x) > q else np.zeros(2, bool)
    edge = np.flatnonzero(same[1:] != same[:-1])
    return _long(edge[::2], edge[1::2] - edge[::2], q)


def _scale(x: np.ndarray, h: np.ndarray, w: int) -> np.ndarray:
    """Runs of periods w to 2w - 1, by the hashes ``h`` of 2w words at each place."""
    none = np.zeros((0, 3), np.int64)
    if len(h) < w:
        return none
    bits = np.uint64(len(h).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # of equal hashes, the first place
    span = 1
    while span < w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    at = np.unique(least[np.append(True, least[1:] != least[:-1])] & low).astype(np.int64)
    at = at[np.argsort(h[at], kind="stable")]
    far = np.diff(at)
    seed = (h[at[1:]] == h[at[:-1]]) & (far >= w) & (far < 2 * w)
    at, q = at[:-1][seed], far[seed]
    if not len(at):
        return none
    order = np.lexsort((at, q))
    at, q = at[order], q[order]
    new = np.append(True, (np.diff(q) != 0) | (np.diff(at) > w))
    first, last = at[new], at[np.append(np.flatnonzero(new)[1:], len(at)) - 1]
    q = q[new]
    end = last + 2 * w
    ok = end - first >= 3 * q - 2 * w + 2  # as much of a run is spanned at least
    first, end, q = first[ok], end[ok], q[ok]
    start, stop = first - _alike(x, first, q, w, -1), end + _alike(x, end, q, w, 1)
    ok = (start > first - w) & (stop < end + w) & (stop - start >= (REPEATS - 1) * q)
    start, stop, q = start[ok], stop[ok], q[ok]
    # hashes said that the words between are alike: now the words themselves
    size = stop - start
    place = np.repeat(start - np.append(0, np.cumsum(size)[:-1]), size) + np.arange(size.sum())
    differ = x[place] != x[place + np.repeat(q, size)]
    wrong = np.zeros(len(q), bool)
    wrong[np.repeat(np.arange(len(q)), size)[differ]] = True
    return _long(start[~wrong], size[~wrong], q[~wrong])


def _alike(x: np.ndarray, at: np.ndarray, q: np.ndarray, most: int, way: int) -> np.ndarray:
    """How many words from ``at`` on (way 1), or before it (-1), are as those q further; ``most`` at most."""
    out = np.zeros(len(at), np.int64)
    live = np.arange(len(at))
    step = 0
    while len(live) and step < most:
        here = at[live] + (step if way > 0 else -1 - step)
        inside = (here >= 0) & (here + q[live] < len(x))
        here = np.where(inside, here, 0)
        same = inside & (x[here] == x[np.where(inside, here + q[live], 0)])
        live = live[same]
        out[live] += 1
        step += 1
    return out


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words lie in a run after its first period."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge[:-1]) > 0


def greatest(runs: np.ndarray) -> tuple[int, int, int]:
    """The run of the greatest length/period; of equals the first, then the shortest period."""
    return max(map(tuple, runs.tolist()), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))


def periodic_runs(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``runs`` (an array of start, length, period by start, then period),
    ``best`` (the run of greatest exponent, or null) and ``collapsed``: the text's words, one
    space between, without the repeats of its runs. No shuffle."""

    def score(texts: list) -> dict:
        words = [words_of(t) for t in texts]
        runs = find_runs(words)
        best = [greatest(r) if len(r) else None for r in runs]
        left = [b" ".join(np.array(w, object)[~dropped(len(w), r)].tolist() if len(r) else w).decode() for w, r in zip(words, runs)]
        flat = np.concatenate([np.zeros((0, 3), np.int64), *runs])
        offsets = np.append(0, np.cumsum([len(r) for r in runs])).astype(np.int32)
        rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=RUN.names)
        return {"runs": pa.ListArray.from_arrays(pa.array(offsets), rows), "best": [dict(zip(RUN.names, b)) if b else None for b in best], "collapsed": left}

    return map_text(docs, text_col, keep, score, [("runs", T.ArrayType(RUN)), ("best", RUN), ("collapsed", T.StringType())])


def plant(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The contract's periods: for one document in ten, words from a place on repeat."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text of documents, the periods of :func:`plant` put in; null ids get none."""
    small_batches(docs.sparkSession)
    src = docs.select("doc_id", "text")

    def run(batches):
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            new = [(i, d) for i, d in enumerate(ids) if d is not None and zlib.crc32(str(d).encode()) % 10 == 0]
            made = {i: b" ".join(plant(words_of(texts[i].as_py()), d)).decode() for i, d in new}
            out = pa.array([made.get(i) if i in made else texts[i].as_py() for i in range(len(ids))], texts.type) if made else texts
            yield pa.RecordBatch.from_arrays([b.column(0), out], names=["doc_id", "text"])

    return src.mapInArrow(run, src.schema)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(planted(table(spark, sf_dir, "documents")), ["doc_id"])
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    best = [F.col(f"best.{c}").alias(c) for c in RUN.names]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *best,
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


QUERIES = {"op11_runs": op11_runs}
ORACLES: dict[str, str] = {}
