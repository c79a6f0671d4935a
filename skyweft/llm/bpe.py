"""Byte-level BPE encoding and decoding by a file of ranks.

A text is cut by the tokenizer's pattern and each match is encoded on its own. A match
that is a token itself is that token. The others' bytes become rows of padded numpy
matrices, bucketed by length: each round every row merges its leftmost pair of least
rank, pairs being looked up in a hashed table, and closes up by one column; a row that
has no pair left leaves. A match over MATRIX_BYTES is a row of its own that merges all
the leftmost pairs of the least rank at once, up to the first whose merge makes a pair of
lesser rank, which is what pair by pair would come to.

Decoding looks up each id's bytes. The pair table is broadcast; its size is bounded by
the vocabulary. Workers keep the ids of short matches; the cache only saves work.

Null and empty texts have no ids and decode to no bytes. Long texts are matched in blocks of
MATCHES. Repeated rows count each, an empty table gives no rows, and columns other than
those asked for are ignored, whatever their names. Null ids decode to null, an id that
is not in the vocabulary is an error.
"""

from __future__ import annotations

import base64
import uuid
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.llm.common import map_text, small_batches, table

#: Production parameters.
RANKS = "byte_bpe_50k.tiktoken"
#: Longest match that goes through the padded matrices.
MATRIX_BYTES = 512
#: Cells of a padded matrix at most, unless one row alone has more.
CELLS = 1 << 20
#: Matches of a text that are encoded at a time.
MATCHES = 200_000
#: A worker's cache: entries before it starts afresh, and the longest match kept.
CACHE_ENTRIES = 500_000
MOST_CACHED = 64

NONE = np.iinfo(np.int32).max
_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks, from lines of base64 and a number."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Pairs:
    """Hashed look-up: two tokens' ids to the id of the token that they make.

    Open addressing in two arrays of a power of two, at most half full.
    """

    def __init__(self, ranks: dict[bytes, int]):
        left, right, made = [], [], []
        for word, rank in ranks.items():
            for i in range(1, len(word)):
                a, b = ranks.get(word[:i]), ranks.get(word[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), made.append(rank)
        self.base = np.int64(max(ranks.values(), default=0) + 1)
        keys = np.array(left, np.int64) * self.base + np.array(right, np.int64)
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.made = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32)
        left_over, made = np.arange(len(keys)), np.array(made, np.int32)
        slot = self._slot(keys)
        while len(left_over):  # each round, one key takes each free slot and the rest move on
            s = slot[left_over]
            free = self.keys[s] < 0
            _, first = np.unique(s[free], return_index=True)
            put = left_over[free][first]
            self.keys[slot[put]], self.made[slot[put]] = keys[put], made[put]
            left_over = left_over[self.keys[s] != keys[left_over]]
            slot[left_over] = (slot[left_over] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs of any shape; NONE where they make no token or an id is negative."""
        key = a.astype(np.int64) * self.base + b
        slot = self._slot(key)
        out = self.made[slot]
        wrong = np.flatnonzero((self.keys[slot] != key).ravel())
        flat, out = key.ravel(), out.copy()
        at = slot.ravel()[wrong]
        while len(wrong):
            open_ = self.keys[at] >= 0
            out.ravel()[wrong[~open_]] = NONE
            wrong, at = wrong[open_], (at[open_] + 1) & self.mask
            hit = self.keys[at] == flat[wrong]
            out.ravel()[wrong[hit]] = self.made[at[hit]]
            wrong, at = wrong[~hit], at[~hit]
        out[(a < 0) | (b < 0)] = NONE
        return out


class Vocabulary:
    """Ranks and pair table: what is broadcast."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.pairs = ranks, Pairs(ranks)
        self.single = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        if (self.single < 0).any():
            raise ValueError("the vocabulary lacks single bytes")

    # --- many matches: length-bucketed padded matrices

    def merge_rows(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each of the words, none empty."""
        out: list = [None] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(size, kind="stable")
        i = 0
        while i < len(order):
            n = int(size[order[i]])
            if n > MATRIX_BYTES:
                out[order[i]] = self.merge_long(words[order[i]])
                i += 1
                continue
            # a bucket's rows are padded to the next power of two, or what is the longest there
            top = int(np.searchsorted(size[order], min(1 << (n - 1).bit_length(), MATRIX_BYTES), "right")) if n > 1 else i + 1
            width = int(size[order[top - 1]])
            bucket = order[i : min(top, i + max(1, CELLS // width))]
            self._merge_bucket(words, bucket, size, out)
            i += len(bucket)
        return out

    def _merge_bucket(self, words: list[bytes], rows: np.ndarray, size: np.ndarray, out: list) -> None:
        n = size[rows].copy()
        width = int(n.max())
        ids = np.full((len(rows), width), -1, np.int32)
        inside = np.arange(width) < n[:, None]
        ids[inside] = self.single[np.frombuffer(b"".join(words[i] for i in rows), np.uint8)]
        if width == 1:
            for i, a in zip(rows.tolist(), ids[:, 0].tolist()):
                out[i] = (a,)
            return
        rank = self.pairs.rank(ids[:, :-1], ids[:, 1:])
        while True:
            at = rank.argmin(1)  # the leftmost of the least
            k = np.arange(len(rows))
            least = rank[k, at]
            done = least == NONE
            if done.any():
                for i, own, m in zip(rows[done].tolist(), ids[done].tolist(), n[done].tolist()):
                    out[i] = tuple(own[:m])
                rows, n, ids, rank, at, least = (a[~done] for a in (rows, n, ids, rank, at, least))
                if not len(rows):
                    return
                most = int(n.max())
                if most < ids.shape[1]:
                    ids, rank = ids[:, :most], rank[:, : most - 1]
                k = np.arange(len(rows))
            width = ids.shape[1]
            ids = ids.copy()
            ids[k, at] = least
            # every row is one shorter: drop the right half of its pair
            keep = np.ones(ids.shape, bool)
            keep[k, at + 1] = False
            ids = ids[keep].reshape(len(rows), width - 1)
            keep = np.ones(rank.shape, bool)
            keep[k, at] = False
            rank = rank[keep].reshape(len(rows), width - 2)
            n -= 1
            if width == 2:
                rank = np.full((len(rows), 1), NONE, np.int32)
                ids = np.concatenate([ids, np.full((len(rows), 1), -1, np.int32)], axis=1)
                continue
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
            rank[left, at[left] - 1] = self.pairs.rank(ids[left, at[left] - 1], ids[left, at[left]])
            rank[right, at[right]] = self.pairs.rank(ids[right, at[right]], ids[right, at[right] + 1])

    # --- one long match

    def merge_long(self, word: bytes) -> tuple[int, ...]:
        """Ids of one long match: the pairs of the least rank, leftmost first, at once.

        Positions wait in a list for each rank. Merging does not change pairs further off,
        so the pairs of one rank can be merged together as long as none of the pairs that
        come of it, with the left neighbour merged and the right one not yet, ranks lower;
        the list is cut after the first that does.
        """
        import heapq

        ids = self.single[np.frombuffer(word, np.uint8)]
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)  # places next to each, n and -1 beyond the ends
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def wait(at: np.ndarray, rank: np.ndarray) -> None:
            known = rank != NONE
            at, rank = at[known], rank[known]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for part, r in zip(np.split(at, cuts), rank[np.append(0, cuts)].tolist() if len(rank) else ()):
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(ranks, r)
                waiting[r].append(part)

        def pair(at: np.ndarray) -> np.ndarray:
            """Ranks of the pairs that begin at places, which may be beyond an end or gone."""
            inside = (at >= 0) & (at < n)
            at = np.where(inside, at, 0)
            right = after[at]
            inside &= (right < n) & (ids[at] >= 0)
            return self.pairs.rank(np.where(inside, ids[at], -1), ids[np.where(right < n, right, 0)])

        wait(np.arange(n - 1), self.pairs.rank(ids[:-1], ids[1:]))
        while ranks:
            r = ranks[0]
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[pair(at) == r]
            if not len(at):
                heapq.heappop(ranks)
                continue
            # of pairs that overlap in a chain every other one is merged, from the left
            chained = np.append(False, after[at[:-1]] == at[1:])
            start = np.flatnonzero(~chained)
            place = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
            todo = at[place % 2 == 0]
            second = after[todo]
            beyond = after[second]
            # what each merge makes, its left neighbour merged if it is in the list
            prior = before[todo]
            merged = np.append(False, (second[:-1] == prior[1:]))
            whole = np.full(len(todo), r, np.int32)
            left = self.pairs.rank(np.where(merged, r, np.where(prior >= 0, ids[prior], -1)).astype(np.int32), whole)
            right = self.pairs.rank(whole, np.where(beyond < n, ids[np.minimum(beyond, n - 1)], -1).astype(np.int32))
            lower = np.flatnonzero((left < r) | (right < r))
            if len(lower):
                rest = at[at > todo[lower[0]]]
                todo, second, beyond, prior = (a[: lower[0] + 1] for a in (todo, second, beyond, prior))
                waiting[r] = [rest]
            else:
                heapq.heappop(ranks)
            ids[todo], ids[second] = r, -1
            after[todo] = beyond
            inside = beyond < n
            before[beyond[inside]] = todo[inside]
            near = np.unique(np.concatenate([before[todo][before[todo] >= 0], todo]))
            wait(near, pair(near))
        return tuple(ids[ids >= 0].tolist())


class Encoder(dict):
    """Ids of matches, as a cache that encodes what it misses; one per worker."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        import regex

        super().__init__()
        self.vocabulary, self.find = vocabulary, regex.compile(pattern)

    def encode(self, texts: list) -> list[list[int]]:
        """Ids of each text, [] for None."""
        if len(self) > CACHE_ENTRIES:
            self.clear()
        out: list[list[int]] = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        count = 0
        for k, text in enumerate(texts):
            if not text:
                continue
            if len(text) <= MATCHES:
                held.append((k, self.find.findall(text)))
                count += len(held[-1][1])
            else:
                found = (m.group() for m in self.find.finditer(text))
                while block := list(islice(found, MATCHES)):
                    self._flush(held, out)
                    held, count = [(k, block)], 0
                    self._flush(held, out)
                    held = []
            if count > MATCHES:
                self._flush(held, out)
                held, count = [], 0
        self._flush(held, out)
        return out

    def _flush(self, held: list[tuple[int, list[str]]], out: list[list[int]]) -> None:
        """Append the ids of matches to their texts'; what isn't known is merged together."""
        missed = [m for m in set(chain.from_iterable(ms for _, ms in held)) if m not in self]
        long: list[str] = []
        if missed:
            ranks, unknown, raw = self.vocabulary.ranks, [], []
            for m in missed:
                b = m.encode()
                if len(m) > MOST_CACHED:
                    long.append(m)
                r = ranks.get(b)
                if r is None:
                    unknown.append(m)
                    raw.append(b)
                else:
                    self[m] = (r,)
            self.update(zip(unknown, self.vocabulary.merge_rows(raw)))
        for k, matches in held:
            out[k].extend(chain.from_iterable(map(self.__getitem__, matches)))
        for m in long:
            del self[m]


_WORKER: dict[str, Encoder] = {}


def _encoder(key: str, vocabulary, pattern: str) -> Encoder:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Encoder(vocabulary.value, pattern)
    return _WORKER[key]


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``ids``, an array of ints, of each row's text. No shuffle."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(path)))
    key = uuid.uuid4().hex

    def score(texts: list) -> dict:
        found = _encoder(key, vocabulary, pattern).encode(texts)
        flat = np.fromiter(chain.from_iterable(found), np.int32, sum(map(len, found)))
        offsets = np.append(0, np.cumsum([len(x) for x in found])).astype(np.int32)
        return {"ids": pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))}

    return map_text(docs, text_col, keep, score, [("ids", T.ArrayType(T.IntegerType()))])


def decode(encoded: DataFrame, path: str, keep: list[str], ids_col: str = "ids") -> DataFrame:
    """``keep`` columns and ``bytes``, what each row's ids stand for. No shuffle."""
    small_batches(encoded.sparkSession)
    words = encoded.sparkSession.sparkContext.broadcast({r: w for w, r in read_ranks(path).items()})
    src = encoded.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, ids_col])])
    schema = T.StructType([*[src.schema[c] for c in keep], T.StructField("bytes", T.BinaryType())])

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for b in batches:
            word = words.value.__getitem__
            made = [None if ids is None else b"".join(map(word, ids)) for ids in _lists(b.column(ids_col))]
            yield pa.RecordBatch.from_arrays([*[b.column(c).cast(arrow.field(c).type) for c in keep], pa.array(made, arrow.field("bytes").type)], schema=arrow)

    return src.mapInArrow(run, schema)


def _lists(column: pa.ListArray):
    """Each row's list, one at a time, so that a batch is never Python objects as a whole."""
    for i in range(len(column)):
        yield column[i].values.to_numpy(zero_copy_only=False).tolist() if column[i].is_valid else None


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(RANKS)
    docs = encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, ["doc_id"])
    told = docs.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"))
    back = decode(told, path, ["doc_id", "n_tokens", "ids_sha256"])
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("bytes"), 256).alias("decoded_sha256"))


QUERIES = {"op13_bpe": op13_bpe}
ORACLES: dict[str, str] = {}
