"""Token counts: map-side two-tier lookup, without a shuffle of pre-tokens.

Tier one is a broadcast table of the lengths of the most frequent chunks of a
bounded sample. Tier two is a cache
in each Python worker; what both miss is encoded by the tokenizer library itself.
The table and caches only save work: every length in them is the library's.

Texts are cut at spaces, tabs and line breaks. The tokenizer drops white space
between pre-tokens and no pre-token, special token or normalisation crosses it,
so a text's count is the sum over its chunks. A chunk is lower-cased and
split if it is Latin-1 without ``<|``, as the tokenizer would do itself; any other
chunk goes through the library whole.

Null and empty texts have 0 bytes and 0 tokens. Repeated rows count each. Texts are read
whole, a very long one alone. An empty table gives no rows. Columns other than the id and
the text are ignored, whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.llm.common import fetch_texts, map_text, table

#: Production parameters.
TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: Tier one: most frequent chunks kept, from at most so many sampled rows.
FREQUENT = 60_000
SAMPLE_ROWS = 1000
SAMPLE_BYTES = 8 << 20
#: Tier two: entries of a worker's cache before it starts afresh.
CACHE_ENTRIES = 600_000
#: Longer chunks (encoded data, addresses) seldom come again and are not kept.
MOST_CACHED = 64

#: Letters and numbers of Latin-1, lower case (fixed values of Unicode classes L and N).
_L, _N = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
#: The tokenizer's split pattern over those.
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\x09-\x0d\x20\x85\xa0{_L}{_N}]+")
_LATIN = re.compile("[\x00-\xff]*").fullmatch


def byte_chars() -> dict[int, str]:
    """Byte-level BPE's character for each byte: itself if printable, else the next from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


_BYTE_CHARS = byte_chars()


def split_chunks(text: str | None) -> list[str]:
    """Cut at space, tab and line breaks; empty chunks stay and count nothing."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if text else []


class Pieces(dict):
    """Token counts of lower-case Latin-1 pre-tokens, by the library's model."""

    def __init__(self, tok):
        self.tokenize = tok.model.tokenize

    def __missing__(self, piece: str) -> int:
        shown = piece if piece.isascii() and piece.isalnum() else piece.encode().decode("latin-1").translate(_BYTE_CHARS)
        n = len(self.tokenize(shown))
        if len(piece) <= MOST_CACHED:
            self[piece] = n
        return n


class Chunks(dict):
    """Token counts of chunks; tier one to begin with, misses are encoded and kept."""

    def __init__(self, tok, frequent: dict[str, int]):
        super().__init__(frequent)
        self.tok, self.pieces = tok, Pieces(tok)
        self[""] = 0

    def __missing__(self, chunk: str) -> int:
        if _LATIN(chunk) and "<|" not in chunk:
            # Latin-1 is in NFC and has one-to-one lower case
            n = sum(map(self.pieces.__getitem__, _PIECE.findall(chunk.lower())))
        else:
            n = len(self.tok.encode(chunk, add_special_tokens=False).ids)
        if len(chunk) <= MOST_CACHED:
            self[chunk] = n
        return n


class Counts:
    """Token counts of texts by the two tiers; one per worker and tokenizer."""

    def __init__(self, path: str, frequent: dict[str, int]):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.frequent = frequent
        self.cache = Chunks(self.tok, frequent)

    def count(self, texts: list) -> np.ndarray:
        if len(self.cache) > CACHE_ENTRIES + len(self.frequent) or len(self.cache.pieces) > CACHE_ENTRIES:
            self.cache = Chunks(self.tok, self.frequent)
        get = self.cache.__getitem__
        return np.fromiter((sum(map(get, split_chunks(t))) for t in texts), np.int64, len(texts))


_WORKER: dict[tuple, Counts] = {}


def _counter(key: tuple, path: str, frequent) -> Counts:
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Counts(path, frequent.value)
    return _WORKER[key]


def frequent_lengths(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> dict[str, int]:
    """The broadcast tier: at most FREQUENT chunks of a sample with their lengths.

    The sample is SAMPLE_ROWS documents, the smallest ids by hash, of SAMPLE_BYTES in
    all. Which they are bears on speed only.
    """
    order = F.xxhash64(F.col(id_col), F.lit(29))
    ids = {r["i"]: (r["h"], 0) for r in docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("i"), order.alias("h")).orderBy("h", "i").limit(SAMPLE_ROWS).collect()}
    seen: Counter = Counter()
    for text, _ in fetch_texts(docs, ids, SAMPLE_BYTES, id_col, text_col):
        seen.update(c for c in split_chunks(text) if len(c) <= MOST_CACHED)
    get = Counts(path, {}).cache.__getitem__
    return {c: get(c) for c, _ in seen.most_common(FREQUENT)}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """id, n_bytes, n_tokens and over_limit of every row of ``docs``."""
    spark = docs.sparkSession
    frequent = spark.sparkContext.broadcast(frequent_lengths(docs, path, id_col, text_col))
    key = (path, uuid.uuid4().hex)

    def score(texts: list) -> dict:
        n = _counter(key, path, frequent).count(texts)
        size = np.fromiter((len(t.encode()) if t else 0 for t in texts), np.int64, len(texts))
        return {"n_bytes": size, "n_tokens": n, "over_limit": n > limit}

    return map_text(docs, text_col, [id_col], score, [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())])


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


QUERIES = {"op5_token_counts": op5_token_counts}
ORACLES: dict[str, str] = {}
