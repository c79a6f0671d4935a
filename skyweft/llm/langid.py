"""Language identification of whole, possibly mixed texts.

Words are runs of letters. A word's script, from the ranges of its letters, narrows
the candidate languages to those whose training text is in that script (all if there
are none). Its score under a language is the mean log likelihood of its character
1- to 4-grams, word ends marked, times the root of its number of letters. Viterbi
over the words, with a penalty for each switch, labels spans; the prediction is the
language with the most letters, those of the language that the text opens in counting
more by a share fitted on the training texts (a mixed text's language is mostly the one
it opens in). The score is the prediction's posterior share: the mean, by letters, of
the chance that each word's scores give it within its surroundings.

Learned from a bounded sample of texts with a lang that are not held out: at most
PER_LANG documents a language and TRAIN_BYTES of text in all, of which each language
has the same share and one text at least (texts over a twentieth of it are passed
over). No language is left out. lang, source and id are no inputs of a prediction.
A text is labelled whole; a very long one is worked through in blocks. Languages are
held to be few: what comes to the driver (eight ids or more, and one text, of each) and the
model's weights grow with their number.

Null texts and texts without a letter are ``und`` with score 0. Ties go to the
language that is smaller by code point. With nothing learned all is ``und``.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.llm.common import fetch_texts, filter_text, groups_by_length, held_out, map_text, table

#: Production parameters.
PER_LANG = 500
#: Training ids in all; with very many languages each gets a share of these and of the bytes.
MOST_IDS = 100_000
TRAIN_BYTES = 8 << 20
BUCKETS = 1 << 16
ORDERS = (1, 2, 3, 4)
SWITCH = 6.0
#: Shares tried for the opening language.
OPENING = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6)
CACHE_WORDS = 400_000
#: Numbers (words x languages) that a worker's arrays hold at a time.
CELLS = 1 << 19
UNKNOWN = "und"
#: In a filter, documents under this score are rejected with the ``und`` ones.
LEAST_SCORE = 0.1

_WORD = re.compile(r"[^\W\d_]+")
#: First and last code points of scripts (fixed values, from Unicode's blocks).
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)),
}


def script_of(word: str) -> str:
    """The script of the word's first letter within a known range."""
    for c in word:
        o = ord(c)
        for name, ranges in SCRIPTS.items():
            if any(a <= o <= b for a, b in ranges):
                return name
    return "other"


def has_letter(text: str | None) -> bool:
    """Whether a character of Unicode class L is in the text."""
    return bool(text) and any(map(str.isalpha, text))


def gram_buckets(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams that begin at each character of the words, ends marked, a
    row an order (-1 where none begins), and where each word begins among the characters.

    The hash is of code points and order only, so it is alike in every process.
    """
    code = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(size) - size
    left = np.repeat(starts + size, size) - np.arange(len(code))
    out = np.full((len(ORDERS), len(code)), -1, np.int64)
    h = np.zeros(len(code), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        k = len(code) - n + 1
        h[:k] = h[:k] * np.uint64(0x100000001B3) + code[n - 1 :] + np.uint64(n)
        if n in ORDERS:
            ok = left >= n
            out[ORDERS.index(n), ok] = (h[ok] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)) % np.uint64(buckets)
    return out, starts


def buckets_for(langs: int) -> int:
    """BUCKETS, fewer for over 256 languages down to 4,096, from where a model grows with them."""
    return max(1 << 12, min(BUCKETS, 1 << (24 - max(langs - 1, 1).bit_length())))


class Model:
    """Log likelihoods of character n-grams and the scripts of each language."""

    def __init__(self, langs: list[str], weights: np.ndarray, scripts: dict[str, list[int]]):
        self.langs, self.weights, self.scripts = langs, weights, scripts
        self.opening = 0.0
        self._reset()

    def __getstate__(self):
        return (self.langs, self.weights, self.scripts, self.opening)

    def __setstate__(self, state):
        self.langs, self.weights, self.scripts, self.opening = state
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.langs)), np.float32)
        # index -1 is no gram
        self.padded = np.concatenate([self.weights, np.zeros((1, len(self.langs)), np.float32)])

    def _learn(self, words: list[str]) -> None:
        grams, starts = gram_buckets(words, len(self.weights))
        letters = np.fromiter(map(len, words), np.int64, len(words))
        sizes = sum(np.maximum(letters + 3 - n, 0) for n in ORDERS)
        sums = sum(np.add.reduceat(self.padded[g], starts, axis=0) for g in grams)
        scores = sums / sizes[:, None] * np.sqrt(letters)[:, None] * 3
        script = list(map(script_of, words))
        for name in set(script):
            ok = self.scripts.get(name)
            if ok and len(ok) < len(self.langs):
                i = np.array([s == name for s in script])
                out = np.ones(len(self.langs), bool)
                out[ok] = False
                scores[np.ix_(i, out)] = (scores[i].min(1) - 20)[:, None]
        scores -= scores.max(1, keepdims=True)
        n = len(self.index)
        if n + len(words) > len(self.table):
            grown = np.zeros((2 * (n + len(words)), len(self.langs)), np.float32)
            grown[:n] = self.table[:n]
            self.table = grown
        self.table[n : n + len(words)] = scores
        self.index.update(zip(words, range(n, n + len(words))))

    def ids(self, flat: list[str]) -> np.ndarray:
        if len(self.index) > CACHE_WORDS:
            self._reset()
        new = sorted(set(flat).difference(self.index))
        some = max(64, CELLS // (8 * max(1, len(self.langs))))
        for i in range(0, len(new), some):
            self._learn(new[i : i + some])
        return np.array(list(map(self.index.__getitem__, flat)), np.int64)

    def spans(self, texts: list) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text: its words' letters, Viterbi labels and posterior of the label.

        Words without a letter of class L are left out.
        """
        words = [_words(t) for t in texts]
        n = np.fromiter(map(len, words), np.int64, len(words))
        flat = list(chain.from_iterable(words))
        ids = self.ids(flat)
        letters = np.array(list(map(len, flat)), np.int64)
        label, chance = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.float32)
        starts = np.cumsum(n) - n
        for group in groups_by_length(n, CELLS // max(4, len(self.langs))):
            self._viterbi(ids, starts[group], n[group], label, chance)
        return [(letters[a : a + k], label[a : a + k], chance[a : a + k]) for a, k in zip(starts, n)]

    def _scores(self, ids: np.ndarray, starts: np.ndarray, n: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores [step, text, language] of the words lo .. hi - 1 of texts, 0 past their
        ends; which words there are, and their numbers."""
        steps = np.arange(lo, hi)[:, None]
        live = (steps < n[None, :]) & (steps >= 0)
        at = np.where(live, starts[None, :] + steps, 0)
        e = self.table[ids[at]]
        e[~live] = 0
        return e, live, at

    def _viterbi(self, ids: np.ndarray, starts: np.ndarray, n: np.ndarray, label: np.ndarray, chance: np.ndarray) -> None:
        """Labels and chances of the texts' words, in blocks of steps of about CELLS
        numbers: what a long text keeps is a bit a word and language, and a best one."""
        top, docs, langs = int(n[0]), len(n), len(self.langs)
        block = max(1, CELLS // (docs * langs))
        rows = np.arange(docs)
        kept = []
        v = np.zeros((docs, langs), np.float32)
        for lo in range(0, top, block):
            e, _, _ = self._scores(ids, starts, n, lo, min(top, lo + block))
            stay, best = np.ones(e.shape, bool), np.zeros(e.shape[:2], np.int32)
            for k in range(len(e)):
                if lo + k:
                    b = v.argmax(1)
                    jump = v[rows, b][:, None] - SWITCH
                    stay[k], best[k] = v >= jump, b
                    v = np.where(stay[k], v, jump)
                v = v + e[k]
            v = v - v.max(1, keepdims=True)
            kept.append((np.packbits(stay, axis=None), best))
        now = v.argmax(1)
        for lo in range((top - 1) // block * block, -1, -block):
            hi = min(top, lo + block)
            bits, best = kept.pop()
            stay = np.unpackbits(bits, count=(hi - lo) * docs * langs).astype(bool).reshape(hi - lo, docs, langs)
            path = np.zeros((hi - lo, docs), np.int64)
            for k in range(hi - lo - 1, -1, -1):
                path[k] = now
                if lo + k:
                    now = np.where(stay[k, rows, now], now, best[k])
            # the word's chance of its label, its neighbours' scores counting half
            e, _, _ = self._scores(ids, starts, n, lo - 1, hi + 1)
            _, live, at = self._scores(ids, starts, n, lo, hi)
            near = e[1:-1] + 0.5 * (e[:-2] + e[2:])
            near -= near.max(2, keepdims=True)
            p = np.exp(near)
            p = np.take_along_axis(p, path[:, :, None], 2)[:, :, 0] / p.sum(2)
            label[at[live]] = path[live]
            chance[at[live]] = p[live]

    def choose(self, letters: np.ndarray, label: np.ndarray, opening: float) -> int:
        by = np.bincount(label, weights=letters, minlength=len(self.langs))
        by[label[0]] += opening * letters.sum()
        return int(by.argmax())

    def predict(self, texts: list) -> tuple[list[str], np.ndarray]:
        langs, scores = [], np.zeros(len(texts))
        found = self.spans(texts) if self.langs else [None] * len(texts)
        for i, (t, f) in enumerate(zip(texts, found)):
            if f is None or not len(f[0]):
                langs.append(UNKNOWN)
                continue
            letters, label, chance = f
            k = self.choose(letters, label, self.opening)
            mine = label == k
            langs.append(self.langs[k])
            scores[i] = min(1.0, float((letters * chance * mine).sum() / letters.sum()))
        return langs, scores


def _words(text: str | None) -> list[str]:
    if not text:
        return []
    words = _WORD.findall(text.lower())
    if text.isascii():
        return words
    out = []
    for w in words:
        # the pattern also takes numerals such as superscripts
        if not w.isalpha():
            w = "".join(filter(str.isalpha, w))
        if w:
            out.append(w)
    if not out and has_letter(text):
        out = ["".join(filter(str.isalpha, unicodedata.normalize("NFC", text.lower()))) or "?"]
    return out


def train(rows: list[tuple]) -> Model:
    """A model of (text, lang) rows."""
    langs = sorted({r[1] for r in rows})
    buckets = buckets_for(len(langs))
    counts = np.zeros((buckets, len(langs)))
    letters: dict[str, np.ndarray] = {}
    seen: list[Counter] = [Counter() for _ in langs]
    for text, lang in rows:
        seen[langs.index(lang)].update(_words(text))
    for k, found in enumerate(seen):
        words = list(found)
        for w in words:
            letters.setdefault(script_of(w), np.zeros(len(langs)))[k] += found[w] * len(w)
        if words:
            grams, _ = gram_buckets(words, buckets)
            times = np.repeat(np.fromiter(map(found.__getitem__, words), float, len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 2)
            for g in grams:
                counts[:, k] += np.bincount(g[g >= 0], weights=times[g >= 0], minlength=buckets)
    smooth = counts + 0.2
    weights = np.log(smooth / smooth.sum(0)) if len(langs) else smooth
    total = sum(letters.values()) if letters else np.zeros(len(langs))
    scripts = {s: np.flatnonzero(n >= 0.005 * np.maximum(total, 1)).tolist() for s, n in letters.items()}
    model = Model(langs, weights.astype(np.float32), scripts)
    found = [(f, langs.index(lang)) for (_, lang), f in zip(rows, model.spans([t for t, _ in rows])) if len(f[0])] if rows else []
    right = {b: sum(model.choose(f[0], f[1], b) == k for f, k in found) for b in OPENING}
    model.opening = max(OPENING, key=lambda b: (right[b], -b))
    model._reset()
    return model


# ---- Spark -------------------------------------------------------------------------


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model of the bounded sample: for each lang the smallest ids by hash."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    per = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("l"), F.xxhash64(F.col(id_col), F.lit(23)).alias("h"))
    langs = [r["l"] for r in per.select("l").distinct().collect()]
    if not langs:
        return train([])
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h", "id"))
    # a task passes on no more than the ranks asked for, so a frequent lang is no hot key
    top = per.withColumn("n", rank).where(F.col("n") <= max(8, min(PER_LANG, MOST_IDS // len(langs)))).orderBy("l", "n")
    ids = {r["id"]: (r["h"], r["l"]) for r in top.collect()}
    return train(fetch_texts(docs, ids, TRAIN_BYTES, id_col, text_col, {lang: TRAIN_BYTES // len(langs) for lang in langs}))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred and score of every row; the model is broadcast, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: list) -> dict:
        langs, scores = shared.value.predict(texts)
        return {"lang_pred": langs, "score": scores}

    return map_text(docs, text_col, [id_col], score, [("lang_pred", T.StringType()), ("score", T.DoubleType())])


def keep_known(docs: DataFrame, model: Model, least: float = LEAST_SCORE, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known with at least that score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(texts: list) -> np.ndarray:
        langs, scores = shared.value.predict(texts)
        return (scores >= least) & np.array([x != UNKNOWN for x in langs], bool)

    return filter_text(docs, text_col, keep)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, trained(docs)).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op9_language_id": op9_language_id}
ORACLES: dict[str, str] = {}
